"""Casts that give NULL for text that does not fit the target type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text forms a safe cast accepts, after trimming.
DATE_FORM = r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"
TIMESTAMP_FORM = (
    r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])"
    r"( ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.[0-9]{1,9})?)?$"
)
INTEGER_FORM = r"^[+-]?[0-9]+$"
PLAIN_NUMBER_FORM = r"^[+-]?([0-9]+(\.[0-9]+)?|\.[0-9]+)$"
EXPONENT_FORM = r"^[+-]?([0-9]+(\.[0-9]+)?|\.[0-9]+)[eE][+-]?[0-9]+$"
NUMBER_FORM = r"^[+-]?([0-9]+(\.[0-9]+)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"

# The words read as booleans.
TRUE_WORDS = ("true", "1")
FALSE_WORDS = ("false", "0")
TRUE_NUMBER_WORDS = ("true", "1", "1.0")
FALSE_NUMBER_WORDS = ("false", "0", "0.0")


def _words_to_boolean(text: Column, true_words, false_words) -> Column:
    word = F.lower(text)
    return F.when(word.isin(*true_words), F.lit(True)).when(
        word.isin(*false_words), F.lit(False)
    )


def safe_cast(value: Column, target: str) -> Column:
    """Cast ``value`` to ``target``; NULL where the trimmed text has another form.

    The form is checked first because ``try_cast`` alone is more lenient
    (it reads ``2018`` as a date). ``try_cast`` then covers what a pattern
    cannot: 30 February, overflow.
    """
    kind = target.strip().upper()
    text = F.trim(value.cast("string"))
    if kind == "DATE":
        return F.when(text.rlike(DATE_FORM), text.try_cast("date"))
    if kind == "TIMESTAMP":
        return F.when(text.rlike(TIMESTAMP_FORM), text.try_cast("timestamp_ntz"))
    if kind in ("INT", "INTEGER", "BIGINT", "SMALLINT"):
        return F.when(text.rlike(INTEGER_FORM), text.try_cast(kind))
    if kind.startswith(("DECIMAL", "NUMERIC")):
        return F.when(text.rlike(PLAIN_NUMBER_FORM), text.try_cast(kind)).when(
            text.rlike(EXPONENT_FORM), text.try_cast("double").try_cast(kind)
        )
    if kind in ("DOUBLE", "FLOAT"):
        return F.when(text.rlike(NUMBER_FORM), text.try_cast(kind))
    if kind in ("BOOLEAN", "BOOL"):
        return _words_to_boolean(text, TRUE_WORDS, FALSE_WORDS)
    return value.cast(target)


def boolean_from_number_words(value: Column) -> Column:
    """Boolean that also reads ``1.0`` and ``0.0`` (flags exported as floats)."""
    return _words_to_boolean(value, TRUE_NUMBER_WORDS, FALSE_NUMBER_WORDS)


def integral_to_int(value: Column) -> Column:
    """Integer from number text such as ``100.0``; NULL when it has a fraction."""
    number = safe_cast(value, "DOUBLE")
    return F.when(number == F.floor(number), number.try_cast("int"))


def cast_failed(raw: Column, typed: Column) -> Column:
    """True where there was text to cast and the cast gave nothing."""
    return raw.isNotNull() & (F.trim(raw.cast("string")) != "") & typed.isNull()


def cast_failed_flag(raw: Column, typed: Column, column_code: str) -> Column:
    return F.when(cast_failed(raw, typed), F.lit(f"T1:{column_code}"))
