"""Flag lists and reject reasons kept as delimited text; NULL means clean."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

FLAG_SEPARATOR = ","
REASON_SEPARATOR = ";"


def _codes_of_true_conditions(pairs: Sequence[tuple[str, Column]], separator: str) -> Column:
    if not pairs:
        return F.lit(None).cast("string")
    codes = [F.when(condition, F.lit(code)) for code, condition in pairs]
    return F.nullif(F.concat_ws(separator, *codes), F.lit(""))


def flag_list(pairs: Sequence[tuple[str, Column]]) -> Column:
    """Codes of the conditions that hold, in the order given."""
    return _codes_of_true_conditions(pairs, FLAG_SEPARATOR)


def reject_reason(pairs: Sequence[tuple[str, Column]]) -> Column:
    return _codes_of_true_conditions(pairs, REASON_SEPARATOR)


def none_of(pairs: Sequence[tuple[str, Column]]) -> Column:
    """No condition holds. As a filter this reaches the scan, which a built text would not."""
    return reduce(and_, [~F.coalesce(condition, F.lit(False)) for _, condition in pairs])


def is_reject(reason: Column) -> Column:
    return F.coalesce(F.trim(reason) != "", F.lit(False))


def _fenced(flags: Column) -> Column:
    return F.concat(F.lit(FLAG_SEPARATOR), flags, F.lit(FLAG_SEPARATOR))


def has_flag(flags: Column, code: str) -> Column:
    """Is ``code`` one of the flags? ``T1`` is also met by ``T1:<column>``.

    Plain substring search between separators: no wildcard can creep in,
    and it stays inside generated code, which an array lambda would not.
    """
    found = _fenced(flags).contains(f",{code},")
    if code == "T1":
        found = found | _fenced(flags).contains(",T1:")
    return F.coalesce(found, F.lit(False))


def has_flag_prefix(flags: Column, prefix: str) -> Column:
    return F.coalesce(_fenced(flags).contains(f",{prefix}:"), F.lit(False))
