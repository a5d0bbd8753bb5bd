"""Marketing leads: one JSON object per line, a won deal nested in its lead."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of a lead and of its deal; every scalar is text.
LEAD_FIELDS = ("mql_id", "first_contact_date", "landing_page_id", "origin")
DEAL_FIELDS = (
    "seller_id",
    "sdr_id",
    "sr_id",
    "won_date",
    "business_segment",
    "lead_type",
    "lead_behaviour_profile",
    "has_company",
    "has_gtin",
    "average_stock",
    "business_type",
    "declared_product_catalog_size",
    "declared_monthly_revenue",
)
CORRUPT = "__corrupt"

DEAL_TYPE = T.StructType([T.StructField(name, T.StringType()) for name in DEAL_FIELDS])
LEAD_TYPE = T.StructType(
    [T.StructField(name, T.StringType()) for name in LEAD_FIELDS]
    + [T.StructField("deal", DEAL_TYPE)]
)


def parse_json_lines(lines: DataFrame) -> DataFrame:
    """Lead columns beside ``raw_json``; other columns of ``lines`` pass through.

    ``is_parsed`` is false for text that is not a JSON object of this shape.
    ``from_json`` returns a partly filled struct for such text, so the corrupt
    record column decides, and nothing of a broken line is kept but its text.
    """
    shape = T.StructType(LEAD_TYPE.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = lines.withColumn(
        "__lead",
        F.from_json("raw_json", shape, {"columnNameOfCorruptRecord": CORRUPT}),
    ).withColumn(
        "is_parsed", F.col("__lead").isNotNull() & F.col(f"__lead.{CORRUPT}").isNull()
    )
    carried = [c for c in lines.columns if c != "raw_json"]
    return parsed.select(
        *[
            F.when(F.col("is_parsed"), F.col(f"__lead.{name}")).alias(name)
            for name in (*LEAD_FIELDS, "deal")
        ],
        "raw_json",
        "is_parsed",
        *carried,
    )


def to_json_lines(nested: DataFrame) -> DataFrame:
    """``raw_json`` from lead columns and ``deal``; absent keys instead of nulls."""
    deal = F.struct(*[F.col(f"deal.{name}").cast("string").alias(name) for name in DEAL_FIELDS])
    body = F.struct(
        *[F.col(name).cast("string").alias(name) for name in LEAD_FIELDS],
        F.when(F.col("deal").isNotNull(), deal).alias("deal"),
    )
    carried = [c for c in nested.columns if c not in (*LEAD_FIELDS, "deal")]
    return nested.select(
        F.to_json(body, {"ignoreNullFields": "true"}).alias("raw_json"), *carried
    )
