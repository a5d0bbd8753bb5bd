"""Silver and gold tables built from the driver tables, one function per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog import inputs
from tidemark.catalog.inputs import BATCHES
from tidemark.plans import gold, silver
from tidemark.plans.contract import GOLD_COLUMNS
from tidemark.sources.scratch import written_table


def input_files(spark: SparkSession, sf_dir: str) -> frozenset[tuple[str, int, int]]:
    """Path, size and modification time of every file of a folder, in any store that Spark reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    store = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    listed = store.listFiles(folder, True)
    found = set()
    while listed.hasNext():
        file = listed.next()
        found.add((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return frozenset(found)


class Tables:
    """Tables over one folder; what several models read is a finished table, as in a batch run.

    A finished table is written once per session and state of the folder, when it is first
    read: files that are replaced, added or removed are seen by the next ``Tables``. ``build``
    computes one table from the finished tables below it.
    """

    _finished: dict[tuple[str, str, frozenset, str], DataFrame] = {}

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._files = input_files(spark, sf_dir)

    def build(self, name: str) -> DataFrame:
        return BUILDERS[name](self)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in FINISHED:
            return self.build(name)
        place = (self.spark.sparkContext.applicationId, self.sf_dir, self._files, name)
        if place not in self._finished:
            self._finished[place] = written_table(self.build(name), name)
        return self._finished[place]

    def raw(self, reader) -> DataFrame:
        return reader(self.spark, self.sf_dir)

    def gold(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in GOLD_COLUMNS}


FINISHED = (
    "bronze_leads",
    "bronze_events",
    "bronze_orders",
    "bronze_order_items",
    "bronze_order_reviews",
    "distinct_events",
    "orders",
    "order_items",
    "order_reviews",
    "customers",
    "products",
    "sellers",
    "leads",
    "clickstream_events",
    "dim_date",
    "fact_order",
    "fact_order_item",
    "fact_lead",
    "fact_session",
)

BUILDERS = {
    "bronze_leads": lambda t: t.raw(inputs.bronze_leads),
    "bronze_events": lambda t: t.raw(inputs.bronze_events),
    "evaluated_leads": lambda t: silver.evaluate_leads(t["bronze_leads"]),
    "leads": lambda t: silver.leads(t["evaluated_leads"], BATCHES),
    "evaluated_events": lambda t: silver.evaluate_events(t["bronze_events"]),
    "distinct_events": lambda t: silver.distinct_events(t["evaluated_events"], BATCHES),
    "clickstream_events": lambda t: silver.clickstream_events(t["distinct_events"]),
    "bronze_orders": lambda t: t.raw(inputs.raw_orders),
    "bronze_order_items": lambda t: t.raw(inputs.raw_items),
    "bronze_order_reviews": lambda t: t.raw(inputs.raw_reviews),
    "orders": lambda t: silver.orders(t["bronze_orders"], BATCHES),
    "order_items": lambda t: silver.order_items(t["bronze_order_items"], t["orders"]),
    "order_payments": lambda t: silver.order_payments(t.raw(inputs.raw_payments)),
    "order_reviews": lambda t: silver.order_reviews(
        t["bronze_order_reviews"], t["orders"], BATCHES
    ),
    "product_category_translation": lambda t: silver.product_category_translation(
        t.raw(inputs.raw_translation), BATCHES
    ),
    "products": lambda t: silver.products(
        t.raw(inputs.raw_products), t["product_category_translation"], BATCHES
    ),
    "customers": lambda t: silver.customers(t.raw(inputs.raw_customers), BATCHES),
    "sellers": lambda t: silver.sellers(t.raw(inputs.raw_sellers), BATCHES),
    "geolocation": lambda t: silver.geolocation(t.raw(inputs.raw_points), BATCHES),
    "dim_date": lambda t: gold.dim_date(
        t["orders"], t["leads"], t["clickstream_events"], BATCHES
    ),
    "dim_customer": lambda t: gold.dim_customer(t["customers"]),
    "dim_product": lambda t: gold.dim_product(t["products"]),
    "dim_seller": lambda t: gold.dim_seller(t["sellers"]),
    "fact_order": lambda t: gold.fact_order(
        t["orders"], t["order_items"], t["order_reviews"], BATCHES
    ),
    "fact_order_item": lambda t: gold.fact_order_item(t["order_items"], t["orders"]),
    "fact_lead": lambda t: gold.fact_lead(t["leads"]),
    "fact_session": lambda t: gold.fact_session(t["clickstream_events"]),
    "kpi_sales_month": lambda t: gold.kpi_sales_month(t["fact_order"], t["dim_date"]),
    "kpi_sales_state_month": lambda t: gold.kpi_sales_state_month(
        t["fact_order"], t["customers"], t["dim_date"]
    ),
    "kpi_delivery_month": lambda t: gold.kpi_delivery_month(t["fact_order"], t["dim_date"]),
    "kpi_delivery_state_month": lambda t: gold.kpi_delivery_state_month(
        t["fact_order"], t["customers"], t["dim_date"]
    ),
    "kpi_lead_month": lambda t: gold.kpi_lead_month(t["fact_lead"], t["dim_date"]),
    "kpi_lead_origin": lambda t: gold.kpi_lead_origin(t["fact_lead"]),
    "kpi_funnel_day": lambda t: gold.kpi_funnel_day(t["fact_session"]),
    "kpi_funnel_month": lambda t: gold.kpi_funnel_month(t["fact_session"]),
}
