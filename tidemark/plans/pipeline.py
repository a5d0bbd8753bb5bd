"""One batch from raw files to checked gold tables.

    <root>/raw/<source>/<batch_id>/<file>     what arrives
    <root>/bronze/<table>/batch_id=...        parsed, verbatim text kept, one partition per batch
    <root>/state/<table>                      winning rows per key, bucketed (``sources.state``)
    <root>/silver/<table>, <root>/gold/<table>
    <root>/ops/runs, <root>/ops/manifest/...

Every layer is a written table before the next one reads it, so a lost executor
never costs more than the step it was working on, and a step can be run again.
State, silver and gold are layers of versions (``sources.versions``): a run writes drafts, its checks
read them, and only what passed them is shown to readers.

Of leads, orders, reviews and events a batch reads its own bronze rows and the states; silver leads,
orders and events are rewritten in the parts that its keys fall into.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.flags import has_flag
from tidemark.operators import checks
from tidemark.operators.batches import MARKETPLACE_BATCHES, BatchPlan, batch_order_problems
from tidemark.operators.compare import compare_metrics, to_metrics
from tidemark.plans import gold, second_route, seeds, silver
from tidemark.plans.contract import (
    GOLD_COLUMNS,
    GOLD_KEYS,
    KPI_TABLES,
    RAW_CSV_COLUMNS,
    SILVER_COLUMNS,
    contract_problems,
)
from tidemark.sources import ledger
from tidemark.sources.csv_records import PARSED, RECORD, read_csv_lines, read_csv_records
from tidemark.sources.raw_leads import parse_json_lines
from tidemark.sources.raw_logs import parse_log_lines, read_lines
from tidemark.sources.tables import (
    add_audit_columns,
    batch_load_summary,
    overwrite_counted,
    write_manifest,
)
from tidemark.sources.state import KeyedState, Shape
from tidemark.sources.versions import Draft, Layer

EVENTS, LEADS = "clickstream_events", "marketing_leads"
LOG_FILE, LEADS_FILE = "access_log.txt", "marketing_leads.jsonl"
MULTI_LINE_EXPORTS = ("order_reviews",)
COUNTS_FILE = "batch_row_counts.csv"
# Fixed value: what the published counts call the events.
PUBLISHED_NAMES = {"clickstream": EVENTS}
VERSIONED = ("state", "silver", "gold")


LEAD_STATE = Shape("leads", ("mql_id",))
EVENT_STATE = Shape(
    "clickstream_events", ("session_id", "line"), within=("session_id",), newest=False,
    order=("source_file", "ingested_at"),
)
ORDER_STATE = Shape("orders", ("order_id",))
REVIEW_STATE = Shape("order_reviews", ("review_id", "order_id"))


class BatchOrderError(RuntimeError):
    """The batch before this one has not been loaded successfully."""


class RowCountError(RuntimeError):
    """Bronze does not hold as many rows as the raw files."""


@dataclass(frozen=True)
class Layout:
    """Where the tables are; a draft that is open stands in for its layer."""

    root: str
    drafts: dict[str, Draft] = field(default_factory=dict, compare=False)

    def layer(self, spark: SparkSession, name: str) -> Layer:
        return Layer(spark, f"{self.root}/{name}")

    def draft(self, spark: SparkSession, name: str) -> Draft:
        if name not in self.drafts:
            self.drafts[name] = self.layer(spark, name).draft()
        return self.drafts[name]

    def publish(self, *names: str) -> None:
        """Shows the drafts of these layers to readers and lets go of versions nobody needs."""
        for name in names:
            draft = self.drafts.pop(name)
            draft.commit()
            draft.layer.prune()

    def raw(self, source: str, batch_id: str, file_name: str) -> str:
        return f"{self.root}/raw/{source}/{batch_id}/{file_name}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, spark: SparkSession, layer: str, name: str) -> DataFrame:
        if layer in self.drafts:
            return self.drafts[layer].read(name)
        if layer in VERSIONED:
            return self.layer(spark, layer).read(name)
        return spark.read.parquet(self.table(layer, name))

    def bronze_batches(self, spark: SparkSession, name: str) -> list[str]:
        """Batches that a bronze table has, from its folders."""
        folders = self.layer(spark, "bronze").names(name)
        found = [unquote(f.removeprefix("batch_id=")) for f in folders if f.startswith("batch_id=")]
        return sorted(found)


def _if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """A batch may come without some of its files."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def raw_frames(spark: SparkSession, layout: Layout, batch_id: str) -> dict[str, DataFrame]:
    """What the batch brought, parsed but not typed further than bronze needs."""

    def logs() -> DataFrame:
        path = layout.raw("clickstream", batch_id, LOG_FILE)
        return parse_log_lines(read_lines(spark, path, "raw_line"))

    def leads() -> DataFrame:
        path = layout.raw("marketing_funnel", batch_id, LEADS_FILE)
        return parse_json_lines(read_lines(spark, path, "raw_json"))

    def export(name: str) -> Callable[[], DataFrame]:
        columns, root, file = RAW_CSV_COLUMNS[name], f"{layout.root}/raw/csv", f"{name}.csv"
        read = read_csv_records if name in MULTI_LINE_EXPORTS else read_csv_lines
        return lambda: read(spark, root, [batch_id], file, columns).select(*columns, PARSED, RECORD)

    readers = {EVENTS: logs, LEADS: leads} | {name: export(name) for name in RAW_CSV_COLUMNS}
    found = {name: _if_present(read) for name, read in readers.items()}
    return {name: frame for name, frame in found.items() if frame is not None}


def published_rows(spark: SparkSession, layout: Layout, batch_id: str, plan: BatchPlan) -> dict[str, int]:
    """Rows that the file of published counts gives this batch, by table; none where there is no such file.

    It has a row for each raw table and a column for each batch, named by its id or the id's first word.
    """
    counts = _if_present(lambda: spark.read.option("header", True).csv(layout.table("raw", COUNTS_FILE)))
    if counts is None:
        return {}
    columns = [c for c in counts.columns if batch_id == c or batch_id.startswith(f"{c}_")]
    if len(columns) != 1:
        raise RowCountError(f"{COUNTS_FILE} has no column for {batch_id}")
    rows = counts.select("table_name", F.col(columns[0]).cast("long").alias("n_rows")).collect()  # a row for each table
    return {PUBLISHED_NAMES.get(r.table_name, r.table_name): r.n_rows for r in rows}


def load_bronze(
    spark: SparkSession, layout: Layout, batch_id: str, plan: BatchPlan = MARKETPLACE_BATCHES
) -> int:
    """Write the batch's partitions and compare row counts; returns the rows loaded.

    Raw is read once: its rows are counted on their way into the table. The table must hold as many,
    and as many as were published, if they were.
    """
    files = {EVENTS: LOG_FILE, LEADS: LEADS_FILE}
    published = published_rows(spark, layout, batch_id, plan)
    total = 0
    frames = raw_frames(spark, layout, batch_id)
    for name, frame in frames.items():
        audited = add_audit_columns(frame, batch_id, files.get(name, f"{name}.csv"))
        path = layout.table("bronze", name)
        n_raw = overwrite_counted(audited, path)
        loaded = batch_load_summary(spark.read.parquet(path), batch_id=batch_id).first()
        n_loaded = loaded.n_rows if loaded else 0
        if n_loaded != n_raw:
            n_raw = frame.count()
        if n_loaded != n_raw:
            raise RowCountError(f"{name} {batch_id}: {n_loaded} rows in bronze, {n_raw} in raw")
        if n_loaded != published.get(name, n_loaded):
            raise RowCountError(f"{name} {batch_id}: {n_loaded} rows in bronze, {published[name]} published")
        total += n_loaded
    for name, n_rows in published.items():
        if n_rows and name not in frames:
            raise RowCountError(f"{name} {batch_id}: no file, {n_rows} rows published")
    return total


def _bronze(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A bronze table; one that no batch has brought yet has its columns and no rows."""
    found = _if_present(lambda: layout.read(spark, "bronze", name))
    return _no_bronze(spark, name) if found is None else found


def _export(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """The parsed rows of a bronze CSV table; the others stay in bronze and are counted by a check."""
    return _bronze(spark, layout, name).filter(PARSED).drop(PARSED, RECORD)


def _no_bronze(spark: SparkSession, name: str) -> DataFrame:
    def no_rows(*columns: str) -> DataFrame:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))

    if name == EVENTS:
        frame = parse_log_lines(no_rows("raw_line"))
    elif name == LEADS:
        frame = parse_json_lines(no_rows("raw_json"))
    else:
        frame = no_rows(*RAW_CSV_COLUMNS[name], RECORD).withColumn(PARSED, F.lit(True))
    return add_audit_columns(frame, F.lit(None).cast("string"), F.lit(None).cast("string"))


def _take_in(
    spark: SparkSession, layout: Layout, plan: BatchPlan, shape: Shape, bronze_name: str,
    versions: Callable[[DataFrame], DataFrame], batch_id: str | None,
) -> tuple[DataFrame, list[int]]:
    """A state with the batch taken in: its rows in the parts that were written, and those parts.

    Where the state does not know what bronze has besides this batch (its first use, batches that
    are not planned), it is built from all of bronze.
    """
    state, draft = KeyedState(layout.layer(spark, "state"), shape, plan), layout.draft(spark, "state")
    bronze = _export(spark, layout, bronze_name) if bronze_name in RAW_CSV_COLUMNS else _bronze(spark, layout, bronze_name)
    there = layout.bronze_batches(spark, bronze_name)
    new = shape.name not in draft.tables
    if batch_id is None or new or {*there, batch_id} != {*state.batches(draft), batch_id}:
        parts = state.rebuild(draft, versions(bronze), [b for b in plan.ids if b in there])
    elif batch_id in there:
        rows = lambda *of: versions(bronze.filter(F.col("batch_id").isin(*of)))
        parts = state.load(draft, batch_id, rows(batch_id), lambda others: rows(*others))
    else:
        parts = []
    if shape.name not in layout.draft(spark, "silver").tables:
        parts = list(range(shape.parts))
    return state.current(draft, parts), parts


def build_silver(spark: SparkSession, layout: Layout, plan: BatchPlan, batch_id: str | None = None) -> None:
    """Drafts of all silver tables and their rejects, after one batch or from whole bronze tables."""
    draft = layout.draft(spark, "silver")

    def agreed(name: str, frame: DataFrame) -> DataFrame:
        problems = contract_problems(frame, name) if name in SILVER_COLUMNS else []
        if problems:
            raise ValueError(f"{name}: {problems}")
        return frame

    def write(name: str, frame: DataFrame) -> None:
        draft.write(name, agreed(name, frame))

    def write_parts(name: str, frame: DataFrame, part: Column, parts: Iterable[int]) -> None:
        if parts:
            draft.write_parts(name, agreed(name, frame).withColumn("part", part), parts)

    def written(name: str) -> DataFrame:
        return layout.read(spark, "silver", name)

    def write_rejects(name: str, bronze_name: str, rejects: Callable[[DataFrame], DataFrame]) -> None:
        """Rejects by batch; those of other batches stay as they are."""
        bronze = _bronze(spark, layout, bronze_name)
        position = F.coalesce(plan.position_of(F.col("batch_id")), F.lit(len(plan.ids)))
        known = list(range(len(plan.ids) + 1))
        if batch_id is not None and name in draft.tables:
            bronze, known = bronze.filter(F.col("batch_id") == batch_id), [plan.sequence_of(batch_id)]
        write_parts(name, rejects(bronze), position, known)

    def take_in(shape: Shape, name: str, versions: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, list[int]]:
        return _take_in(spark, layout, plan, shape, name, versions, batch_id)

    latest, parts = take_in(LEAD_STATE, LEADS, lambda x: silver.lead_versions(silver.evaluate_leads(x)))
    write_parts("leads", silver.typed_leads(latest), LEAD_STATE.part(), parts)
    write_rejects("leads_rejects", LEADS, lambda x: silver.leads_rejects(silver.evaluate_leads(x)))

    unique, parts = take_in(
        EVENT_STATE, EVENTS, lambda x: silver.event_versions(silver.evaluate_events(x))
    )
    write_parts("clickstream_events", silver.clickstream_events(unique), EVENT_STATE.part(), parts)
    write_rejects(
        "clickstream_rejects", EVENTS, lambda x: silver.events_rejects(silver.evaluate_events(x))
    )

    latest, parts = take_in(ORDER_STATE, "orders", silver.order_versions)
    write_parts("orders", silver.latest_orders(latest, plan), ORDER_STATE.part(), parts)
    orders = written("orders")
    write("order_items", silver.order_items(_export(spark, layout, "order_items"), orders))
    write("order_payments", silver.order_payments(_export(spark, layout, "order_payments")))
    take_in(REVIEW_STATE, "order_reviews", silver.review_versions)
    reviews = KeyedState(layout.layer(spark, "state"), REVIEW_STATE, plan)
    latest = reviews.current(layout.draft(spark, "state"))
    write("order_reviews", silver.latest_reviews(latest, orders, plan))
    write("customers", silver.customers(_export(spark, layout, "customers"), plan))
    write("sellers", silver.sellers(_export(spark, layout, "sellers"), plan))
    write(
        "product_category_translation",
        silver.product_category_translation(
            _export(spark, layout, "product_category_translation"), plan
        ),
    )
    write(
        "products",
        silver.products(
            _export(spark, layout, "products"), written("product_category_translation"), plan
        ),
    )
    write("geolocation", silver.geolocation(_export(spark, layout, "geolocation"), plan))


def build_gold(spark: SparkSession, layout: Layout, plan: BatchPlan) -> None:
    """Drafts of the dimensions, then facts, then KPI tables, each from written tables."""
    draft = layout.draft(spark, "gold")
    s = lambda name: layout.read(spark, "silver", name)
    g = lambda name: layout.read(spark, "gold", name)
    steps: dict[str, Callable[[], DataFrame]] = {
        "dim_date": lambda: gold.dim_date(s("orders"), s("leads"), s("clickstream_events"), plan),
        "dim_customer": lambda: gold.dim_customer(s("customers")),
        "dim_product": lambda: gold.dim_product(s("products")),
        "dim_seller": lambda: gold.dim_seller(s("sellers")),
        "fact_order": lambda: gold.fact_order(
            s("orders"), s("order_items"), s("order_reviews"), plan
        ),
        "fact_order_item": lambda: gold.fact_order_item(s("order_items"), s("orders")),
        "fact_lead": lambda: gold.fact_lead(s("leads")),
        "fact_session": lambda: gold.fact_session(s("clickstream_events")),
        "kpi_sales_month": lambda: gold.kpi_sales_month(g("fact_order"), g("dim_date")),
        "kpi_sales_state_month": lambda: gold.kpi_sales_state_month(
            g("fact_order"), g("dim_customer"), g("dim_date")
        ),
        "kpi_delivery_month": lambda: gold.kpi_delivery_month(g("fact_order"), g("dim_date")),
        "kpi_delivery_state_month": lambda: gold.kpi_delivery_state_month(
            g("fact_order"), g("dim_customer"), g("dim_date")
        ),
        "kpi_lead_month": lambda: gold.kpi_lead_month(g("fact_lead"), g("dim_date")),
        "kpi_lead_origin": lambda: gold.kpi_lead_origin(g("fact_lead")),
        "kpi_funnel_day": lambda: gold.kpi_funnel_day(g("fact_session")),
        "kpi_funnel_month": lambda: gold.kpi_funnel_month(g("fact_session")),
    }
    for name, build in steps.items():
        frame = build()
        problems = contract_problems(frame, name)
        if problems:
            raise ValueError(f"{name}: {problems}")
        draft.write(name, frame)


def batch_checks(
    spark: SparkSession, layout: Layout, plan: BatchPlan, batch_id: str
) -> list[checks.Check]:
    """Checks whose figures depend on how many batches are loaded."""
    leads = layout.read(spark, "silver", "leads")
    events = layout.read(spark, "silver", "clickstream_events")
    orders = layout.read(spark, "silver", "orders")
    check, error, warn = checks.Check, checks.ERROR, checks.WARN
    orphans = checks.orphan_rows(
        events, "order_id", orders, "order_id", F.col("order_id").isNotNull()
    )
    allowed = seeds.orphans_allowed("clickstream_to_orders", batch_id, plan)
    found = [
        check("events order orphans above expected", checks.orphans_above(orphans, allowed), error)
    ]
    if plan.is_middle(batch_id):
        within = checks.orphans_within(orphans, allowed)
        return [*found, check("events order orphans within expected", within, warn)]
    close_time = leads.agg(
        F.count_if(has_flag(F.col("dq_flag"), "C1")).alias("actual_count")
    ).filter(F.col("actual_count") != seeds.anomaly_count("leads", "C1"))
    sessions = checks.expected_counts(
        checks.session_flag_counts(events),
        seeds.expected_anomalies(spark).filter(F.col("table_name") == EVENTS),
        ["sub_code"],
    )
    totals = checks.final_lead_counts(leads, seeds.FINAL_LEADS, seeds.FINAL_DEALS)
    return [
        *found,
        check("events flag counts", checks.count_mismatches(sessions), warn),
        check("leads close time count", close_time, warn),
        check("leads final totals", totals, warn),
    ]


def silver_checks(
    spark: SparkSession, layout: Layout, plan: BatchPlan, batch_id: str
) -> list[checks.Check]:
    s = lambda name: layout.read(spark, "silver", name)
    leads, events = s("leads"), s("clickstream_events")
    bronze_leads = _bronze(spark, layout, LEADS)
    check, error, warn = checks.Check, checks.ERROR, checks.WARN
    required = {
        "leads": ("mql_id", "first_contact_date", "landing_page_id", "origin", "has_deal",
                  "source_file", "batch_id"),
        "clickstream_events": ("event_id", "session_id", "user_id", "event_ts", "event_date",
                               "event_type", "source_file", "batch_id"),
        "leads_rejects": ("reject_reason",),
        "clickstream_rejects": ("reject_reason",),
    }
    has_value = lambda column: F.col(column).isNotNull()
    return [
        *[
            check(
                f"{name} required columns",
                checks.null_counts(s(name), columns).filter(F.col("violations") > 0),
                error,
            )
            for name, columns in required.items()
        ],
        *batch_checks(spark, layout, plan, batch_id),
        check(
            "leads origin accepted",
            checks.accepted_values(leads, "origin", list(seeds.LEAD_ORIGINS)),
            error,
        ),
        check("leads mql_id unique", checks.unique(leads, ["mql_id"]), error),
        check(
            "leads seller_id unique",
            checks.unique(leads, ["seller_id"], has_value("seller_id")),
            warn,
        ),
        check(
            "leads seller_id known",
            checks.relationships(
                leads, "seller_id", s("sellers"), "seller_id", has_value("seller_id")
            ),
            warn,
        ),
        check("leads bronze unparsed", checks.unparsed(bronze_leads), error),
        *[
            check(f"{name} bronze unparsed", checks.unparsed(_bronze(spark, layout, name)), warn)
            for name in RAW_CSV_COLUMNS
        ],
        check(
            "leads counts match bronze",
            checks.lead_layer_problems(
                checks.lead_layer_counts(leads, s("leads_rejects"), bronze_leads)
            ),
            error,
        ),
        check("leads replay", checks.replay_problems(bronze_leads, plan), error),
        check(
            "leads dates in scope",
            checks.no_dates_after_cutoff(leads, ["first_contact_date", "won_date"], plan),
            error,
        ),
        check("leads rejects empty", checks.no_rows(s("leads_rejects")), warn),
        check("events event_id unique", checks.unique(events, ["event_id"]), error),
        check(
            "events type accepted",
            checks.accepted_values(events, "event_type", list(gold.FUNNEL_STEPS)),
            error,
        ),
        check("events in scope", checks.not_after_cutoff(events, "event_ts", plan), error),
        check(
            "events user known",
            checks.relationships(events, "user_id", s("customers"), "customer_id"),
            error,
        ),
        check(
            "events product known",
            checks.relationships(
                events, "product_id", s("products"), "product_id", has_value("product_id")
            ),
            error,
        ),
        check("events rejects empty", checks.no_rows(s("clickstream_rejects")), error),
        check(
            "purchase amount matches order",
            checks.purchase_amount_problems(events, s("order_items")),
            warn,
        ),
    ]


def gold_checks(spark: SparkSession, layout: Layout, plan: BatchPlan) -> list[checks.Check]:
    tables = {name: layout.read(spark, "gold", name) for name in GOLD_COLUMNS}
    silver_tables = {name: layout.read(spark, "silver", name) for name in SILVER_COLUMNS}
    facts = {name: tables[name] for name in GOLD_COLUMNS if name.startswith("fact_")}
    check = checks.Check
    return [
        check(
            "gold keys unique",
            checks.key_uniqueness(tables, GOLD_KEYS).filter(F.col("n_problems") > 0),
        ),
        check("fact grain", checks.grain_duplicates(facts, GOLD_KEYS)),
        check(
            "foreign keys", checks.foreign_key_orphans(tables).filter(F.col("n_orphans") > 0)
        ),
        check(
            "gold counts match silver",
            checks.differing_totals(checks.layer_counts(silver_tables, tables)),
        ),
        check(
            "money totals match silver",
            checks.differing_totals(
                checks.money_totals(silver_tables, tables), checks.MONEY_TOLERANCE
            ),
        ),
        check(
            "kpi components add up",
            checks.differing_totals(checks.kpi_additivity(tables), checks.MONEY_TOLERANCE),
        ),
        check("kpi flags and ratios", checks.kpi_flag_problems(tables)),
        check("calendar without gaps", checks.calendar_gaps(tables["dim_date"], plan)),
    ]


def second_route_check(spark: SparkSession, layout: Layout, plan: BatchPlan) -> checks.Check:
    """Published KPI tables against the same figures straight from bronze, which it reads as a whole."""
    b = lambda name: _export(spark, layout, name)
    orders = second_route.order_components(b("orders"), b("order_items"), b("order_reviews"), b("customers"), plan)
    leads = second_route.lead_components(_bronze(spark, layout, LEADS), plan)
    sessions = second_route.session_components(_bronze(spark, layout, EVENTS))
    expected = second_route.metrics(second_route.kpi_tables(orders, leads, sessions, plan))
    actual = [to_metrics(layout.read(spark, "gold", name), name, GOLD_KEYS[name]) for name in KPI_TABLES]
    problems = compare_metrics(checks.union_all(expected), checks.union_all(actual))
    return checks.Check("kpis agree with the second route", problems, checks.WARN)


def check_batch_order(
    spark: SparkSession, layout: Layout, batch_id: str, plan: BatchPlan
) -> None:
    if plan.previous(batch_id) is None:
        return
    runs = _if_present(lambda: ledger.read_runs(spark, layout.table("ops", "runs")))
    if runs is None:
        raise BatchOrderError(f"{batch_id}: no run of {plan.previous(batch_id)} yet")
    latest = ledger.latest_status_per_batch(runs)
    held_back = batch_order_problems(latest, plan, ledger.SUCCESS)
    problem = held_back.filter(F.col("batch_id") == batch_id).first()
    if problem:
        raise BatchOrderError(
            f"{batch_id}: latest run of {problem.previous_batch} is {problem.previous_status}"
        )


def rows_out(spark: SparkSession, layout: Layout) -> int:
    tables = {name: layout.read(spark, "silver", name) for name in SILVER_COLUMNS}
    tables |= {name: layout.read(spark, "gold", name) for name in GOLD_COLUMNS}
    totals = checks.layer_rows(tables).filter(F.col("table_name") == "all").first()
    return int(totals.n_rows)


def write_manifests(spark: SparkSession, layout: Layout, batch_id: str) -> None:
    """Fingerprints of the batch's log and lead lines, for readers that wait for a batch."""
    for name, text in ((EVENTS, "raw_line"), (LEADS, "raw_json")):
        bronze = _if_present(lambda table=name: _bronze(spark, layout, table))
        if bronze is not None:
            part = bronze.filter(F.col("batch_id") == batch_id)
            write_manifest(part, [text], layout.table("ops/manifest", name))


def run_batch(
    spark: SparkSession,
    root: str,
    batch_id: str,
    plan: BatchPlan = MARKETPLACE_BATCHES,
    run_id: str | None = None,
) -> DataFrame:
    """Load one batch, bring silver and gold up to date; returns the report of all checks.

    Silver is shown to readers when its checks have passed, then gold when its own have.

    The run is recorded whether it succeeds or fails; checks of severity
    ``error`` that find something fail it.
    """
    layout = Layout(root.rstrip("/"))
    check_batch_order(spark, layout, batch_id, plan)
    run_id = run_id or f"{batch_id}-{uuid.uuid4().hex[:12]}"
    started = datetime.now(timezone.utc)
    step, n_in, n_out = "bronze", None, None
    status = ledger.FAILED
    try:
        n_in = load_bronze(spark, layout, batch_id, plan)
        write_manifests(spark, layout, batch_id)
        step = "silver"
        build_silver(spark, layout, plan, batch_id)
        silver_report = checks.raise_on_errors(
            checks.report(silver_checks(spark, layout, plan, batch_id))
        )
        layout.publish("state", "silver")
        step = "gold"
        build_gold(spark, layout, plan)
        found = gold_checks(spark, layout, plan)
        if plan.is_final(batch_id):
            found = [*found, second_route_check(spark, layout, plan)]
        gold_report = checks.raise_on_errors(checks.report(found))
        layout.publish("gold")
        n_out = rows_out(spark, layout)
        status = ledger.SUCCESS
        return silver_report.unionByName(gold_report)
    finally:
        ledger.record_run(
            spark, layout.table("ops", "runs"), run_id, batch_id, status, started,
            datetime.now(timezone.utc),
            failed_model=None if status == ledger.SUCCESS else step,
            rows_in=n_in, rows_out=n_out,
        )


def run_batches(
    spark: SparkSession, root: str, wanted: str, plan: BatchPlan = MARKETPLACE_BATCHES
) -> None:
    """One batch, or ``all`` of them in their order."""
    for batch_id in plan.resolve(wanted):
        run_batch(spark, root, batch_id, plan)

