"""Recurring batches: windows, guards, customer and product catalogs."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.contract import INACTIVE_DAYS, TRANSACTION_COLUMNS
from winback.functions import lines
from winback.operators.quality import count_kinds
from winback.session import materialise
from winback.sources.bronze import union_parts
from winback.sources.guards import require_columns
from winback.sources.tables import Tables

# Sizes of a recurring batch.
BATCH_DAYS = 30
BATCH_INVOICES = 1500
SCENARIO_FACTORS = {"volume_spike": 3}
CATALOG_COLUMNS = ("stock_code", "description", "base_price", "frequency")


def next_window(
    source: DataFrame,
    previous: DataFrame | None,
    scenario: str = "normal",
    days: int = BATCH_DAYS,
    start: date | str | None = None,
) -> DataFrame:
    """One row: start, end and id of the next batch.

    It starts the day after the last earlier batch, else after the last real day.
    """
    last = F.max(lines.purchase_day())
    found = source.agg(last.alias("_last_real"))
    after = F.col("_last_real")
    if previous is not None:
        after = F.coalesce(previous.agg(last).scalar(), after)
    begin = F.lit(start).cast("date") if start else F.date_add(after, 1)
    return (
        found.select(begin.alias("batch_start_date"))
        .withColumn("batch_end_date", F.date_add("batch_start_date", days - 1))
        .withColumn(
            "batch_id",
            F.concat_ws(
                "_",
                F.date_format("batch_start_date", "yyyyMMdd"),
                F.date_format("batch_end_date", "yyyyMMdd"),
                F.lit(scenario),
            ),
        )
    )


def planned_invoices(scenario: str, base: int = BATCH_INVOICES) -> int:
    return base * SCENARIO_FACTORS.get(scenario, 1)


def batch_seed(start: date, scenario: str) -> int:
    return int(start.strftime("%Y%m%d")) + sum(map(ord, scenario))


def invoice_prefix(batch_id: str) -> str:
    return f"SYN-{batch_id}-"


def batch_rows(transactions: DataFrame, batch_id: str) -> DataFrame:
    return transactions.filter(F.col("invoice").startswith(invoice_prefix(batch_id)))


def append_batch(
    tables: Tables,
    batch: DataFrame,
    manifest: DataFrame,
    batch_id: str,
    replace: bool = False,
) -> None:
    """Store a batch and its manifest row once; `replace` allows doing it again."""
    if tables.exists("synthetic", "transactions"):
        stored = tables.read("synthetic", "transactions").filter(F.col("batch_id") == batch_id)
        if not stored.isEmpty():
            if not replace:
                raise ValueError(f"batch {batch_id} is stored already; replace it explicitly")
    tables.forget_state_of_batch(batch_id)
    for row in manifest.select("batch_start_date").collect():
        tables.forget_state(row[0])
    stamped = batch.select(*TRANSACTION_COLUMNS, F.lit(batch_id).alias("batch_id"))
    # One batch is one partition: both writes put it in place of an earlier one as a whole.
    tables.write_replace(stamped, "synthetic", "transactions", "batch_id", batch_id)
    tables.write_replace(manifest, "synthetic", "generation_runs", "batch_id", batch_id)


def manifest_row(
    batch: DataFrame,
    batch_id: str,
    scenario: str,
    seed: int,
    start: date,
    end: date,
    planned: int,
) -> DataFrame:
    """What a batch was meant to hold and what it holds."""
    counted = batch.agg(
        count_kinds("invoice").cast("bigint").alias("generated_invoices"),
        F.count("*").alias("generated_rows"),
    )
    now = datetime.now(timezone.utc)
    return counted.select(
        F.lit(scenario).alias("scenario"),
        F.lit(seed).cast("bigint").alias("random_seed"),
        F.lit(start).alias("batch_start_date"),
        F.lit(end).alias("batch_end_date"),
        F.lit(planned).cast("bigint").alias("planned_invoices"),
        "generated_invoices",
        "generated_rows",
        F.lit(now).alias("generated_at"),
        F.lit(batch_id).alias("batch_id"),
    )


def history_before(source: DataFrame, previous: DataFrame | None, start: date | str) -> DataFrame:
    """All real lines and those of earlier batches."""
    real = source.select(*TRANSACTION_COLUMNS)
    if previous is None:
        return real
    earlier = previous.select(*TRANSACTION_COLUMNS).filter(
        lines.purchase_day() < F.lit(start).cast("date")
    )
    return union_parts(real, earlier)


def latest_country(history: DataFrame) -> DataFrame:
    """Country of each customer's last line; equal times go by invoice, code, country."""
    newest = F.max(F.struct("invoice_date", "invoice", "stock_code", "country"))
    return (
        history.filter(lines.valid_line("strict"))
        .groupBy("customer_id")
        .agg(newest.alias("_newest"))
        .select("customer_id", F.col("_newest.country").alias("country"))
    )


def customer_profiles(history: DataFrame, start: date | str) -> DataFrame:
    """Latest country and days without a purchase when the batch starts.

    One aggregation gives both, so no join is needed.
    """
    newest = F.max(F.struct("invoice_date", "invoice", "stock_code", "country"))
    return (
        history.filter(lines.valid_line("strict"))
        .groupBy("customer_id")
        .agg(newest.alias("_newest"))
        .select(
            F.col("customer_id").cast("bigint").alias("customer_id"),
            F.col("_newest.country").alias("country"),
            F.datediff(F.lit(start).cast("date"), F.to_date("_newest.invoice_date")).alias(
                "inactive_days"
            ),
        )
    )


def customer_pools(profiles: DataFrame, inactive_days: int = INACTIVE_DAYS) -> DataFrame:
    """Rows per pool; a pool nobody belongs to holds everyone."""
    profiles = materialise(profiles, "profiles")
    inactive = F.col("inactive_days") >= inactive_days
    sizes = profiles.agg(
        F.count_if(inactive).alias("inactive"), F.count_if(~inactive).alias("active")
    )
    no_inactive = sizes.select(F.col("inactive") == 0).scalar()
    no_active = sizes.select(F.col("active") == 0).scalar()
    pools = F.array_compact(
        F.array(
            F.when(inactive | no_inactive, F.lit("inactive")),
            F.when(~inactive | no_active, F.lit("active")),
        )
    )
    return profiles.select(F.explode(pools).alias("pool"), *profiles.columns)


def product_catalog(history: DataFrame) -> DataFrame:
    """Mean price and line count per code and description."""
    return (
        history.filter(lines.valid_line("strict") & F.col("description").isNotNull())
        .groupBy("stock_code", "description")
        .agg(
            (F.sum("price").cast("double") / F.count("price")).alias("base_price"),
            F.count("invoice").cast("double").alias("frequency"),
        )
        .filter(F.col("base_price") > 0)
    )


def consolidate_catalog(catalog: DataFrame) -> DataFrame:
    """One row per code: first description, total frequency, weighted price."""
    require_columns(catalog, CATALOG_COLUMNS)
    weight = F.sum("frequency")
    return (
        catalog.groupBy("stock_code")
        .agg(
            F.min("description").alias("description"),
            (F.sum(F.col("base_price") * F.col("frequency")) / weight).alias("base_price"),
            weight.alias("frequency"),
        )
        .select(*CATALOG_COLUMNS)
    )


def with_product_share(catalog: DataFrame) -> DataFrame:
    catalog = materialise(catalog, "catalog")
    total = catalog.agg(F.sum("frequency")).scalar()
    return catalog.withColumn("product_share", F.col("frequency") / total)


def daily_summary(batch: DataFrame) -> DataFrame:
    return (
        batch.groupBy(lines.purchase_day().alias("purchase_date"))
        .agg(
            F.count("*").alias("number_rows"),
            F.count_distinct("invoice").alias("number_invoices"),
            F.count_distinct("customer_id").alias("number_customers"),
        )
        .orderBy("purchase_date")
    )


def first_lines(batch: DataFrame, rows: int = 20) -> DataFrame:
    """The earliest lines; every column breaks ties."""
    rest = [c for c in TRANSACTION_COLUMNS if c != "invoice_date"]
    return batch.orderBy("invoice_date", *rest).limit(rows)
