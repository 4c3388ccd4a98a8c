"""Queries on sources, sinks, cleaning and quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.contract import (
    OBSERVATION_DAYS,
    TRANSACTION_COLUMNS,
    TRANSACTION_SCHEMA,
    Parameters,
)
from winback.functions import lines as line
from winback.functions.dates import as_date
from winback.operators import batches, cleaning, quality, rounds
from winback.operators.features import modeling_base
from winback.plans import frames
from winback.plans.catalog import query
from winback.plans.sql import with_steps
from winback.session import FILE_ROWS, materialise
from winback.sources.bronze import union_parts
from winback.sources.guards import conform, require_columns, require_rows
from winback.sources.tables import Tables

_LINE = "invoice, stock_code, description, quantity, invoice_date, price, customer_id, country"


@query("source_bronze", with_steps("SELECT * FROM bronze"))
def source_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return frames.bronze(spark, folder)


@query(
    "source_conformed_batch",
    with_steps(
        f"SELECT {_LINE} FROM renamed WHERE CAST(invoice_date AS DATE) > DATE '2001-05-08'"
    ),
)
def source_conformed_batch(spark: SparkSession, folder: str) -> DataFrame:
    raw = cleaning.rename_columns(frames.bronze(spark, folder))
    batch = raw.filter(line.purchase_day() > F.lit(frames.REAL_UNTIL).cast("date"))
    # A batch arrives untyped, as text.
    text = batch.select(*[F.col(c).cast("string").alias(c) for c in batch.columns])
    require_rows(require_columns(text, TRANSACTION_COLUMNS), "batch")
    return conform(text, TRANSACTION_SCHEMA)


@query("table_full_write", with_steps(f"SELECT {_LINE} FROM silver"))
def table_full_write(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables.scratch(spark)
    tables.write_full(frames.silver(spark, folder), "silver", "transactions")
    return tables.read("silver", "transactions")


@query(
    "table_append",
    with_steps(
        f"SELECT {_LINE} FROM silver"
    ),
)
def table_append(spark: SparkSession, folder: str) -> DataFrame:
    """All of silver in two parts, the second added to the first."""
    tables = Tables.scratch(spark)
    silver = frames.silver(spark, folder)
    cut = F.lit(frames.REAL_UNTIL).cast("date")
    for part in (silver.filter(line.purchase_day() <= cut), silver.filter(line.purchase_day() > cut)):
        tables.write_append(part, "silver", "transactions")
    return tables.read("silver", "transactions")


@query(
    "table_replace_date",
    with_steps(
        """SELECT scoring_date, customer_id, number_orders, total_spent FROM round_features"""
    ),
)
def table_replace_date(spark: SparkSession, folder: str) -> DataFrame:
    """Feature snapshots per date, one date written twice."""
    tables = Tables.scratch(spark)
    silver = frames.stored_silver(spark, folder)
    tables.write_replace(
        frames.features_of(silver), "gold", "feature_snapshot", "scoring_date"
    )
    # The date is computed afresh: a table is not overwritten from itself.
    fresh = frames.features_of(silver, (frames.MATURED_ROUND,))
    day = as_date(frames.MATURED_ROUND)
    tables.write_replace(fresh, "gold", "feature_snapshot", "scoring_date", day)
    return tables.read("gold", "feature_snapshot").select(
        "scoring_date", "customer_id", "number_orders", "total_spent"
    )


def _batch_lines(spark: SparkSession, folder: str) -> DataFrame:
    first, last = frames.BATCH
    return frames.silver(spark, folder).filter(line.between(first, last))


def _manifest(batch: DataFrame) -> DataFrame:
    first, last = frames.BATCH
    return batches.manifest_row(
        batch,
        f"{first:%Y%m%d}_{last:%Y%m%d}_normal",
        "normal",
        batches.batch_seed(first, "normal"),
        first,
        last,
        batches.planned_invoices("normal"),
    )


@query(
    "table_delete_batch",
    with_steps(
        """SELECT 'second' AS batch_id, count(*) AS row_count,
             CAST(sum(quantity) AS BIGINT) AS items
           FROM silver WHERE CAST(invoice_date AS DATE)
             BETWEEN DATE '2001-05-09' AND DATE '2001-06-07'"""
    ),
)
def table_delete_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches stored, the first stored again in place of itself and then deleted."""
    tables = Tables.scratch(spark)
    # Written once: five writes and the checks before them read the same few lines.
    batch = materialise(_batch_lines(spark, folder), "batch")
    manifest = materialise(_manifest(batch), "manifest")

    def named(batch_id: str) -> DataFrame:
        return manifest.withColumn("batch_id", F.lit(batch_id))

    for batch_id in ("first", "second"):
        batches.append_batch(tables, batch, named(batch_id), batch_id)
    batches.append_batch(tables, batch, named("first"), "first", replace=True)
    tables.delete_batch("first")
    return (
        tables.read("synthetic", "transactions")
        .groupBy("batch_id")
        .agg(F.count("*").alias("row_count"), F.sum("quantity").alias("items"))
    )


@query(
    "table_layers",
    with_steps(
        """SELECT 'silver' AS layer, 'transactions' AS table_key, count(*) AS row_count FROM silver
           UNION ALL SELECT 'gold', 'modeling', count(*) FROM base"""
    ),
)
def table_layers(spark: SparkSession, folder: str) -> DataFrame:
    """Layers made on demand, creating one twice being harmless."""
    tables = Tables.scratch(spark)
    tables.create_layer("silver")
    tables.write_full(
        frames.silver(spark, folder), "silver", "transactions", file_rows=FILE_ROWS
    )
    # From the stored lines: joined and cleaned once.
    base = frames.base_of(tables.read("silver", "transactions"))
    tables.write_full(base, "gold", "modeling", by="reference_date")

    def size(layer: str, key: str) -> DataFrame:
        counted = tables.read(layer, key).agg(F.count("*").alias("row_count"))
        return counted.select(F.lit(layer).alias("layer"), F.lit(key).alias("table_key"), "row_count")

    return union_parts(size("silver", "transactions"), size("gold", "modeling"))


@query(
    "batch_gate",
    with_steps(
        f"""SELECT {_LINE}, '20010509_20010607_normal' AS batch_id FROM silver
            WHERE CAST(invoice_date AS DATE) BETWEEN DATE '2001-05-09' AND DATE '2001-06-07'"""
    ),
)
def batch_gate(spark: SparkSession, folder: str) -> DataFrame:
    """A batch that arrives as text is typed, checked and stored; the given lines have
    defects, so only its window is enforced."""
    batch = _batch_lines(spark, folder)
    text = batch.select(*[F.col(c).cast("string").alias(c) for c in batch.columns])
    first, last = frames.BATCH
    batch_id = f"{first:%Y%m%d}_{last:%Y%m%d}_normal"
    return rounds.accept_batch(
        Tables.scratch(spark), text, batch_id, "normal", first, last, expect_clean=False
    )


@query("table_full_history", with_steps(f"SELECT {_LINE} FROM silver "
    "WHERE CAST(invoice_date AS DATE) <= DATE '2001-06-07'"))
def table_full_history(spark: SparkSession, folder: str) -> DataFrame:
    tables = Tables.scratch(spark)
    real = frames.silver(spark, folder).filter(line.until(frames.REAL_UNTIL))
    batch = _batch_lines(spark, folder)
    manifest = _manifest(batch).withColumn("batch_id", F.lit("batch"))
    batches.append_batch(tables, batch, manifest, "batch")
    return tables.create_full_history(real).select(*TRANSACTION_COLUMNS)


@query(
    "batch_manifest",
    with_steps(
        """SELECT '20010509_20010607_normal' AS batch_id, 'normal' AS scenario,
             CAST(20010509 + (SELECT sum(unicode(c)) FROM
               (SELECT unnest(string_split('normal', '')) AS c)) AS BIGINT) AS random_seed, DATE '2001-05-09' AS batch_start_date,
             DATE '2001-06-07' AS batch_end_date, CAST(1500 AS BIGINT) AS planned_invoices,
             count(DISTINCT invoice) AS generated_invoices, count(*) AS generated_rows
           FROM silver WHERE CAST(invoice_date AS DATE)
             BETWEEN DATE '2001-05-09' AND DATE '2001-06-07'"""
    ),
)
def batch_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return _manifest(_batch_lines(spark, folder)).drop("generated_at")


@query("clean_renamed", with_steps("SELECT * FROM renamed"))
def clean_renamed(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.rename_columns(frames.bronze(spark, folder))


@query("clean_known_customers", with_steps("SELECT * FROM renamed WHERE customer_id IS NOT NULL"))
def clean_known_customers(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_missing_customer(clean_renamed(spark, folder))


@query("clean_deduplicated", with_steps("SELECT DISTINCT * FROM renamed"))
def clean_deduplicated(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.drop_duplicate_rows(clean_renamed(spark, folder))


@query("clean_silver", with_steps("SELECT * FROM silver"))
def clean_silver(spark: SparkSession, folder: str) -> DataFrame:
    return frames.silver(spark, folder)


@query(
    "clean_line_flags",
    with_steps("SELECT * REPLACE (CAST(total_amount AS DOUBLE) AS total_amount) FROM flagged"),
)
def clean_line_flags(spark: SparkSession, folder: str) -> DataFrame:
    flagged = cleaning.with_line_flags(frames.silver(spark, folder))
    return flagged.withColumn("total_amount", F.col("total_amount").cast("double"))


_VALID = f"SELECT {_LINE}, CAST(total_amount AS DOUBLE) AS total_amount, purchase_date FROM "


def _valid(spark: SparkSession, folder: str, rule: str) -> DataFrame:
    found = frames.lines(spark, folder, rule)
    return found.withColumn("total_amount", F.col("total_amount").cast("double"))


@query("clean_modeling_lines", with_steps(_VALID + "modeling"))
def clean_modeling_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _valid(spark, folder, "modeling")


@query("clean_strict_lines", with_steps(_VALID + "strict"))
def clean_strict_lines(spark: SparkSession, folder: str) -> DataFrame:
    return _valid(spark, folder, "strict")


@query(
    "clean_time_cuts",
    with_steps(
        """SELECT 'until' AS cut, count(*) AS row_count, min(purchase_date) AS first_day,
             max(purchase_date) AS last_day
           FROM strict WHERE purchase_date <= DATE '2001-06-08'
           UNION ALL SELECT 'after_within', count(*), min(purchase_date), max(purchase_date)
           FROM strict WHERE purchase_date > DATE '2001-06-08'
             AND purchase_date <= DATE '2001-06-08' + 30
           UNION ALL SELECT 'between', count(*), min(purchase_date), max(purchase_date)
           FROM strict WHERE purchase_date BETWEEN DATE '2001-05-09' AND DATE '2001-06-08'"""
    ),
)
def clean_time_cuts(spark: SparkSession, folder: str) -> DataFrame:
    """The three time cuts, counted in one pass."""
    strict = frames.lines(spark, folder, "strict")
    cuts = {
        "until": line.until("2001-06-08"),
        "after_within": line.after_within("2001-06-08", 30),
        "between": line.between("2001-05-09", "2001-06-08"),
    }
    names = F.array_compact(F.array(*[F.when(test, F.lit(n)) for n, test in cuts.items()]))
    return (
        strict.select("purchase_date", F.explode(names).alias("cut"))
        .groupBy("cut")
        .agg(
            F.count("*").alias("row_count"),
            F.min("purchase_date").alias("first_day"),
            F.max("purchase_date").alias("last_day"),
        )
    )


@query("clean_product_lines", with_steps("SELECT * FROM silver WHERE stock_code = '77'"))
def clean_product_lines(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.lines_of_product(frames.silver(spark, folder), "77")


@query("clean_discount_lines", with_steps("SELECT * FROM silver WHERE description = 'Discount'"))
def clean_discount_lines(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.discount_lines(frames.silver(spark, folder))


@query("clean_non_positive_quantity", with_steps("SELECT * FROM silver WHERE quantity <= 0"))
def clean_non_positive_quantity(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.non_positive_quantity(frames.silver(spark, folder))


@query("clean_model_input", with_steps("SELECT * FROM round_input"))
def clean_model_input(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.model_input(frames.round_features(spark, folder))


@query(
    "clean_decimals_to_double",
    with_steps("SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM silver"),
)
def clean_decimals_to_double(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.decimals_to_double(frames.silver(spark, folder))


@query(
    "quality_row_and_duplicate_counts",
    with_steps(
        """SELECT (SELECT count(*) FROM renamed) AS row_count, count(*) AS distinct_rows,
             (SELECT count(*) FROM renamed) - count(*) AS duplicate_rows
           FROM (SELECT DISTINCT * FROM renamed)"""
    ),
)
def quality_row_and_duplicate_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_count(clean_renamed(spark, folder))


_TYPES = " UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS column_name, CASE any_value(typeof({c}))
      WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
      ELSE lower(any_value(typeof({c}))) END AS data_type, count({c}) AS present_rows FROM silver"""
    for i, c in enumerate(TRANSACTION_COLUMNS)
)


@query("quality_column_types", with_steps(_TYPES))
def quality_column_types(spark: SparkSession, folder: str) -> DataFrame:
    """Types as the written files state them, not as the code does."""
    tables = Tables.scratch(spark)
    tables.write_full(frames.silver(spark, folder), "silver", "transactions")
    return quality.column_types(spark.read.parquet(tables.path("silver", "transactions")))


@query(
    "quality_date_range",
    with_steps(
        "SELECT min(invoice_date) AS min_date, max(invoice_date) AS max_date FROM renamed"
    ),
)
def quality_date_range(spark: SparkSession, folder: str) -> DataFrame:
    return quality.date_range(clean_renamed(spark, folder), "invoice_date")


_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM renamed"
    for c in TRANSACTION_COLUMNS
)


@query("quality_null_counts", with_steps(_NULLS))
def quality_null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_counts(clean_renamed(spark, folder))


_REPORT_NULLS = " UNION ALL ".join(
    f"SELECT 'null_rows', '{c}', count(*) - count({c}), count(*) = count({c}) FROM renamed"
    for c in TRANSACTION_COLUMNS
)


@query(
    "quality_report",
    with_steps(
        f"""SELECT 'row_count' AS check_name, '*' AS subject, count(*) AS measure,
              count(*) > 0 AS passed FROM renamed
            UNION ALL SELECT 'column_count', '*', 8, true
            UNION ALL SELECT 'date_column', 'invoice_date', 1, true
            UNION ALL SELECT 'date_range', 'invoice_date', 1, min(invoice_date) IS NOT NULL
              FROM renamed
            UNION ALL SELECT 'duplicate_rows', '*', (SELECT count(*) FROM renamed) - count(*),
              (SELECT count(*) FROM renamed) = count(*) FROM (SELECT DISTINCT * FROM renamed)
            UNION ALL {_REPORT_NULLS}"""
    ),
)
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(clean_renamed(spark, folder), "invoice_date")


@query(
    "quality_batch_checks",
    with_steps(
        """SELECT count(*) AS batch_rows, count(DISTINCT invoice) AS batch_invoices,
             min(d) AS min_date, max(d) AS max_date,
             count(*) FILTER (d < DATE '2001-05-09' OR d > DATE '2001-06-01') AS rows_outside_window,
             count(*) FILTER (description IS NULL) AS null_rows,
             count(*) FILTER (quantity <= 0 OR price <= 0) AS non_positive_rows,
             (SELECT count(*) FROM (SELECT invoice, stock_code FROM lot
               GROUP BY invoice, stock_code HAVING count(*) > 1)) AS duplicate_keys
           FROM lot""",
        """lot AS (SELECT *, CAST(invoice_date AS DATE) AS d FROM silver
           WHERE CAST(invoice_date AS DATE) BETWEEN DATE '2001-05-09' AND DATE '2001-06-07')""",
    ),
)
def quality_batch_checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.batch_checks(_batch_lines(spark, folder), "2001-05-09", "2001-06-01")


@query(
    "quality_scoring_input",
    with_steps(
        """SELECT count(*) AS row_count,
             count(*) - (SELECT count(*) FROM (SELECT DISTINCT customer_id, scoring_date
               FROM round_features)) AS duplicate_keys,
             count(*) FILTER (total_spent IS NULL OR average_ticket IS NULL) AS null_feature_rows,
             count(*) FILTER (NOT isfinite(total_spent) OR NOT isfinite(average_ticket))
               AS non_finite_rows
           FROM round_features"""
    ),
)
def quality_scoring_input(spark: SparkSession, folder: str) -> DataFrame:
    return quality.input_checks(frames.round_features(spark, folder))


@query(
    "quality_scores",
    with_steps(
        """SELECT count(*) AS row_count,
             count(*) - (SELECT count(*) FROM (SELECT DISTINCT customer_id, scoring_date
               FROM scores)) AS duplicate_keys,
             count(*) FILTER (NOT isfinite(reactivation_probability)) AS non_finite_scores,
             count(*) FILTER (reactivation_probability < 0 OR reactivation_probability > 1)
               AS scores_outside_unit,
             count(*) FILTER (priority_group IS NULL) AS missing_groups
           FROM scores"""
    ),
)
def quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score_checks(frames.scored_rounds(spark, folder))


@query(
    "quality_windowed_input",
    with_steps(
        """SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS duplicate_keys,
             count(*) FILTER (inactive_days > 180) AS null_feature_rows,
             count(*) FILTER (inactive_days > 180) AS non_finite_rows
           FROM population"""
    ),
)
def quality_windowed_input(spark: SparkSession, folder: str) -> DataFrame:
    """Customers who bought nothing in the window have no features to explain."""
    windowed = modeling_base(
        frames.lines(spark, folder, "modeling"),
        frames.dates(),
        Parameters(observation_days=OBSERVATION_DAYS),
    )
    return quality.input_checks(windowed, "reference_date")
