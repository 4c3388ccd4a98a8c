"""Queries on the monitoring of a scoring round."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.contract import FEATURES, PROBABILITY
from winback.functions import lines
from winback.functions.dates import as_date
from winback.functions.drift import psi, psi_status, worst_status
from winback.operators import batches, monitoring
from winback.plans import frames
from winback.plans.catalog import query
from winback.plans.sql import ROUNDED_METRICS, metric_steps, rounded, with_steps
from winback.session import materialise
from winback.sources.bronze import union_parts
from winback.sources.tables import Tables

_DAY, _OPEN = frames.MATURED_ROUND, frames.OPEN_ROUND


def _scores(spark: SparkSession, folder: str) -> DataFrame:
    """Score table of the rounds, written once as scoring leaves it."""
    return materialise(frames.scored_rounds(spark, folder), "scores")


def _stored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """History, scores and reference population as the earlier stages leave them."""
    silver = frames.stored_silver(spark, folder)
    scores, reference = frames.scores_and_reference(silver)
    return silver, materialise(scores, "scores"), materialise(reference, "reference")


def _runs(silver: DataFrame) -> DataFrame:
    """Manifest of the month before the round and of an older, longer batch."""

    def run(scenario: str, first: str, last: str, written: str) -> DataFrame:
        batch = monitoring.round_lines(silver, first, last)
        row = batches.manifest_row(
            batch, f"{first}_{scenario}", scenario, 1, as_date(first), as_date(last), 1500
        )
        return row.withColumn("generated_at", F.lit(written).cast("timestamp"))

    return run("normal", "2001-05-01", "2001-06-30", "2001-07-01 00:00:00").unionByName(
        run("volume_spike", "2001-05-09", "2001-06-08", "2001-07-02 00:00:00")
    )


_WINDOWS = """windows AS (SELECT scoring_date, previous_scoring_date,
  coalesce(previous_scoring_date + 1, scoring_date - 29) AS batch_start_date
  FROM (SELECT scoring_date, lag(scoring_date) OVER (ORDER BY scoring_date)
          AS previous_scoring_date FROM (SELECT DISTINCT scoring_date FROM scores)))"""


@query(
    "monitor_round_window",
    with_steps("SELECT * FROM windows WHERE scoring_date = DATE '2001-06-08'", _WINDOWS),
)
def monitor_round_window(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.round_window(frames.scored_rounds(spark, folder), _DAY)


def _batches(silver: DataFrame) -> DataFrame:
    """Manifest rows of batches as the data has them: a batch per month and one per quarter.

    Dates, time of writing and scenario come from the lines: a batch above the mean size of
    its kind is a spike.
    """

    def per(unit: str) -> DataFrame:
        sizes = silver.groupBy(F.date_trunc(unit, "invoice_date").alias("_unit")).agg(
            F.min(lines.purchase_day()).alias("batch_start_date"),
            F.max(lines.purchase_day()).alias("batch_end_date"),
            F.max("invoice_date").alias("generated_at"),
            F.count("*").alias("_rows"),
        )
        mean = sizes.agg(F.avg("_rows")).scalar()
        spike = F.when(F.col("_rows") > mean, f"{unit}_spike").otherwise(f"{unit}_normal")
        return sizes.withColumn("scenario", spike).drop("_unit", "_rows")

    return per("month").unionByName(per("quarter"))


_BATCHES = ", ".join(
    f"""{unit}_sizes AS (SELECT min(CAST(invoice_date AS DATE)) AS batch_start_date,
      max(CAST(invoice_date AS DATE)) AS batch_end_date, max(invoice_date) AS generated_at,
      count(*) AS n FROM silver GROUP BY date_trunc('{unit}', invoice_date)),
    {unit}_runs AS (SELECT *, CASE WHEN n > (SELECT avg(n) FROM {unit}_sizes) THEN '{unit}_spike'
      ELSE '{unit}_normal' END AS scenario FROM {unit}_sizes)"""
    for unit in ("month", "quarter")
)


@query(
    "monitor_scenario",
    with_steps(
        """SELECT d AS scoring_date, coalesce((SELECT scenario FROM
             (SELECT * FROM month_runs UNION ALL SELECT * FROM quarter_runs)
             WHERE d BETWEEN batch_start_date AND batch_end_date
             ORDER BY generated_at DESC, scenario DESC LIMIT 1), 'unknown') AS scenario
           FROM (SELECT DISTINCT scoring_date AS d FROM scores)""",
        _BATCHES,
    ),
)
def monitor_scenario(spark: SparkSession, folder: str) -> DataFrame:
    runs = materialise(_batches(frames.silver(spark, folder)), "runs")
    return union_parts(*[monitoring.scenario_at(runs, day) for day in frames.ROUNDS])


_LOT = """lot AS (SELECT *, count(*) OVER (PARTITION BY invoice, stock_code, description, quantity,
    invoice_date, price, customer_id, country) AS copies
  FROM silver WHERE CAST(invoice_date AS DATE)
    BETWEEN (SELECT batch_start_date FROM windows WHERE scoring_date = DATE '2001-06-08')
      AND DATE '2001-06-08'),
counters AS (SELECT count(*) AS batch_rows, count(DISTINCT invoice) AS batch_invoices,
  count(DISTINCT customer_id) AS batch_customers,
  count(*) FILTER (description IS NULL) AS null_rows,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lot)) AS duplicate_rows,
  count(*) FILTER (price <= 0) AS invalid_price_rows,
  count(*) FILTER (quantity <= 0) AS invalid_quantity_rows,
  count(*) FILTER (invoice LIKE 'C%') AS cancelled_rows,
  count(*) FILTER (stock_code LIKE 'TEST%') AS test_rows,
  count(*) FILTER (description = 'Discount') AS discount_rows FROM lot),
quality AS (SELECT *, CASE WHEN null_rows > 0 OR duplicate_rows > 0 OR invalid_price_rows > 0
  OR invalid_quantity_rows > 0 THEN 'CRITICAL' ELSE 'PASS' END AS dq_status FROM counters)"""


@query("monitor_batch_counters", with_steps("SELECT * FROM quality", f"{_WINDOWS}, {_LOT}"))
def monitor_batch_counters(spark: SparkSession, folder: str) -> DataFrame:
    silver = frames.silver(spark, folder)
    return monitoring.batch_counters(monitoring.round_lines(silver, "2001-05-09", _DAY))


_SCORE_STATS = ["score_mean", "score_median", "score_p90", "predicted_positive_rate"]
_DISTRIBUTION = f"""distribution AS (SELECT scoring_date, min(reactivation_probability) AS score_min,
  max(reactivation_probability) AS score_max,
  round(avg(reactivation_probability), 6) AS score_mean,
  round(quantile_cont(reactivation_probability, 0.5), 6) AS score_median,
  round(quantile_cont(reactivation_probability, 0.9), 6) AS score_p90,
  round(avg(prediction_0_5), 6) AS predicted_positive_rate
  FROM scores GROUP BY scoring_date)"""


@query("monitor_score_distribution", with_steps("SELECT * FROM distribution", _DISTRIBUTION))
def monitor_score_distribution(spark: SparkSession, folder: str) -> DataFrame:
    found = monitoring.score_distribution(_scores(spark, folder))
    return found.withColumns({n: F.round(n, 6) for n in _SCORE_STATS})


_PRIORITY = """priority AS (SELECT scoring_date, count(*) AS number_customers,
  count(*) FILTER (priority_group = 'TOP_10') AS top_10_customers,
  count(*) FILTER (priority_group = 'TOP_20') AS top_20_customers,
  count(*) FILTER (priority_group = 'TOP_30') AS top_30_customers,
  count(*) FILTER (priority_group = 'REMAINDER') AS remainder_customers,
  'PASS' AS priority_status FROM scores GROUP BY scoring_date)"""


@query("monitor_priority_counts", with_steps("SELECT * FROM priority", _PRIORITY))
def monitor_priority_counts(spark: SparkSession, folder: str) -> DataFrame:
    return monitoring.priority_counts(frames.scored_rounds(spark, folder))


_VOLUME = """sizes AS (SELECT w.scoring_date,
    (SELECT count(*) FROM scores s WHERE s.scoring_date = w.scoring_date) AS number_customers,
    CASE WHEN previous_scoring_date IS NULL
      THEN (SELECT count(DISTINCT customer_id) FROM base WHERE reference_date = DATE '2000-06-08')
      ELSE (SELECT count(*) FROM scores s WHERE s.scoring_date = w.previous_scoring_date) END
      AS previous_number_customers
  FROM windows w),
volume AS (SELECT *, CASE WHEN abs(volume_change) >= 0.5 THEN 'CRITICAL'
    WHEN abs(volume_change) >= 0.3 THEN 'WARNING' ELSE 'PASS' END AS volume_status
  FROM (SELECT *, CAST(number_customers - previous_number_customers AS DOUBLE)
    / previous_number_customers AS volume_change FROM sizes))"""


@query(
    "monitor_volume_change",
    with_steps(
        "SELECT * FROM volume WHERE scoring_date <> DATE '2001-08-01'", f"{_WINDOWS}, {_VOLUME}"
    ),
)
def monitor_volume_change(spark: SparkSession, folder: str) -> DataFrame:
    """A round with one before it, and the first round against the reference population."""
    _, scores, reference = _stored(spark, folder)
    first = monitoring.volume_change(scores, reference, frames.ROUNDS[0])
    return first.unionByName(monitoring.volume_change(scores, reference, _DAY))


def _psi_steps(reference: str, current: str, names: str, prefix: str) -> str:
    """Steps ending in `<prefix>psi`: columns feature_name and psi."""
    return f"""
{prefix}r AS (UNPIVOT ({reference}) ON {names} INTO NAME feature_name VALUE v),
{prefix}c AS (UNPIVOT ({current}) ON {names} INTO NAME feature_name VALUE v),
{prefix}shape AS (
  SELECT feature_name, count(DISTINCT v) AS n_values,
    (SELECT list_sort(list_distinct(quantile_cont(v, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])))
       FROM {prefix}r r WHERE r.feature_name = b.feature_name) AS edges
  FROM (SELECT * FROM {prefix}r UNION ALL SELECT * FROM {prefix}c) b GROUP BY feature_name),
{prefix}binned AS (
  SELECT feature_name, side, CASE WHEN n_values <= 10 THEN v
    ELSE len(list_filter(edges[2:len(edges) - 1], lambda e: e <= v)) END AS bin
  FROM (SELECT *, 'r' AS side FROM {prefix}r UNION ALL SELECT *, 'c' FROM {prefix}c)
  JOIN {prefix}shape USING (feature_name)),
{prefix}shares AS (
  SELECT feature_name, bin,
    greatest(count(*) FILTER (side = 'r') / CAST((SELECT count(*) FROM {prefix}r r
      WHERE r.feature_name = b.feature_name) AS DOUBLE), 1e-6) AS r,
    greatest(count(*) FILTER (side = 'c') / CAST((SELECT count(*) FROM {prefix}c c
      WHERE c.feature_name = b.feature_name) AS DOUBLE), 1e-6) AS c
  FROM {prefix}binned b GROUP BY feature_name, bin),
{prefix}psi AS (
  SELECT feature_name, CASE WHEN any_value(n_values) > 10 AND len(any_value(edges)) < 3 THEN 0
    ELSE round(sum((c - r) * ln(c / r)), 6) END AS psi
  FROM {prefix}shares JOIN {prefix}shape USING (feature_name) GROUP BY feature_name)"""


_FEATURE_COLUMNS = ", ".join(FEATURES)
_AS_DOUBLES = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in FEATURES)
_FEATURE_PSI = _psi_steps(
    f"SELECT {_AS_DOUBLES} FROM base WHERE reference_date = DATE '2000-06-08'",
    f"SELECT {_AS_DOUBLES} FROM scores WHERE scoring_date = DATE '2001-06-08'",
    _FEATURE_COLUMNS,
    "f",
)
_STATUS = "CASE WHEN {0} >= 0.25 THEN 'CRITICAL' WHEN {0} >= 0.1 THEN 'WARNING' ELSE 'PASS' END"
_FEATURE_STATS = [
    "reference_mean", "current_mean", "reference_median", "current_median", "current_std",
    "current_min", "current_p10", "current_p25", "current_p75", "current_p90", "current_max", "psi",
]
_DRIFT = (
    _FEATURE_PSI
    + """,
ref_stats AS (SELECT feature_name, avg(v) AS reference_mean, median(v) AS reference_median
  FROM fr GROUP BY feature_name),
cur_stats AS (SELECT feature_name, avg(v) AS current_mean, median(v) AS current_median,
  stddev_samp(v) AS current_std, min(v) AS current_min, quantile_cont(v, 0.1) AS current_p10,
  quantile_cont(v, 0.25) AS current_p25, quantile_cont(v, 0.75) AS current_p75,
  quantile_cont(v, 0.9) AS current_p90, max(v) AS current_max FROM fc GROUP BY feature_name),
drift AS (SELECT DATE '2001-06-08' AS scoring_date, DATE '2000-06-08' AS reference_date, *
  FROM ref_stats JOIN cur_stats USING (feature_name) JOIN fpsi USING (feature_name))"""
)


def _drift(spark: SparkSession, folder: str) -> DataFrame:
    _, scores, reference = _stored(spark, folder)
    current = monitoring.at_date(scores, _DAY)
    return monitoring.feature_drift(reference, current, _DAY, frames.DRIFT_REFERENCE)


@query(
    "monitor_feature_drift",
    with_steps(
        f"SELECT scoring_date, reference_date, feature_name, {rounded(_FEATURE_STATS)}, "
        f"{_STATUS.format('psi')} AS status FROM drift",
        _DRIFT,
    ),
)
def monitor_feature_drift(spark: SparkSession, folder: str) -> DataFrame:
    return _drift(spark, folder).withColumns({n: F.round(n, 6) for n in _FEATURE_STATS})


@query(
    "monitor_feature_psi",
    with_steps("SELECT feature_name, psi FROM fpsi", _FEATURE_PSI),
)
def monitor_feature_psi(spark: SparkSession, folder: str) -> DataFrame:
    _, scores, reference = _stored(spark, folder)
    found = psi(reference, monitoring.at_date(scores, _DAY), FEATURES)
    return found.withColumn("psi", F.round("psi", 6))


# The round's features of later and larger purchases, against the round itself.
_SHIFTED = {"total_items": 2.5, "total_spent": 1.4, "average_ticket": 1.4}
_SHIFT_SQL = ", ".join(
    f"CAST({f} AS DOUBLE) * {_SHIFTED.get(f, 1)}::DOUBLE AS {f}" for f in FEATURES
)
_SHIFT_PSI = _psi_steps(
    f"SELECT {_AS_DOUBLES} FROM scores WHERE scoring_date = DATE '2001-06-08'",
    f"SELECT {_SHIFT_SQL} FROM scores WHERE scoring_date = DATE '2001-06-08'",
    _FEATURE_COLUMNS,
    "s",
)


@query(
    "monitor_psi_status",
    with_steps(
        f"""SELECT feature_name, psi, {_STATUS.format('psi')} AS status,
              {_STATUS.format('(SELECT max(psi) FROM spsi)')} AS worst_status FROM spsi""",
        _SHIFT_PSI,
    ),
)
def monitor_psi_status(spark: SparkSession, folder: str) -> DataFrame:
    """Every feature's status and the worst of all, for a round with shifted amounts."""
    current = monitoring.at_date(_scores(spark, folder), _DAY)
    shifted = current.withColumns(
        {f: F.col(f) * F.lit(float(factor)) for f, factor in _SHIFTED.items()}
    )
    found = psi(current, shifted, FEATURES).withColumn("psi", F.round("psi", 6))
    rows = materialise(found.withColumn("status", psi_status(F.col("psi"))), "psi")
    seen = [
        rows.filter(F.col("feature_name") == f).select("status").scalar() for f in FEATURES
    ]
    return rows.withColumn("worst_status", worst_status(*seen))


_SCORE_PSI = _psi_steps(
    "SELECT reactivation_probability FROM scores WHERE scoring_date = DATE '2001-05-08'",
    "SELECT reactivation_probability FROM scores WHERE scoring_date = DATE '2001-06-08'",
    PROBABILITY,
    "p",
)


@query(
    "monitor_score_drift",
    with_steps(
        f"SELECT DATE '2001-06-08' AS scoring_date, psi AS score_psi, "
        f"{_STATUS.format('psi')} AS score_drift_status FROM ppsi",
        _SCORE_PSI,
    ),
)
def monitor_score_drift(spark: SparkSession, folder: str) -> DataFrame:
    found = monitoring.score_drift(_scores(spark, folder), _DAY)
    return found.withColumn("score_psi", F.round("score_psi", 6))


@query(
    "monitor_target_maturity",
    with_steps(
        """SELECT d AS scoring_date, d + 30 AS target_end_date, m AS maximum_history_date,
             CASE WHEN m >= d + 30 THEN 'MATURED' ELSE 'NOT_MATURED' END AS target_status
           FROM (SELECT unnest([DATE '2001-06-08', DATE '2001-08-01']) AS d),
             (SELECT max(CAST(invoice_date AS DATE)) AS m FROM silver)"""
    ),
)
def monitor_target_maturity(spark: SparkSession, folder: str) -> DataFrame:
    silver = frames.silver(spark, folder)
    return monitoring.target_maturity(silver, _DAY).unionByName(
        monitoring.target_maturity(silver, _OPEN)
    )


_MATURED = """matured AS (SELECT scoring_date, customer_id, reactivation_probability,
  CASE WHEN customer_id IN (SELECT customer_id FROM strict
    WHERE purchase_date > DATE '2001-06-08' AND purchase_date <= DATE '2001-06-08' + 30)
    THEN 1 ELSE 0 END AS target_reactivated_30d
  FROM scores WHERE scoring_date = DATE '2001-06-08')"""


@query(
    "monitor_matured_labels",
    with_steps(
        "SELECT customer_id, reactivation_probability, target_reactivated_30d FROM matured",
        _MATURED,
    ),
)
def monitor_matured_labels(spark: SparkSession, folder: str) -> DataFrame:
    scores = frames.scored_rounds(spark, folder, (_DAY,))
    return monitoring.matured_labels(scores, frames.silver(spark, folder), _DAY).select(
        "customer_id", PROBABILITY, "target_reactivated_30d"
    )


_PERFORMANCE = [
    n for n in ROUNDED_METRICS
    if n not in ("predicted_positive_rate", "precision", "recall", "f1")
]


@query(
    "monitor_performance",
    with_steps(
        f"""SELECT scoring_date, scoring_date + 30 AS target_end_date,
              'synthetic_performance' AS performance_type, {rounded(_PERFORMANCE)}
            FROM evaluated""",
        f"{_MATURED}, {metric_steps('matured', 'scoring_date', 'customer_id')}",
    ),
)
def monitor_performance(spark: SparkSession, folder: str) -> DataFrame:
    """The matured round's metrics; the open round adds no row."""
    silver = frames.stored_silver(spark, folder)
    scores = materialise(frames.scores_of(silver), "scores")
    both = monitoring.performance(scores, silver, _DAY).unionByName(
        monitoring.performance(scores, silver, _OPEN)
    )
    return both.drop("calculated_at").withColumns({n: F.round(n, 6) for n in _PERFORMANCE})


_SUMMARY_STEPS = ", ".join(
    [_WINDOWS, _LOT, _DISTRIBUTION, _PRIORITY, _VOLUME, _FEATURE_PSI, _SCORE_PSI]
)
_SUMMARY_SQL = f"""
SELECT *, CASE WHEN 'CRITICAL' IN (dq_status, volume_status, priority_status,
      feature_drift_status, score_drift_status) THEN 'CRITICAL'
    WHEN 'WARNING' IN (dq_status, volume_status, priority_status, feature_drift_status,
      score_drift_status) THEN 'WARNING' ELSE 'PASS' END AS overall_status
FROM (
  SELECT w.scoring_date, 'volume_spike' AS scenario, 'frequency_recency' AS model_name,
    '1' AS model_version, batch_start_date, quality.*, v.number_customers,
    previous_number_customers, volume_change, volume_status, score_min, score_mean, score_median,
    score_p90, score_max, predicted_positive_rate, top_10_customers, top_20_customers,
    top_30_customers, remainder_customers, priority_status,
    (SELECT max(psi) FROM fpsi) AS maximum_feature_psi, (SELECT psi FROM ppsi) AS score_psi,
    {_STATUS.format('(SELECT max(psi) FROM fpsi)')} AS feature_drift_status,
    {_STATUS.format('(SELECT psi FROM ppsi)')} AS score_drift_status,
    'MATURED' AS target_status
  FROM windows w JOIN volume v USING (scoring_date) JOIN distribution USING (scoring_date)
  JOIN priority USING (scoring_date), quality
  WHERE w.scoring_date = DATE '2001-06-08')
"""
_SUMMARY_ROUNDED = [*_SCORE_STATS, "maximum_feature_psi", "score_psi"]


def _summary(spark: SparkSession, folder: str) -> DataFrame:
    silver, scores, reference = _stored(spark, folder)
    drift = monitoring.feature_drift(
        reference, monitoring.at_date(scores, _DAY), _DAY, frames.DRIFT_REFERENCE
    )
    return monitoring.summary(scores, silver, reference, _runs(silver), _DAY, drift)


@query("monitor_round_summary", with_steps(_SUMMARY_SQL, _SUMMARY_STEPS))
def monitor_round_summary(spark: SparkSession, folder: str) -> DataFrame:
    return _summary(spark, folder).drop("monitored_at").withColumns(
        {n: F.round(n, 6) for n in _SUMMARY_ROUNDED}
    )


@query(
    "monitor_stored_tables",
    with_steps(
        """SELECT 'summary' AS table_key, DATE '2001-06-08' AS scoring_date,
             CAST(1 AS BIGINT) AS row_count
           UNION ALL SELECT 'feature_monitoring', DATE '2001-06-08', CAST(count(*) AS BIGINT)
             FROM fpsi
           UNION ALL SELECT 'performance', DATE '2001-06-08', CAST(1 AS BIGINT)""",
        _FEATURE_PSI,
    ),
)
def monitor_stored_tables(spark: SparkSession, folder: str) -> DataFrame:
    """A round monitored twice leaves each table as after the first time."""
    tables = Tables.scratch(spark)
    silver, scores, reference = _stored(spark, folder)
    for _ in range(2):
        monitoring.monitor_round(
            tables, scores, silver, reference, None, _DAY, frames.DRIFT_REFERENCE
        )

    def size(key: str) -> DataFrame:
        stored = tables.read("monitoring", key)
        return stored.groupBy("scoring_date").agg(F.count("*").alias("row_count")).select(
            F.lit(key).alias("table_key"), "scoring_date", "row_count"
        )

    return size("summary").unionByName(size("feature_monitoring")).unionByName(size("performance"))


@query(
    "monitor_feature_view",
    with_steps(
        f"SELECT feature_name, psi, {_STATUS.format('psi')} AS status FROM fpsi", _FEATURE_PSI
    ),
)
def monitor_feature_view(spark: SparkSession, folder: str) -> DataFrame:
    """Features of a stored round, largest PSI first."""
    tables = Tables.scratch(spark)
    tables.write_replace(
        _drift(spark, folder), "monitoring", "feature_monitoring", "scoring_date", as_date(_DAY)
    )
    return monitoring.feature_view(tables, _DAY).select(
        "feature_name", F.round("psi", 6).alias("psi"), "status"
    )
