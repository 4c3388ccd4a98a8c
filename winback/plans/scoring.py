"""Queries on batch scoring and recurring batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.contract import PROBABILITY
from winback.functions import lines as line
from winback.operators import batches, scoring
from winback.plans import frames
from winback.plans.catalog import query
from winback.plans.sql import rounded, with_steps


@query(
    "score_latest_date",
    with_steps("SELECT max(CAST(invoice_date AS DATE)) AS scoring_date FROM silver"),
)
def score_latest_date(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.latest_day(frames.silver(spark, folder))


@query(
    "score_probabilities",
    with_steps(
        """SELECT customer_id, scoring_date, reactivation_probability,
             CASE WHEN reactivation_probability >= 0.5 THEN 1 ELSE 0 END AS prediction_0_5
           FROM round_scores"""
    ),
)
def score_probabilities(spark: SparkSession, folder: str) -> DataFrame:
    features = frames.round_features(spark, folder)
    scored = scoring.with_probability(features, scoring.frequency_recency_score())
    return scored.select("customer_id", "scoring_date", PROBABILITY, "prediction_0_5")


_SCORES = "SELECT * FROM scores"


@query("score_table", with_steps(_SCORES))
def score_table(spark: SparkSession, folder: str) -> DataFrame:
    """The whole score table of three rounds, without the time of scoring."""
    return frames.scored_rounds(spark, folder).drop("scored_at")


@query(
    "score_priority_ranking",
    with_steps(
        """SELECT customer_id, scoring_date, score_rank, score_percentile, priority_group
           FROM scores WHERE scoring_date = (SELECT max(CAST(invoice_date AS DATE)) FROM silver)"""
    ),
)
def score_priority_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking at the last day with a transaction."""
    day = scoring.resolve_scoring_date(frames.silver(spark, folder))
    return frames.scored_rounds(spark, folder, (day,)).select(
        "customer_id", "scoring_date", "score_rank", "score_percentile", "priority_group"
    )


@query(
    "score_summary_by_group",
    with_steps(
        """SELECT scoring_date, priority_group, count(*) AS number_customers,
             min(reactivation_probability) AS minimum_score,
             round(avg(reactivation_probability), 6) AS average_score,
             max(reactivation_probability) AS maximum_score
           FROM scores GROUP BY scoring_date, priority_group"""
    ),
)
def score_summary_by_group(spark: SparkSession, folder: str) -> DataFrame:
    found = scoring.summary_by_group(frames.scored_rounds(spark, folder))
    return found.withColumn("average_score", F.round("average_score", 6))


@query(
    "score_summary",
    with_steps(
        f"""SELECT scoring_date, number_customers, minimum_score, maximum_score,
              {rounded(['average_score', 'predicted_positive_rate'])}
            FROM (SELECT scoring_date, count(*) AS number_customers,
              min(reactivation_probability) AS minimum_score,
              avg(reactivation_probability) AS average_score,
              max(reactivation_probability) AS maximum_score,
              avg(prediction_0_5) AS predicted_positive_rate
            FROM scores GROUP BY scoring_date)"""
    ),
)
def score_summary(spark: SparkSession, folder: str) -> DataFrame:
    found = scoring.summary(frames.scored_rounds(spark, folder))
    return found.withColumns(
        {n: F.round(n, 6) for n in ("average_score", "predicted_positive_rate")}
    )


# Lines up to a day stand for the real table, those of the next month for a stored batch.
_LOTS = """real AS (SELECT * FROM silver WHERE CAST(invoice_date AS DATE) <= DATE '2001-05-08'),
earlier AS (SELECT * FROM silver
  WHERE CAST(invoice_date AS DATE) BETWEEN DATE '2001-05-09' AND DATE '2001-06-07'),
valid AS (SELECT * FROM strict WHERE purchase_date <= DATE '2001-06-07')"""
_START = "2001-06-08"


def _real(spark: SparkSession, folder: str) -> DataFrame:
    return frames.silver(spark, folder).filter(line.until(frames.REAL_UNTIL))


def _earlier(spark: SparkSession, folder: str) -> DataFrame:
    return frames.silver(spark, folder).filter(line.between(*frames.BATCH))


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return frames.silver(spark, folder).filter(line.until(frames.BATCH[1]))


@query(
    "batch_next_window",
    with_steps(
        """SELECT start AS batch_start_date, start + 29 AS batch_end_date,
             strftime(start, '%Y%m%d') || '_' || strftime(start + 29, '%Y%m%d') || '_normal'
               AS batch_id
           FROM (SELECT coalesce((SELECT max(CAST(invoice_date AS DATE)) FROM earlier),
                   (SELECT max(CAST(invoice_date AS DATE)) FROM real)) + 1 AS start)""",
        _LOTS,
    ),
)
def batch_next_window(spark: SparkSession, folder: str) -> DataFrame:
    return batches.next_window(_real(spark, folder), _earlier(spark, folder))


@query(
    "batch_history_before",
    with_steps("SELECT * FROM real UNION ALL SELECT * FROM earlier", _LOTS),
)
def batch_history_before(spark: SparkSession, folder: str) -> DataFrame:
    return batches.history_before(_real(spark, folder), _earlier(spark, folder), _START)


@query(
    "batch_stored_rows",
    with_steps(
        """SELECT 'SYN-20010509_20010607_normal-' || invoice AS invoice, stock_code, quantity
           FROM earlier""",
        _LOTS,
    ),
)
def batch_stored_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of a batch found by its invoice prefix among all lines."""
    batch_id = "20010509_20010607_normal"
    stamped = _earlier(spark, folder).withColumn(
        "invoice", F.concat(F.lit(batches.invoice_prefix(batch_id)), "invoice")
    )
    stored = _real(spark, folder).unionByName(stamped)
    return batches.batch_rows(stored, batch_id).select("invoice", "stock_code", "quantity")


_LATEST = """latest AS (SELECT customer_id, country, purchase_date FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id
    ORDER BY invoice_date DESC, invoice DESC, stock_code DESC, country DESC) AS k FROM valid)
  WHERE k = 1)"""


@query(
    "batch_latest_country",
    with_steps("SELECT customer_id, country FROM latest", f"{_LOTS}, {_LATEST}"),
)
def batch_latest_country(spark: SparkSession, folder: str) -> DataFrame:
    return batches.latest_country(_history(spark, folder))


_PROFILES = """profiles AS (SELECT customer_id, country,
  CAST(DATE '2001-06-08' - purchase_date AS INTEGER) AS inactive_days FROM latest)"""


@query(
    "batch_customer_profiles",
    with_steps("SELECT * FROM profiles", f"{_LOTS}, {_LATEST}, {_PROFILES}"),
)
def batch_customer_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return batches.customer_profiles(_history(spark, folder), _START)


@query(
    "batch_customer_pools",
    with_steps(
        """SELECT 'inactive' AS pool, * FROM profiles WHERE inactive_days >= 60
             OR NOT EXISTS (SELECT 1 FROM profiles WHERE inactive_days >= 60)
           UNION ALL SELECT 'active' AS pool, * FROM profiles WHERE inactive_days < 60
             OR NOT EXISTS (SELECT 1 FROM profiles WHERE inactive_days < 60)""",
        f"{_LOTS}, {_LATEST}, {_PROFILES}",
    ),
)
def batch_customer_pools(spark: SparkSession, folder: str) -> DataFrame:
    return batches.customer_pools(batches.customer_profiles(_history(spark, folder), _START))


_CATALOG = """catalog AS (SELECT stock_code, description,
  CAST(sum(price) AS DOUBLE) / count(price) AS base_price, CAST(count(*) AS DOUBLE) AS frequency
  FROM valid GROUP BY stock_code, description HAVING sum(price) > 0),
consolidated AS (SELECT stock_code, min(description) AS description,
  sum(base_price * frequency) / sum(frequency) AS base_price, sum(frequency) AS frequency
  FROM catalog GROUP BY stock_code)"""


@query(
    "batch_product_catalog",
    with_steps("SELECT * FROM catalog", f"{_LOTS}, {_CATALOG}"),
)
def batch_product_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return batches.product_catalog(_history(spark, folder))


@query(
    "batch_consolidated_catalog",
    with_steps(
        "SELECT stock_code, description, round(base_price, 6) AS base_price, frequency "
        "FROM consolidated",
        f"{_LOTS}, {_CATALOG}",
    ),
)
def batch_consolidated_catalog(spark: SparkSession, folder: str) -> DataFrame:
    found = batches.consolidate_catalog(batches.product_catalog(_history(spark, folder)))
    return found.withColumn("base_price", F.round("base_price", 6))


@query(
    "batch_product_share",
    with_steps(
        """SELECT stock_code, frequency,
             frequency / (SELECT sum(frequency) FROM consolidated) AS product_share
           FROM consolidated""",
        f"{_LOTS}, {_CATALOG}",
    ),
)
def batch_product_share(spark: SparkSession, folder: str) -> DataFrame:
    catalog = batches.consolidate_catalog(batches.product_catalog(_history(spark, folder)))
    return batches.with_product_share(catalog).select("stock_code", "frequency", "product_share")


@query(
    "batch_daily_summary",
    with_steps(
        """SELECT CAST(invoice_date AS DATE) AS purchase_date, count(*) AS number_rows,
             count(DISTINCT invoice) AS number_invoices,
             count(DISTINCT customer_id) AS number_customers
           FROM earlier GROUP BY 1""",
        _LOTS,
    ),
)
def batch_daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    return batches.daily_summary(_earlier(spark, folder))


@query(
    "batch_first_lines",
    with_steps(
        """SELECT * FROM earlier ORDER BY invoice_date, invoice, stock_code, description NULLS FIRST,
             quantity, price, customer_id, country LIMIT 20""",
        _LOTS,
    ),
)
def batch_first_lines(spark: SparkSession, folder: str) -> DataFrame:
    return batches.first_lines(_earlier(spark, folder))
