"""Exploratory queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.operators import explore
from winback.plans import frames
from winback.plans.catalog import query
from winback.plans.sql import with_steps


@query(
    "explore_distinct_customers",
    with_steps("SELECT count(DISTINCT customer_id) AS distinct_customers FROM silver"),
)
def explore_distinct_customers(spark: SparkSession, folder: str) -> DataFrame:
    return explore.distinct_customers(frames.silver(spark, folder))


@query(
    "explore_available_period",
    with_steps(
        "SELECT min(invoice_date) AS min_invoice_date, max(invoice_date) AS max_invoice_date "
        "FROM silver"
    ),
)
def explore_available_period(spark: SparkSession, folder: str) -> DataFrame:
    return explore.available_period(frames.silver(spark, folder))


@query(
    "explore_purchases_per_customer",
    with_steps(
        """SELECT customer_id, count(*) AS num_transactions,
             CAST(sum(quantity) AS DOUBLE) / count(quantity) AS avg_quantity,
             CAST(sum(quantity) AS DOUBLE) * CAST(sum(price) AS DOUBLE) AS sum_qty_times_sum_price,
             CAST(sum(quantity * price) AS DOUBLE) AS total_amount
           FROM silver GROUP BY customer_id"""
    ),
)
def explore_purchases_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    return explore.purchases_per_customer(frames.silver(spark, folder))


@query(
    "explore_days_between_purchases",
    with_steps(
        """SELECT customer_id,
             CAST(CAST(invoice_date AS DATE) - CAST(previous AS DATE) AS INTEGER)
               AS days_between_invoices
           FROM (SELECT customer_id, invoice_date, lag(invoice_date) OVER
                   (PARTITION BY customer_id ORDER BY invoice_date) AS previous FROM silver)
           WHERE strftime(invoice_date, '%Y-%m-%d') <> strftime(previous, '%Y-%m-%d')"""
    ),
)
def explore_days_between_purchases(spark: SparkSession, folder: str) -> DataFrame:
    return explore.days_between_purchases(frames.silver(spark, folder))


@query(
    "explore_cancellations",
    with_steps(
        """SELECT invoice LIKE 'C%' AS is_cancelled, count(*) AS num_transactions,
             CAST(sum(quantity) AS BIGINT) AS total_quantity,
             CAST(sum(quantity) AS DOUBLE) * CAST(sum(price) AS DOUBLE) AS sum_qty_times_sum_price,
             CAST(sum(quantity * price) AS DOUBLE) AS total_amount,
             CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM silver) AS share_of_lines
           FROM silver GROUP BY 1"""
    ),
)
def explore_cancellations(spark: SparkSession, folder: str) -> DataFrame:
    return explore.cancellations(frames.silver(spark, folder))


@query(
    "explore_single_date_target",
    with_steps(
        """SELECT customer_id, DATE '2001-06-08' AS reference_date, last_purchase_date,
             CAST(DATE '2001-06-08' - last_purchase_date AS INTEGER) AS inactive_days,
             CASE WHEN customer_id IN (SELECT customer_id FROM strict
               WHERE purchase_date > DATE '2001-06-08' AND purchase_date <= DATE '2001-06-08' + 30)
             THEN 1 ELSE 0 END AS target_reactivated_30d
           FROM (SELECT customer_id, max(purchase_date) AS last_purchase_date FROM strict
                 WHERE purchase_date <= DATE '2001-06-08' GROUP BY customer_id)
           WHERE DATE '2001-06-08' - last_purchase_date >= 60"""
    ),
)
def explore_single_date_target(spark: SparkSession, folder: str) -> DataFrame:
    return explore.single_date_population(frames.silver(spark, folder), "2001-06-08")


_QUANTILES = ", ".join(
    f"round(quantile_cont(value, {p}), 6) AS {n}"
    for n, p in {
        "minimum": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "maximum": 1.0
    }.items()
)


@query(
    "explore_value_distributions",
    with_steps(
        f"SELECT measure, {_QUANTILES} FROM long GROUP BY measure",
        """long AS (
          SELECT 'recency_days' AS measure, CAST((SELECT max(CAST(invoice_date AS DATE)) FROM silver)
            - max(purchase_date) AS DOUBLE) AS value FROM strict GROUP BY customer_id
          UNION ALL SELECT 'customer_amount', CAST(sum(total_amount) AS DOUBLE)
            FROM strict GROUP BY customer_id
          UNION ALL SELECT 'invoice_ticket', CAST(sum(total_amount) AS DOUBLE)
            FROM strict GROUP BY invoice)""",
    ),
)
def explore_value_distributions(spark: SparkSession, folder: str) -> DataFrame:
    found = explore.value_distributions(frames.silver(spark, folder))
    return found.select(
        "measure", *[F.round(c, 6).alias(c) for c in found.columns if c != "measure"]
    )


@query(
    "explore_customers_per_country",
    with_steps(
        "SELECT country, count(DISTINCT customer_id) AS customers FROM silver GROUP BY country"
    ),
)
def explore_customers_per_country(spark: SparkSession, folder: str) -> DataFrame:
    return explore.customers_per_country(frames.silver(spark, folder))


@query(
    "explore_monthly_activity",
    with_steps(
        """SELECT CAST(date_trunc('month', purchase_date) AS DATE) AS "month",
             count(DISTINCT customer_id) AS active_customers, count(DISTINCT invoice) AS orders,
             CAST(sum(total_amount) AS DOUBLE) AS revenue
           FROM strict GROUP BY 1"""
    ),
)
def explore_monthly_activity(spark: SparkSession, folder: str) -> DataFrame:
    return explore.monthly_activity(frames.silver(spark, folder))


@query(
    "explore_returning_customers",
    with_steps(
        """SELECT CAST(g AS INTEGER) AS gap_days,
             count(DISTINCT customer_id) FILTER (gap >= g) AS customers
           FROM gaps, (SELECT unnest([30, 60, 90]) AS g) GROUP BY g""",
        """gaps AS (SELECT customer_id, lead(purchase_date) OVER
             (PARTITION BY customer_id ORDER BY purchase_date) - purchase_date AS gap
           FROM strict)""",
    ),
)
def explore_returning_customers(spark: SparkSession, folder: str) -> DataFrame:
    return explore.returning_customers(frames.silver(spark, folder))


def _mean_sql(column: str) -> str:
    return with_steps(
        f"SELECT {column}, CAST(sum(total_amount) AS DOUBLE) / count(*) AS mean_amount, "
        f"count(*) AS lines FROM strict GROUP BY {column}"
    )


@query("explore_mean_amount_by_country", _mean_sql("country"))
def explore_mean_amount_by_country(spark: SparkSession, folder: str) -> DataFrame:
    return explore.mean_amount_by(frames.silver(spark, folder), "country")


@query("explore_mean_amount_by_product", _mean_sql("stock_code"))
def explore_mean_amount_by_product(spark: SparkSession, folder: str) -> DataFrame:
    return explore.mean_amount_by(frames.silver(spark, folder), "stock_code")
