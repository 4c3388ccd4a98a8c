"""Exploratory summaries of the transaction table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winback.contract import INACTIVE_DAYS, PREDICTION_DAYS
from winback.functions import lines
from winback.functions.dates import as_date
from winback.functions.ordered import exact_percentiles
from winback.operators.cleaning import valid_lines
from winback.operators.population import population
from winback.operators.quality import count_where

# Gaps, in days, after which a return is counted.
RETURN_GAPS = (30, 60, 90)
DISTRIBUTION = {"p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}


def _as_double(total: Column) -> Column:
    return total.cast("double")


def distinct_customers(df: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(count(F.col("customer_id")).alias("distinct_customers"))


def available_period(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("invoice_date").alias("min_invoice_date"),
        F.max("invoice_date").alias("max_invoice_date"),
    )


def purchases_per_customer(df: DataFrame) -> DataFrame:
    """Lines, mean quantity and amounts, largest mean quantity first."""
    quantity, price = F.sum("quantity"), F.sum("price")
    return (
        df.groupBy("customer_id")
        .agg(
            F.count("*").alias("num_transactions"),
            F.avg("quantity").alias("avg_quantity"),
            (_as_double(quantity) * _as_double(price)).alias("sum_qty_times_sum_price"),
            _as_double(F.sum(lines.line_amount())).alias("total_amount"),
        )
        .orderBy(F.col("avg_quantity").desc(), "customer_id")
    )


def customer_days(df: DataFrame) -> DataFrame:
    """Distinct purchase days per customer: as many rows as the calendar allows."""
    return df.select("customer_id", lines.purchase_day().alias("purchase_date")).distinct()


def days_between_purchases(df: DataFrame) -> DataFrame:
    """Gaps between consecutive purchase days of a customer.

    Pairs of lines on one day never count, so the days alone decide; ordering them
    instead of the lines keeps a hot customer small.
    """
    by_day = Window.partitionBy("customer_id").orderBy("purchase_date")
    gap = F.datediff("purchase_date", F.lag("purchase_date").over(by_day))
    return (
        customer_days(df)
        .select("customer_id", gap.alias("days_between_invoices"))
        .filter(F.col("days_between_invoices").isNotNull())
    )


def cancellations(df: DataFrame) -> DataFrame:
    """Lines, quantity and amounts of cancelled and other lines, with their shares."""
    grouped = df.groupBy(lines.is_cancelled().alias("is_cancelled")).agg(
        F.count("*").alias("num_transactions"),
        F.sum("quantity").alias("total_quantity"),
        (_as_double(F.sum("quantity")) * _as_double(F.sum("price"))).alias(
            "sum_qty_times_sum_price"
        ),
        _as_double(F.sum(lines.line_amount())).alias("total_amount"),
    )
    # Two rows, or three with missing invoices.
    everything = Window.partitionBy()
    return grouped.withColumn(
        "share_of_lines", F.col("num_transactions") / F.sum("num_transactions").over(everything)
    )


def single_date_population(
    df: DataFrame,
    day: date | str,
    inactive_days: int = INACTIVE_DAYS,
    prediction_days: int = PREDICTION_DAYS,
) -> DataFrame:
    """Inactive customers at one date with their return label, strict rule."""
    strict = valid_lines(df, "strict")
    return population(strict, [as_date(day)], inactive_days, prediction_days)


def value_distributions(df: DataFrame) -> DataFrame:
    """Recency per customer, amount per customer and ticket per invoice."""
    strict = valid_lines(df, "strict")
    last_day = df.agg(F.max(lines.purchase_day())).scalar()
    per_customer = strict.groupBy("customer_id").agg(
        F.max("purchase_date").alias("_last"), _as_double(F.sum("total_amount")).alias("_amount")
    )
    long = (
        per_customer.select(
            F.datediff(last_day, "_last").cast("double").alias("recency_days"),
            F.col("_amount").alias("customer_amount"),
        )
        .unpivot([], ["recency_days", "customer_amount"], "measure", "value")
        .unionByName(
            strict.groupBy("invoice")
            .agg(_as_double(F.sum("total_amount")).alias("value"))
            .select(F.lit("invoice_ticket").alias("measure"), "value")
        )
    )
    return exact_percentiles(
        long, ["measure"], "value", {"minimum": 0.0, **DISTRIBUTION, "maximum": 1.0}
    )


def customers_per_country(df: DataFrame) -> DataFrame:
    return df.groupBy("country").agg(F.count_distinct("customer_id").alias("customers"))


def monthly_activity(df: DataFrame) -> DataFrame:
    """Active customers, orders and revenue per month, strict rule."""
    strict = valid_lines(df, "strict")
    return (
        strict.groupBy(F.trunc("purchase_date", "MM").alias("month"))
        .agg(
            F.count_distinct("customer_id").alias("active_customers"),
            F.count_distinct("invoice").alias("orders"),
            _as_double(F.sum("total_amount")).alias("revenue"),
        )
        .orderBy("month")
    )


def returning_customers(df: DataFrame, gaps: tuple[int, ...] = RETURN_GAPS) -> DataFrame:
    """Customers that came back after at least so many days without a purchase."""
    strict = valid_lines(df, "strict").drop("purchase_date")
    longest = (
        days_between_purchases(strict)
        .groupBy("customer_id")
        .agg(F.max("days_between_invoices").alias("_longest"))
    )
    counted = longest.agg(
        *[count_where(F.col("_longest") >= gap).alias(str(gap)) for gap in gaps]
    )
    return counted.unpivot([], [F.col(f"`{g}`") for g in gaps], "gap", "customers").select(
        F.col("gap").cast("int").alias("gap_days"), "customers"
    )


def mean_amount_by(df: DataFrame, column: str) -> DataFrame:
    """Mean line amount per value of a column, strict rule."""
    total = F.sum("total_amount")
    return (
        valid_lines(df, "strict")
        .groupBy(column)
        .agg((_as_double(total) / F.count("*")).alias("mean_amount"), F.count("*").alias("lines"))
    )
