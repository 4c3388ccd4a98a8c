"""Predicates on transaction lines."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.contract import MONTH

# Markers in the source columns.
CANCEL_PREFIX = "C"
TEST_PREFIX = "TEST"
DISCOUNT = "Discount"


def is_cancelled() -> Column:
    return F.col("invoice").startswith(CANCEL_PREFIX)


def is_test() -> Column:
    return F.col("stock_code").startswith(TEST_PREFIX)


def is_discount() -> Column:
    return F.col("description") == DISCOUNT


def line_amount() -> Column:
    return F.col("quantity") * F.col("price")


def purchase_day() -> Column:
    return F.to_date("invoice_date")


def valid_line(rule: str) -> Column:
    """Lines that count as purchases.

    "modeling" drops cancelled, test, zero-price and zero-quantity lines. "strict" asks
    for positive price and quantity and drops discounts; a missing description is
    neither a discount nor a known product, so strict drops it too.
    """
    kept = ~is_cancelled() & ~is_test()
    if rule == "modeling":
        return kept & (F.col("price") != 0) & (F.col("quantity") != 0)
    if rule == "strict":
        return kept & ~is_discount() & (F.col("price") > 0) & (F.col("quantity") > 0)
    raise ValueError(f"unknown rule {rule!r}; use 'modeling' or 'strict'")


def until(day: date | str) -> Column:
    return purchase_day() <= F.lit(day).cast("date")


def after_within(day: date | str, days: int) -> Column:
    """Days in (day, day + days]."""
    start = F.lit(day).cast("date")
    return (purchase_day() > start) & (purchase_day() <= F.date_add(start, days))


def between(first: date | str, last: date | str) -> Column:
    return purchase_day().between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def month() -> Column:
    """The month of a line, as stored silver is partitioned by it."""
    return F.date_format("invoice_date", "yyyy-MM")


def in_months(df: DataFrame, first: date | str | Column, last: date | str | Column) -> DataFrame:
    """Lines of the months from `first` to `last`, where the frame knows the month.

    Only narrows what is read; a condition on the day still has to follow.
    """
    if MONTH not in df.columns:
        return df

    def of(day: date | str | Column) -> Column:
        day = day if isinstance(day, Column) else F.lit(str(day)).cast("date")
        return F.date_format(day, "yyyy-MM")

    return df.filter(F.col(MONTH).between(of(first), of(last)))
