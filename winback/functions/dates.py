"""Reference dates and the mapping of days onto them."""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Sequence
from datetime import date, timedelta
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def reference_dates(
    spark: SparkSession, start: date | str, end: date | str, step: str = "1 MONTH"
) -> DataFrame:
    """One row per reference date, both ends included."""
    return spark.range(1).select(
        F.explode(
            F.sequence(
                F.lit(as_date(start)), F.lit(as_date(end)), F.expr(f"INTERVAL {step}")
            )
        ).alias("reference_date")
    )


def monthly_dates(start: date | str, end: date | str) -> list[date]:
    """The same dates as values; a parameter list, its length does not follow the data."""
    start, end, found = as_date(start), as_date(end), []
    for month in count(start.month - 1):
        year = start.year + month // 12
        last = monthrange(year, month % 12 + 1)[1]
        day = date(year, month % 12 + 1, min(start.day, last))
        if day > end:
            return found
        found.append(day)


def _lookup(values: Sequence[int], position: Column) -> Column:
    table = F.expr(f"array({','.join(map(str, values))})")
    last = len(values) - 1
    return F.get(table, F.least(F.greatest(position, F.lit(0)), F.lit(last)))


def first_index_from(day: str, dates: Sequence[date]) -> Column:
    """Position of the first of `dates` not before the day in a column; len(dates) if none."""
    positions, index = [], 0
    for offset in range((dates[-1] - dates[0]).days + 1):
        if dates[0] + timedelta(days=offset) > dates[index]:
            index += 1
        positions.append(index)
    positions.append(len(dates))
    return _lookup(positions, F.datediff(F.expr(day), F.lit(dates[0])))


def last_index_until(day: str, dates: Sequence[date]) -> Column:
    """Position of the last of `dates` not after the day in a column; -1 if none."""
    positions, index = [-1], -1
    for offset in range((dates[-1] - dates[0]).days + 1):
        if index + 1 < len(dates) and dates[0] + timedelta(days=offset) >= dates[index + 1]:
            index += 1
        positions.append(index)
    return _lookup(positions, F.datediff(F.expr(day), F.lit(dates[0])) + 1)


def date_at(index: Column, dates: Sequence[date]) -> Column:
    table = ",".join(f"DATE '{day}'" for day in dates)
    return F.get(F.expr(f"array({table})"), index)
