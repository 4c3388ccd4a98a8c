"""Data-quality reports and the gates that read them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.contract import FEATURES, PROBABILITY, TRANSACTION_COLUMNS
from winback.sources.guards import require_columns


class DataQualityError(Exception):
    """A quality gate failed."""


def any_null(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(name).isNull() for name in columns])


def is_finite(name: str) -> Column:
    value = F.col(name)
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def any_non_finite(columns: Sequence[str]) -> Column:
    # A missing value is not finite either.
    return reduce(
        Column.__or__, [~F.coalesce(is_finite(name), F.lit(False)) for name in columns]
    )


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, True))


def count_kinds(name: str) -> Column:
    """Distinct values, a missing value counting as one."""
    missing = F.coalesce(F.max(F.col(name).isNull().cast("int")), F.lit(0))
    return F.count_distinct(F.col(name)) + missing


def _copies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows with their number of copies; copies meet before the exchange."""
    return df.groupBy(*columns).agg(F.count("*").alias("_copies"))


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, one row per column."""
    counted = df.agg(*[count_where(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column_name", "null_rows")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and the difference."""
    copies = F.col("_copies")
    return _copies(df, df.columns).agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("row_count"),
        F.count("*").alias("distinct_rows"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("duplicate_rows"),
    )


def date_range(df: DataFrame, date_column: str) -> DataFrame:
    return df.agg(F.min(date_column).alias("min_date"), F.max(date_column).alias("max_date"))


def column_types(df: DataFrame) -> DataFrame:
    """Columns in order with their type and the rows that have a value, from one pass."""
    counted = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col(f"_{i}").alias("present_rows"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counted.select(F.inline(F.array(*entries)))


def quality_report(df: DataFrame, date_column: str) -> DataFrame:
    """All checks of a table from one pass: check, subject, measure, passed.

    Distinct rows with their number of copies carry everything the checks need.
    """
    columns = df.columns
    copies = F.col("_copies")
    has_date = date_column in columns
    facts = _copies(df, columns).agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("_duplicates"),
        *[
            F.coalesce(F.sum(F.when(F.col(f"`{c}`").isNull(), copies)), F.lit(0)).alias(f"_null_{c}")
            for c in columns
        ],
        *([F.min(date_column).isNotNull().alias("_dated")] if has_date else []),
    )

    def check(name: str, subject: str, measure: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            F.lit(subject).alias("subject"),
            measure.cast("bigint").alias("measure"),
            passed.alias("passed"),
        )

    checks = [
        check("row_count", "*", F.col("_rows"), F.col("_rows") > 0),
        check("column_count", "*", F.lit(len(columns)), F.lit(len(columns) > 0)),
        check("date_column", date_column, F.lit(int(has_date)), F.lit(has_date)),
        check("duplicate_rows", "*", F.col("_duplicates"), F.col("_duplicates") == 0),
    ]
    if has_date:
        dated = F.col("_dated")
        checks.append(check("date_range", date_column, dated.cast("int"), dated))
    for c in columns:
        nulls = F.col(f"`_null_{c}`")
        checks.append(check("null_rows", c, nulls, nulls == 0))
    return facts.select(F.explode(F.array(*checks)).alias("c")).select("c.*")


def enforce(report: DataFrame) -> None:
    """Raise when a check of the report failed; the report has a row per check."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        raise DataQualityError(
            "failed checks: "
            + ", ".join(f"{r['check_name']}({r['subject']})={r['measure']}" for r in failed)
        )


def batch_checks(batch: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """One row of counters for a new batch of transactions."""
    require_columns(batch, TRANSACTION_COLUMNS)
    day = F.to_date("invoice_date")
    outside = ~day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    keys = batch.groupBy("invoice", "stock_code").agg(
        F.count("*").alias("_n"),
        F.min(day).alias("_first"),
        F.max(day).alias("_last"),
        count_where(outside).alias("_outside"),
        count_where(any_null(TRANSACTION_COLUMNS)).alias("_null"),
        count_where((F.col("quantity") <= 0) | (F.col("price") <= 0)).alias("_bad"),
    )
    return keys.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("batch_rows"),
        count_kinds("invoice").alias("batch_invoices"),
        F.min("_first").alias("min_date"),
        F.max("_last").alias("max_date"),
        F.coalesce(F.sum("_outside"), F.lit(0)).alias("rows_outside_window"),
        F.coalesce(F.sum("_null"), F.lit(0)).alias("null_rows"),
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("non_positive_rows"),
        count_where(F.col("_n") > 1).alias("duplicate_keys"),
    )


def enforce_batch(checks: DataFrame, expect_clean: bool = True) -> None:
    """Gate on batch counters; a batch sent to carry defects only checks its window."""
    row = checks.first()
    problems = {}
    if row["batch_rows"] == 0:
        problems["batch_rows"] = 0
    watched = ["rows_outside_window"]
    if expect_clean:
        watched += ["null_rows", "non_positive_rows", "duplicate_keys"]
    problems.update({name: row[name] for name in watched if row[name] > 0})
    if problems:
        raise DataQualityError(f"batch rejected: {problems}")


def input_checks(
    df: DataFrame, date_column: str = "scoring_date", features: Sequence[str] = FEATURES
) -> DataFrame:
    """One row: rows, repeated keys, rows with missing and with non-finite features."""
    doubles = df.select(
        "customer_id", date_column, *[F.col(f).cast("double").alias(f) for f in features]
    )
    keys = doubles.groupBy("customer_id", date_column).agg(
        F.count("*").alias("_n"),
        count_where(any_null(features)).alias("_null"),
        count_where(any_non_finite(features)).alias("_wild"),
    )
    return keys.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        count_where(F.col("_n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum("_null"), F.lit(0)).alias("null_feature_rows"),
        F.coalesce(F.sum("_wild"), F.lit(0)).alias("non_finite_rows"),
    )


def score_checks(scored: DataFrame) -> DataFrame:
    """One row: rows, repeated keys, bad scores and missing groups."""
    score = F.col(PROBABILITY)
    keys = scored.groupBy("customer_id", "scoring_date").agg(
        F.count("*").alias("_n"),
        count_where(any_non_finite([PROBABILITY])).alias("_wild"),
        count_where((score < 0) | (score > 1)).alias("_outside"),
        count_where(F.col("priority_group").isNull()).alias("_ungrouped"),
    )
    return keys.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        count_where(F.col("_n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum("_wild"), F.lit(0)).alias("non_finite_scores"),
        F.coalesce(F.sum("_outside"), F.lit(0)).alias("scores_outside_unit"),
        F.coalesce(F.sum("_ungrouped"), F.lit(0)).alias("missing_groups"),
    )


def enforce_counters(checks: DataFrame, rows: int | None = None) -> None:
    """Raise when a counter other than row_count is above 0, or rows differ."""
    found = checks.first().asDict()
    count = found.pop("row_count")
    problems = {name: value for name, value in found.items() if value > 0}
    if count == 0 or (rows is not None and count != rows):
        problems["row_count"] = count
    if problems:
        raise DataQualityError(f"rejected: {problems}")
