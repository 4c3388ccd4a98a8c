"""Temporal splits of the modeling base."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.contract import TARGET

SPLITS = ("train", "valid", "test")
# Share of the reference dates per split.
RATIOS = {"train": 0.70, "valid": 0.15, "test": 0.15}

Bounds = Mapping[str, tuple[date | str, date | str]]


def with_split(df: DataFrame, bounds: Bounds, date_column: str = "reference_date") -> DataFrame:
    """Label each row by the date range that holds it; rows outside all are dropped."""
    label = F.lit(None).cast("string")
    for name, (first, last) in bounds.items():
        inside = F.col(date_column).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        label = F.when(inside, name).otherwise(label)
    return df.withColumn("split", label).filter(F.col("split").isNotNull())


def bounds_by_ratio(
    dates: list[date], ratios: Mapping[str, float] = RATIOS
) -> dict[str, tuple[date, date]]:
    """Consecutive ranges of the reference dates in the given proportions."""
    ordered, bounds, start, share = sorted(set(dates)), {}, 0, 0.0
    names = list(ratios)
    for name in names:
        share += ratios[name]
        stop = len(ordered) if name == names[-1] else round(share * len(ordered))
        if stop > start:
            bounds[name] = (ordered[start], ordered[stop - 1])
        start = max(start, stop)
    return bounds


def split_audit(df: DataFrame, date_column: str = "reference_date") -> DataFrame:
    return df.groupBy("split").agg(
        F.min(date_column).alias("min_date"),
        F.max(date_column).alias("max_date"),
        F.count("*").alias("row_count"),
    )


def class_weight(train: DataFrame) -> DataFrame:
    """Negatives per positive; NULL weight when there is no positive."""
    positives = F.count_if(F.col(TARGET) == 1)
    negatives = F.count_if(F.col(TARGET) == 0)
    return train.agg(
        negatives.alias("negatives"),
        positives.alias("positives"),
        F.try_divide(negatives, positives).alias("positive_weight"),
    )


def positive_weight(train: DataFrame) -> float:
    weight = class_weight(train).first()["positive_weight"]
    if weight is None:
        raise ValueError("the training rows hold no positive example")
    return weight
