"""Scores, ranking and priority groups of a scoring date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.contract import (
    FEATURES,
    LABEL_THRESHOLD,
    PROBABILITY,
    SCORE_COLUMNS,
    ModelInfo,
)
from winback.functions import lines
from winback.functions.dates import as_date
from winback.functions.ordered import with_rank

# Groups by rank / N; the rest is REMAINDER.
PRIORITY_GROUPS = {"TOP_10": 0.10, "TOP_20": 0.20, "TOP_30": 0.30}
REMAINDER = "REMAINDER"


def resolve_scoring_date(history: DataFrame, given: date | str | None = None) -> date:
    """The given date, else the last day with a transaction."""
    if given:
        return as_date(given)
    found = latest_day(history).first()["scoring_date"]
    if found is None:
        raise ValueError("no scoring date: the history has no dated row")
    return found


def latest_day(history: DataFrame) -> DataFrame:
    return history.agg(F.max(lines.purchase_day()).alias("scoring_date"))


def frequency_recency_score() -> Column:
    """Orders against orders plus months of silence, in (0, 1)."""
    orders = F.col("number_orders").cast("double")
    return orders / (orders + F.col("inactive_days") / F.lit(30.0))


def rule_scores(df: DataFrame) -> dict[str, Column]:
    """Simple rules as ranking scores: larger is better."""
    return {
        "recency": -F.col("inactive_days").cast("double"),
        "frequency": F.col("number_orders").cast("double"),
        "monetary": F.col("total_spent").cast("double"),
        "ticket": F.col("average_ticket").cast("double"),
    }


def with_probability(
    df: DataFrame, probability: Column, threshold: float = LABEL_THRESHOLD
) -> DataFrame:
    return df.withColumn(PROBABILITY, probability).withColumn(
        "prediction_0_5", (F.col(PROBABILITY) >= threshold).cast("int")
    )


def priority_group(
    percentile: Column, groups: Mapping[str, float] = PRIORITY_GROUPS
) -> Column:
    label = F.lit(REMAINDER)
    for name, limit in sorted(groups.items(), key=lambda item: -item[1]):
        label = F.when(percentile <= limit, name).otherwise(label)
    return label


def with_priority(scored: DataFrame) -> DataFrame:
    """Rank per scoring date by score, then customer; percentile and group."""
    ranked = with_rank(
        scored,
        ["scoring_date"],
        [F.col(PROBABILITY).desc(), F.col("customer_id").asc()],
        "score_rank",
    )
    percentile = F.col("score_rank") / F.col("score_rank_of")
    return (
        ranked.withColumn("score_percentile", percentile)
        .withColumn("priority_group", priority_group(F.col("score_percentile")))
        .drop("score_rank_of")
    )


def with_provenance(df: DataFrame, model: ModelInfo) -> DataFrame:
    return df.withColumns(
        {
            "model_name": F.lit(model.name),
            "model_version": F.lit(model.version),
            "model_alias": F.lit(model.alias),
            "source_run_id": F.lit(model.run_id),
            "scored_at": F.current_timestamp(),
        }
    ).select(*SCORE_COLUMNS)


def score_population(
    features: DataFrame,
    probability: Column,
    model: ModelInfo,
    extra: Sequence[str] = (),
) -> DataFrame:
    """From features to the complete score table.

    `extra` names input columns beyond the features that `probability` reads.
    """
    keys = ("customer_id", "scoring_date", "first_purchase_date", "last_purchase_date")
    doubles = features.select(
        *keys, *[F.col(f).cast("double").alias(f) for f in FEATURES], *extra
    )
    return (
        doubles.transform(with_probability, probability)
        .transform(with_priority)
        .transform(with_provenance, model)
    )


def summary_by_group(scored: DataFrame) -> DataFrame:
    score = F.col(PROBABILITY)
    return (
        scored.groupBy("scoring_date", "priority_group")
        .agg(
            F.count("*").alias("number_customers"),
            F.min(score).alias("minimum_score"),
            F.avg(score).alias("average_score"),
            F.max(score).alias("maximum_score"),
        )
        .orderBy("scoring_date", "priority_group")
    )


def summary(scored: DataFrame) -> DataFrame:
    score = F.col(PROBABILITY)
    return scored.groupBy("scoring_date").agg(
        F.count("*").alias("number_customers"),
        F.min(score).alias("minimum_score"),
        F.avg(score).alias("average_score"),
        F.max(score).alias("maximum_score"),
        F.avg("prediction_0_5").alias("predicted_positive_rate"),
    )
