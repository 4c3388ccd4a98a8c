"""Frames the queries start from, derived from the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from winback.contract import PREDICTION_DAYS, ModelInfo, Parameters
from winback.functions.dates import as_date, monthly_dates
from winback.functions.lines import line_amount, purchase_day, valid_line
from winback.operators.cleaning import to_silver, valid_lines
from winback.operators.features import modeling_base, scoring_features
from winback.operators.population import View, of_view, slot_changes_of
from winback.operators.scoring import (
    frequency_recency_score,
    score_population,
    with_probability,
)
from winback.operators.splits import with_split
from winback.session import FILE_ROWS, bound_tasks, materialise
from winback.sources.bronze import read_bronze

# Dates that suit the given tables.
REFERENCE_START, REFERENCE_END = "1999-10-08", "2001-06-08"
BOUNDS = {
    "train": ("1999-10-08", "2000-12-08"),
    "valid": ("2001-01-08", "2001-03-08"),
    "test": ("2001-04-08", "2001-06-08"),
}
DRIFT_REFERENCE = "2000-06-08"
ROUNDS = ("2001-05-08", "2001-06-08", "2001-08-01")
MATURED_ROUND, OPEN_ROUND = "2001-06-08", "2001-08-01"
# Lines after this day play the part of recurring batches.
REAL_UNTIL = "2001-05-08"
BATCH = (date(2001, 5, 9), date(2001, 6, 7))
RULE_MODEL = ModelInfo("frequency_recency", "1", "champion", "rule")


def dates() -> list[date]:
    return monthly_dates(REFERENCE_START, REFERENCE_END)


# Session setting: pieces that the lines are dealt to where their files are too few.
PIECES = "spark.winback.pieces"


# The order of a line, beside the invoice named after it.
ORDER = "_order"


def bronze(spark: SparkSession, folder: str, key: str | None = None) -> DataFrame:
    bound_tasks(spark)
    pieces = spark.conf.get(PIECES, None)
    return read_bronze(spark, folder, int(pieces) if pieces else None, key)


def silver(spark: SparkSession, folder: str) -> DataFrame:
    """Clean lines. Equal lines have one order, so where the joins exchanged the lines by
    order, dropping duplicates exchanges nothing."""
    return to_silver(bronze(spark, folder, ORDER)).drop(ORDER)


def stored_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Silver written once, for queries that derive several frames from it."""
    return materialise(silver(spark, folder), "silver", FILE_ROWS)


def lines(spark: SparkSession, folder: str, rule: str) -> DataFrame:
    return valid_lines(silver(spark, folder), rule)


def base_of(
    silver_lines: DataFrame,
    rule: str = "modeling",
    on: list[date] | None = None,
    changes: DataFrame | None = None,
) -> DataFrame:
    lines = valid_lines(silver_lines, rule)
    return modeling_base(lines, on or dates(), Parameters(rule=rule), changes)


def base(spark: SparkSession, folder: str, rule: str = "modeling") -> DataFrame:
    return base_of(silver(spark, folder), rule)


def split_base(spark: SparkSession, folder: str) -> DataFrame:
    """The modeling base with its split."""
    return with_split(base(spark, folder), BOUNDS)


def rule_scored_base(spark: SparkSession, folder: str) -> DataFrame:
    return with_probability(split_base(spark, folder), frequency_recency_score())


def features_of(
    silver_lines: DataFrame, rounds=ROUNDS, changes: DataFrame | None = None
) -> DataFrame:
    return scoring_features(valid_lines(silver_lines, "strict"), rounds, changes=changes)


def round_features(spark: SparkSession, folder: str, rounds=ROUNDS) -> DataFrame:
    return features_of(silver(spark, folder), rounds)


def scores_of(
    silver_lines: DataFrame, rounds=ROUNDS, changes: DataFrame | None = None
) -> DataFrame:
    return score_population(
        features_of(silver_lines, rounds, changes), frequency_recency_score(), RULE_MODEL
    )


def scores_and_reference(silver_lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Scores of the rounds and the reference population, from one pass over the lines."""
    on = [as_date(DRIFT_REFERENCE)]
    views = {
        "scores": View(valid_line("strict"), [as_date(day) for day in ROUNDS]),
        "reference": View(valid_line("modeling"), on, PREDICTION_DAYS),
    }
    lines = silver_lines.withColumns(
        {"total_amount": line_amount(), "purchase_date": purchase_day()}
    )
    changes = materialise(slot_changes_of(lines, views), "changes")
    return (
        scores_of(silver_lines, changes=of_view(changes, "scores")),
        base_of(silver_lines, on=on, changes=of_view(changes, "reference")),
    )


def scored_rounds(spark: SparkSession, folder: str, rounds=ROUNDS) -> DataFrame:
    return scores_of(silver(spark, folder), rounds)
