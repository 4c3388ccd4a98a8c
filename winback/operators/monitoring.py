"""Monitoring of one scoring round: batch quality, volume, drift, performance."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.contract import (
    FEATURES,
    PREDICTION_DAYS,
    PROBABILITY,
    TARGET,
    TRANSACTION_COLUMNS,
    VOLUME_CRITICAL,
    VOLUME_WARNING,
)
from winback.functions import lines
from winback.functions.dates import as_date
from winback.functions.drift import psi, psi_of_counts, psi_status, value_counts, worst_status
from winback.functions.ordered import exact_percentiles
from winback.operators.metrics import evaluate, top_name
from winback.operators.quality import any_null, count_kinds, count_where
from winback.operators.scoring import PRIORITY_GROUPS, REMAINDER
from winback.session import materialise
from winback.sources.guards import require_rows
from winback.sources.tables import Tables

# Days covered by a round with no round before it, and the label of rows.
FIRST_ROUND_DAYS = 30
UNKNOWN_SCENARIO = "unknown"
PERFORMANCE_TYPE = "synthetic_performance"
GROUP_COUNTS = {
    **{name: f"{name.lower()}_customers" for name in PRIORITY_GROUPS},
    REMAINDER: "remainder_customers",
}


def at_date(df: DataFrame, day: date | str, column: str = "scoring_date") -> DataFrame:
    return df.filter(F.col(column) == F.lit(day).cast("date"))


def round_window(scores: DataFrame, day: date | str) -> DataFrame:
    """One row: the round's date, the round before, and the first day it covers."""
    this = F.lit(day).cast("date")
    previous = F.max(F.when(F.col("scoring_date") < this, F.col("scoring_date")))
    return scores.agg(previous.alias("previous_scoring_date")).select(
        this.alias("scoring_date"),
        "previous_scoring_date",
        F.coalesce(
            F.date_add("previous_scoring_date", 1), F.date_sub(this, FIRST_ROUND_DAYS - 1)
        ).alias("batch_start_date"),
    )


def round_lines(history: DataFrame, start: date | str, day: date | str) -> DataFrame:
    return lines.in_months(history, start, day).filter(lines.between(start, day))


def scenario_at(runs: DataFrame, day: date | str) -> DataFrame:
    """One row: the scenario of the newest batch that covers the date."""
    this = F.lit(day).cast("date")
    covers = (F.col("batch_start_date") <= this) & (F.col("batch_end_date") >= this)
    newest = F.max(F.when(covers, F.struct("generated_at", "scenario")))
    return runs.agg(newest.alias("_newest")).select(
        this.alias("scoring_date"),
        F.coalesce("_newest.scenario", F.lit(UNKNOWN_SCENARIO)).alias("scenario"),
    )


def batch_counters(batch: DataFrame) -> DataFrame:
    """All counters of a round's lines from one pass, with the quality status."""
    copies = F.col("_copies")

    def copies_where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, copies)), F.lit(0))

    distinct_rows = batch.groupBy(*TRANSACTION_COLUMNS).agg(F.count("*").alias("_copies"))
    counted = distinct_rows.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("batch_rows"),
        count_kinds("invoice").cast("bigint").alias("batch_invoices"),
        count_kinds("customer_id").cast("bigint").alias("batch_customers"),
        copies_where(any_null(TRANSACTION_COLUMNS)).alias("null_rows"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).alias("duplicate_rows"),
        copies_where(F.col("price") <= 0).alias("invalid_price_rows"),
        copies_where(F.col("quantity") <= 0).alias("invalid_quantity_rows"),
        copies_where(lines.is_cancelled()).alias("cancelled_rows"),
        copies_where(lines.is_test()).alias("test_rows"),
        copies_where(lines.is_discount()).alias("discount_rows"),
    )
    defects = ("null_rows", "duplicate_rows", "invalid_price_rows", "invalid_quantity_rows")
    found = F.greatest(*[F.col(name) for name in defects]) > 0
    return counted.withColumn("dq_status", F.when(found, "CRITICAL").otherwise("PASS"))


def score_distribution(scores: DataFrame) -> DataFrame:
    """Per scoring date: range, mean, median, 90th percentile and positive rate."""
    score = F.col(PROBABILITY)
    plain = scores.groupBy("scoring_date").agg(
        F.min(score).alias("score_min"),
        F.avg(score).alias("score_mean"),
        F.max(score).alias("score_max"),
        F.avg("prediction_0_5").alias("predicted_positive_rate"),
    )
    ordered = exact_percentiles(
        scores, ["scoring_date"], PROBABILITY, {"score_median": 0.5, "score_p90": 0.9}
    )
    return plain.join(ordered, "scoring_date")


def priority_counts(scores: DataFrame) -> DataFrame:
    """Customers per group and date; CRITICAL when the groups do not add up."""
    counted = scores.groupBy("scoring_date").agg(
        F.count("*").alias("number_customers"),
        *[
            count_where(F.col("priority_group") == group).alias(name)
            for group, name in GROUP_COUNTS.items()
        ],
    )
    total = sum((F.col(name) for name in GROUP_COUNTS.values()), F.lit(0))
    return counted.withColumn(
        "priority_status",
        F.when(total == F.col("number_customers"), "PASS").otherwise("CRITICAL"),
    )


def volume_change(scores: DataFrame, reference: DataFrame, day: date | str) -> DataFrame:
    """Customers of the round against the round before, else the reference population."""
    this = F.lit(day).cast("date")
    per_date = scores.filter(F.col("scoring_date") <= this).groupBy("scoring_date").agg(
        F.count("*").alias("_n")
    )
    reference_size = reference.agg(F.count_distinct("customer_id")).scalar()
    earlier = F.col("scoring_date") < this
    # One row per scoring date reaches this aggregation.
    counts = per_date.agg(
        F.sum(F.when(~earlier, F.col("_n"))).alias("number_customers"),
        F.max(F.when(earlier, F.struct("scoring_date", "_n"))).alias("_previous"),
    ).select(
        this.alias("scoring_date"),
        "number_customers",
        F.coalesce("_previous._n", reference_size).alias("previous_number_customers"),
    )
    change = F.coalesce(
        F.try_divide(
            (F.col("number_customers") - F.col("previous_number_customers")).cast("double"),
            F.col("previous_number_customers").cast("double"),
        ),
        F.lit(0.0),
    )
    size = F.abs("volume_change")
    return counts.withColumn("volume_change", change).withColumn(
        "volume_status",
        F.when(size >= VOLUME_CRITICAL, "CRITICAL")
        .when(size >= VOLUME_WARNING, "WARNING")
        .otherwise("PASS"),
    )


def feature_drift(
    reference: DataFrame,
    current: DataFrame,
    day: date | str,
    reference_day: date | str,
    flag_missing: bool = False,
) -> DataFrame:
    """One row per feature: statistics of both populations and the PSI."""
    counts = value_counts(reference, current, FEATURES)
    ref, cur = ("reference_rows", "reference_upto"), ("current_rows", "current_upto")
    value = F.col("value")

    def mean(rows: str) -> Column:
        weight = F.col(rows)
        return F.try_divide(F.sum(value * weight), F.sum(weight).cast("double"))

    # All from counted values in one aggregation.
    picks = {
        "reference_median": (0.5, *ref),
        "current_median": (0.5, *cur),
        "current_min": (0.0, *cur),
        "current_p10": (0.10, *cur),
        "current_p25": (0.25, *cur),
        "current_p75": (0.75, *cur),
        "current_p90": (0.90, *cur),
        "current_max": (1.0, *cur),
    }
    measured = psi_of_counts(
        counts,
        picks=picks,
        also={"reference_mean": mean("reference_rows"), "current_mean": mean("current_rows")},
    )
    # Squares are taken from the mean, a row per feature, so large values lose nothing.
    away = F.pow(value - F.col("current_mean"), 2) * F.col("current_rows")
    spread = (
        counts.join(materialise(measured, "measured"), "feature_name")
        .groupBy("feature_name", "psi", "reference_mean", "current_mean", *picks)
        .agg(
            F.sqrt(F.try_divide(F.sum(away), F.max("current_upto_total") - 1)).alias("current_std")
        )
    )
    return (
        spread
        .select(
            F.lit(day).cast("date").alias("scoring_date"),
            F.lit(reference_day).cast("date").alias("reference_date"),
            "feature_name",
            "reference_mean",
            "current_mean",
            "reference_median",
            "current_median",
            "current_std",
            "current_min",
            "current_p10",
            "current_p25",
            "current_p75",
            "current_p90",
            "current_max",
            "psi",
            psi_status(F.col("psi"), flag_missing).alias("status"),
        )
    )


def score_drift(scores: DataFrame, day: date | str) -> DataFrame:
    """PSI of the scores against the first scoring date."""
    first = scores.agg(F.min("scoring_date")).scalar()
    reference = scores.filter(F.col("scoring_date") == first)
    found = psi(reference, at_date(scores, day), [PROBABILITY])
    return found.select(
        F.lit(day).cast("date").alias("scoring_date"),
        F.col("psi").alias("score_psi"),
        psi_status(F.col("psi")).alias("score_drift_status"),
    )


def target_maturity(
    history: DataFrame, day: date | str, days: int = PREDICTION_DAYS
) -> DataFrame:
    """One row: whether the history covers the whole prediction window."""
    this = F.lit(day).cast("date")
    end = F.date_add(this, days)
    return history.agg(F.max(lines.purchase_day()).alias("maximum_history_date")).select(
        this.alias("scoring_date"),
        end.alias("target_end_date"),
        "maximum_history_date",
        F.when(F.col("maximum_history_date") >= end, "MATURED")
        .otherwise("NOT_MATURED")
        .alias("target_status"),
    )


def matured_labels(
    scores: DataFrame, history: DataFrame, day: date | str, days: int = PREDICTION_DAYS
) -> DataFrame:
    """Scored customers of a date with what they did in the window after it."""
    end = as_date(day) + timedelta(days=days)
    returned = (
        lines.in_months(history, day, end)
        .filter(lines.after_within(day, days))
        .filter(lines.valid_line("strict"))
        .select("customer_id")
        .distinct()
        .withColumn(TARGET, F.lit(1))
    )
    return at_date(scores, day).join(returned, "customer_id", "left").fillna({TARGET: 0})


def performance(
    scores: DataFrame, history: DataFrame, day: date | str, days: int = PREDICTION_DAYS
) -> DataFrame:
    """One row of ranking metrics; no row while the window is still open."""
    labelled = matured_labels(scores, history, day, days)
    found = evaluate(labelled, group=("scoring_date",), keys=("customer_id",))
    names = [
        top_name(metric, k) for k in (0.10, 0.20, 0.30) for metric in ("precision", "recall", "lift")
    ]
    status = target_maturity(history, day, days).select("target_status").scalar()
    return found.filter(status == "MATURED").select(
        "scoring_date",
        F.date_add("scoring_date", days).alias("target_end_date"),
        F.lit(PERFORMANCE_TYPE).alias("performance_type"),
        "positive_rate",
        "pr_auc",
        "roc_auc",
        "brier_score",
        *names,
        F.current_timestamp().alias("calculated_at"),
    )


def summary(
    scores: DataFrame,
    history: DataFrame,
    reference: DataFrame,
    runs: DataFrame | None,
    day: date | str,
    drift: DataFrame,
) -> DataFrame:
    """The one-row report of a round.

    Every part is a single row of its own and enters the report as a scalar subquery.
    """
    day = as_date(day)
    current = require_rows(at_date(scores, day), f"scores of {day}")
    window = round_window(scores, day)
    start = window.first()["batch_start_date"]
    counters = batch_counters(round_lines(history, start, day))
    if runs is None:
        scenario = window.select("scoring_date", F.lit(UNKNOWN_SCENARIO).alias("scenario"))
    else:
        scenario = scenario_at(runs, day)
    model = current.agg(
        F.min_by("model_name", "score_rank").alias("model_name"),
        F.min_by("model_version", "score_rank").alias("model_version"),
    )
    worst_feature = drift.agg(F.max("psi").alias("maximum_feature_psi"))
    parts = [
        scenario,
        model,
        counters,
        volume_change(scores, reference, day).drop("number_customers"),
        score_distribution(current),
        priority_counts(current),
        worst_feature,
        score_drift(scores, day),
        target_maturity(history, day).select("scoring_date", "target_status"),
    ]
    packed = [
        part.drop("scoring_date").select(F.struct("*")).scalar().alias(f"_{i}")
        for i, part in enumerate(parts)
    ]
    report = window.select("scoring_date", "batch_start_date", *packed)
    report = report.select(
        "scoring_date", "batch_start_date", *[f"_{i}.*" for i in range(len(parts))]
    ).withColumn(
        "feature_drift_status", psi_status(F.col("maximum_feature_psi"))
    )
    watched = ("dq", "volume", "priority", "feature_drift", "score_drift")
    return report.select(
        "scoring_date",
        "scenario",
        "model_name",
        "model_version",
        "batch_start_date",
        "batch_rows",
        "batch_invoices",
        "batch_customers",
        "null_rows",
        "duplicate_rows",
        "invalid_price_rows",
        "invalid_quantity_rows",
        "cancelled_rows",
        "test_rows",
        "discount_rows",
        "number_customers",
        "previous_number_customers",
        "volume_change",
        "score_min",
        "score_mean",
        "score_median",
        "score_p90",
        "score_max",
        "predicted_positive_rate",
        *GROUP_COUNTS.values(),
        "maximum_feature_psi",
        "score_psi",
        "dq_status",
        "volume_status",
        "priority_status",
        "feature_drift_status",
        "score_drift_status",
        "target_status",
        worst_status(*[F.col(f"{name}_status") for name in watched]).alias("overall_status"),
        F.current_timestamp().alias("monitored_at"),
    )


def monitor_round(
    tables: Tables,
    scores: DataFrame,
    history: DataFrame,
    modeling: DataFrame,
    runs: DataFrame | None,
    day: date | str,
    reference_day: date | str,
) -> None:
    """Compute the round's three tables and replace that date in each."""
    day = as_date(day)
    reference = require_rows(
        at_date(modeling, reference_day, "reference_date"), f"reference of {reference_day}"
    )
    current = at_date(scores, day)
    tables.write_replace(
        feature_drift(reference, current, day, reference_day),
        "monitoring", "feature_monitoring", "scoring_date", day,
    )
    drift = at_date(tables.read("monitoring", "feature_monitoring"), day)
    tables.write_replace(
        summary(scores, history, reference, runs, day, drift),
        "monitoring", "summary", "scoring_date", day,
    )
    if target_maturity(history, day).first()["target_status"] == "MATURED":
        tables.write_replace(
            performance(scores, history, day),
            "monitoring", "performance", "scoring_date", day,
        )


def feature_view(tables: Tables, day: date | str) -> DataFrame:
    return at_date(tables.read("monitoring", "feature_monitoring"), day).orderBy(
        F.col("psi").desc(), "feature_name"
    )
