"""Exact ranking and classification metrics per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.contract import LABEL_THRESHOLD, PROBABILITY, TARGET, TOP_FRACTIONS
from winback.functions.ordered import join_null_safe, with_running_totals
from winback.session import materialise

TOP_METRICS = ("precision", "recall", "lift")


def top_name(metric: str, fraction: float) -> str:
    return f"{metric}_at_{round(fraction * 100)}pct"


def _ratio(part: Column, whole: Column) -> Column:
    """0 where the whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _top_size(fraction: float) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(fraction)))


def _top_hits(
    rows: DataFrame,
    points: DataFrame,
    group: list[str],
    keys: Sequence[str],
    fractions: Sequence[float],
) -> DataFrame:
    """Positives among the first rows of each group, a column per fraction."""
    sizes = [
        F.struct(F.lit(top_name("_top", f)).alias("_top"), _top_size(f).alias("_size"))
        for f in fractions
    ]
    before = F.col("_seen") - F.col("_rows")
    # The scores at which a top ends: a row per group and fraction.
    edges = materialise(
        points.select("*", F.inline(F.array(*sizes)))
        .filter((before < F.col("_size")) & (F.col("_size") <= F.col("_seen")))
        .select(
            *group,
            "_s",
            "_top",
            (F.col("_size") - before).alias("_wanted"),
            (F.col("_hits") - F.col("_pos")).alias("_above"),
            F.when(F.col("_size") == F.col("_seen"), F.col("_pos")).alias("_whole"),
        ),
        "edges",
    )
    cut = edges.filter(F.col("_whole").isNull()).select(*group, "_s", "_top", "_wanted")
    tied = with_running_totals(
        join_null_safe(rows, cut, [*group, "_s"]),
        [*group, "_top"],
        [F.col(k).asc() for k in keys],
        {"_place": F.lit(1)},
    )
    part = tied.groupBy(*group, "_top").agg(
        F.sum(F.when(F.col("_place") <= F.col("_wanted"), F.col("_y")).otherwise(0)).alias("_part")
    )
    hits = F.col("_above") + F.coalesce("_whole", "_part", F.lit(0))
    return (
        join_null_safe(edges, part, [*group, "_top"], "left")
        .groupBy(*group)
        .agg(
            *[
                F.sum(F.when(F.col("_top") == top_name("_top", f), hits)).alias(top_name("_top", f))
                for f in fractions
            ]
        )
    )


def evaluate(
    df: DataFrame,
    group: Sequence[str] = ("split",),
    score: str = PROBABILITY,
    target: str = TARGET,
    keys: Sequence[str] = ("customer_id", "reference_date"),
    threshold: float = LABEL_THRESHOLD,
    fractions: Sequence[float] = TOP_FRACTIONS,
) -> DataFrame:
    """All metrics, one row per group.

    Rows are first counted by score: running totals then pass over distinct scores only, and
    average precision and ROC area are exact under ties. Only where the edge of a top cuts
    through equal scores are the rows of that score put in the order of `keys`.
    """
    group = list(group)
    # Stored: the rows are counted, sampled for ranges, and met again at the edges.
    rows = materialise(
        df.select(
            *group, *keys, F.col(score).alias("_s"), F.col(target).cast("bigint").alias("_y")
        ),
        "scored",
    )
    counted = rows.groupBy(*group, "_s").agg(
        F.count("*").alias("_rows"),
        F.sum("_y").alias("_pos"),
        F.sum(1 - F.col("_y")).alias("_neg"),
    )
    points = with_running_totals(
        counted,
        group,
        [F.col("_s").desc()],
        {"_seen": F.col("_rows"), "_hits": F.col("_pos")},
    ).withColumnsRenamed({"_seen_total": "_n", "_hits_total": "_p"})
    tops = _top_hits(rows, points, group, keys, fractions)
    pos, neg = F.col("_pos").cast("double"), F.col("_neg").cast("double")
    called = F.col("_s") >= threshold

    def total_where(condition: Column, amount: str) -> Column:
        return F.sum(F.when(condition, F.col(amount)).otherwise(0))

    curves = points.groupBy(*group, "_n", "_p").agg(
        F.sum(pos * F.col("_hits") / F.col("_seen")).alias("_precision_sum"),
        # Positives ranked above each negative, ties counting half.
        F.sum(neg * (F.col("_hits") - pos / 2)).alias("_pairs_won"),
        F.sum(pos * F.pow(F.col("_s") - 1, 2) + neg * F.pow("_s", 2)).alias("_squares"),
        total_where(~called, "_neg").alias("true_negative"),
        total_where(called, "_neg").alias("false_positive"),
        total_where(~called, "_pos").alias("false_negative"),
        total_where(called, "_pos").alias("true_positive"),
    )
    curves = join_null_safe(curves, tops, group)
    n, p = F.col("_n"), F.col("_p")
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    top = []
    for f in fractions:
        size, hits = _top_size(f), F.col(top_name("_top", f))
        precision = _ratio(hits, size)
        top += [
            precision.alias(top_name("precision", f)),
            _ratio(hits, p).alias(top_name("recall", f)),
            _ratio(precision, p / n).alias(top_name("lift", f)),
        ]
    both_classes = (p > 0) & (p < n)
    return curves.select(
        *group,
        n.alias("row_count"),
        (p / n).alias("positive_rate"),
        ((tp + fp) / n).alias("predicted_positive_rate"),
        F.when(p > 0, F.col("_precision_sum") / p).otherwise(0.0).alias("pr_auc"),
        F.when(both_classes, F.col("_pairs_won") / p / (n - p)).alias("roc_auc"),
        (F.col("_squares") / n).alias("brier_score"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "true_negative",
        "false_positive",
        "false_negative",
        "true_positive",
        *top,
    )


def confusion(
    df: DataFrame,
    group: Sequence[str] = ("split",),
    score: str = PROBABILITY,
    target: str = TARGET,
    threshold: float = LABEL_THRESHOLD,
) -> DataFrame:
    """The four cells per group, zero cells included, with precision, recall and F1."""
    positive, called = F.col(target) == 1, F.col(score) >= threshold
    cells = df.groupBy(*group).agg(
        F.count_if(~positive & ~called).alias("true_negative"),
        F.count_if(~positive & called).alias("false_positive"),
        F.count_if(positive & ~called).alias("false_negative"),
        F.count_if(positive & called).alias("true_positive"),
    )
    tp, fp, fn = F.col("true_positive"), F.col("false_positive"), F.col("false_negative")
    return cells.withColumns(
        {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def rates(
    df: DataFrame,
    group: Sequence[str] = ("split",),
    score: str = PROBABILITY,
    target: str = TARGET,
    threshold: float = LABEL_THRESHOLD,
) -> DataFrame:
    """Rows, real and predicted positive rate and Brier score per group."""
    called = (F.col(score) >= threshold).cast("int")
    return df.groupBy(*group).agg(
        F.count("*").alias("row_count"),
        F.avg(target).alias("positive_rate"),
        F.avg(called).alias("predicted_positive_rate"),
        F.avg(F.pow(F.col(score) - F.col(target), 2)).alias("brier_score"),
    )


def return_rate_by_group(df: DataFrame, group: str = "priority_group") -> DataFrame:
    return df.groupBy(group).agg(
        F.count("*").alias("customers"),
        F.sum(TARGET).alias("reactivated_customers"),
        F.avg(TARGET).alias("reactivation_rate"),
    )
