"""Exact ranks, running totals and percentiles without a single-task window.

Rows are range-partitioned on the wanted order and written once with their partition
number. Each partition is then numbered or summed on its own, and offsets (at most one
row per partition and group border) join the pieces. The offsets are written too: the
optimiser then knows their size and broadcasts them only below the session's limit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winback.session import materialise

# Row numbers of one partition fit into this many bits of the generated id.
_POSITION_BITS = 33


def with_rank(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "rank"
) -> DataFrame:
    """1..N per group in `order`, which must be a total order within the group.

    Also adds `<name>_of`, the number of rows in the group.
    """
    placed = materialise(
        df.orderBy(*[F.col(g) for g in group], *order).withColumn(
            "_place", F.monotonically_increasing_id()
        ),
        "rank",
    ).withColumn("_piece", F.shiftright("_place", _POSITION_BITS))
    # Rows of one group are consecutive, so within a piece they form one run.
    runs = placed.groupBy(*group, "_piece").agg(
        F.count("*").alias("_rows"), F.min("_place").alias("_first")
    )
    by_piece = Window.partitionBy(*group).orderBy("_piece")
    offsets = runs.select(
        *group,
        "_piece",
        "_first",
        (F.sum("_rows").over(by_piece) - F.col("_rows")).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(*group)).alias(f"{name}_of"),
    )
    return (
        _attach(placed, offsets, [*group, "_piece"])
        .withColumn(name, F.col("_place") - F.col("_first") + F.col("_before") + 1)
        .drop("_place", "_piece", "_first", "_before")
    )


def with_running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    totals: Mapping[str, Column],
) -> DataFrame:
    """Running sums per group in `order`, the row itself included.

    `order` must be a total order within the group. Each sum over the whole group comes
    along as `<name>_total`.
    """
    summands = {f"_add_{name}": value for name, value in totals.items()}
    pieces = materialise(
        df.repartitionByRange(*[F.col(g) for g in group], *order)
        .withColumns(summands)
        .withColumn("_piece", F.spark_partition_id()),
        "totals",
    )
    within = Window.partitionBy("_piece", *group).orderBy(*order)
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = pieces.withColumns(
        {name: F.sum(f"_add_{name}").over(within) for name in totals}
    ).drop(*summands)
    runs = pieces.groupBy(*group, "_piece").agg(
        *[F.sum(f"_add_{name}").alias(f"_run_{name}") for name in totals]
    )
    everything = Window.partitionBy(*group)
    by_piece = everything.orderBy("_piece")
    offsets = runs.select(
        *group,
        "_piece",
        *[
            (F.sum(f"_run_{name}").over(by_piece) - F.col(f"_run_{name}")).alias(
                f"_before_{name}"
            )
            for name in totals
        ],
        *[F.sum(f"_run_{name}").over(everything).alias(f"{name}_total") for name in totals],
    )
    joined = _attach(summed, offsets, [*group, "_piece"])
    running = joined.withColumns(
        {name: F.col(name) + F.col(f"_before_{name}") for name in totals}
    ).drop("_piece", *[f"_before_{name}" for name in totals])
    # Stored, so that none of its readers sorts again.
    return materialise(running, "running")


def _attach(rows: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    return join_null_safe(rows, materialise(offsets, "offsets"), keys)


def join_null_safe(
    rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """An equality join in which null keys meet, so that rows of a null group stay."""
    renamed = other.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.join(renamed, condition, how).drop(*[f"_k_{k}" for k in keys])


def exact_percentiles(
    df: DataFrame, group: Sequence[str], value: str, percents: Mapping[str, float]
) -> DataFrame:
    """Linear-interpolation percentiles per group, one row per group.

    Equal values are first counted together, so a frequent value costs one row.
    """
    counted = (
        df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    )
    running = with_running_totals(counted, group, [F.col(value)], {"_upto": F.col("_n")})
    picks = {name: (p, "_n", "_upto") for name, p in percents.items()}
    return percentiles_of_running(running, group, value, picks)


def percentiles_of_running(
    running: DataFrame,
    group: Sequence[str],
    value: str,
    picks: Mapping[str, tuple[float, str, str]],
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Percentiles from distinct values with weights and running weights.

    `picks` names each percentile with its fraction, weight column and running weight
    column. The value at position fraction * (N - 1) is read off the row that covers it,
    in the same aggregation as the further measures in `also`.
    """
    also = dict(also or {})
    uptos = sorted({upto for _, _, upto in picks.values()})

    def position(fraction: float, upto: str) -> Column:
        return F.lit(fraction) * (F.col(f"{upto}_total") - 1)

    ends = []
    for name, (fraction, weight, upto) in picks.items():
        at = position(fraction, upto)
        for end, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            covered = (index < F.col(upto)) & (index >= F.col(upto) - F.col(weight))
            ends.append(F.max(F.when(covered, F.col(value))).alias(f"_{end}_{name}"))
    picked = running.groupBy(*group).agg(
        *[F.max(f"{upto}_total").alias(f"{upto}_total") for upto in uptos],
        *ends,
        *[measure.alias(name) for name, measure in also.items()],
    )
    out = []
    for name, (fraction, _, upto) in picks.items():
        at = position(fraction, upto)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((low + (high - low) * (at - F.floor(at))).alias(name))
    return picked.select(*group, *out, *also)
