"""Customers at each reference date with what they did in a window of days before it.

A line counts for the reference dates from the first on or after its day to the last that is
no more than the window's days later. Lines with the same span of dates are merged, in one
exchange that combines first; from then on a span is two events, what it adds at its first
date and takes away after its last, whatever number of dates it covers. Running sums over a
customer's events, at most one row per date, are the window at every date. For counts of
distinct values a span only adds from where the spans of the same value before it end, so
that overlapping spans count once. The first day inside the window is that of the earliest
span still to end, since spans that begin earlier never end later.

The same rows carry the customer's whole history (as `population.as_of` has it), so that one
scan of the lines gives both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winback.functions.dates import as_date, date_at, first_index_from, last_index_until

_SPAN = "span"


def _events(
    lines: DataFrame,
    dates: Sequence[date],
    days: int,
    recent: Mapping[str, str],
    ever: Mapping[str, str],
    look_ahead: int,
) -> DataFrame:
    """What changes per customer and slot, the position of a date."""
    last = dates[-1] + timedelta(days=look_ahead)
    kinds = {f"recent {name}": name for name in recent} | {f"ever {name}": name for name in ever}
    slotted = lines.filter(F.col("purchase_date") <= F.lit(last)).select(
        "customer_id",
        first_index_from("purchase_date", dates).alias("slot"),
        last_index_until(f"date_add(purchase_date, {days})", dates).alias("until"),
        "purchase_date",
        F.col("quantity").alias("items"),
        F.col("total_amount").alias("spent"),
        F.lit("").alias(_SPAN),
        *[F.col(name).cast("string").alias(kind) for kind, name in kinds.items()],
    )
    kept = ["customer_id", "slot", "until", "purchase_date", "items", "spent"]
    span = F.col("kind") == _SPAN
    counted = F.when(F.col("kind").startswith("ever "), F.col("slot") < len(dates)).otherwise(
        F.col("slot") <= F.col("until")
    )
    merged = (
        slotted.unpivot(kept, [_SPAN, *kinds], "kind", "value")
        .filter(F.col("value").isNotNull() & (span | counted))
        .withColumn("until", F.when(F.col("kind").startswith("ever "), -1).otherwise(F.col("until")))
        .groupBy("customer_id", "kind", "value", "slot", "until")
        .agg(
            F.sum(F.when(span, F.col("items"))).alias("items"),
            F.sum(F.when(span, F.col("spent"))).alias("spent"),
            F.count_if(span).alias("lines"),
            F.min(F.when(span, F.col("purchase_date"))).alias("first_day"),
            F.max(F.when(span, F.col("purchase_date"))).alias("last_day"),
        )
    )
    # Spans of one value: a row per pair of dates at most, however many lines there were.
    before = F.lag("until").over(
        Window.partitionBy("customer_id", "kind", "value").orderBy("slot", "until")
    )
    merged = merged.withColumn("before", before)
    inside = F.col("slot") <= F.col("until")
    fresh = F.greatest(F.col("slot"), F.coalesce(F.col("before"), F.lit(-1)) + 1)
    number = {
        "start": F.when(F.col("kind").startswith("ever "), F.col("before").isNull().cast("long"))
        .when(~span & (fresh <= F.col("until")), F.lit(1).cast("long"))
        .otherwise(F.lit(0).cast("long")),
    }
    number["stop"] = F.when(F.col("kind").startswith("recent "), -number["start"]).otherwise(0)

    def event(slot: Column, sign: int) -> Column:
        """The whole history changes at the start only, the window at both ends."""
        starts = sign > 0
        window = {name: F.when(span & inside, sign * F.col(name)) for name in ("items", "spent", "lines")}
        return F.struct(
            slot.cast("int").alias("slot"),
            *[
                F.when(F.lit(starts), F.col(name)).alias(name)
                for name in ("items", "spent", "lines", "first_day", "last_day")
            ],
            *[value.alias(f"recent_{name}") for name, value in window.items()],
            F.when(F.lit(not starts), F.col("first_day")).alias("ending_day"),
            number["start" if starts else "stop"].cast("long").alias("number"),
        )

    begin = event(F.when(F.col("kind").startswith("recent "), fresh).otherwise(F.col("slot")), 1)
    end = event(F.col("until") + 1, -1)
    both = F.when(inside, F.array(begin, end)).otherwise(F.array(begin))
    each = merged.select("customer_id", "kind", F.inline(both))
    return each.groupBy("customer_id", "slot").agg(
        *[F.sum(name).alias(name) for name in ("items", "spent", "lines")],
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        *[F.sum(f"recent_{name}").alias(f"recent_{name}") for name in ("items", "spent", "lines")],
        F.min("ending_day").alias("ending_day"),
        *[
            # Zero where a line had no value to count.
            F.sum(F.when(F.col("kind") == f"{when} {name}", F.col("number")).otherwise(0)).alias(
                f"{when} {count}"
            )
            for when, names in (("recent", recent), ("ever", ever))
            for name, count in names.items()
        ],
    )


def window_states(
    lines: DataFrame,
    dates: Sequence[date | str],
    days: int,
    recent: Mapping[str, str],
    ever: Mapping[str, str] | None = None,
    look_ahead: int = 0,
) -> DataFrame:
    """Customers per reference date from their first purchase on.

    Besides the columns of `population.as_of` (counts of distinct values by `ever`), the
    window [reference date - days, reference date] as `recent_` columns: first purchase,
    items, spend, and counts of distinct values by `recent`; NULL where it has no line.
    """
    dates, ever = sorted(as_date(d) for d in dates), dict(ever or {})
    by_slot = Window.partitionBy("customer_id").orderBy("slot")
    so_far = by_slot.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = by_slot.rowsBetween(1, Window.unboundedFollowing)
    state = _events(lines, dates, days, recent, ever, look_ahead).select(
        "customer_id",
        "slot",
        F.lead("slot", 1, len(dates)).over(by_slot).alias("_next_slot"),
        F.min("first_day").over(after).alias("next_purchase_date"),
        F.min("first_day").over(so_far).alias("first_purchase_date"),
        F.max("last_day").over(so_far).alias("last_purchase_date"),
        F.sum("lines").over(so_far).alias("lines_so_far"),
        F.sum("items").over(so_far).alias("total_items"),
        F.sum("spent").over(so_far).alias("total_spent"),
        *[F.sum(f"ever {count}").over(so_far).alias(count) for count in ever.values()],
        (F.coalesce(F.sum("recent_lines").over(so_far), F.lit(0)) > 0).alias("_any"),
        F.min("ending_day").over(after).alias("recent_first_purchase_date"),
        F.sum("recent_items").over(so_far).alias("recent_total_items"),
        F.sum("recent_spent").over(so_far).alias("recent_total_spent"),
        *[F.sum(f"recent {count}").over(so_far).alias(f"recent_{count}") for count in recent.values()],
    )
    seen = ["first_purchase_date", "total_items", "total_spent", *recent.values()]
    return (
        state.filter(F.col("slot") < len(dates))
        .withColumns({f"recent_{n}": F.when(F.col("_any"), F.col(f"recent_{n}")) for n in seen})
        # A state holds until the slot before the customer's next event.
        .withColumn("_at", F.explode(F.sequence(F.col("slot"), F.col("_next_slot") - 1)))
        .withColumn("reference_date", date_at(F.col("_at"), dates))
        .withColumn("inactive_days", F.datediff("reference_date", "last_purchase_date"))
        .drop("slot", "_next_slot", "_at", "_any")
    )
