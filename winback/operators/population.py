"""Customers as they stood at each reference date.

A customer's state only changes when a purchase falls between two reference dates. Lines
are therefore reduced to what is new per customer and slot (the gap that ends at a
reference date); running sums over the slots give every date's state. Lines are never
copied to later dates, and nothing but the per-slot rows is ordered per customer: at most
one row per reference date, however many lines the customer has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winback.contract import INACTIVE_DAYS, PREDICTION_DAYS, TARGET
from winback.functions.dates import date_at, first_index_from

# Columns whose distinct values are counted, and the names of the counts.
COUNTED = {
    "invoice": "number_orders",
    "stock_code": "unique_products",
    "country": "distinct_countries",
}


def slot_changes(
    lines: DataFrame,
    dates: Sequence[date],
    counted: dict[str, str] = COUNTED,
    look_ahead: int = 0,
) -> DataFrame:
    """What each customer's lines add between consecutive reference dates.

    One pass and one exchange of the lines: every line gives a row per counted column
    and one for its slot. Rows of a hot customer spread by the counted value, and those
    of a hot value shrink before the exchange.
    """
    dates = sorted(dates)
    last = dates[-1] + timedelta(days=look_ahead)
    slotted = lines.filter(F.col("purchase_date") <= F.lit(last)).select(
        "customer_id",
        first_index_from("purchase_date", dates).alias("slot"),
        "purchase_date",
        F.col("quantity").alias("items"),
        F.col("total_amount").alias("spent"),
        *[F.col(name).cast("string").alias(name) for name in counted],
    )
    kept = ["customer_id", "slot", "purchase_date", "items", "spent"]
    long = slotted.withColumn("slot_key", F.col("slot").cast("string")).unpivot(
        kept, [*counted, "slot_key"], "kind", "value"
    )
    per_slot = F.col("kind") == "slot_key"
    first_seen = (
        long.filter(F.col("value").isNotNull() & (per_slot | (F.col("slot") < len(dates))))
        .groupBy("customer_id", "kind", "value")
        .agg(
            F.min("slot").alias("slot"),
            F.sum(F.when(per_slot, F.col("items"))).alias("items"),
            F.sum(F.when(per_slot, F.col("spent"))).alias("spent"),
            F.min(F.when(per_slot, F.col("purchase_date"))).alias("first_day"),
            F.max(F.when(per_slot, F.col("purchase_date"))).alias("last_day"),
            F.count(F.when(per_slot, True)).alias("lines"),
        )
    )
    return first_seen.groupBy("customer_id", "slot").agg(*_sums(counted))


def _sums(counted: Mapping[str, str]) -> list[Column]:
    return [
        F.sum("items").alias("items"),
        F.sum("spent").alias("spent"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        F.sum("lines").alias("lines"),
        *[F.count_if(F.col("kind") == name).alias(count) for name, count in counted.items()],
    ]


@dataclass(frozen=True)
class View:
    """Lines that count, the dates they are seen at, and the days after the last one."""

    counts: Column
    dates: Sequence[date]
    look_ahead: int = 0


def slot_changes_of(
    lines: DataFrame, views: Mapping[str, View], counted: dict[str, str] = COUNTED
) -> DataFrame:
    """`slot_changes` of several views of the same lines, with the view's name.

    One pass and one exchange for all of them: lines get the slots between the dates of all
    views, and every value the first slot in which each view sees it.
    """
    union = sorted({day for view in views.values() for day in view.dates})
    seen_by = {}
    for i, view in enumerate(views.values()):
        last = max(view.dates) + timedelta(days=view.look_ahead)
        seen = view.counts & (F.col("purchase_date") <= F.lit(last))
        seen_by[f"_in{i}"] = F.when(seen, True).otherwise(False)
    slotted = (
        lines.withColumns(seen_by)
        .filter(reduce(Column.__or__, map(F.col, seen_by)))
        .select(
            "customer_id",
            first_index_from("purchase_date", union).alias("slot"),
            "purchase_date",
            F.col("quantity").alias("items"),
            F.col("total_amount").alias("spent"),
            *[F.col(name).cast("string").alias(name) for name in counted],
            *seen_by,
        )
    )
    kept = ["customer_id", "slot", "purchase_date", "items", "spent", *seen_by]
    # Lines that the same views see in a slot are summed together.
    slot_key = F.concat_ws(" ", "slot", *seen_by)
    long = slotted.withColumn("slot_key", slot_key).unpivot(
        kept, [*counted, "slot_key"], "kind", "value"
    )
    per_slot = F.col("kind") == "slot_key"
    first_seen = (
        long.filter(F.col("value").isNotNull())
        .groupBy("customer_id", "kind", "value")
        .agg(
            *[F.min(F.when(F.col(name), F.col("slot"))).alias(name) for name in seen_by],
            F.sum(F.when(per_slot, F.col("items"))).alias("items"),
            F.sum(F.when(per_slot, F.col("spent"))).alias("spent"),
            F.min(F.when(per_slot, F.col("purchase_date"))).alias("first_day"),
            F.max(F.when(per_slot, F.col("purchase_date"))).alias("last_day"),
            F.count(F.when(per_slot, True)).alias("lines"),
        )
    )
    # A value belongs to as many views as see it; its row is repeated per view only where rows
    # are few, a customer's slots.
    per_slots = first_seen.groupBy("customer_id", *seen_by).agg(*_sums(counted))

    def of(i: int, name: str, view: View) -> Column:
        """A view's name and its own slot, NULL where it does not see the row."""
        before = [sum(day in view.dates for day in union[:at]) for at in range(len(union) + 1)]
        own = F.get(F.expr(f"array({','.join(map(str, before))})"), F.col(f"_in{i}"))
        dated = own < len(set(view.dates))
        return F.struct(F.lit(name).alias("view"), own.alias("slot"), dated.alias("_dated"))

    each = F.array(*[of(i, name, view) for i, (name, view) in enumerate(views.items())])
    return (
        per_slots.select("*", F.inline(each))
        .filter(F.col("slot").isNotNull())
        .groupBy("customer_id", "view", "slot")
        .agg(
            F.sum("items").alias("items"),
            F.sum("spent").alias("spent"),
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
            F.sum("lines").alias("lines"),
            # What is first seen after the last date is no part of any state.
            *[
                F.sum(F.when(F.col("_dated"), F.col(count)).otherwise(0)).alias(count)
                for count in counted.values()
            ],
        )
    )


def of_view(changes: DataFrame, name: str) -> DataFrame:
    return changes.filter(F.col("view") == name).drop("view")


def as_of(
    changes: DataFrame, dates: Sequence[date], counted: Sequence[str] = tuple(COUNTED.values())
) -> DataFrame:
    """State per customer and reference date from the first purchase on."""
    dates = sorted(dates)
    by_slot = Window.partitionBy("customer_id").orderBy("slot")
    so_far = by_slot.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = changes.select(
        "customer_id",
        "slot",
        F.lead("slot", 1, len(dates)).over(by_slot).alias("_next_slot"),
        F.lead("first_day").over(by_slot).alias("next_purchase_date"),
        F.min("first_day").over(so_far).alias("first_purchase_date"),
        F.max("last_day").over(so_far).alias("last_purchase_date"),
        F.sum("lines").over(so_far).alias("lines_so_far"),
        F.sum("items").over(so_far).alias("total_items"),
        F.sum("spent").over(so_far).alias("total_spent"),
        *[F.sum(name).over(so_far).alias(name) for name in counted],
    )
    # The state holds until the slot before the customer's next change.
    return (
        state.filter(F.col("slot") < len(dates))
        .withColumn("_at", F.explode(F.sequence(F.col("slot"), F.col("_next_slot") - 1)))
        .withColumn("reference_date", date_at(F.col("_at"), dates))
        .withColumn("inactive_days", F.datediff("reference_date", "last_purchase_date"))
        .drop("slot", "_next_slot", "_at")
    )


def eligible(df: DataFrame, inactive_days: int = INACTIVE_DAYS) -> DataFrame:
    return df.filter(F.col("inactive_days") >= inactive_days)


def with_target(df: DataFrame, days: int = PREDICTION_DAYS) -> DataFrame:
    """1 when the next purchase falls in (reference date, reference date + days]."""
    in_time = F.col("next_purchase_date") <= F.date_add("reference_date", days)
    return df.withColumn(TARGET, F.when(in_time, 1).otherwise(0)).drop("next_purchase_date")


def purchase_slots(lines: DataFrame, dates: Sequence[date], look_ahead: int) -> DataFrame:
    """Slot rows with days only, for the population without features."""
    return slot_changes(lines, dates, counted={}, look_ahead=look_ahead)


def population(
    lines: DataFrame,
    dates: Sequence[date],
    inactive_days: int = INACTIVE_DAYS,
    prediction_days: int = PREDICTION_DAYS,
) -> DataFrame:
    """Inactive customers per reference date with the return label."""
    changes = purchase_slots(lines, dates, prediction_days)
    return (
        as_of(changes, dates, counted=())
        .transform(eligible, inactive_days)
        .transform(with_target, prediction_days)
        .select("customer_id", "reference_date", "last_purchase_date", "inactive_days", TARGET)
    )


def target_rate(labelled: DataFrame) -> DataFrame:
    """Eligible and returned customers per reference date, rate in percent."""
    counts = labelled.groupBy("reference_date").agg(
        F.count("*").alias("eligible_customers"),
        F.sum(TARGET).alias("reactivated_customers"),
    )
    rate = F.col("reactivated_customers").cast("decimal(18,0)") * 100 / F.col(
        "eligible_customers"
    ).cast("decimal(18,0)")
    return counts.withColumn(
        "reactivation_rate", F.round(rate, 2).cast("double")
    ).orderBy("reference_date")


def class_balance(labelled: DataFrame) -> DataFrame:
    counts = labelled.groupBy(TARGET).agg(F.count("*").alias("count"))
    # Two rows at most reach this window.
    share = F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy())
    return counts.withColumn("percent", share)
