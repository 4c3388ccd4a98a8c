"""Customer features as of a date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.contract import FEATURES, INACTIVE_DAYS, OBSERVATION_DAYS, TARGET, Parameters
from winback.functions.dates import as_date
from winback.operators.population import COUNTED, as_of, eligible, slot_changes, with_target
from winback.operators.sliding import window_states

BASE_COLUMNS = (
    "customer_id",
    "reference_date",
    "last_purchase_date",
    "inactive_days",
    TARGET,
    "first_purchase_date",
    "number_orders",
    "total_items",
    "total_spent",
    "unique_products",
    "distinct_countries",
    "customer_tenure_days",
    "average_ticket",
    "average_amount_per_country",
    "average_amount_per_stock_code",
)


def _per(count: str) -> Column:
    return F.when(F.col(count) > 0, F.col("total_spent") / F.col(count))


def with_ratios(df: DataFrame, date_column: str = "reference_date") -> DataFrame:
    """Spend as double (summed exactly before), tenure and the three guarded ratios."""
    return df.withColumn("total_spent", F.col("total_spent").cast("double")).withColumns(
        {
            "customer_tenure_days": F.datediff(date_column, "first_purchase_date"),
            "average_ticket": _per("number_orders"),
            "average_amount_per_country": _per("distinct_countries"),
            "average_amount_per_stock_code": _per("unique_products"),
        }
    )


def modeling_base(
    lines: DataFrame,
    dates: Sequence[date],
    params: Parameters = Parameters(),
    changes: DataFrame | None = None,
) -> DataFrame:
    """Inactive customers per reference date with label and features.

    With `params.observation_days`, features see only that many days up to the date
    (both ends included) and are NULL where the customer bought nothing in them.
    `changes` are the slot changes of these lines, where they are at hand.
    """
    if params.observation_days is not None:
        states = window_states(
            lines, dates, params.observation_days, COUNTED, look_ahead=params.prediction_days
        )
        return (
            states.transform(eligible, params.inactive_days)
            .transform(with_target, params.prediction_days)
            .transform(_recent, COUNTED)
            .transform(with_ratios)
            .select(*BASE_COLUMNS)
        )
    if changes is None:
        changes = slot_changes(lines, dates, look_ahead=params.prediction_days)
    return (
        as_of(changes, dates)
        .transform(eligible, params.inactive_days)
        .transform(with_target, params.prediction_days)
        .transform(with_ratios)
        .select(*BASE_COLUMNS)
    )


def _recent(states: DataFrame, counted: Mapping[str, str]) -> DataFrame:
    """The window's columns in the place of those of the whole history."""
    names = ["first_purchase_date", "total_items", "total_spent", *counted.values()]
    return states.drop(*names).withColumnsRenamed({f"recent_{name}": name for name in names})


def windowed_totals(
    lines: DataFrame,
    dates: Sequence[date],
    days: int = OBSERVATION_DAYS,
    counted: Mapping[str, str] = COUNTED,
) -> DataFrame:
    """Counts and sums over [reference date - days, reference date], where it has lines."""
    states = window_states(lines, dates, days, counted).transform(_recent, counted)
    return states.filter(F.col("first_purchase_date").isNotNull()).select(
        "customer_id",
        "reference_date",
        "first_purchase_date",
        "total_items",
        "total_spent",
        *counted.values(),
    )


def scoring_features(
    lines: DataFrame,
    dates: Sequence[date | str],
    inactive_days: int = INACTIVE_DAYS,
    changes: DataFrame | None = None,
) -> DataFrame:
    """Inactive customers at the scoring dates with their features.

    `changes` are the slot changes of these lines, where they are at hand.
    """
    dates = [as_date(d) for d in dates]
    if changes is None:
        changes = slot_changes(lines, dates)
    state = as_of(changes, dates).withColumnRenamed(
        "reference_date", "scoring_date"
    )
    return (
        state.transform(eligible, inactive_days)
        .transform(with_ratios, "scoring_date")
        .select(
            "customer_id",
            "scoring_date",
            "first_purchase_date",
            "last_purchase_date",
            *FEATURES,
        )
    )


def extra_features(
    lines: DataFrame, dates: Sequence[date], days: int = OBSERVATION_DAYS
) -> DataFrame:
    """Active days, mean gap between them, and recent against whole spend."""
    daily = lines.withColumn("purchase_day", F.col("purchase_date"))
    states = window_states(daily, dates, days, recent={}, ever={"purchase_day": "active_days"})
    gap = F.datediff("last_purchase_date", "first_purchase_date")
    return (
        states.transform(eligible)
        .select(
            "customer_id",
            "reference_date",
            "active_days",
            (gap / F.nullif(F.col("active_days") - 1, F.lit(0))).alias("mean_days_between_purchases"),
            F.col("total_spent").cast("double").alias("total_spent"),
            F.coalesce(F.col("recent_total_spent").cast("double"), F.lit(0.0)).alias("recent_spent"),
        )
        .withColumn("recent_spend_share", F.try_divide("recent_spent", "total_spent"))
    )
