"""Windows from events against brute force, and the shape of their plan."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import SMALL
from winback.contract import TARGET, Parameters
from winback.functions.dates import monthly_dates
from winback.operators.cleaning import valid_lines
from winback.operators.features import extra_features, modeling_base, windowed_totals
from winback.operators.population import COUNTED
from winback.operators.sliding import window_states
from winback.plans import all_queries

purchases = st.lists(
    st.tuples(
        st.integers(1, 3), st.integers(0, 400), st.sampled_from("ABC"), st.sampled_from(["X", "Y", None]),
        st.sampled_from(["i1", "i2", "i3", "i4"]), st.integers(1, 5),
    ),
    min_size=1, max_size=40,
)
START = dt.date(2011, 1, 1)


def lines_of(make_lines, purchases):
    rows = [
        (c, str(START + dt.timedelta(days=d)), {"stock_code": s, "country": k, "invoice": i, "quantity": q})
        for c, d, s, k, i, q in purchases
    ]
    return valid_lines(make_lines(rows), "modeling")


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(purchases, st.sampled_from([20, 45, 180]), st.sampled_from(["1 MONTH", "uneven"]))
def test_states_equal_brute_force(make_lines, purchases, days, step):
    dates = monthly_dates("2011-02-28", "2011-12-28")
    if step == "uneven":
        dates = [dates[0], dates[0] + dt.timedelta(days=1), *dates[3:5], dates[-1]]
    found = window_states(
        lines_of(make_lines, purchases), dates, days, COUNTED, {"invoice": "orders_ever"}, look_ahead=30
    )
    got = {
        (r.customer_id, r.reference_date): (
            r.first_purchase_date, r.last_purchase_date, r.lines_so_far, r.total_items, r.orders_ever,
            r.next_purchase_date, r.recent_first_purchase_date, r.recent_total_items,
            r.recent_number_orders, r.recent_unique_products, r.recent_distinct_countries,
        )
        for r in found.collect()
    }
    want = {}
    kept = [(c, START + dt.timedelta(days=d), s, k, i, q) for c, d, s, k, i, q in purchases]
    horizon = dates[-1] + dt.timedelta(days=30)
    for customer in {p[0] for p in kept}:
        mine = [p for p in kept if p[0] == customer]
        for day in dates:
            past = [p for p in mine if p[1] <= day]
            if not past:
                continue
            near = [p for p in past if (day - p[1]).days <= days]
            after = [p[1] for p in mine if day < p[1] <= horizon]
            window = (None,) * 5
            if near:
                countries = {p[3] for p in near} - {None}
                window = (
                    min(p[1] for p in near), sum(p[5] for p in near), len({p[4] for p in near}),
                    len({p[2] for p in near}), len(countries),
                )
            want[customer, day] = (
                min(p[1] for p in past), max(p[1] for p in past), len(past), sum(p[5] for p in past),
                len({p[4] for p in past}), min(after, default=None), *window,
            )
    assert got == want


def test_a_customer_with_a_third_of_the_lines(spark):
    from pyspark.sql import functions as F

    i = F.col("id")
    lines = spark.range(30_000).select(
        F.when(i % 3 == 0, 0).otherwise(i % 211 + 1).alias("customer_id"),
        F.expr("date_add(DATE'2010-01-01', cast((id * 31) % 500 as int))").alias("purchase_date"),
        (i % 7 + 1).cast("int").alias("quantity"),
        F.lit(2).cast("decimal(16,4)").alias("total_amount"),
        (i % 900).cast("string").alias("invoice"),
        F.when(i % 2 == 0, "hot").otherwise((i % 500).cast("string")).alias("stock_code"),
        (i % 11).cast("string").alias("country"),
    )
    day = dt.date(2011, 3, 8)
    got = {r.customer_id: r for r in windowed_totals(lines, monthly_dates("2010-06-08", day)).filter(
        F.col("reference_date") == F.lit(day)).collect()}
    past = lines.filter(F.col("purchase_date").between(F.date_sub(F.lit(day), 180), F.lit(day)))
    for r in past.groupBy("customer_id").agg(
        F.count_distinct("invoice").alias("o"), F.count_distinct("stock_code").alias("p"),
        F.count_distinct("country").alias("c"), F.sum("quantity").alias("q"), F.min("purchase_date").alias("d"),
    ).collect():
        g = got[r.customer_id]
        assert (g.number_orders, g.unique_products, g.distinct_countries, g.total_items, g.first_purchase_date) == (
            r.o, r.p, r.c, r.q, r.d)


def test_one_scan_and_no_copies_per_date(spark, make_lines):
    for name in ("features_windowed_base", "features_activity_and_trend"):
        plan = all_queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        scans = re.findall(r"FileScan parquet .*?(\w+)\.parquet", plan)
        assert sorted(scans) == sorted(set(scans)) and scans
    # Dates are only generated from the finished states, of which there are few.
    lines = lines_of(make_lines, [(1, d, "A", "X", f"i{d}", 1) for d in range(100)])
    dates = monthly_dates("2011-02-28", "2011-12-28")
    plan = window_states(lines, dates, 180, COUNTED)._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Window")]
    assert plan.count("explode") == above.count("explode") == 1


def test_no_lines(spark, make_lines):
    lines = lines_of(make_lines, [(1, 5, "A", "X", "i1", 1)]).limit(0)
    dates = monthly_dates("2011-02-28", "2011-12-28")
    assert windowed_totals(lines, dates).collect() == []
    assert modeling_base(lines, dates, Parameters(observation_days=180)).collect() == []
    assert extra_features(lines, dates).collect() == []
    assert TARGET in modeling_base(lines, dates, Parameters(observation_days=180)).columns
