import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from winback.contract import INACTIVE_DAYS, OBSERVATION_DAYS, PREDICTION_DAYS, TARGET, Parameters
from winback.functions import lines as line_rules
from winback.functions.dates import first_index_from, last_index_until, monthly_dates, reference_dates
from winback.operators.cleaning import valid_lines
from winback.operators.features import modeling_base, scoring_features, windowed_totals
from winback.operators.population import (
    View,
    of_view,
    population,
    slot_changes,
    slot_changes_of,
)


def test_contract():
    assert (INACTIVE_DAYS, OBSERVATION_DAYS, PREDICTION_DAYS) == (60, 180, 30)


def test_eligibility_example(make_lines):
    lines = valid_lines(make_lines([(1, "2011-03-20"), (2, "2011-05-10")]), "modeling")
    found = {r[0]: r[1] for r in population(lines, [dt.date(2011, 6, 1)]).select(
        "customer_id", "inactive_days").collect()}
    assert found == {1: 73}


@pytest.mark.parametrize(
    "day, label",
    [("2011-06-01", None), ("2011-06-02", 1), ("2011-07-01", 1), ("2011-07-02", 0)],
)
def test_target_window_bounds(make_lines, day, label):
    lines = valid_lines(make_lines([(1, "2011-03-01"), (1, day)]), "modeling")
    rows = population(lines, [dt.date(2011, 6, 1)]).collect()
    # A purchase on the reference date itself makes the customer active.
    assert [r[TARGET] for r in rows] == ([] if label is None else [label])


def test_same_customer_two_dates(make_lines):
    lines = valid_lines(
        make_lines([(12345, "2011-01-05"), (67890, "2011-01-06"), (12345, "2011-06-20")]),
        "modeling",
    )
    found = population(lines, [dt.date(2011, 6, 1), dt.date(2011, 8, 25)])
    assert {(r.customer_id, str(r.reference_date), r[TARGET]) for r in found.collect()} == {
        (12345, "2011-06-01", 1),
        (67890, "2011-06-01", 0),
        (12345, "2011-08-25", 0),
        (67890, "2011-08-25", 0),
    }


@pytest.mark.parametrize("day, seen", [("2010-12-02", False), ("2010-12-03", True),
                                       ("2011-06-01", True), ("2011-06-02", False)])
def test_observation_window_bounds(make_lines, day, seen):
    lines = valid_lines(make_lines([(1, day)]), "modeling")
    assert (windowed_totals(lines, [dt.date(2011, 6, 1)]).count() > 0) is seen


def test_nobody_in_window_gives_missing_features(make_lines):
    lines = valid_lines(make_lines([(1, "2010-01-01")]), "modeling")
    params = Parameters(observation_days=180)
    row = modeling_base(lines, [dt.date(2011, 6, 1)], params).first()
    assert row.number_orders is None and row.average_ticket is None and row.inactive_days == 516


def test_later_purchases_never_change_features(make_lines):
    day = dt.date(2011, 6, 1)
    past = [(1, "2011-01-05", {"quantity": 3}), (1, "2011-02-05"), (2, "2011-01-01")]
    future = [(1, "2011-06-02", {"quantity": 50, "country": "Z", "stock_code": "N"})]
    def features(rows):
        base = modeling_base(valid_lines(make_lines(rows), "modeling"), [day]).drop(TARGET)
        return sorted(map(tuple, base.collect()))
    assert features(past) == features(past + future)


def test_empty_lines(make_lines):
    lines = valid_lines(make_lines([]), "strict")
    assert modeling_base(lines, [dt.date(2011, 6, 1)]).count() == 0
    assert scoring_features(lines, ["2011-06-01"]).count() == 0


def test_missing_keys_are_not_counted(make_lines):
    rows = [(1, "2011-01-05", {"country": None, "stock_code": "B"}), (1, "2011-01-06")]
    row = scoring_features(valid_lines(make_lines(rows), "strict"), ["2011-06-01"]).first()
    assert (row.distinct_countries, row.unique_products, row.number_orders) == (1, 2, 2)


def test_reference_dates_clip_to_month_ends(spark):
    found = [r[0] for r in reference_dates(spark, "2011-01-31", "2011-06-30").collect()]
    assert found == monthly_dates("2011-01-31", "2011-06-30")
    assert len(monthly_dates("2010-03-08", "2011-11-08")) == 21


def test_slots_of_days(spark):
    dates = [dt.date(2011, 1, 31), dt.date(2011, 2, 1), dt.date(2011, 4, 10)]
    days = [dt.date(2011, 1, 25) + dt.timedelta(days=i) for i in range(90)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    rows = df.select("day", first_index_from("day", dates), last_index_until("day", dates)).collect()
    for day, first, last in rows:
        assert first == sum(d < day for d in dates)
        assert last == sum(d <= day for d in dates) - 1


purchases = st.lists(
    st.tuples(
        st.integers(1, 3), st.integers(0, 400), st.sampled_from("ABC"), st.sampled_from("XY"),
        st.sampled_from(["i1", "i2", "i3", "i4"]), st.integers(-2, 5),
    ),
    min_size=1, max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(purchases)
def test_base_equals_brute_force(make_lines, purchases):
    start = dt.date(2011, 1, 1)
    rows = [
        (c, str(start + dt.timedelta(days=d)),
         {"stock_code": s, "country": k, "invoice": i, "quantity": q})
        for c, d, s, k, i, q in purchases
    ]
    dates = monthly_dates("2011-02-28", "2011-12-28")
    lines = valid_lines(make_lines(rows), "modeling")
    got = {
        (r.customer_id, r.reference_date): (
            r.inactive_days, r[TARGET], r.number_orders, r.total_items, r.total_spent,
            r.unique_products, r.distinct_countries, r.first_purchase_date,
        )
        for r in modeling_base(lines, dates).collect()
    }
    kept = [(c, start + dt.timedelta(days=d), s, k, i, q) for c, d, s, k, i, q in purchases if q]
    want = {}
    for customer in {p[0] for p in kept}:
        mine = [p for p in kept if p[0] == customer]
        for day in dates:
            past = [p for p in mine if p[1] <= day]
            if not past or (day - max(p[1] for p in past)).days < 60:
                continue
            back = any(day < p[1] <= day + dt.timedelta(days=30) for p in mine)
            want[customer, day] = (
                (day - max(p[1] for p in past)).days, int(back), len({p[4] for p in past}),
                sum(p[5] for p in past), 2.0 * sum(p[5] for p in past), len({p[2] for p in past}),
                len({p[3] for p in past}), min(p[1] for p in past),
            )
    assert got == want


def test_views_together_are_as_each_alone(make_lines):
    """Views of other rules, dates and days after the last, sharing a date or none."""
    rows = [
        (1, "2011-01-31"),
        (1, "2011-02-01", {"invoice": "x", "country": "Y"}),
        (1, "2011-02-02", {"invoice": "x", "stock_code": "B", "price": -3}),
        (1, "2011-03-20", {"stock_code": "B"}),
        (1, "2011-03-21", {"stock_code": "C", "country": None}),
        (2, "2011-02-10", {"description": "Discount", "quantity": 4}),
        (2, "2011-03-05", {"description": None, "invoice": None}),
        (2, "2011-03-05", {"invoice": "Cx"}),
        (None, "2011-01-05"),
        (3, "2011-03-31", {"quantity": -2}),
        (3, "2011-04-01"),
        (4, "2012-01-01"),
    ]
    d = dt.date
    views = {
        "strict": ("strict", [d(2011, 2, 1), d(2011, 3, 20)], 0),
        "loose": ("modeling", [d(2011, 2, 1), d(2011, 3, 1)], 30),
        "one": ("modeling", [d(2011, 2, 15)], 3),
    }
    silver = make_lines(rows)
    lines = silver.withColumns(
        {"total_amount": line_rules.line_amount(), "purchase_date": line_rules.purchase_day()}
    )
    together = slot_changes_of(
        lines, {name: View(line_rules.valid_line(r), on, n) for name, (r, on, n) in views.items()}
    )
    for name, (rule, on, days) in views.items():
        alone = slot_changes(valid_lines(silver, rule), on, look_ahead=days)
        found = of_view(together, name).select(*alone.columns)
        assert [f.dataType for f in found.schema] == [f.dataType for f in alone.schema]
        want = sorted(map(str, alone.collect()))
        assert want and sorted(map(str, found.collect())) == want
