import pytest
from pyspark.sql import functions as F

from winback.operators import explore
from winback.operators.cleaning import to_silver, valid_lines
from winback.operators.monitoring import batch_counters
from winback.operators.quality import (
    DataQualityError,
    batch_checks,
    enforce,
    enforce_batch,
    enforce_counters,
    input_checks,
    quality_report,
)
from winback.contract import BRONZE_NAMES, FEATURES


def failed(report):
    return {(r.check_name, r.subject) for r in report.filter(~F.col("passed")).collect()}


def test_clean_table_passes(make_lines):
    report = quality_report(make_lines([(1, "2011-01-01"), (2, "2011-01-01")]), "invoice_date")
    assert failed(report) == set()
    enforce(report)


def test_defects_are_named(make_lines):
    row = (1, "2011-01-01", {"invoice": "1", "description": None})
    report = quality_report(make_lines([row, row]), "invoice_date")
    assert failed(report) == {("duplicate_rows", "*"), ("null_rows", "description")}
    with pytest.raises(DataQualityError, match="duplicate_rows"):
        enforce(report)


def test_empty_table_and_missing_date_fail(make_lines):
    empty = make_lines([])
    assert failed(quality_report(empty, "invoice_date")) == {
        ("row_count", "*"), ("date_range", "invoice_date"),
    }
    assert ("date_column", "when") in failed(quality_report(make_lines([(1, "2011-01-01")]), "when"))


def test_strict_rule_drops_unknown_descriptions(make_lines):
    kinds = [
        {}, {"description": None}, {"description": "Discount"}, {"price": -2}, {"quantity": -1},
        {"price": 0}, {"quantity": 0}, {"invoice": "C9"}, {"stock_code": "TEST1"},
    ]
    lines = make_lines([(i, "2011-01-01", extra) for i, extra in enumerate(kinds)])
    kept = lambda rule: {r.customer_id for r in valid_lines(lines, rule).collect()}
    assert kept("strict") == {0}
    assert kept("modeling") == {0, 1, 2, 3, 4}
    with pytest.raises(ValueError, match="unknown rule"):
        valid_lines(lines, "loose")


def test_silver_from_bronze(make_lines):
    rows = [(1, "2011-01-01", {"invoice": "1"})] * 2 + [(None, "2011-01-01")]
    bronze = make_lines(rows).withColumnsRenamed({v: k for k, v in BRONZE_NAMES.items()})
    assert to_silver(bronze).count() == 1


def test_batch_gate(make_lines):
    good = [(1, "2011-01-02", {"invoice": "1"}), (1, "2011-01-03", {"invoice": "2"})]
    enforce_batch(batch_checks(make_lines(good), "2011-01-01", "2011-01-30"))
    with pytest.raises(DataQualityError, match="rows_outside_window"):
        enforce_batch(batch_checks(make_lines(good), "2011-01-03", "2011-01-30"))
    bad = make_lines([*good, (2, "2011-01-02", {"invoice": "1"}), (3, "2011-01-02", {"price": 0}),
                      (4, "2011-01-02", {"country": None})])
    checks = batch_checks(bad, "2011-01-01", "2011-01-30")
    row = checks.first()
    assert (row.duplicate_keys, row.non_positive_rows, row.null_rows) == (1, 1, 1)
    with pytest.raises(DataQualityError):
        enforce_batch(checks)
    enforce_batch(checks, expect_clean=False)
    with pytest.raises(DataQualityError, match="batch_rows"):
        enforce_batch(batch_checks(make_lines([]), "2011-01-01", "2011-01-30"))


def test_round_counters_count_copies(make_lines):
    twice = (1, "2011-01-02", {"invoice": "C1", "description": None, "price": 0})
    counters = batch_counters(make_lines([twice, twice, (None, "2011-01-02"), (2, "2011-01-03")]))
    row = counters.first()
    assert (row.batch_rows, row.duplicate_rows, row.null_rows) == (4, 1, 3)
    assert (row.cancelled_rows, row.invalid_price_rows, row.batch_customers) == (2, 2, 3)
    assert row.dq_status == "CRITICAL"
    clean = batch_counters(make_lines([(1, "2011-01-02")])).first()
    assert clean.dq_status == "PASS"


def test_feature_gate(spark):
    names = ", ".join(f"{f} double" for f in FEATURES)
    rows = [(i, *[1.0] * len(FEATURES)) for i in range(4)]
    rows[1] = (1, float("nan"), *[1.0] * 9)
    rows[2] = (2, None, *[1.0] * 9)
    rows[3] = (0, float("-inf"), *[1.0] * 9)
    df = spark.createDataFrame(rows, f"customer_id bigint, {names}").withColumn(
        "scoring_date", F.lit("2011-01-01").cast("date"))
    row = input_checks(df).first()
    assert (row.row_count, row.duplicate_keys, row.null_feature_rows, row.non_finite_rows) == (
        4, 1, 1, 3)
    with pytest.raises(DataQualityError):
        enforce_counters(input_checks(df))
    enforce_counters(input_checks(df.limit(1)), rows=1)


def test_gaps_between_days(make_lines):
    rows = [(1, "2011-01-01T09:00"), (1, "2011-01-01T18:00"), (1, "2011-01-05"), (1, "2011-03-10")]
    gaps = explore.days_between_purchases(make_lines(rows)).collect()
    assert sorted(r.days_between_invoices for r in gaps) == [4, 64]
    back = explore.returning_customers(make_lines(rows)).collect()
    assert sorted(map(tuple, back)) == [(30, 1), (60, 1), (90, 0)]
