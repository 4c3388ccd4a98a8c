"""Hot keys give the same results, and plans keep the shape that scales."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from winback.functions.dates import monthly_dates
from winback.operators import explore, quality
from winback.operators.cleaning import valid_lines
from winback.operators.features import scoring_features
from winback.plans import all_queries, frames


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """20,000 lines, a third of them of one customer and of one invoice."""
    i = F.col("id")
    return spark.range(20_000).select(
        F.when(i % 3 == 0, "hot").otherwise((i / 4).cast("int").cast("string")).alias("invoice"),
        (F.when(i % 3 == 1, 0).otherwise(i % 500)).cast("string").alias("stock_code"),
        F.lit("thing").alias("description"),
        (i % 7 + 1).cast("int").alias("quantity"),
        F.expr("timestamp_ntz'2010-01-01 00:00:00' + make_dt_interval(cast((id * 31) % 500 as int))")
        .alias("invoice_date"),
        F.lit(2).cast("decimal(16,4)").alias("price"),
        F.when(i % 3 == 0, 0).otherwise(i % 211 + 1).alias("customer_id"),
        (i % 11).cast("string").alias("country"),
    )


def test_hot_customer_features(hot):
    dates = monthly_dates("2010-06-08", "2011-06-08")
    lines = valid_lines(hot, "strict")
    got = {(r.customer_id, r.scoring_date): r for r in scoring_features(lines, dates, 0).collect()}
    day = dates[-1]
    past = lines.filter(F.col("purchase_date") <= F.lit(day)).groupBy("customer_id").agg(
        F.count_distinct("invoice").alias("o"), F.count_distinct("stock_code").alias("p"),
        F.count_distinct("country").alias("c"), F.sum("quantity").alias("q"))
    for r in past.collect():
        g = got[r.customer_id, day]
        assert (g.number_orders, g.unique_products, g.distinct_countries, g.total_items) == (
            r.o, r.p, r.c, r.q)


def test_hot_customer_gaps(hot):
    days = {r[0] for r in hot.filter("customer_id = 0").select(F.to_date("invoice_date")).distinct().collect()}
    ordered = sorted(days)
    want = sorted((b - a).days for a, b in zip(ordered, ordered[1:]))
    got = explore.days_between_purchases(hot).filter("customer_id = 0").collect()
    assert sorted(r.days_between_invoices for r in got) == want


def test_hot_copies(hot):
    copies = hot.unionAll(hot.filter("customer_id = 0"))
    row = quality.duplicate_count(copies).first()
    assert row.row_count == copies.count() and row.distinct_rows == hot.distinct().count()


def test_base_reads_lines_once_and_does_not_copy_them(spark):
    plan = plan_of(frames.base(spark, SMALL)).split("== Physical Plan ==")[1]
    assert plan.count("lineitem.parquet") == 1
    assert "BroadcastNestedLoopJoin" not in plan
    # Dedup, first-seen values, slot sums, and customers for the running sums; small files
    # are also spread over the cores once.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 4


def test_scan_is_pruned_and_filtered(spark):
    plan = plan_of(frames.lines(spark, SMALL, "strict").select("customer_id", "purchase_date"))
    physical = plan.split("== Physical Plan ==")[1]
    scan = next(l for l in physical.splitlines() if "lineitem.parquet" in l)
    assert "l_extendedprice" not in scan and "IsNotNull(l_orderkey)" in scan


def test_date_cut_reaches_the_scan(spark):
    df = scoring_features(frames.lines(spark, SMALL, "strict"), [dt.date(1999, 1, 1)])
    physical = plan_of(df).split("== Physical Plan ==")[1]
    scan = next(l for l in physical.splitlines() if "orders.parquet" in l)
    assert "LessThan(o_orderdate" in scan


def test_rank_does_not_use_one_task(spark):
    physical = plan_of(all_queries()["score_priority_ranking"](spark, SMALL))
    assert "SinglePartition" not in physical
    # Offsets are joined by their known, small size.
    assert "BroadcastHashJoin" in physical
