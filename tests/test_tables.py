import datetime as dt

import pytest
from pyspark.sql import functions as F

from winback.operators import batches, quality, rounds
from winback.sources.guards import conform, require_columns, require_rows, require_tables
from winback.sources.tables import Tables

DAY1, DAY2 = dt.date(2011, 1, 1), dt.date(2011, 2, 1)


@pytest.fixture
def tables(spark):
    return Tables.scratch(spark)


def rows(spark, *values):
    return spark.createDataFrame(list(values), "customer_id bigint, scoring_date date")


def stored(tables):
    found = tables.read("gold", "reactivation_scores").select("customer_id", "scoring_date")
    return sorted(map(tuple, found.collect()))


def replace(tables, df, day=None):
    tables.write_replace(df, "gold", "reactivation_scores", "scoring_date", day)


def test_replacing_a_date_keeps_the_others_and_is_idempotent(spark, tables):
    replace(tables, rows(spark, (1, DAY1), (2, DAY1), (3, DAY2)))
    for _ in range(2):
        replace(tables, rows(spark, (7, DAY2), (8, DAY2)), DAY2)
        assert stored(tables) == [(1, DAY1), (2, DAY1), (7, DAY2), (8, DAY2)]


def test_replacing_does_not_depend_on_session_settings(spark, tables):
    replace(tables, rows(spark, (1, DAY1), (2, DAY2)))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        replace(tables, rows(spark, (3, DAY2)), DAY2)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    assert stored(tables) == [(1, DAY1), (3, DAY2)]


@pytest.mark.parametrize("foreign", [DAY1, None])
def test_replacing_refuses_other_dates(spark, tables, foreign):
    replace(tables, rows(spark, (1, DAY1), (2, DAY2)))
    with pytest.raises(Exception, match="rows outside scoring_date"):
        replace(tables, rows(spark, (3, DAY2), (4, foreign)), DAY2)
    assert stored(tables) == [(1, DAY1), (2, DAY2)]


def test_full_write_replaces_everything(spark, tables):
    for value in (1, 2):
        tables.write_full(rows(spark, (value, DAY1)), "gold", "modeling", by="scoring_date")
    assert [r.customer_id for r in tables.read("gold", "modeling").collect()] == [2]


def test_append_creates_then_adds(spark, tables):
    for value in (1, 2):
        tables.write_append(rows(spark, (value, DAY1)), "gold", "modeling")
    assert tables.read("gold", "modeling").count() == 2


def test_dropping_a_date(spark, tables):
    replace(tables, rows(spark, (1, DAY1), (2, DAY2)))
    tables.drop_partition("gold", "reactivation_scores", "scoring_date", DAY1)
    assert stored(tables) == [(2, DAY2)]


def test_names_are_checked(tables):
    with pytest.raises(KeyError, match="known"):
        tables.name("gold", "nothing")
    with pytest.raises(KeyError):
        tables.name("nowhere", "modeling")
    assert not tables.exists("gold", "modeling")


def batch_of(make_lines, n):
    return make_lines([(i, "2011-03-01") for i in range(n)])


def manifest(batch, batch_id):
    return batches.manifest_row(batch, batch_id, "normal", 7, DAY1, DAY2, 1500)


def test_batch_is_stored_once_unless_replaced(make_lines, tables):
    batch = batch_of(make_lines, 3)
    batches.append_batch(tables, batch, manifest(batch, "b1"), "b1")
    batches.append_batch(tables, batch, manifest(batch, "b2"), "b2")
    with pytest.raises(ValueError, match="stored already"):
        batches.append_batch(tables, batch, manifest(batch, "b1"), "b1")
    smaller = batch_of(make_lines, 2)
    batches.append_batch(tables, smaller, manifest(smaller, "b1"), "b1", replace=True)
    counted = tables.read("synthetic", "transactions").groupBy("batch_id").count()
    assert dict(map(tuple, counted.collect())) == {"b1": 2, "b2": 3}
    runs = tables.read("synthetic", "generation_runs").select("batch_id", "generated_rows")
    assert dict(map(tuple, runs.collect())) == {"b1": 2, "b2": 3}
    history = tables.create_full_history(batch_of(make_lines, 4))
    assert history.count() == 9


def test_windows_follow_each_other(make_lines):
    real = make_lines([(1, "2011-01-31")])
    first = batches.next_window(real, None).first()
    assert first.batch_start_date == dt.date(2011, 2, 1)
    assert first.batch_end_date == dt.date(2011, 3, 2)
    assert first.batch_id == "20110201_20110302_normal"
    later = batches.next_window(real, make_lines([(1, "2011-03-02")]), "volume_spike").first()
    assert later.batch_id == "20110303_20110401_volume_spike"
    given = batches.next_window(real, None, start="2012-01-01", days=2).first()
    assert given.batch_end_date == dt.date(2012, 1, 2)
    assert batches.planned_invoices("volume_spike") == 4500


def test_pools_fall_back_to_everyone(spark):
    profiles = spark.createDataFrame(
        [(1, "X", 70), (2, "Y", 90)], "customer_id bigint, country string, inactive_days int"
    )
    found = batches.customer_pools(profiles).groupBy("pool").count().collect()
    assert dict(map(tuple, found)) == {"inactive": 2, "active": 2}
    mixed = profiles.unionAll(spark.createDataFrame([(3, "Z", 1)], profiles.schema))
    found = batches.customer_pools(mixed).groupBy("pool").count().collect()
    assert dict(map(tuple, found)) == {"inactive": 2, "active": 1}


CATALOG = "stock_code string, description string, base_price double, frequency double"


def test_catalog_consolidation(spark):
    given = [("A", "Zulu", 10.0, 2.0), ("A", "Alpha", 20.0, 3.0), ("B", "Beta", 5.0, 4.0)]
    catalog = batches.consolidate_catalog(spark.createDataFrame(given, CATALOG))
    assert sorted(map(tuple, catalog.collect())) == [
        ("A", "Alpha", 16.0, 5.0),
        ("B", "Beta", 5.0, 4.0),
    ]
    shares = batches.with_product_share(catalog).collect()
    assert sum(r.product_share for r in shares) == pytest.approx(1)


def test_catalog_needs_frequency(spark):
    catalog = spark.createDataFrame([("A", "Alpha", 1.0, 1.0)], CATALOG).drop("frequency")
    with pytest.raises(ValueError, match="frequency"):
        batches.consolidate_catalog(catalog)


def test_latest_country_of_equal_times(make_lines):
    rows = [
        (1, "2011-01-01", {"country": "X", "invoice": "5"}),
        (1, "2011-01-01", {"country": "Y", "invoice": "6"}),
        (2, "2011-01-01", {"country": "X"}),
        (2, "2011-01-09", {"country": "W", "quantity": -1}),
    ]
    found = batches.latest_country(make_lines(rows)).collect()
    assert dict(map(tuple, found)) == {1: "Y", 2: "X"}


def test_guards(spark, make_lines):
    lines = make_lines([(1, "2011-01-01")])
    with pytest.raises(ValueError, match="nope"):
        require_columns(lines, ["invoice", "nope"])
    with pytest.raises(ValueError, match="no rows"):
        require_rows(lines.limit(0), "batch")
    with pytest.raises(ValueError, match="missing tables"):
        require_tables(Tables.scratch(spark), ("gold", "modeling"))
    text = lines.select(*[F.col(c).cast("string").alias(c) for c in reversed(lines.columns)])
    assert conform(text, lines.schema).schema == lines.schema


def test_a_batch_that_fails_a_check_is_not_stored(make_lines, tables):
    good, first, last = batch_of(make_lines, 3), dt.date(2011, 3, 1), dt.date(2011, 3, 30)
    with pytest.raises(quality.DataQualityError, match="outside"):
        rounds.accept_batch(tables, good, "b", "normal", first + dt.timedelta(days=1), last)
    with pytest.raises(ValueError, match="missing columns"):
        rounds.accept_batch(tables, good.drop("price"), "b", "normal", first, last)
    with pytest.raises(quality.DataQualityError, match="non_positive"):
        rounds.accept_batch(tables, good.withColumn("price", F.lit(0)), "b", "normal", first, last)
    assert not tables.exists("synthetic", "transactions")
    text = good.select(*[F.col(c).cast("string").alias(c) for c in good.columns])
    assert rounds.accept_batch(tables, text, "b", "normal", first, last).count() == 3
    run = tables.read("synthetic", "generation_runs").first()
    assert (run.scenario, run.generated_rows, run.batch_start_date) == ("normal", 3, first)
