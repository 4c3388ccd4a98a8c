"""Frames of lines are stored in small files and derived from once."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from winback import session
from winback.operators import batches, carried, models
from winback.operators.cleaning import valid_lines
from winback.plans import all_queries, frames, monitoring
from winback.sources import tables as tables_module


def test_files_of_stored_lines_hold_few_rows(spark):
    rows = spark.range(2_500, numPartitions=1)
    stored = session.materialise(rows, "files", file_rows=1_000)
    sizes = [pq.read_metadata(f.removeprefix("file://")).num_rows for f in stored.inputFiles()]
    assert sorted(sizes) == [500, 1_000, 1_000] and stored.count() == 2_500


def test_stored_silver_bounds_its_files(spark, monkeypatch):
    monkeypatch.setattr(frames, "FILE_ROWS", 300)
    stored = frames.stored_silver(spark, SMALL)
    sizes = [pq.read_metadata(f.removeprefix("file://")).num_rows for f in stored.inputFiles()]
    assert max(sizes) <= 300
    assert sum(sizes) == frames.silver(spark, SMALL).count()


def counted_scans(monkeypatch, spark, name):
    """How often a query asks for the given lines."""
    asked = []
    given = frames.bronze

    def bronze(*args):
        asked.append(args)
        return given(*args)

    monkeypatch.setattr(frames, "bronze", bronze)
    assert all_queries()[name](spark, SMALL).count() > 0
    return len(asked)


@pytest.mark.parametrize("name", ["table_replace_date", "table_layers"])
def test_lines_are_joined_and_cleaned_once(spark, monkeypatch, name):
    assert counted_scans(monkeypatch, spark, name) == 1


def test_batch_is_computed_once(spark, monkeypatch):
    """What is stored and checked comes from the written batch, not from the given tables."""
    frames_of = []
    given = batches.append_batch

    def append(tables, batch, manifest, *rest, **named):
        frames_of.extend([batch, manifest])
        given(tables, batch, manifest, *rest, **named)

    monkeypatch.setattr(batches, "append_batch", append)
    all_queries()["table_delete_batch"](spark, SMALL).collect()
    assert len(frames_of) == 6
    for frame in frames_of:
        plan = frame._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        assert "lineitem.parquet" not in plan


def test_one_date_is_written_without_an_exchange(spark, monkeypatch):
    asked = []
    given = tables_module._rebalanced
    monkeypatch.setattr(
        tables_module, "_rebalanced", lambda df, by: asked.append(by) or given(df, by)
    )
    tables = tables_module.Tables.scratch(spark)
    day = dt.date(2001, 6, 8)
    rows = spark.range(10).select(F.col("id").alias("customer_id"), F.lit(day).alias("scoring_date"))
    for _ in range(2):
        tables.write_replace(rows, "gold", "feature_snapshot", "scoring_date", day)
    assert asked == [] and tables.read("gold", "feature_snapshot").count() == 10
    tables.write_replace(rows, "gold", "feature_snapshot", "scoring_date")
    assert asked == ["scoring_date"]


def test_pairs_of_a_new_date_are_written_once(spark, make_lines, monkeypatch):
    labels = []
    given = session.materialise
    monkeypatch.setattr(
        carried, "materialise", lambda df, label="stage", *r: labels.append(label) or given(df, label, *r)
    )
    tables = tables_module.Tables.scratch(spark)
    rows = [(1, "2001-01-01"), (1, "2001-02-01", {"stock_code": "B"}), (2, "2001-02-02")]
    lines = valid_lines(make_lines(rows), "strict")
    first, day = dt.date(2001, 1, 8), dt.date(2001, 2, 8)
    carried.advance(tables, lines.filter(F.col("purchase_date") <= F.lit(first)), None, first)
    later = lines.filter(F.col("purchase_date") > F.lit(first))
    carried.advance(tables, later, first, day)
    assert "new-pairs" not in labels
    want = carried.features(tables, day, 0).orderBy("customer_id").collect()
    # A second time the date's pairs are replaced.
    carried.advance(tables, later, first, day)
    assert "new-pairs" in labels
    assert carried.features(tables, day, 0).orderBy("customer_id").collect() == want
    # A date without lines has a state and no pairs.
    empty = dt.date(2001, 2, 9)
    carried.advance(tables, lines.limit(0), day, empty)
    assert carried.features(tables, empty, 0).count() == 2


def test_training_rows_are_dealt_evenly(spark):
    rows = spark.range(9_000, numPartitions=9).filter("id < 2000")
    rows = models._dealt(rows, 2_000)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism
    assert sum(sizes) == 2_000 and max(sizes) < 1.1 * min(sizes)


def test_tasks_of_exchanged_lines_are_bounded_unless_the_session_says(spark):
    given = spark.conf.get(session.ADVISORY, None)
    try:
        spark.conf.unset(session.ADVISORY)
        frames.bronze(spark, SMALL)
        assert spark.conf.get(session.ADVISORY) == session.TASK_BYTES == "32m"
        spark.conf.set(session.ADVISORY, "8m")
        frames.bronze(spark, SMALL)
        assert spark.conf.get(session.ADVISORY) == "8m"
    finally:
        if given is None:
            spark.conf.unset(session.ADVISORY)
        else:
            spark.conf.set(session.ADVISORY, given)


def test_a_reading_task_is_given_few_stored_lines(spark):
    """Files are packed by bytes, a file counting four megabytes more than it has."""
    files = int(spark.conf.get("spark.sql.files.maxPartitionBytes").rstrip("b")) >> 22
    assert files * session.FILE_ROWS <= 1_600_000


def test_duplicates_are_dropped_where_lines_met_their_order(spark):
    """Lines that were exchanged to meet their orders are not exchanged again."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    given = spark.conf.get(name)
    try:
        spark.conf.set(name, "-1")
        silver = frames.silver(spark, SMALL)
        plan = silver._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        rows = silver.count()
    finally:
        spark.conf.set(name, given)
    exchanges = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l]
    assert exchanges and not [l for l in exchanges if "invoice#" in l]
    assert rows == silver.distinct().count() == frames.silver(spark, SMALL).count()


def test_scores_and_reference_take_one_pass_over_the_lines(spark):
    plans = []

    def watch(df):
        plans.append(df._jdf.queryExecution().toString().split("== Physical Plan ==")[1])

    session.watchers.append(watch)
    try:
        silver, scores, reference = monitoring._stored(spark, SMALL)
    finally:
        session.watchers.remove(watch)
    assert len([p for p in plans if "Expand" in p]) == 1
    day = [dt.date.fromisoformat(frames.DRIFT_REFERENCE)]
    assert reference.exceptAll(frames.base_of(silver, on=day)).count() == 0
    assert reference.count() == frames.base_of(silver, on=day).count() > 0
    plain = frames.scores_of(silver).drop("scored_at")
    assert scores.drop("scored_at").exceptAll(plain).count() == 0
    assert scores.count() == plain.count() > 0
