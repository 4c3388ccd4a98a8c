"""The pipeline on a small corpus with planted cases, and its registration."""

import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_classifiers import PLAIN
from winback.llm import rows

WORDS = [a + b for a in "ba ce di fo gu ha ke li mo nu".split() for b in "ran sel tim vor pul".split()]


def corpus():
    random.seed(11)
    docs, labels = [], []
    for i in range(400):
        text = " ".join(random.choices(PLAIN + WORDS, k=random.randint(40, 90))) + "."
        quality, toxic = 1, 0
        if i % 8 == 1:
            text, quality = " ".join(w.upper() + "!!" for w in text.split()), 0
        elif i % 8 == 3:
            at = text.split()
            at[5] = random.choice(["grobnaxa", "grobnaxi", "vilefoo"])
            text, toxic = " ".join(at), 1
        docs.append((i, text))
        labels.append((i, quality, toxic))
    return docs, labels


def test_stages_remove_what_they_should(spark, tmp_path):
    docs, labels = corpus()
    passage = " ".join(random.choices(WORDS, k=30))
    clean = [i for i, q, t in labels if q and not t]
    copies = [(1000 + n, docs[clean[0]][1]) for n in range(5)]
    dirty = [(2000, docs[clean[1]][1][:60] + " " + passage)]
    short = [(3000, None)]
    folder = str(tmp_path)
    every = docs + copies + dirty + short
    spark.createDataFrame(
        [(i, t, "en", "s", len(t or "")) for i, t in every],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    got = corpus_pipeline.run(spark, folder).collect()
    kept = {r.doc_id for r in got}
    bad = {i for i, q, t in labels if not q or t}
    assert not kept & bad
    assert not kept & {2000, 1000, 1001, 1002, 1003, 1004}
    assert kept >= set(clean)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got[0].asDict())


def rows_of(frame):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.text) for r in frame.collect()))


def test_rows_without_id_or_with_one_id_are_judged_alone(spark, tmp_path):
    random.seed(3)
    a, b, c, d, e, passage = (" ".join(random.choices(WORDS, k=60)) for _ in range(6))
    schema = (
        "doc_id long, text string, _key string, _path string, _file string, _chunk string, "
        "_bits string, _base string"
    )
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )

    def run(stage, given):
        docs = spark.createDataFrame([(i, t, *"??????") for i, t in given], schema).repartition(3)
        found = stage(spark, docs, str(tmp_path))
        assert found.columns == docs.columns
        return rows_of(found)

    # Copies of each other and of a document with an id; texts of their own under one id.
    given = [(None, a), (1, a), (None, a), (None, b), (5, c), (5, d), (5, c), (4, c), (None, e), (None, e)]
    kept = [(1, a), (4, c), (5, d), (None, b), (None, e)]
    assert run(corpus_pipeline.drop_near_duplicates, given) == sorted(
        (i is None, i or 0, t) for i, t in kept
    )
    given = [(None, passage), (None, a), (9, passage), (9, b), (7, c), (7, c)]
    kept = [(None, a), (9, b), (7, c), (7, c)]
    assert run(corpus_pipeline.drop_contaminated, given) == sorted(
        (i is None, i or 0, t) for i, t in kept
    )


def test_classifier_stages_keep_every_column(spark, tmp_path):
    docs, labels = corpus()
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    names = ["_quality", "_toxicity", "_tagged", "_found", "_letter", "score"]
    frame = spark.createDataFrame(
        [(i, t, *names) for i, t in docs],
        "doc_id long, text string, " + ", ".join(f"{n} string" for n in names),
    )
    bad = {1: {i for i, q, t in labels if not q}, 2: {i for i, q, t in labels if t}}
    for stage, removed in ((corpus_pipeline.keep_quality, bad[1]), (corpus_pipeline.drop_toxic, bad[2])):
        found = stage(spark, frame, str(tmp_path))
        assert found.columns == frame.columns
        rows = found.collect()
        assert {tuple(r[2:]) for r in rows} == {tuple(names)}
        assert removed and not removed & {r.doc_id for r in rows}


@pytest.mark.parametrize("bitmaps", [8192, 2])
def test_rows_go_by_their_place(spark, tmp_path, bitmaps):
    spark.range(100_000).selectExpr("id as doc_id", "id % 5 as _file").repartition(4).write.parquet(
        f"{tmp_path}/t"
    )
    keyed = rows.with_row_key(spark.read.parquet(f"{tmp_path}/t"))
    assert keyed.frame.select(keyed.key).distinct().count() == 100_000
    gone = keyed.frame.filter("doc_id % 7 = 3 and doc_id < 60000")
    left = rows.without_rows(keyed, gone, bitmaps)
    assert left.columns == ["doc_id", "_file"]
    expected = [i for i in range(100_000) if i % 7 != 3 or i >= 60_000]
    assert sorted(r.doc_id for r in left.collect()) == expected
    # Nothing but bitmaps is exchanged.
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    nothing = keyed.frame.limit(0)
    assert rows.without_rows(keyed, nothing).count() == 100_000


def test_all_operators_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    for number in range(1, 14):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "toxicity", "near_duplicates", "decontamination", "packing",
    ]
