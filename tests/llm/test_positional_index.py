"""Decontamination against a search that slides every window over every document."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.compare import database, difference
from tests.conftest import SMALL
from winback.llm import positional_index as index
from winback.llm.queries import QUERIES, SQL
from winback.session import new_folder

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, width):
    held = words(text)
    hit, found = [False] * len(held), set()
    for name, item in items:
        line = words(item)
        if name is None or not line:
            continue
        for at in range(max(1, len(line) - width + 1)):
            window = line[at : at + width]
            for start in range(len(held) - len(window) + 1):
                if held[start : start + len(window)] == window:
                    found.add(str(name))
                    hit[start : start + len(window)] = [True] * len(window)
    return len(held), sum(hit), ",".join(sorted(found))


def near_brute(text, items, width, near, totals):
    held, found = words(text), set()
    for name, item in items:
        line = words(item)
        if name is None or not line:
            continue
        for at in range(max(1, len(line) - width + 1)):
            window = line[at : at + width]
            rarest = min(range(len(window)), key=lambda i: (totals.get(window[i], 0), i))
            for place in (i for i, w in enumerate(held) if w == window[rarest]):
                around = set(held[max(0, place - near) : place + near + 1])
                if set(window) <= around:
                    found.add(str(name))
    return ",".join(sorted(found))


ITEMS = [
    (1, "alpha Beta gamma delta"),
    (2, "one two"),
    (3, None),
    (4, "!!!"),
    (None, "alpha"),
    (5, "été x1 日本 a the of ÉTÉ alpha beta"),
    (6, "end"),
    (7, "of the of the"),
    (7, "of the of the"),
    (10, "ALPHA beta gamma"),
    (11, "absentword"),
    (12, "a a a"),
]


def test_phrases_and_blocks_and_near(spark, frame, messy):
    rows = [(100 + n, t) for n, (_, t) in enumerate(messy)]
    items = spark.createDataFrame([(i, t, "?") for i, t in ITEMS], "item_id long, text string, part string")
    path = new_folder(spark, "test-index")
    index.build(frame(rows), path, segment_bytes=3_000)
    totals = {}
    for _, text in rows:
        for word in words(text):
            totals[word] = totals.get(word, 0) + 1
    for block_words in (500_000, 12):
        found = index.search(spark, path, items, width=3, near=6, block_words=block_words)
        digest = found.join(index.contamination(found).select("doc_id", "n_hit", "contaminated"), "doc_id")
        got = {r.doc_id: r for r in digest.collect()}
        assert sorted(got) == [i for i, _ in rows]
        for i, text in rows:
            r = got[i]
            n, hit, names = brute(text, ITEMS, 3)
            assert (r.n_words, r.n_hit, ",".join(r["items"])) == (n, hit, names), i
            assert r.contaminated == (hit > 0 and 20 * hit >= n)
            assert all(a.stop < b.first for a, b in zip(r.spans, r.spans[1:]))
            if len(text or "") < 10_000:
                assert ",".join(r.near_items) == near_brute(text, ITEMS, 3, 6, totals), i


def test_null_ids_repeated_rows_and_empty_tables(spark, frame, messy):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    path = new_folder(spark, "test-index")
    index.build(frame(messy), path)
    found = index.contamination(index.search(spark, path, items, width=3))
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, r.n_hit) for r in found.collect())
    assert got == sorted((i is not None, i or 0, *brute(t, ITEMS, 3)[:2]) for i, t in messy)
    none = index.contamination(index.search(spark, path, items.limit(0)))
    assert none.agg(F.sum("n_hit"), F.count("*")).first()[:] == (0, len(messy))
    path = new_folder(spark, "test-index")
    index.build(frame([]), path)
    assert index.search(spark, path, items).count() == 0


def test_gaps_of_any_size_survive():
    gaps = np.array([0, 1, 127, 128, 300, (1 << 14) - 1, 1 << 14, 1 << 21, (1 << 28) - 1])
    data, size = index._pack(gaps)
    assert size.sum() == len(data)
    assert index._unpack(data).tolist() == gaps.tolist()


def test_query_equals_its_sql(spark, con):
    name = "op5_decontamination"
    assert difference(con, QUERIES[name](spark, SMALL), SQL[name]) is None


def test_items_without_id_are_searched_as_in_the_sql(spark, tmp_path, monkeypatch):
    some = [f"w{i}" for i in range(60)]
    one, two, three = (" ".join(some[a : a + 15]) for a in (0, 20, 40))
    items = [(None, one), (None, "w1 w2 w3"), (7, two), (None, two), (None, None), (8, three)]
    docs = [(1, one), (2, "x " + two + " y"), (3, three + " " + one), (4, "x w1 w2 w3 y"), (5, "x"), (None, one)]
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        frame = spark.createDataFrame(rows, f"{key} long, text string")
        frame.toPandas().astype({key: "Int64"}).to_parquet(f"{tmp_path}/{name}.parquet")
    name = "op5_decontamination"
    docs_with_id = {r.doc_id: r for r in QUERIES[name](spark, str(tmp_path)).collect()}
    assert {i: (r.n_hit, r.n_items, r.contaminated) for i, r in docs_with_id.items()} == {
        1: (15, 1, True), 2: (15, 2, True), 3: (30, 2, True), 4: (3, 1, True), 5: (0, 0, False),
        None: (15, 1, True),
    }
    spark.createDataFrame(docs[:-1], "doc_id long, text string").toPandas().to_parquet(
        f"{tmp_path}/documents.parquet"
    )
    for words_of_block in (index.BLOCK_WORDS, 10):
        search = index.search
        with monkeypatch.context() as patch:
            patch.setattr(
                index, "search", lambda *a, **o: search(*a, **o, block_words=words_of_block)
            )
            found = QUERIES[name](spark, str(tmp_path))
            assert difference(database(str(tmp_path)), found, SQL[name]) is None


def test_a_segment_is_built_in_bounded_memory():
    """Arrays of a few dozen bytes a byte of text do not fit an executor's workers."""
    line = " ".join(f"word{i % 5000} of" for i in range(20_000))
    copies = index.SEGMENT_BYTES // len(line)
    table = pa.table({"doc_id": list(range(copies)), "text": [line] * copies})
    tracemalloc.start()
    row = index._segment(table, 0, 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert row.num_rows == 1 and peak < 80 << 20, peak >> 20
