"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tests.compare import database, difference
from winback.llm import queries, ranked_search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return [w.translate(CAPITALS) for w in WORD.findall(text or "")]


def plain(documents, items, k):
    counted = [(i, Counter(terms(t))) for i, t in documents]
    held = sum(bool(c) for _, c in counted)
    total = sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c in counted:
            m = 10 + 90 * sum(c.values()) * held // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * held + 2) / (2 * df[w] + 1)))
                * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m))
                for w in set(terms(text))
                if w in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, missing, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, None if missing else i, -score))
    return sorted(out, key=str)


def found(spark, path, items, **how):
    frame = spark.createDataFrame(
        [(i, t, 0, "x") for i, t in items], "item_id string, text string, rank int, number string"
    )
    rows = ranked_search.search(spark, path, frame, **how).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=str)


@pytest.fixture(scope="module")
def corpus():
    random.seed(4)
    # From a word in every document to words in one, with copies and ties.
    vocabulary = [f"w{i}" for i in range(400)]
    odds = [1 / (i + 1) for i in range(400)]
    rows = [(i, " ".join(random.choices(vocabulary, odds, k=random.randint(1, 80)))) for i in range(600)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(7, rows[8][1]), (None, rows[9][1]), (None, None)]
    random.shuffle(rows)
    items = [(f"i{n}", " ".join(random.choices(vocabulary, k=random.randint(1, 30)))) for n in range(25)]
    items += [("copy", rows[7][1]), ("copied", dict(rows)[1000]), ("frequent", "w0 W1 w2"), ("none", "zzz zz")]
    items += [("null", None), ("empty", " ... "), (None, "w5 w9 w200"), ("i0", items[0][1]), ("i1", "w3 w4")]
    return rows, items


@pytest.mark.parametrize("segment_bytes,wave,block_bytes", [(1 << 20, 16, 1 << 20), (800, 3, 400)])
def test_equals_scoring_all(spark, tmp_path, frame, corpus, segment_bytes, wave, block_bytes):
    rows, items = corpus
    path = f"{tmp_path}/index"
    ranked_search.build(frame(rows), path, segment_bytes=segment_bytes)
    for k in (1, 10):
        got = found(spark, path, items, k=k, wave=wave, block_bytes=block_bytes)
        assert got == plain(rows, items, k)


def test_a_file_holds_one_segment(spark, tmp_path, frame, corpus):
    rows, items = corpus
    path = tmp_path / "index"
    ranked_search.build(frame(rows), str(path), segment_bytes=800)
    held = [pq.ParquetFile(file).metadata.num_rows for file in path.glob("*.parquet")]
    assert sum(held) > 9 and max(held) == 1
    assert found(spark, str(path), items, k=10) == plain(rows, items, 10)


def test_batches_of_segments_are_bounded(spark):
    before = spark.conf.get(queries.BATCH_SIZE, None)
    try:
        spark.conf.unset(queries.BATCH_SIZE)
        queries.op13_ranked_search(spark, "/root/testdata/sf0.001")
        assert spark.conf.get(queries.BATCH_SIZE) == queries.BATCH_BYTES
        spark.conf.set(queries.BATCH_SIZE, "9m")
        queries.op13_ranked_search(spark, "/root/testdata/sf0.001")
        assert spark.conf.get(queries.BATCH_SIZE) == "9m"
    finally:
        spark.conf.unset(queries.BATCH_SIZE)
        if before:
            spark.conf.set(queries.BATCH_SIZE, before)


def test_messy_texts(spark, tmp_path, frame, messy):
    path = f"{tmp_path}/index"
    ranked_search.build(frame(messy), path)
    items = [("a", "alpha beta x1"), ("b", "ÉTÉ été 日本"), ("c", messy[0][1]), ("d", "one two end no id")]
    assert found(spark, path, items) == plain(messy, items, 10)


def test_empty_tables(spark, tmp_path, frame):
    path = f"{tmp_path}/index"
    ranked_search.build(frame([]), path)
    assert found(spark, path, [("a", "word")]) == []
    path = f"{tmp_path}/other"
    ranked_search.build(frame([(1, "word")]), path)
    assert found(spark, path, []) == []


def segment_of(rows, texts):
    held = [Counter(terms(t)) for _, t in rows]
    block = ranked_search.Block([0], sorted({w.encode() for w in terms(texts)}), [])
    block.of.append(np.arange(len(block.terms)))
    postings = sorted((w.encode(), d, n) for d, c in enumerate(held) for w, n in c.items())
    names = sorted({p[0] for p in postings})
    counts = Counter(p[0] for p in postings)
    row = {
        "doc_ids": pa.array([i for i, _ in rows], pa.int64()),
        "lengths": pa.array([sum(c.values()) for c in held], pa.int32()),
        "terms": pa.array(names, pa.binary()),
        "counts": pa.array([counts[w] for w in names], pa.int32()),
        "docs": pa.py_buffer(np.array([p[1] for p in postings], "<i4").tobytes()),
        "times": pa.py_buffer(np.array([p[2] for p in postings], "<i4").tobytes()),
    }
    df = np.array([counts.get(w, 0) for w in block.terms])
    weights = np.array([ranked_search.weight(len(rows), int(n)) for n in df])
    return ranked_search._Segment(row, block, ranked_search.Corpus(len(rows), 20 * len(rows), weights))


def test_maxima_of_all_ranges(corpus):
    rows = sorted((r for r in corpus[0] if r[0] is not None), key=lambda r: r[0])[:200]
    segment = segment_of(rows, "w0 w3 w20 w399")
    for start, end in zip(segment.starts, segment.ends, strict=True):
        ranges = [(a, b) for a in range(start, end + 1) for b in range(a, end + 1)]
        lows, highs = (np.array(x) for x in zip(*ranges, strict=True))
        values, places = segment.maxima(lows, highs)
        for (a, b), value, place in zip(ranges, values, places, strict=True):
            assert value == (segment.impacts[a:b].max() if b > a else 0)
            assert b == a or (a <= place < b and segment.impacts[place] == value)


def test_intervals_leave_most_documents_out(corpus):
    """A rare passage among many documents: few of them are scored, fewer with a floor."""
    random.seed(5)
    rows = [(i, " ".join(random.choices([f"w{j}" for j in range(300)], k=20))) for i in range(3000)]
    rows[1234] = (1234, "w1 w2 w3 w4 w5 w6 w7 w8 rare")
    segment = segment_of(rows, "w1 w2 w3 w4 w5 w6 w7 w8 rare")
    terms_of = np.arange(len(segment.starts))
    scores, docs, evaluated = segment.search(terms_of, 1, (1, ranked_search._NO_ID), batch=4)
    assert docs.tolist() == [1234] and evaluated < 100
    _, _, none = segment.search(terms_of, 1, (int(scores[0]) + 1, ranked_search._NO_ID))
    assert none < evaluated
    # A tie is looked for only among smaller ids.
    _, _, before = segment.search(terms_of, 1, (int(scores[0]), 1233))
    again, docs, _ = segment.search(terms_of, 1, (int(scores[0]), 1234))
    assert docs.tolist() == [1234] and again[0] == scores[0]


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    found = queries.op13_ranked_search(spark, folder)
    assert difference(database(folder), found, queries.SQL["op13_ranked_search"]) is None
