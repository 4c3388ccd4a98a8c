"""Forest search against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from winback.llm import neighbours


def brute(rows, k):
    """(query, rank, id, distance) over the usable rows."""
    held = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    size = max({len(v) for _, v in held}, key=lambda n: sum(len(v) == n for _, v in held))
    held = [(i, v) for i, v in held if len(v) == size]
    out = {}
    for q, point in held:
        if q % 100 == 0:
            far = sorted({(float(np.sqrt(((v - point) ** 2).sum())), i) for i, v in held if i != q})
            out[q] = [(i, d) for d, i in far[:k]]
    return out


def search(spark, rows, **options):
    frame = spark.createDataFrame(
        [(i, v, "?", "?") for i, v in rows],
        "vec_id long, embedding array<float>, tree string, vector string",
    ).repartition(3)
    found = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 100 == 0, **options).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in found.items()}


def test_recall_and_exact_scores(spark):
    random = np.random.default_rng(2)
    centres = random.normal(size=(10, 16))
    points = (centres[random.integers(0, 10, 3000)] + 0.3 * random.normal(size=(3000, 16))).astype("f4")
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    got, want = search(spark, rows), brute(rows, 10)
    assert set(got) == set(want)
    recall = []
    for q, near in want.items():
        assert [r for r, _, _ in got[q]] == list(range(1, 11))
        assert [(s, i) for _, i, s in got[q]] == sorted((s, i) for _, i, s in got[q])
        for _, i, s in got[q]:
            assert s == pytest.approx(float(np.linalg.norm(points[i].astype(float) - points[q])), abs=1e-12)
        recall.append(len({i for i, _ in near} & {i for _, i, _ in got[q]}) / 10)
    assert np.mean(recall) >= 0.9


def test_copies_ties_and_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PIECE", 7)
    bad = [(50, None), (51, []), (52, [0.0, 0.0]), (53, [1.0, None]), (54, [float("nan"), 1.0])]
    bad += [(55, [float("inf"), 1.0]), (56, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    rows = [(100 * i + 7, [1.0, 2.0]) for i in range(300)]
    rows += [(100, [1.0, 2.0]), (200, [1.0, 2.5]), (300, [5.0, 5.0]), (8, [5.0, 6.0]), (9, [6.0, 5.0])]
    rows += [(9, [6.0, 5.0])]
    got = search(spark, rows + bad, open_leaves=1_000)
    want = brute(rows + bad, 10)
    assert {q: [(i, s) for _, i, s in v] for q, v in got.items()} == {
        q: [(i, pytest.approx(s, abs=1e-9)) for i, s in v] for q, v in want.items()
    }


def test_few_rows_and_none(spark):
    got = search(spark, [(0, [1.0]), (100, [3.0]), (5, [2.0])])
    assert got == {0: [(1, 5, 1.0), (2, 100, 2.0)], 100: [(1, 5, 1.0), (2, 0, 2.0)]}
    assert search(spark, [(0, [1.0])]) == {}
    assert search(spark, []) == {}


def test_queue_opens_the_nearest_leaves_of_all_trees():
    random = np.random.default_rng(4)
    points = random.normal(size=(500, 6))
    forest = [neighbours.grow(points, 20, seed) for seed in range(3)]
    for tree in forest:
        at = neighbours.leaf_of(tree, points)
        assert at.max() < tree.leaves and np.bincount(at, minlength=tree.leaves).max() <= 20
    found = neighbours.opened(forest, points[3], 10**9)
    assert sorted(found) == [(t, leaf) for t, tree in enumerate(forest) for leaf in range(tree.leaves)]
    first = {(t, int(neighbours.leaf_of(tree, points[3:4])[0])) for t, tree in enumerate(forest)}
    assert set(found[:3]) == first


def test_equal_points_are_one_leaf():
    tree = neighbours.grow(np.ones((100, 4)), 10, 0)
    assert tree.leaves == 1 and neighbours.leaf_of(tree, np.ones((2, 4))).tolist() == [0, 0]


@pytest.mark.parametrize("n", [2_000, 20_000])
def test_recall_without_structure_at_any_size(spark, n):
    random = np.random.default_rng(6)
    points = random.normal(size=(n, 64))
    points = (points / np.linalg.norm(points, axis=1)[:, None]).astype("f4")
    frame = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": list(points)}))
    found = neighbours.nearest(frame, F.col("vec_id") % 400 == 0).toPandas()
    recall = []
    for q, near in found.groupby("query_id"):
        far = ((points.astype(float) - points[q]) ** 2).sum(1)
        far[q] = np.inf
        recall.append(len(set(np.argsort(far)[:10]) & set(near["vec_id"])) / 10)
    assert len(recall) == n // 400
    assert np.mean(recall) >= 0.9
