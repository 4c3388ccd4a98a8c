"""Nearest neighbours by a forest of random-projection trees.

Trees are grown on a bounded sample, each by a task: a node cuts its points at the median
of their projection on the line between two of them. Every row is then put into its leaf
of every tree. A query walks all trees at once in one order of priority, nearest cut first,
until it has opened a number of leaves in all. That number is measured on each table: some
queries are compared with all rows, and as many leaves are opened as give them RECALL of
their true neighbours. Vectors without structure need a third of all leaves or more.

Neighbouring leaves of a tree make a region, and a query meets the leaves it opened of a
region at once. Regions are split into pieces of bounded size; a task compares a piece's
rows with the queries that opened their leaves, exactly and in double precision, and passes
on the nearest few of each query.

Of rows with equal vectors only the k + 1 smallest ids can be among anyone's k nearest
(ties go to the smaller id, and one may be the query), so the others stay out of the index:
no result changes, and a vector that a third of all rows share is no hot leaf.

Rows whose vector is null, zero, or holds a null or non-finite component take no part;
neither do rows whose vector has another length than most. Rows without an id take no part.
Rows repeating an id are separate candidates, but not for queries of that id. Fewer
candidates than k give all of them; an empty table gives no rows.

The sample bounds the number of leaves, so the rows of a leaf grow with the table: raise `sample`
with it (the forest's size, on the driver and in every task, follows the sample).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winback.session import materialise

TREES = 8
SAMPLE = 40_000
LEAF = 64
# Leaves that a query opens over all trees, at least.
OPENED = 60
# Mean share of the true neighbours that the opened leaves hold, on the queries that are
# compared with all rows; and how many these are.
RECALL = 0.95
PROBES = 100
# Neighbouring leaves that a query meets at once.
REGION = 64
# Rows of a region that one task compares.
PIECE = 50_000
# Queries walked or compared at once, and distances held at once.
BLOCK = 256
DISTANCES = 1 << 20


class Tree(NamedTuple):
    """Inner nodes in order of creation; a child below zero is leaf ~child."""

    normals: np.ndarray  # nodes x dimensions
    cuts: np.ndarray
    children: np.ndarray  # nodes x 2
    leaves: int


def grow(points: np.ndarray, leaf: int, seed: int) -> Tree:
    random = np.random.default_rng(seed)
    normals, cuts, children = [], [], []
    leaves = 0
    work = [(np.arange(len(points)), -1, 0)]
    while work:
        held, parent, side = work.pop()
        split = _split(points, held, random) if len(held) > leaf else None
        if split is None:
            at, leaves = ~leaves, leaves + 1
        else:
            normal, cut, right = split
            at = len(cuts)
            normals.append(normal)
            cuts.append(cut)
            children.append([0, 0])
            work += [(held[~right], at, 0), (held[right], at, 1)]
        if parent >= 0:
            children[parent][side] = at
    dimensions = points.shape[1]
    return Tree(
        np.array(normals).reshape(-1, dimensions),
        np.array(cuts),
        np.array(children, np.int64).reshape(-1, 2),
        leaves,
    )


def _split(points: np.ndarray, held: np.ndarray, random) -> tuple | None:
    for _ in range(5):
        a, b = random.choice(held, 2, replace=False)
        normal = points[a] - points[b]
        length = np.linalg.norm(normal)
        if length == 0:
            continue
        normal = normal / length
        along = points[held] @ normal
        cut = float(np.median(along))
        right = along > cut
        if right.any():
            return normal, cut, right
    return None


def leaf_of(tree: Tree, points: np.ndarray) -> np.ndarray:
    at = np.zeros(len(points), np.int64)
    if not len(tree.cuts):
        return at
    live = np.arange(len(points))
    while len(live):
        node = at[live]
        side = (np.einsum("ij,ij->i", points[live], tree.normals[node]) > tree.cuts[node]).astype(int)
        at[live] = tree.children[node, side]
        live = live[at[live] >= 0]
    return ~at


def urgencies(forest: list[Tree], points: np.ndarray) -> np.ndarray:
    """Points x leaves of all trees, one tree after the other: the largest distance to a cut
    that separates the point from the leaf, below zero for the leaf it lies in."""
    out = np.empty((sum(tree.leaves for tree in forest), len(points)))
    base = 0
    for tree in forest:
        far = np.full((len(tree.cuts) + 1, len(points)), -np.inf)
        sides = tree.normals @ points.T - tree.cuts[:, None]
        # Parents come before their children.
        for node, (left, right) in enumerate(tree.children.tolist()):
            side = sides[node]
            for child, crossed in ((left, side > 0), (right, side <= 0)):
                value = np.maximum(far[node], np.where(crossed, np.abs(side), -np.inf))
                if child < 0:
                    out[base + ~child] = value
                else:
                    far[child] = value
        if not len(tree.cuts):
            out[base] = -np.inf
        base += tree.leaves
    return out.T


def places(forest: list[Tree]) -> np.ndarray:
    """(tree, leaf) of the columns of `urgencies`."""
    return np.array([(t, n) for t, tree in enumerate(forest) for n in range(tree.leaves)], np.int32)


def opened(forest: list[Tree], point: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of a priority queue shared by all trees: a branch is as
    urgent as the smallest distance to a cut that separates it from the point."""
    order = np.argsort(urgencies(forest, point[None])[0], kind="stable")[:most]
    return [(int(t), int(n)) for t, n in places(forest)[order]]


def _closest(points: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) of all pairs that can be among the k nearest of a query."""
    p2, q2 = (points**2).sum(1), (queries**2).sum(1)
    rough = p2 + q2[:, None] - 2 * queries @ points.T
    if len(points) <= k:
        return np.nonzero(np.ones(rough.shape, bool))
    # What rounding can move a rough distance by.
    slack = 8 * (points.shape[1] + 4) * np.finfo(float).eps * (p2.max() + q2)
    limit = np.partition(rough, k - 1, axis=1)[:, k - 1] + slack
    return np.nonzero(~(rough > limit[:, None]))


def _distances(points, queries, point: np.ndarray, query: np.ndarray) -> np.ndarray:
    out = np.empty(len(point))
    step = max(1, DISTANCES // max(1, points.shape[1]))
    for at in range(0, len(point), step):
        some = slice(at, at + step)
        out[some] = np.sqrt(((points[point[some]] - queries[query[some]]) ** 2).sum(1))
    return out


def _first(owner: np.ndarray, far: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k nearest of each owner; equal pairs count once."""
    order = np.lexsort((ids, far, owner))
    o, f, i = owner[order], far[order], ids[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (f[1:] != f[:-1]) | (i[1:] != i[:-1])
    order, o = order[new], o[new]
    return order[np.arange(len(o)) - np.searchsorted(o, o) < k]


_FLOATS, _DOUBLES = "array<float>", "array<double>"


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector) of the rows that take part; single precision stays as short as it is."""
    v = F.col("vector")
    kind = _FLOATS if vectors.schema[vector_column].dataType.simpleString() == _FLOATS else _DOUBLES
    finite = F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast(kind).alias("vector"),
    ).filter(F.col("vec_id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (sizes["n"] if sizes else 0))


def grow_forest(rows: DataFrame, trees: int, sample: int, leaf: int) -> list[Tree]:
    """Trees over about `sample` rows drawn by the hash of their ids, one task a tree."""
    spark = rows.sparkSession
    n = rows.count()
    share = F.pmod(F.xxhash64(F.lit(3), F.col("vec_id")), F.lit(1_000_000)) < int(
        1e6 * min(1.0, sample / max(1, n))
    ) + 1
    points = _matrix(rows.filter(share).orderBy("vec_id").select("vector").toArrow().column(0))
    if not len(points):
        return []
    shared = spark.sparkContext.broadcast(points)

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                tree = grow(shared.value, leaf, number)
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": pa.array([number], pa.int64()),
                        "normals": pa.array([tree.normals.ravel()], pa.list_(pa.float64())),
                        "cuts": pa.array([tree.cuts], pa.list_(pa.float64())),
                        "children": pa.array([tree.children.ravel()], pa.list_(pa.int64())),
                        "leaves": pa.array([tree.leaves], pa.int64()),
                    }
                )

    schema = "tree long, normals array<double>, cuts array<double>, children array<long>, leaves long"
    # The forest is as large as the sample, whatever the table.
    found = spark.range(0, trees, 1, trees).mapInArrow(grown, schema).orderBy("tree").toArrow()
    return [
        Tree(
            np.array(r["normals"]).reshape(-1, points.shape[1]),
            np.array(r["cuts"]),
            np.array(r["children"], np.int64).reshape(-1, 2),
            r["leaves"],
        )
        for r in found.to_pylist()
    ]


def leaves_to_open(
    candidates: DataFrame, queries: DataFrame, forest: list[Tree], k: int, recall: float
) -> int:
    """Leaves that hold `recall` of the k nearest of some queries, drawn by the hash of their
    vectors, each vector once."""
    spark = candidates.sparkSession
    drawn = queries.groupBy("vector").agg(F.min("vec_id").alias("vec_id"))
    drawn = drawn.orderBy(F.xxhash64(F.lit(5), "vec_id"), "vec_id").limit(PROBES).toArrow()
    if not drawn.num_rows:
        return OPENED
    probes, names = _matrix(drawn.column("vector")), drawn.column("vec_id").to_numpy()
    shared = spark.sparkContext.broadcast((forest, probes, names))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, probes, names = shared.value
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            points, ids = _matrix(batch.column("vector")), batch.column("vec_id").to_numpy()
            probe, point = _closest(points, probes, k + 1)
            other = ids[point] != names[probe]
            probe, point = probe[other], point[other]
            leaves = np.column_stack([leaf_of(tree, points) for tree in trees])
            new = [probe, _distances(points, probes, point, probe), ids[point], leaves[point]]
            held = [np.concatenate(x) for x in zip(held, new)] if held else new
            best = _first(*held[:3], k)
            held = [x[best] for x in held]
        if held:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(held[0], pa.int32()),
                    pa.array(held[1], pa.float64()),
                    pa.array(held[2], pa.int64()),
                    pa.array(list(held[3]), pa.list_(pa.int32())),
                ],
                names=["probe", "far", "vec_id", "leaves"],
            )

    found = candidates.mapInArrow(compare, "probe int, far double, vec_id long, leaves array<int>")
    order = Window.partitionBy("probe").orderBy("far", "vec_id")
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    found = found.select("probe", "leaves").toArrow()
    if not found.num_rows:
        return OPENED
    probe, leaves = found.column("probe").to_numpy(), np.array(found.column("leaves").to_pylist())
    turns = np.argsort(np.argsort(urgencies(forest, probes), axis=1), axis=1)
    begins = np.cumsum([0] + [tree.leaves for tree in forest[:-1]])
    needed = np.sort(turns[probe[:, None], leaves + begins].min(axis=1))
    return max(OPENED, int(needed[int(np.ceil(recall * len(needed))) - 1]) + 1)


def _meet(ids, points, leaves, begins, stops, asked: pa.Table, k: int) -> Iterator[tuple]:
    """(queries, ids, distances): the k nearest of some queries in the leaves they opened."""
    queries, names = _matrix(asked.column("vector")), asked.column("query_id").to_numpy()
    lists = asked.column("leaves").combine_chunks()
    wanted = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    order = np.argsort(wanted, kind="stable")
    wanted, owner = wanted[order], owner[order]
    firsts, ends = np.searchsorted(wanted, leaves), np.searchsorted(wanted, leaves, "right")
    found = []
    for begin, stop, first, end in zip(*(x.tolist() for x in (begins, stops, firsts, ends))):
        step = max(1, DISTANCES // (stop - begin))
        for at in range(first, end, step):
            some = owner[at : min(at + step, end)]
            # A query may be among its own nearest.
            query, point = _closest(points[begin:stop], queries[some], k + 1)
            query, point = some[query], point + begin
            other = ids[point] != names[query]
            query, point = query[other], point[other]
            far = _distances(points, queries, point, query)
            best = _first(query, far, ids[point], k)
            found.append((query[best], ids[point[best]], far[best]))
    if found:
        query, near, far = (np.concatenate(x) for x in zip(*found))
        best = _first(query, far, near, k)
        yield names[query[best]], near[best], far[best]


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    trees: int = TREES,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    open_leaves: int | None = None,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The k nearest found of every query row: query_id, rank, vec_id, score (distance).

    `is_query` is a condition on `vec_id`. A query opens `open_leaves` leaves, by default as
    many as RECALL takes on this table.
    """
    rows = materialise(usable(vectors, id_column, vector_column), "vectors")
    spark = rows.sparkSession
    forest = spark.sparkContext.broadcast(grow_forest(rows, trees, sample, leaf))
    copies = Window.partitionBy("vector").orderBy("vec_id")
    candidates = rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column("vector"))
            for number, tree in enumerate(forest.value):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(points), number), pa.int32()),
                        pa.array(leaf_of(tree, points), pa.int32()),
                        batch.column("vec_id"),
                        batch.column("vector"),
                    ],
                    names=["tree", "leaf", "vec_id", "vector"],
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _matrix(batch.column("vector"))
            for number, tree in enumerate(forest.value):
                held = np.bincount(leaf_of(tree, points) // REGION)
                regions = np.flatnonzero(held)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(regions), number), pa.int32()),
                        pa.array(regions, pa.int32()),
                        pa.array(held[regions], pa.int64()),
                    ],
                    names=["tree", "region", "n"],
                )

    # Regions are counted first and dealt after: placing a row twice costs less than storing
    # its vector once per tree.
    candidates = materialise(candidates.select("vec_id", "vector"), "candidates")
    sizes = (
        candidates.mapInArrow(count, "tree int, region int, n long")
        .groupBy("tree", "region")
        .agg(F.ceil(F.sum("n") / PIECE).cast("int").alias("pieces"))
    )
    sizes = materialise(sizes, "region-sizes")
    if open_leaves is None:
        open_leaves = leaves_to_open(candidates, rows.filter(is_query), forest.value, k, RECALL)
    kind = candidates.schema["vector"].dataType.simpleString()
    index = candidates.mapInArrow(place, f"tree int, leaf int, vec_id long, vector {kind}")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = places(forest.value)
        region = place[:, 1] // REGION
        most = min(open_leaves, len(place))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                urgent = urgencies(forest.value, _matrix(some.column("vector")))
                chosen = np.sort(np.argpartition(urgent, most - 1, axis=1)[:, :most], axis=1).ravel()
                owner = np.repeat(np.arange(some.num_rows), most)
                new = np.ones(len(owner), bool)
                new[1:] = owner[1:] != owner[:-1]
                new[1:] |= place[chosen[1:], 0] != place[chosen[:-1], 0]
                new[1:] |= region[chosen[1:]] != region[chosen[:-1]]
                begins = np.flatnonzero(new)
                asker = pa.array(owner[begins])
                edges = pa.array(np.append(begins, len(owner)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(place[chosen[begins], 0]),
                        pa.array(region[chosen[begins]]),
                        some.column("vec_id").take(asker),
                        some.column("vector").take(asker),
                        pa.ListArray.from_arrays(edges, pa.array(place[chosen, 1])),
                    ],
                    names=["tree", "region", "query_id", "vector", "leaves"],
                )

    queries = rows.filter(is_query).mapInArrow(
        walk, f"tree int, region int, query_id long, vector {kind}, leaves array<int>"
    )
    # A query meets every piece of a region it opened; a row is in one piece.
    every_piece = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    asked = queries.join(sizes, ["tree", "region"]).select(
        "tree", "region", every_piece.alias("piece"), "query_id", "vector", "leaves"
    )
    own_piece = F.pmod(F.xxhash64("vec_id"), F.col("pieces")).cast("int")
    index = index.withColumn("region", F.floor(F.col("leaf") / REGION).cast("int"))
    held = index.join(sizes, ["tree", "region"]).select(
        "tree", "region", own_piece.alias("piece"), "leaf", "vec_id", "vector"
    )

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        names, scores, owners = [], [], []
        if left.num_rows and right.num_rows:
            left = left.sort_by("leaf")
            ids, points = left.column("vec_id").to_numpy(), _matrix(left.column("vector"))
            leaves, begins = np.unique(left.column("leaf").to_numpy(), return_index=True)
            stops = np.append(begins[1:], len(ids))
            for at in range(0, right.num_rows, BLOCK):
                for found in _meet(ids, points, leaves, begins, stops, right.slice(at, BLOCK), k):
                    for whole, part in zip((owners, names, scores), found):
                        whole.append(part)
        return pa.table(
            {
                "query_id": pa.array(np.concatenate(owners) if owners else [], pa.int64()),
                "vec_id": pa.array(np.concatenate(names) if names else [], pa.int64()),
                "score": pa.array(np.concatenate(scores) if scores else [], pa.float64()),
            }
        )

    key = ["tree", "region", "piece"]
    found = (
        held.groupBy(*key)
        .cogroup(asked.groupBy(*key))
        .applyInArrow(compare, "query_id long, vec_id long, score double")
        .distinct()
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
