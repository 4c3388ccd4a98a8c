"""Connected components of an edge list by alternating stars, all in shuffles.

Each round rewires edges to the smallest neighbour (large stars, then small stars) until
nothing changes. A round is written to the shared folder, so lineage stays short and lost
executors cost no earlier round. Minima are taken by partial aggregation; a node with a
third of all edges is one key of a join that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.session import materialise


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link neighbours of each node to the smallest of them and itself."""
    if larger:
        sides = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = sides.join(least, "u")
    if larger:
        found = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        found = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v"))
        )
    return found.filter("u != v").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the smallest node reachable.

    Loops and repeated edges are ignored; an empty edge list gives no rows.
    """
    links = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
    links = materialise(links.filter("u != v"), "links")
    state = None
    while True:
        links = materialise(_star(_star(links, True), False), "links")
        now = _state(links)
        if now == state:
            break
        state = now
    # Every edge now leads to a root.
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
