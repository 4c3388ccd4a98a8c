"""SimHash fingerprints and their near duplicates by a self-join of a binary trie.

Fingerprints are cut into subtrees by their upper bits. A subtree meets every subtree whose
upper bits differ from its own in no more than the error budget: each fingerprint visits
those with larger numbers, so two subtrees meet in one task. There both tries are walked
together from the roots, a bit at a time: a pair of nodes carries the bits that differed
so far, and a pair beyond the budget is dropped with everything below it. Tries are sorted
arrays, a node is a range of one. Pairs of nodes are walked in blocks, depth first, so
memory is bounded however many pairs there are.

Equal fingerprints are one leaf. A task reports the links it found as a tree per group
(each member to its smallest), never all pairs; `components` joins the trees.

A null text is empty. A text without words has fingerprint zero and is linked like any
other. Rows repeating an id are separate documents with one id; null ids count as larger
than any other. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.llm.components import components
from winback.llm.texts import NOT_SPACE, Flat, flatten, lower_ascii, parts, spans
from winback.session import materialise

BITS = 64
# Upper bits that name a subtree, at least; and the fingerprints of a subtree on average, at
# most: more fingerprints make more subtrees, not larger ones.
PREFIX_BITS = 8
SUBTREE = 1 << 16
# Node pairs walked at once, and leaf pairs under which two nodes are compared outright.
BLOCK = 200_000
LEAF_PAIRS = 16


def _shingle_hashes(flat: Flat, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 (seed 42) of every shingle of `size` words, and how many each text has."""
    starts, ends = spans(flat.data, flat.offsets, NOT_SPACE)
    lengths = ends - starts
    n = len(starts)
    # Words again, lowered, with one space after each.
    line = np.full(int(lengths.sum()) + n, 0x20, np.uint8)
    line[np.arange(len(line) - n) + np.repeat(np.arange(n), lengths)] = lower_ascii(
        flat.data[NOT_SPACE[flat.data]]
    )
    begin = np.cumsum(lengths + 1) - lengths - 1
    stop = begin + lengths
    bounds = np.searchsorted(starts, flat.offsets)
    per_text = np.diff(bounds)
    counts = np.where(per_text >= size, per_text - size + 1, np.minimum(per_text, 1))
    text = np.repeat(np.arange(len(counts)), counts)
    first = bounds[text] + np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    last = np.minimum(first + size, bounds[text + 1]) - 1
    data, digest = line.tobytes(), xxhash.xxh64_intdigest
    hashes = [
        digest(data[a:b], 42) for a, b in zip(begin[first].tolist(), stop[last].tolist())
    ]
    return np.array(hashes, np.uint64), counts


def fingerprints_of(flat: Flat, size: int) -> np.ndarray:
    """A bit is set if over half of a text's shingle hashes have it."""
    hashes, counts = _shingle_hashes(flat, size)
    totals = np.zeros((len(counts), BITS), np.int64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begins = (np.cumsum(counts) - counts)[some]
        totals[some] = np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
    set_bits = 2 * totals > counts[:, None]
    return np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(
    documents: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and the fingerprint of the whole text, as a signed 64-bit number."""
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in parts(batch, "text"):
                found = fingerprints_of(flatten(some.column("text")), shingle)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(found.view(np.int64))],
                    names=["doc_id", "fingerprint"],
                )

    return texts.mapInArrow(compute, "doc_id long, fingerprint long")


class _Walk:
    """Links among the sorted distinct fingerprints of one meeting of subtrees."""

    def __init__(self, leaves: np.ndarray, distance: int):
        self.leaves, self.distance = leaves, distance
        self.label = np.arange(len(leaves))

    def _link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                return
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while True:
                shorter = label[label]
                if (shorter == label).all():
                    break
                label[:] = shorter

    def _compare(self, a0, a1, b0, b1) -> None:
        """All leaf pairs of small node pairs."""
        na, nb = a1 - a0, b1 - b0
        each = na * nb
        pair = np.repeat(np.arange(len(each)), each)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(each) - each, each)
        x, y = a0[pair] + at // nb[pair], b0[pair] + at % nb[pair]
        close = np.bitwise_count(self.leaves[x] ^ self.leaves[y]) <= self.distance
        close &= x != y
        self._link(x[close], y[close])

    def _split(self, low: np.ndarray, high: np.ndarray, depth: int) -> np.ndarray:
        """Where the bit at `depth` turns to one inside each node."""
        bit = np.uint64(1 << (BITS - 1 - depth))
        above = ~np.uint64((1 << (BITS - depth)) - 1)
        middle = np.searchsorted(self.leaves, (self.leaves[low] & above) | bit)
        return np.clip(middle, low, high)

    def run(self, roots: tuple[np.ndarray, ...], depth: int) -> None:
        """Walk pairs of nodes (first and end of one, of the other, differing bits)."""
        work = [(depth, *roots)]
        while work:
            depth, a0, a1, b0, b1, differ = work.pop()
            if len(a0) > BLOCK:
                half = len(a0) // 2
                work.append((depth, *(x[half:] for x in (a0, a1, b0, b1, differ))))
                work.append((depth, *(x[:half] for x in (a0, a1, b0, b1, differ))))
                continue
            few = (a1 - a0) * (b1 - b0) <= LEAF_PAIRS
            if few.any():
                self._compare(a0[few], a1[few], b0[few], b1[few])
                a0, a1, b0, b1, differ = (x[~few] for x in (a0, a1, b0, b1, differ))
            if not len(a0) or depth == BITS:
                continue
            am, bm = self._split(a0, a1, depth), self._split(b0, b1, depth)
            same = (a0 == b0) & (a1 == b1)
            spent = differ < self.distance
            children = []
            for left0, left1, right0, right1, more, allowed in (
                (a0, am, b0, bm, 0, True),
                (am, a1, bm, b1, 0, True),
                (a0, am, bm, b1, 1, spent),
                # A node with itself has this pair already.
                (am, a1, b0, bm, 1, spent & ~same),
            ):
                kept = (left0 < left1) & (right0 < right1) & allowed
                children.append(
                    (left0[kept], left1[kept], right0[kept], right1[kept], differ[kept] + more)
                )
            work.append((depth + 1, *(np.concatenate(x) for x in zip(*children))))


def _meet(table: pa.Table, prefix_bits: int, distance: int) -> pa.Table:
    """Links of one subtree with itself and with its visitors."""
    node = table.column("node")[0].as_py()
    leaves = np.sort(table.column("fingerprint").to_numpy().astype(np.int64).view(np.uint64))
    tops = leaves >> np.uint64(BITS - prefix_bits)
    names, begins = np.unique(tops, return_index=True)
    stops = np.append(begins[1:], len(leaves))
    own = np.searchsorted(names, node)
    walk = _Walk(leaves, distance)
    if own < len(names) and names[own] == node:
        differ = np.bitwise_count(names ^ np.uint64(node)).astype(np.int64)
        walk.run(
            (
                begins,
                stops,
                np.full(len(names), begins[own]),
                np.full(len(names), stops[own]),
                differ,
            ),
            prefix_bits,
        )
    linked = np.flatnonzero(walk.label != np.arange(len(leaves)))
    signed = leaves.view(np.int64)
    return pa.table({"u": signed[linked], "v": signed[walk.label[linked]]})


def links(distinct: DataFrame, distance: int = 3, prefix_bits: int = PREFIX_BITS) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints within `distance` bits."""
    masks = [
        sum(1 << bit for bit in bits)
        for n in range(min(distance, prefix_bits) + 1)
        for bits in combinations(range(prefix_bits), n)
    ]
    top = F.shiftrightunsigned("fingerprint", BITS - prefix_bits)
    visits = distinct.select(
        "fingerprint",
        top.alias("top"),
        F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"),
    ).select("fingerprint", "top", F.col("top").bitwiseXOR(F.col("mask")).alias("node"))

    def meet(table: pa.Table) -> pa.Table:
        return _meet(table, prefix_bits, distance)

    # Two subtrees meet at the larger number.
    return (
        visits.filter("node >= top")
        .select("node", "fingerprint")
        .groupBy("node")
        .applyInArrow(meet, "u long, v long")
    )


def near_duplicates(
    documents: DataFrame,
    shingle: int = 3,
    distance: int = 3,
    prefix_bits: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, fingerprint, and component_id: the smallest id reachable over links.

    `prefix_bits` cuts the trie into subtrees, by default of bounded mean size.
    """
    found = materialise(fingerprints(documents, shingle, id_column, text_column), "fingerprints")
    distinct = materialise(
        found.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct"
    )
    if prefix_bits is None:
        prefix_bits = max(PREFIX_BITS, (distinct.count() // SUBTREE).bit_length())
    of = components(links(distinct, distance, prefix_bits))
    named = of.join(distinct, of.node == distinct.fingerprint).select("node", "root", "first")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    moved = materialise(
        named.join(least, "root").select(F.col("node").alias("fingerprint"), "least"), "classes"
    )
    classes = distinct.join(moved, "fingerprint", "left").select(
        "fingerprint", F.coalesce("least", "first").alias("component_id")
    )
    return found.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")


def hex_digits(fingerprint) -> Column:
    """The 16 lowercase hexadecimal digits of a fingerprint."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")
