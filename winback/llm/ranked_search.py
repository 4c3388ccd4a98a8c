"""Ranked lexical search: range-maximum tables over posting lists, intervals best first.

`build` stores the postings of all documents. The index is cut by document: a segment (one
row) holds a few megabytes of text, its documents in the order of their ids, as sorted terms,
in how many documents each stands, and for every such document its place and the term's
occurrences. Postings stay with their documents, so a word that half the corpus holds is
never gathered.

`search` ranks the documents for each item by integer scores (`weight`, `lengthened` and
`impact` below) and returns the k best, ties by ascending id. A term's impact depends on the
document alone, so a segment has one list of impacts per term and over it a sparse table: for
every place and power of two, where the largest impact of that many postings stands. The
largest impact in any range is then one comparison. An item is searched in intervals of
documents: the sum over its terms of the largest impact inside bounds every score in the
interval. The intervals of highest bound (a batch of `BATCH` at a time) are split at the
document where one of their terms has its largest impact; that document is scored exactly and
the parts left and right of it are bounded anew. An interval whose bound does not reach the
k-th best document so far is dropped, and where it only ties, is kept if its ids are smaller.

Segments are searched in two waves. The first takes one of `WAVE`; what the k-th best document
in it scores is where the second wave starts to drop intervals, which leaves few of them.
Items are searched in blocks of bounded size, each a pass over the stored index.

Terms are runs of ASCII digits and letters (A-Z lowered) and of characters outside ASCII. Null
and empty texts have none; they rank for nothing and nothing ranks for them. Documents keep
their row: equal ids are separate, null ids rank behind all others in ties. Equal rows of
items are searched once; rows of one id with different texts are items of their own. Empty
tables give no rows, and only the id and text columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winback.llm.texts import LETTERS_AND_DIGITS, flatten, lower_ascii, parts, words
from winback.session import materialise

SEGMENT_BYTES = 8 << 20
# Segments of a file. Parquet's writer looks at its size every hundred rows and its reader opens
# all rows of a row group at once, so the segments of a file are what either holds in memory.
FILE_SEGMENTS = 1
BATCH = 64
WAVE = 16
# Bytes of items searched at once.
BLOCK_BYTES = 1 << 20

_SEGMENTS = (
    "part int, segment int, held long, total long, doc_ids array<long>, lengths array<int>, "
    "terms array<binary>, counts array<int>, docs binary, times binary"
)
_FOUND = "number int, doc_id long, score long"
_NO_ID = np.iinfo(np.int64).max


def weight(held: int, df: int) -> int:
    """Of a term that `df` of `held` documents hold."""
    return math.floor(1000 * math.log((2 * held + 2) / (2 * df + 1)))


def lengthened(lengths: np.ndarray, held: int, total: int) -> np.ndarray:
    """What a document's length adds to the divisor, per thousand of the mean length."""
    return 10 + (90 * lengths.astype(np.int64) * held) // max(total, 1)


def impact(times: np.ndarray, lengthened_by: np.ndarray) -> np.ndarray:
    times = times.astype(np.int64)
    return (1_000_000_000 * times) // (1000 * times + 8 * lengthened_by)


def build(
    documents: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    segment_bytes: int = SEGMENT_BYTES,
) -> None:
    """Write the segments of all documents under `path`."""
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for some in _joined(batches, segment_bytes):
            order = pc.sort_indices(some, sort_keys=[("doc_id", "ascending")], null_placement="at_end")
            some = some.take(order)
            flat = flatten(some.column("text"))
            found = words(flat._replace(data=lower_ascii(flat.data)), LETTERS_AND_DIGITS)
            names = pc.array_sort_indices(found.terms).to_numpy()
            ranks = np.empty(len(names), np.int64)
            ranks[names] = np.arange(len(names))
            n = some.num_rows
            owner = np.repeat(np.arange(n), np.diff(found.bounds))
            postings, times = np.unique(ranks[found.codes] * n + owner, return_counts=True)
            counts = np.bincount(postings // n, minlength=len(names))
            lengths = np.diff(found.bounds)
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "segment": pa.array([number], pa.int32()),
                    "held": pa.array([int((lengths > 0).sum())], pa.int64()),
                    "total": pa.array([int(lengths.sum())], pa.int64()),
                    "doc_ids": _one_list(some.column("doc_id").combine_chunks()),
                    "lengths": pa.array([lengths.astype(np.int32)], pa.list_(pa.int32())),
                    "terms": _one_list(found.terms.take(pa.array(names)).cast(pa.binary())),
                    "counts": pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                    "docs": pa.array([(postings % n).astype("<i4").tobytes()], pa.binary()),
                    "times": pa.array([times.astype("<i4").tobytes()], pa.binary()),
                }
            )
            number += 1

    stored = texts.mapInArrow(segments, _SEGMENTS).write
    stored.option("maxRecordsPerFile", FILE_SEGMENTS).parquet(path)


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _joined(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Rows regrouped to about `limit` bytes of text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for some in parts(batch, "text", limit):
            more = pc.sum(pc.binary_length(some.column("text"))).as_py() or 0
            if held and size + more > limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(some)
            size += more
    if held:
        yield pa.Table.from_batches(held)


class Block(NamedTuple):
    """Items to search: their numbers and ids, and the places of their terms in `terms`."""

    ids: list
    terms: list[bytes]
    of: list[np.ndarray]


class Corpus(NamedTuple):
    held: int  # documents with a term
    total: int  # terms of all documents
    weights: np.ndarray  # of each term of the block


class _Segment:
    """Impacts of a block's terms in one segment, list after list, and their maxima."""

    def __init__(self, row: dict, block: Block, corpus: Corpus):
        ids = row["doc_ids"]
        self.doc_ids = pc.fill_null(ids, _NO_ID).to_numpy(zero_copy_only=False)
        self.n = len(self.doc_ids)
        by = lengthened(row["lengths"].to_numpy(), corpus.held, corpus.total)
        counts = row["counts"].to_numpy().astype(np.int64)
        places = pc.index_in(pa.array(block.terms, pa.binary()), row["terms"])
        present = places.is_valid().to_numpy(zero_copy_only=False)
        at = pc.fill_null(places, 0).to_numpy(zero_copy_only=False)
        begins = (np.cumsum(counts) - counts)[at] if len(counts) else at
        sizes = np.where(present, counts[at] if len(counts) else 0, 0)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        chosen = np.repeat(begins - self.starts, sizes) + np.arange(int(sizes.sum()))
        self.docs = np.frombuffer(row["docs"], "<i4")[chosen].astype(np.int64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        times = np.frombuffer(row["times"], "<i4")[chosen]
        self.impacts = impact(times, by[self.docs]) * corpus.weights[owner]
        # In rising order, so that one search finds a document in any list.
        self.keys = owner * self.n + self.docs
        self._index(int(sizes.max(initial=0)))

    def _index(self, longest: int) -> None:
        """best[k, i]: where the largest of the 2**k impacts from i on stands."""
        size = len(self.docs)
        levels = [np.arange(size, dtype=np.int32)]
        while 2 << (len(levels) - 1) <= longest:
            last, step = levels[-1], 1 << (len(levels) - 1)
            left, right = last[:-step], last[step:]
            better = np.where(self.impacts[left] >= self.impacts[right], left, right)
            # Entries near the end would leave their list and are never read.
            levels.append(np.concatenate((better, last[size - step :])))
        self.best = np.concatenate(levels)
        self.level = np.zeros(longest + 2, np.int64)
        for power in range(1, len(levels)):
            self.level[1 << power :] = power

    def maxima(self, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest impact of each range of postings (0 of an empty one) and its place."""
        size = highs - lows
        level = self.level[size]
        some = size > 0
        base = level * len(self.docs)
        left = self.best[np.where(some, base + lows, 0)]
        right = self.best[np.where(some, base + highs - (1 << level), 0)]
        a, b = self.impacts[left], self.impacts[right]
        return np.where(some, np.maximum(a, b), 0), np.where(a >= b, left, right)

    def search(self, terms: np.ndarray, k: int, floor: tuple[int, int], batch: int = BATCH):
        """(score, document) of the best documents of an item, those beyond `floor` at least:
        only what scores higher, or as high with an id as small, is looked for."""
        terms = terms[self.ends[terms] > self.starts[terms]]
        nothing = np.zeros(0, np.int64)
        scores, found, evaluated = nothing, nothing, 0
        if not len(terms):
            return scores, found, evaluated
        lows, highs = self.starts[terms][None], self.ends[terms][None]
        values, tops = self.maxima(lows, highs)
        bounds, firsts = values.sum(axis=1), np.zeros(1, np.int64)
        while True:
            score, last = floor
            if len(scores) == k:
                score, last = max(floor, (scores[-1], self.doc_ids[found[-1]]), key=lambda f: (f[0], -f[1]))
            open_ = (bounds > score) | ((bounds == score) & (self.doc_ids[np.minimum(firsts, self.n - 1)] <= last))
            open_ &= bounds > 0
            if not open_.any():
                return scores, found, evaluated
            order = np.flatnonzero(open_)
            if len(order) > batch:
                order = order[np.argpartition(-bounds[order], batch - 1)]
            taken, rest = order[:batch], order[batch:]
            row = np.arange(len(taken))
            split = self.docs[tops[taken, values[taken].argmax(axis=1)]]
            low, high = lows[taken], highs[taken]
            probe = np.searchsorted(self.keys, terms * self.n + split[:, None])
            inside = np.minimum(probe, len(self.keys) - 1)
            there = (probe < high) & (self.docs[inside] == split[:, None])
            exact = np.where(there, self.impacts[inside], 0).sum(axis=1)
            evaluated += len(row)
            scores, found = _best(
                np.concatenate((scores, exact)), np.concatenate((found, split)), self.doc_ids, k
            )
            new_lows = np.concatenate((low, probe + there))
            new_highs = np.concatenate((probe, high))
            new_values, new_tops = self.maxima(new_lows, new_highs)
            lows = np.concatenate((lows[rest], new_lows))
            highs = np.concatenate((highs[rest], new_highs))
            values = np.concatenate((values[rest], new_values))
            tops = np.concatenate((tops[rest], new_tops))
            bounds = np.concatenate((bounds[rest], new_values.sum(axis=1)))
            firsts = np.concatenate((firsts[rest], firsts[taken], split + 1))


def _best(scores: np.ndarray, docs: np.ndarray, ids: np.ndarray, k: int):
    order = np.lexsort((docs, ids[docs], -scores))[:k]
    return scores[order], docs[order]


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            yield {
                k: v.values if isinstance(v, pa.ListScalar) else v.as_buffer() if isinstance(v, pa.BinaryScalar) else v.as_py()
                for k, v in row.items()
            }


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[Block]:
    """Items with a term, in blocks that the driver holds."""
    held = items.filter("text is not null").distinct()
    size = held.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for number in range(blocks):
        chosen = held.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == number)
        ids, of = [], []
        terms: dict[bytes, int] = {}
        for row in chosen.collect():
            flat = flatten(pa.array([row.text.encode()], pa.binary()))
            got = words(flat._replace(data=lower_ascii(flat.data)), LETTERS_AND_DIGITS).terms.to_pylist()
            if got:
                ids.append(row.item_id)
                of.append(np.array([terms.setdefault(t, len(terms)) for t in got], np.int64))
        if ids:
            yield Block(ids, list(terms), of)


def _corpus(index: DataFrame, block: Block) -> Corpus:
    sums = index.agg(F.sum("held"), F.sum("total")).first()
    wanted = pa.array(block.terms, pa.binary())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for segment in _rows_of(batches):
            places = pc.index_in(wanted, segment["terms"])
            there = places.is_valid()
            at = np.flatnonzero(there.to_numpy(zero_copy_only=False))
            total[at] += segment["counts"].to_numpy()[places.filter(there).to_numpy()]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(seen), "df": pa.array(total[seen])})

    counted = index.select("terms", "counts").mapInArrow(count, "term long, df long")
    held, total = int(sums[0] or 0), int(sums[1] or 0)
    weights = np.zeros(len(block.terms), np.int64)
    for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
        weights[row.term] = weight(held, row.df)
    return Corpus(held, total, weights)


def _wave(index: DataFrame, block: Block, corpus: Corpus, k: int, floors: dict[int, tuple[int, int]]):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            segment = _Segment(row, block, corpus)
            numbers, ids, scores = [], [], []
            for number, terms in enumerate(block.of):
                terms = terms[corpus.weights[terms] > 0]
                score, found, _ = segment.search(terms, k, floors.get(number, (1, _NO_ID)))
                numbers.append(np.full(len(found), number, np.int32))
                ids.append(found)
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(numbers), pa.int32()),
                    row["doc_ids"].take(pa.array(np.concatenate(ids))),
                    pa.array(np.concatenate(scores), pa.int64()),
                ],
                names=["number", "doc_id", "score"],
            )

    columns = ["doc_ids", "lengths", "terms", "counts", "docs", "times"]
    return index.select(*columns).mapInArrow(find, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    spark: SparkSession,
    path: str,
    items: DataFrame,
    k: int = 10,
    item_column: str = "item_id",
    text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
    wave: int = WAVE,
) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each item."""
    index = spark.read.schema(_SEGMENTS).parquet(path)
    items = items.select(F.col(item_column).alias("item_id"), F.col(text_column).cast("string").alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()
    early = F.pmod(F.xxhash64("part", "segment"), F.lit(wave)) == 0
    results = []
    for block in _blocks(items, block_bytes):
        corpus = _corpus(index, block)
        first = materialise(_ranked(_wave(index.filter(early), block, corpus, k, {}), k), "first-wave")
        floors = {
            r.number: (r.score, _NO_ID if r.doc_id is None else r.doc_id)
            for r in first.filter(F.col("rank") == k).collect()
        }
        second = _wave(index.filter(~early), block, corpus, k, floors)
        names = spark.createDataFrame(list(enumerate(block.ids)), f"number int, item_id {kind}")
        best = _ranked(first.drop("rank").unionAll(second), k)
        results.append(best.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, results)
