"""Distributed positional inverted index over documents, and phrase search in it.

`build` stores the postings of all words of all documents. The index is cut by document:
a segment (one row) holds a few megabytes of text as its sorted terms, their counts, and
their positions as gaps in variable-length bytes, term after term. Every position belongs
to one segment, so segments are searched alone, by as many tasks as there are, and a word
that fills a third of the corpus is never gathered in one place.

`search` takes the windows of a set of items (13 consecutive words, or all words of a
shorter item), block by block of bounded size. Term counts over the whole index order the
terms of each window; in a segment the list of the rarest term, shifted by its offset, is
intersected with the next rarest until the phrase is settled or no position is left. With
`near`, windows also match without their order: every word of the window must occur within
`near` words of an occurrence of its rarest word, in the same document.

Words are runs of ASCII digits and letters (A-Z lowered) and of characters outside ASCII. A
null or empty text has no words and matches nothing; an item without words has no window.
Repeated documents and repeated items count each. Documents keep their row: equal or null
ids stay separate rows. Only the id and text columns are read. Empty tables give no rows,
an empty item table gives documents without hits. Items without an id are left out, or with
`unnamed` searched like any other: their windows mark hit words and all of them together
are one null in `items`, which counts as an item and adds no name to the digest.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.llm.texts import LETTERS_AND_DIGITS, flatten, gather, lower_ascii, parts, words

# Bytes of text of a segment; a worker holds some twenty times as much while it builds one.
SEGMENT_BYTES = 4 << 20
WINDOW = 13
# Words of items searched at once; more items make more passes over the index.
BLOCK_WORDS = 500_000

_SEGMENTS = (
    "part int, segment int, doc_ids array<long>, bounds array<long>, terms array<binary>, "
    "counts array<int>, sizes array<int>, postings binary"
)
_FOUND = (
    "part int, segment int, number int, doc_id long, n_words long, "
    "spans array<struct<first:long,stop:long>>, items array<string>, near_items array<string>"
)


def _pack(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below 2**28 as 7-bit groups, lowest first; and the bytes of each number."""
    size = np.ones(len(gaps), np.uint8)
    for bound in (1 << 7, 1 << 14, 1 << 21):
        size += gaps >= bound
    ends = np.cumsum(size, dtype=np.int32)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    rest, at, live = gaps.copy(), ends - size, np.arange(len(gaps))
    for _ in range(4):
        more = rest >= 128
        out[at] = (rest & 127) | (more << 7)
        live = np.flatnonzero(more)
        if not len(live):
            break
        rest, at = rest[live] >> 7, at[live] + 1
    return out, size


def _unpack(data: np.ndarray) -> np.ndarray:
    last = data < 128
    ends = np.flatnonzero(last)
    begins = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    out = np.zeros(len(ends), np.int64)
    for step in range(4):
        there = begins + step <= ends
        if not there.any():
            break
        out[there] |= (data[begins[there] + step].astype(np.int64) & 127) << (7 * step)
    return out


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
        part = TaskContext.get().partitionId()
        for number, some in enumerate(_joined(batches, segment_bytes)):
            yield _segment(some, part, number)

    texts.mapInArrow(segments, _SEGMENTS).write.parquet(path)


def _segment(some: pa.Table, part: int, number: int) -> pa.RecordBatch:
    """One row: the terms of some texts and their positions.

    Numbers of words take four bytes, and arrays go as soon as they are read for the last
    time: what is held at once is a worker's peak.
    """
    terms, codes, bounds = _numbered(some.column("text"))
    order = np.argsort(codes, kind="stable").astype(np.int32)
    counts = np.bincount(codes, minlength=len(terms))
    begins = np.cumsum(counts) - counts
    del codes
    gaps = np.diff(order, prepend=np.int32(0))
    gaps[begins] = order[begins]
    del order
    data, size = _pack(gaps)
    del gaps
    sizes = np.add.reduceat(size, begins, dtype=np.int32) if len(begins) else size.astype(np.int32)
    row = {
        "part": pa.array([part], pa.int32()),
        "segment": pa.array([number], pa.int32()),
        "doc_ids": pa.array([some.column("doc_id")], pa.list_(pa.int64())),
        "bounds": pa.array([bounds], pa.list_(pa.int64())),
        "terms": _one_list(terms.cast(pa.binary())),
        "counts": pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
        "sizes": pa.array([sizes], pa.list_(pa.int32())),
        "postings": pa.array([data.tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(row)


def _numbered(texts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Sorted distinct words, the number of each word in order, and where each text begins."""
    flat = flatten(texts)
    found = words(flat._replace(data=lower_ascii(flat.data)), LETTERS_AND_DIGITS)
    names = pc.array_sort_indices(found.terms)
    ranks = np.empty(len(names), np.int32)
    ranks[names.to_numpy()] = np.arange(len(names), dtype=np.int32)
    return found.terms.take(names), ranks[found.codes], found.bounds


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
    """Distinct windows of some items, as term numbers and who owns them."""

    terms: list[bytes]
    windows: np.ndarray  # windows x width term numbers, -1 past the end of a short one
    lengths: np.ndarray
    owners: list[list[str | None]]


def windows_of(items: list[tuple[str | None, bytes]], width: int = WINDOW) -> Block:
    terms: dict[bytes, int] = {}
    found: dict[tuple[int, ...], dict[str | None, None]] = {}
    for name, text in items:
        flat = flatten(pa.array([text], pa.binary()))
        got = words(flat._replace(data=lower_ascii(flat.data)), LETTERS_AND_DIGITS)
        numbers = [terms.setdefault(t, len(terms)) for t in got.terms.to_pylist()]
        line = [numbers[c] for c in got.codes.tolist()]
        for at in range(max(1, len(line) - width + 1) if line else 0):
            found.setdefault(tuple(line[at : at + width]), {})[name] = None
    table = np.full((len(found), width), -1, np.int64)
    for i, window in enumerate(found):
        table[i, : len(window)] = window
    lengths = np.array([len(window) for window in found], np.int64)
    return Block(list(terms), table, lengths, [list(owners) for owners in found.values()])


def _in_order(names: Iterable[str | None]) -> list[str | None]:
    return sorted(names, key=lambda name: (name is None, name or ""))


class _Lists:
    """Position lists of a segment for the terms of a block."""

    def __init__(self, segment: dict, wanted: pa.Array):
        self.places = pc.index_in(wanted, segment["terms"])
        rows = self.places.to_numpy(zero_copy_only=False)
        self.present = ~np.isnan(rows.astype(float))
        rows = np.where(self.present, rows, 0).astype(np.int64)
        sizes = segment["sizes"].to_numpy().astype(np.int64)
        self.counts = np.where(self.present, segment["counts"].to_numpy()[rows] if len(sizes) else 0, 0)
        self.begins = (np.cumsum(sizes) - sizes)[rows] if len(sizes) else rows
        self.sizes = sizes[rows] if len(sizes) else rows
        self.data = np.frombuffer(segment["postings"], np.uint8)
        self.known: dict[int, np.ndarray] = {}

    def of(self, term: int) -> np.ndarray:
        if term not in self.known:
            begin = self.begins[term]
            held = self.data[begin : begin + self.sizes[term]]
            self.known[term] = np.cumsum(_unpack(held))
        return self.known[term]


def _within(places: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Which of the places are in the sorted, non-empty list of positions."""
    at = np.minimum(np.searchsorted(positions, places), len(positions) - 1)
    return positions[at] == places


def _phrases(block: Block, by_rarity: np.ndarray, lists: _Lists, bounds: np.ndarray):
    """(window, first word) of every occurrence of a window inside one document."""
    used = block.windows >= 0
    possible = (lists.present[np.where(used, block.windows, 0)] | ~used).all(axis=1)
    anchors: dict[tuple[int, int, int], np.ndarray] = {}
    for w in np.flatnonzero(possible).tolist():
        window, length = block.windows[w], int(block.lengths[w])
        offsets = by_rarity[w, :length]
        first = int(offsets[0])
        if length == 1:
            starts = lists.of(int(window[first]))
        else:
            # Neighbouring windows share their two rarest terms.
            second = int(offsets[1])
            key = (int(window[first]), int(window[second]), second - first)
            if key not in anchors:
                there = lists.of(key[0])
                anchors[key] = there[_within(there + key[2], lists.of(key[1]))]
            starts = anchors[key] - first
            for offset in offsets[2:].tolist():
                if not len(starts):
                    break
                starts = starts[_within(starts + offset, lists.of(int(window[offset])))]
        if len(starts):
            inside = np.searchsorted(bounds, starts, "right") == np.searchsorted(
                bounds, starts + length - 1, "right"
            )
            starts = starts[inside & (starts >= 0)]
            if len(starts):
                yield w, starts


def _near(block: Block, by_rarity: np.ndarray, lists: _Lists, bounds: np.ndarray, near: int):
    """(window, place of its rarest word) where all its words are near that place."""
    used = block.windows >= 0
    possible = (lists.present[np.where(used, block.windows, 0)] | ~used).all(axis=1)
    for w in np.flatnonzero(possible).tolist():
        window, length = block.windows[w], int(block.lengths[w])
        offsets = by_rarity[w, :length]
        places = lists.of(int(window[offsets[0]]))
        for offset in offsets[1:].tolist():
            if not len(places):
                break
            document = np.searchsorted(bounds, places, "right")
            low = np.maximum(places - near, bounds[document - 1])
            high = np.minimum(places + near, bounds[document] - 1)
            other = lists.of(int(window[offset]))
            at = np.searchsorted(other, low)
            places = places[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= high)]
        if len(places):
            yield w, places


def _search_segment(segment: dict, block: Block, by_rarity, wanted, near) -> pa.RecordBatch:
    bounds = segment["bounds"].to_numpy()
    n = len(bounds) - 1
    lists = _Lists(segment, wanted)
    change = np.zeros(int(bounds[-1]) + 1, np.int32)
    items: dict[int, set[str | None]] = {}
    near_items: dict[int, set[str | None]] = {}
    for w, starts in _phrases(block, by_rarity, lists, bounds):
        np.add.at(change, starts, 1)
        np.add.at(change, starts + int(block.lengths[w]), -1)
        for document in np.unique(np.searchsorted(bounds, starts, "right") - 1).tolist():
            items.setdefault(document, set()).update(block.owners[w])
    if near is not None:
        for w, places in _near(block, by_rarity, lists, bounds, near):
            for document in np.unique(np.searchsorted(bounds, places, "right") - 1).tolist():
                near_items.setdefault(document, set()).update(block.owners[w])
    hit = np.concatenate(([False], np.cumsum(change[:-1]) > 0, [False]))
    first = np.flatnonzero(hit[1:] & ~hit[:-1])
    stop = np.flatnonzero(hit[:-1] & ~hit[1:])
    # A run of hit words may cross into the next document: it is cut there.
    inner = bounds[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(hit) - 2)])
    inner = inner[hit[inner] & hit[inner + 1]]
    first, stop = np.sort(np.concatenate((first, inner))), np.sort(np.concatenate((stop, inner)))
    owner = np.searchsorted(bounds, first, "right") - 1
    spans = pa.StructArray.from_arrays(
        [pa.array(first - bounds[owner]), pa.array(stop - bounds[owner])], names=["first", "stop"]
    )
    edges = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.RecordBatch.from_pydict(
        {
            "part": pa.array(np.full(n, segment["part"]), pa.int32()),
            "segment": pa.array(np.full(n, segment["segment"]), pa.int32()),
            "number": pa.array(np.arange(n), pa.int32()),
            "doc_id": segment["doc_ids"],
            "n_words": pa.array(np.diff(bounds)),
            "spans": pa.ListArray.from_arrays(pa.array(edges), spans),
            "items": pa.array([_in_order(items.get(i, ())) for i in range(n)], pa.list_(pa.string())),
            "near_items": pa.array(
                [_in_order(near_items.get(i, ())) for i in range(n)], pa.list_(pa.string())
            ),
        }
    )


def _segments_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            yield {
                k: v.values if isinstance(v, pa.ListScalar) else v.as_buffer() if k == "postings" else v.as_py()
                for k, v in row.items()
            }


def _term_counts(index: DataFrame, terms: list[bytes]) -> dict[int, int]:
    """Occurrences of the terms in the whole index: one number per term of the block."""
    wanted = pa.array(terms, pa.binary())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for segment in _segments_of(batches):
            rows = pc.index_in(segment["terms"], wanted)
            there = rows.is_valid()
            at = rows.filter(there).to_numpy()
            total[at] += segment["counts"].filter(there).to_numpy()
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(seen), "n": pa.array(total[seen])})

    counted = index.select("terms", "counts").mapInArrow(count, "term long, n long")
    return {r.term: r.n for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def _blocks(
    items: DataFrame, item_column: str, text_column: str, block_words: int, unnamed: bool
) -> Iterator[list[tuple[str | None, bytes]]]:
    """Items in blocks of about `block_words` words; each block is what the driver holds."""
    held = items.select(
        F.col(item_column).cast("string").alias("item"), F.col(text_column).cast("string").alias("text")
    ).filter("text is not null")
    if not unnamed:
        held = held.filter("item is not null")
    # A word takes two bytes at least, with what separates it.
    bytes_in_all = held.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-bytes_in_all // (2 * block_words)))
    for number in range(blocks):
        chosen = held.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number)
        yield [(r.item, r.text.encode()) for r in chosen.distinct().collect()]


def search(
    spark: SparkSession,
    path: str,
    items: DataFrame,
    item_column: str = "item_id",
    text_column: str = "text",
    width: int = WINDOW,
    near: int | None = None,
    block_words: int = BLOCK_WORDS,
    unnamed: bool = False,
) -> DataFrame:
    """Every document of the index with its words, the spans of words inside occurrences
    of windows, and the items whose windows occur (and, with `near`, occur without order).
    `unnamed` searches the items without an id as well."""
    index = spark.read.schema(_SEGMENTS).parquet(path)
    passes = []
    for held in _blocks(items, item_column, text_column, block_words, unnamed):
        block = windows_of(held, width)
        totals = _term_counts(index, block.terms) if block.terms else {}
        rarity = np.array([totals.get(i, 0) for i in range(len(block.terms))] + [1 << 62])
        by_rarity = np.argsort(rarity[block.windows], axis=1, kind="stable")
        passes.append(_one_pass(index, block, by_rarity, near))
    if len(passes) == 1:
        return passes[0]
    key = ["part", "segment", "number"]
    every = reduce(DataFrame.unionAll, passes).groupBy(*key).agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        *[
            F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
            for c in ("items", "near_items")
        ],
    )
    return every.withColumn("spans", _merged("spans"))


def _merged(spans: str):
    """Overlapping and touching spans of a sorted array as one."""
    empty = F.array().cast("array<struct<first:bigint,stop:bigint>>")

    def add(done, span):
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (F.get(done, F.size(done) - 1)["stop"] >= span["first"])
        longer = F.struct(
            last["first"].alias("first"), F.greatest(last["stop"], span["stop"]).alias("stop")
        )
        return F.when(
            joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        ).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, empty, add)


def _one_pass(index: DataFrame, block: Block, by_rarity: np.ndarray, near: int | None) -> DataFrame:
    terms = block.terms

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(terms, pa.binary())
        for segment in _segments_of(batches):
            yield _search_segment(segment, block, by_rarity, wanted, near)

    return index.mapInArrow(find, _FOUND)


def contamination(found: DataFrame) -> DataFrame:
    """Digest of `search` per document: words, hit words, items, and the verdict that at
    least a twentieth of the words is hit."""
    hit = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["first"]
    )
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )
