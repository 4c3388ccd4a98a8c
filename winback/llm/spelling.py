"""Spelling variants: words one edit apart, found by pivotal grams.

`word_counts` counts the words of all documents: maximal runs of ASCII letters and U+00C0 to
U+00FF, A-Z lowered, of `least_length` characters and `least_count` occurrences at least.
With `damage`, a run is changed first where a checksum of document and run says so.

`near_words` finds the pairs of words that differ by exactly one inserted, deleted or replaced
character. The overlapping bigrams of a word are ordered from the rarest (over all words), the
three rarest are its prefix, and dynamic programming picks the two of them that do not overlap
and are rarest in all: its pivots. One edit touches one of two disjoint grams at most, so a
pivot of the word whose prefix ends rarer stands in the other word as well, and within its
prefix. Position limits: left or right of that pivot nothing changed, so there the words are
alike and the pivot is equally far from that end, while lengths differ by one at most; and of
the other side, the first or the last half is unchanged. Pivots are therefore joined with
prefix grams on gram, distance from the unchanged end, what stands there, the unchanged half
and length, which leaves few candidates however many words share a gram, and every candidate
is verified by its edit distance. Pairs are found in the join; no group is gathered.

`variants` names the form of each word, its near word with the most occurrences if they are
`ratio` times its own, and the root, where following forms ends. Forms grow on every step, so
pointer jumping ends after a few joins.

Null and empty texts have no words; a null id is an empty one. Repeated rows and equal ids
count each, for checksums too. Empty tables give no rows. Texts of any length and runs of any
length are taken whole, and only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.llm.texts import Flat, byte_set, flatten, lower_ascii, parts, words
from winback.session import materialise

PREFIX = 3
PIVOTS = 2
GRAM = 2

_LETTER = byte_set((0x61, 0x7A))
# In UTF-8, U+00C0 to U+00FF are this byte and any that continues it.
_LEAD = 0xC3
_ANY = byte_set((0x01, 0xFF))
# Longer runs are checksummed one by one.
_LONG = 48


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1)
    return table


_CRC = _crc_table()


def _checksums(starts: np.ndarray, codes: np.ndarray, terms: Flat) -> np.ndarray:
    """crc32 of some bytes, whose crc32 is given, followed by a term."""
    lengths = np.diff(terms.offsets)[codes]
    order = np.argsort(-lengths, kind="stable")
    state = starts[order] ^ np.uint32(0xFFFFFFFF)
    begin, sizes = terms.offsets[:-1][codes][order], lengths[order]
    long = int(np.searchsorted(-sizes, -_LONG, "left"))
    live = len(order)
    for at in range(int(sizes[long]) if long < len(sizes) else 0):
        # Longest first, so those that still have a byte stand in front.
        live = long + int(np.searchsorted(-sizes[long:live], -at, "left"))
        some = state[long:live]
        byte = terms.data[begin[long:live] + at]
        state[long:live] = _CRC[(some ^ byte) & np.uint32(0xFF)] ^ (some >> np.uint32(8))
    out = np.empty(len(order), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in order[:long].tolist():
        out[i] = zlib.crc32(terms.text(codes[i]), int(starts[i]))
    return out


def _counted(ids: pa.Array, flat: Flat, damage: int | None) -> tuple[pa.Array, np.ndarray]:
    """Words of some documents and how often each occurs; a word may come twice."""
    data = lower_ascii(flat.data)
    lead = data == _LEAD
    kept = _LETTER[data] | lead
    kept[1:] |= lead[:-1]
    found = words(Flat(np.where(kept, data, 0).astype(np.uint8), flat.offsets), _ANY)
    n = len(found.terms)
    if damage is None or n == 0:
        return found.terms, np.bincount(found.codes, minlength=n)
    owner = np.repeat(np.arange(len(flat.offsets) - 1), np.diff(found.bounds))
    pairs, times = np.unique(owner * n + found.codes, return_counts=True)
    owner, codes = pairs // n, pairs % n
    heads = [zlib.crc32(b"%s:" % (b"" if i is None else b"%d" % i)) for i in ids.to_pylist()]
    terms = flatten(found.terms)
    sums = _checksums(np.array(heads, np.uint32)[owner], codes, terms)
    hit = sums % np.uint32(damage) == 0
    whole = np.bincount(codes[~hit], weights=times[~hit], minlength=n).astype(np.int64)
    changed: dict[bytes, int] = {}
    for i in np.flatnonzero(hit).tolist():
        run = terms.text(codes[i]).decode()
        at = int(sums[i]) % len(run)
        word = (run[:at] + run[at + 1 :]).encode()
        changed[word] = changed.get(word, 0) + int(times[i])
    every = pa.concat_arrays([found.terms, pa.array(list(changed), pa.large_binary()).cast(found.terms.type)])
    return every, np.concatenate((whole, np.fromiter(changed.values(), np.int64, len(changed))))


def word_counts(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    damage: int | None = None,
    least_length: int = 5,
    least_count: int = 3,
) -> DataFrame:
    """word and n, stored. `damage`: with h the crc32 of `<id>:<run>`, a run whose h it
    divides loses its character h % length."""
    texts = documents.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in parts(batch, "text"):
                terms, n = _counted(some.column("id"), flatten(some.column("text")), damage)
                flat = flatten(terms)
                upto = np.concatenate(([0], np.cumsum((flat.data & 0xC0) != 0x80)))
                length = upto[flat.offsets[1:]] - upto[flat.offsets[:-1]]
                good = pa.array((length >= least_length) & (n > 0))
                yield pa.RecordBatch.from_arrays(
                    [terms.filter(good).cast(pa.binary()).cast(pa.string()), pa.array(n).filter(good)],
                    names=["word", "n"],
                )

    each = texts.mapInArrow(count, "word string, n long")
    counted = each.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)
    return materialise(counted, "words")


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length, and their characters as a matrix of bytes (U+0000 to U+00FF)."""
    flat = flatten(column)
    lead = flat.data == _LEAD
    # The byte after a lead is the character less 0x40.
    follows = np.concatenate(([False], lead[:-1]))
    characters = np.where(follows, flat.data | 0x40, flat.data)[~lead]
    upto = np.concatenate(([0], np.cumsum(~lead)))
    begins, lengths = upto[flat.offsets[:-1]], np.diff(upto[flat.offsets])
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        yield rows, characters[begins[rows][:, None] + np.arange(length)].astype(np.uint8)


def _grams(characters: np.ndarray) -> np.ndarray:
    return characters[:, :-1].astype(np.int64) << 8 | characters[:, 1:]


def gram_ranks(counted: DataFrame) -> np.ndarray:
    """For each of the 65,536 bigrams its place in the order from rare to frequent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for _, characters in _by_length(batch.column(0)):
                total += np.bincount(_grams(characters).ravel(), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"gram": pa.array(seen), "n": pa.array(total[seen])})

    found = counted.select("word").mapInArrow(count, "gram long, n long")
    times = np.zeros(1 << 16, np.int64)
    # A row for each pair of 90 letters at most.
    for row in found.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        times[row.gram] = row.n
    ranks = np.empty(1 << 16, np.int64)
    ranks[np.argsort(times, kind="stable")] = np.arange(1 << 16)
    return ranks


def _choose(places: np.ndarray, costs: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Of each row's places, in rising order, `pivots` that are GRAM apart with the least sum
    of costs: best[i] is the least sum of j grams that end with the i-th, for rising j."""
    k, width = places.shape
    best = costs.astype(np.float64)
    came = np.zeros((pivots, k, width), np.int64)
    for j in range(1, pivots):
        longer = np.full((k, width), np.inf)
        for i in range(j, width):
            for before in range(j - 1, i):
                value = best[:, before] + costs[:, i]
                better = (places[:, i] - places[:, before] >= GRAM) & (value < longer[:, i])
                longer[better, i] = value[better]
                came[j, better, i] = before
        best = longer
    row = np.arange(k)
    at = best.argmin(axis=1)
    out = np.empty((k, pivots), np.int64)
    for j in range(pivots - 1, -1, -1):
        out[:, j] = places[row, at]
        at = came[j, row, at]
    return out


class _Hashes:
    """Hashes of any stretch of each row's characters, equal for equal stretches."""

    def __init__(self, characters: np.ndarray):
        k, length = characters.shape
        self.upto = np.zeros((k, length + 1), np.uint64)
        self.power = np.ones(length + 1, np.uint64)
        base = np.uint64(0x9E3779B97F4A7C15)
        with np.errstate(over="ignore"):
            for i in range(length):
                self.upto[:, i + 1] = (self.upto[:, i] + characters[:, i] + np.uint64(1)) * base
                self.power[i + 1] = self.power[i] * base

    def of(self, row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return self.upto[row, stop] - self.upto[row, start] * self.power[stop - start]


def _mixed(*values: np.ndarray | int) -> np.ndarray:
    """One key of several numbers."""
    out = np.uint64(0)
    with np.errstate(over="ignore"):
        for value in values:
            out = (out ^ np.asarray(value).astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            out = out ^ (out >> np.uint64(32))
    return out.view(np.int64)


def _keys(grams: np.ndarray, hashes: _Hashes, row: np.ndarray, place: np.ndarray, other: int):
    """Keys of grams at places of rows, as a near word of length `other` has them, and which
    of `row` each belongs to. For either side of the gram that can be unchanged, the near word
    has the same there; of its other side, with one edit, the first or the last half is the
    same. A half's size is the near word's, so that its own keys (`other` its length) agree."""
    length = grams.shape[1] + 1
    gram = grams[row, place]
    for side, unchanged in enumerate(((0 * place, place), (place + GRAM, 0 * place + length))):
        context = hashes.of(row, *unchanged)
        distance = unchanged[1] - unchanged[0]
        first, stop = (place + GRAM, 0 * place + length) if side == 0 else (0 * place, place)
        changed = other - GRAM - distance
        for half in range(2):
            size = changed // 2 if half == 0 else changed - changed // 2
            begin, end = (first, first + size) if half == 0 else (stop - size, stop)
            fits = np.flatnonzero((changed >= 0) & (begin >= first) & (end <= stop))
            part = hashes.of(row[fits], begin[fits], end[fits])
            yield fits, _mixed(gram[fits], 2 * side + half, distance[fits], other, context[fits], part)


_ENTRIES = "pivot boolean, key long, last int, word string, n long"


def _entries(ranks: np.ndarray):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, characters in _by_length(batch.column("word")):
                yield from _of_length(batch.take(pa.array(rows)), characters)

    def _of_length(words_of: pa.RecordBatch, characters: np.ndarray) -> Iterator[pa.RecordBatch]:
        k, length = characters.shape
        grams = _grams(characters)
        cost = ranks[grams]
        by_cost = np.argsort(cost, axis=1, kind="stable")
        row = np.arange(k)
        last = cost[row, by_cost[:, min(PREFIX, length - 1) - 1]]
        prefix = np.sort(by_cost[:, :PREFIX], axis=1)
        pivots = _choose(prefix, np.take_along_axis(cost, prefix, axis=1))
        hashes = _Hashes(characters)

        def batches_of(pivot: bool, of: np.ndarray, place: np.ndarray, other: int):
            for fits, key in _keys(grams, hashes, of, place, other):
                taken = words_of.take(pa.array(of[fits]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(key), pivot)),
                        pa.array(key),
                        pa.array(last[of[fits]], pa.int32()),
                        taken.column("word"),
                        taken.column("n"),
                    ],
                    names=["pivot", "key", "last", "word", "n"],
                )

        # All places of a gram that ends the prefix belong to it.
        of, place = np.nonzero(cost <= last[:, None])
        yield from batches_of(False, of, place, length)
        of, place = np.repeat(row, PIVOTS), pivots.ravel()
        for other in (length - 1, length, length + 1):
            yield from batches_of(True, of, place, other)

    return entries


def near_words(counted: DataFrame) -> DataFrame:
    """Each pair of near words, in both directions: word, n, near, near_n; stored."""
    entries = counted.select("word", "n").mapInArrow(_entries(gram_ranks(counted)), _ENTRIES)
    entries = materialise(entries, "grams")
    pivots = entries.filter("pivot").drop("pivot")
    index = entries.filter("not pivot").select(
        "key", F.col("last").alias("other_last"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )
    found = pivots.join(index, "key").filter(
        (F.col("last") <= F.col("other_last")) & (F.levenshtein("word", "near", 1) == 1)
    )
    least = F.least("word", "near")
    ends = [
        least.alias("a"),
        F.when(least == F.col("word"), F.col("n")).otherwise(F.col("near_n")).alias("a_n"),
        F.greatest("word", "near").alias("b"),
        F.when(least == F.col("word"), F.col("near_n")).otherwise(F.col("n")).alias("b_n"),
    ]
    pairs = materialise(found.select(*ends).distinct(), "near-words")
    forth = pairs.select(
        F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")
    )
    back = pairs.select(
        F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")
    )
    return forth.unionAll(back)


def roots(forms: DataFrame) -> DataFrame:
    """word and root, where following the forms of (word, form) ends; a word without a form
    has no row. Each step doubles how far a word looks."""
    reached = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = reached.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        )
        stepped = materialise(stepped, "roots")
        reached = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            return reached


def variants(counted: DataFrame, ratio: int = 2) -> DataFrame:
    """All words: word, form, root, n, n_near and form_n."""
    near = near_words(counted)
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    of = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    every = counted.join(of, "word", "left")
    enough = -F.col("best.minus") >= ratio * F.col("n")
    every = every.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.minus")).alias("form_n"),
    )
    every = materialise(every, "forms")
    ends = roots(every.filter("form is not null"))
    return every.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
