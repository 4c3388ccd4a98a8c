"""Re-Pair: a sequence of ids as grammar rules and a shorter sequence of symbols.

Frequent adjacent pairs are replaced by new symbols until no pair is frequent or a round
gains next to nothing. A round
takes the pairs in order of frequency as long as no symbol ends one chosen pair and
begins another: their occurrences cannot overlap, so replacing them together equals
replacing them one after the other. Every rule keeps the length of its expansion, and
the sequence keeps the number of ids before every 1,024th symbol, so a range of ids is
decoded without touching the rest.

A shard is these bytes, little-endian: `RPG1`; unsigned 32-bit first symbol (ids are
smaller), rules, symbols, bytes per symbol (2 or 4); unsigned 64-bit ids; the rules
(left, right); their 32-bit expansion lengths; the 64-bit anchors; the symbols.
"""

from __future__ import annotations

import struct
from typing import NamedTuple

import numpy as np

from winback.llm.texts import gather

MAGIC = b"RPG1"
HEADER = "<4s4IQ"
ANCHOR = 1024
# A pair is frequent if it occurs this often in its shard.
FREQUENT = 24
# A round takes pairs down to this share of its most frequent pair.
SHARE = 32
# Rounds end once one shortens the sequence by less than this share.
LEAST_GAIN = 0.005
# Candidates looked at in a round.
CANDIDATES = 4096


def _chosen(sequence: np.ndarray, keys: np.ndarray, frequent: int, room: int) -> np.ndarray:
    ordered = np.sort(keys)
    edges = np.flatnonzero(ordered[1:] != ordered[:-1]) + 1
    firsts = np.concatenate(([0], edges))
    counts = np.diff(np.concatenate((firsts, [len(ordered)])))
    least = max(frequent, int(counts.max(initial=0)) // SHARE)
    likely = np.flatnonzero(counts >= least)
    likely = likely[np.lexsort((likely, -counts[likely]))][:CANDIDATES]
    half = 4 * keys.itemsize
    lefts, rights, taken = set(), set(), []
    for pair in ordered[firsts[likely]].tolist():
        left, right = pair >> half, pair & ((1 << half) - 1)
        # A doubled symbol ends and begins itself, so it may be in no other chosen pair.
        if left in rights or right in lefts or (left == right and left in lefts):
            continue
        lefts.add(left)
        rights.add(right)
        taken.append(pair)
        if len(taken) == room:
            break
    return np.array(taken, keys.dtype)


def compress(
    ids: np.ndarray, first_symbol: int, frequent: int = FREQUENT
) -> tuple[np.ndarray, np.ndarray]:
    """Rules (left, right), where rule i is symbol first_symbol + i, and the symbols left."""
    sequence = ids.astype(np.uint32)
    rules: list[np.ndarray] = []
    made = 0
    # Pairs of 16-bit symbols sort many times faster than wider ones.
    narrow = first_symbol < (1 << 16)
    limit, kind, half = ((1 << 16), np.uint32, 16) if narrow else ((1 << 31), np.uint64, 32)
    while len(sequence) > 1 and first_symbol + made < limit:
        keys = (sequence[:-1].astype(kind) << kind(half)) | sequence[1:].astype(kind)
        taken = _chosen(sequence, keys, frequent, limit - first_symbol - made)
        if not len(taken):
            break
        begins = np.zeros(first_symbol + made, bool)
        ends = np.zeros(first_symbol + made, bool)
        left = (taken >> kind(half)).astype(np.int64)
        right = (taken & kind((1 << half) - 1)).astype(np.int64)
        begins[left], ends[right] = True, True
        places = np.flatnonzero(begins[sequence[:-1]] & ends[sequence[1:]])
        by_key = np.argsort(taken)
        ordered = taken[by_key]
        at = np.minimum(np.searchsorted(ordered, keys[places]), len(ordered) - 1)
        same = ordered[at] == keys[places]
        places, at = places[same], at[same]
        # Only a doubled symbol overlaps itself: in a run every other place counts.
        fresh = np.concatenate(([True], np.diff(places) != 1))
        index = np.arange(len(places))
        since = index - np.maximum.accumulate(np.where(fresh, index, 0))
        places, at = places[since % 2 == 0], at[since % 2 == 0]
        sequence[places] = (first_symbol + made + by_key[at]).astype(np.uint32)
        kept = np.ones(len(sequence), bool)
        kept[places + 1] = False
        before, sequence = len(sequence), sequence[kept]
        rules.append(np.stack((left, right), 1))
        made += len(taken)
        if before - len(sequence) < LEAST_GAIN * before:
            break
    found = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    return found.astype(np.uint32), sequence


def expansion_lengths(rules: np.ndarray, first_symbol: int) -> np.ndarray:
    lengths = [1] * len(rules)
    for i, (left, right) in enumerate(rules.tolist()):
        lengths[i] = sum(
            lengths[side - first_symbol] if side >= first_symbol else 1 for side in (left, right)
        )
    return np.array(lengths, np.uint32)


class Shard(NamedTuple):
    first_symbol: int
    n_ids: int
    rules: np.ndarray
    lengths: np.ndarray
    anchors: np.ndarray
    symbols: np.ndarray


def pack(ids: np.ndarray, first_symbol: int, frequent: int = FREQUENT) -> bytes:
    rules, symbols = compress(ids, first_symbol, frequent)
    lengths = expansion_lengths(rules, first_symbol)
    width = 2 if first_symbol + len(rules) <= 1 << 16 else 4
    kind = f"<u{width}"
    each = _lengths_of(symbols.astype(np.int64), lengths, first_symbol)
    upto = np.cumsum(each) - each
    return b"".join(
        (
            struct.pack(HEADER, MAGIC, first_symbol, len(rules), len(symbols), width, len(ids)),
            rules.astype(kind).tobytes(),
            lengths.astype("<u4").tobytes(),
            upto[::ANCHOR].astype("<u8").tobytes(),
            symbols.astype(kind).tobytes(),
        )
    )


def unpack(data: bytes) -> Shard:
    magic, first_symbol, n_rules, n_symbols, width, n_ids = struct.unpack_from(HEADER, data)
    if magic != MAGIC:
        raise ValueError("not a shard of token ids")
    at, out = struct.calcsize(HEADER), []
    for kind, count in (
        (f"<u{width}", 2 * n_rules),
        ("<u4", n_rules),
        ("<u8", -(-n_symbols // ANCHOR)),
        (f"<u{width}", n_symbols),
    ):
        out.append(np.frombuffer(data, kind, count, at).astype(np.int64))
        at += out[-1].size * np.dtype(kind).itemsize
    if at != len(data):
        raise ValueError("a shard of token ids is cut short or too long")
    return Shard(first_symbol, n_ids, out[0].reshape(-1, 2), *out[1:])


def _lengths_of(symbols: np.ndarray, lengths: np.ndarray, first_symbol: int) -> np.ndarray:
    each = np.ones(len(symbols), np.int64)
    made = symbols >= first_symbol
    each[made] = lengths[symbols[made] - first_symbol]
    return each


class Decoder:
    """Expansions of all rules of a shard, ready to decode any range of its ids."""

    def __init__(self, shard: Shard):
        self.shard = shard
        known: list[list[int]] = []
        base = shard.first_symbol
        for left, right in shard.rules.tolist():
            known.append(
                (known[left - base] if left >= base else [left])
                + (known[right - base] if right >= base else [right])
            )
        sizes = shard.lengths
        self.table = np.concatenate(
            (np.arange(base), np.fromiter((i for k in known for i in k), np.int64, int(sizes.sum())))
        ).astype(np.uint32)
        self.begins = np.concatenate((np.arange(base), base + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((np.ones(base, np.int64), sizes))

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids start..stop, from the symbols that cover them."""
        shard = self.shard
        stop = shard.n_ids if stop is None else min(stop, shard.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first = int(np.searchsorted(shard.anchors, start, "right")) - 1
        last = int(np.searchsorted(shard.anchors, stop, "left"))
        symbols = shard.symbols[first * ANCHOR : last * ANCHOR]
        found = gather(self.table, self.begins[symbols], self.sizes[symbols])
        skip = start - int(shard.anchors[first])
        return found[skip : skip + stop - start]
