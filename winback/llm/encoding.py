"""Token ids of whole texts by a public tokenizer, computed once per distinct piece.

The library splits a text into pieces and merges inside them. Texts repeat their pieces
far more often than not, so a batch is cut where no token can cross, distinct pieces go
through the library once, and their ids are copied to every place. The result is the
library's encoding of the whole text; `cuts=None` sends whole texts instead.
"""

from __future__ import annotations

import functools
import os
from itertools import compress

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from winback.llm.texts import Flat, binary_array, byte_set, flatten, gather, hash_bytes

# Distinct pieces remembered between batches of one worker.
REMEMBERED = 2_000_000

_VISIBLE = byte_set((0x21, 0x7E))
# A byte that surely starts something other than white space: visible ASCII, or the lead
# byte of U+00C0 to U+00FF.
_SURE = byte_set((0x21, 0x7E), (0xC3, 0xC3))
_LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A))
# The second byte of a letter from U+00C0 to U+00FF: all but the signs of times and division.
_LETTER_END = byte_set((0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF))
# Marks that end a run of letters and begin no contraction. The vertical bar is left out, as
# it closes the end token's name.
_MARK = byte_set(*((ord(c), ord(c)) for c in '!"%)*,.:;?]}'))


def byte_level_cuts(flat: Flat) -> np.ndarray:
    """Cuts for byte-level encodings that glue one space to the following word.

    Before the last space of a white space run, around a line feed that stands alone
    between visible characters, and between a letter and the mark after it: words then
    repeat more often, as each mark would otherwise make another piece of its word.
    """
    data = flat.data
    before, after = data[:-1], data[1:]
    cut = np.zeros(len(data) + 1, bool)
    # A space at i, something visible at i + 1: cut before the space.
    cut[:-2] |= (before == 0x20) & _SURE[after]
    feed = (data[1:-1] == 0x0A) & _VISIBLE[data[:-2]] & _SURE[data[2:]]
    cut[1:-2] |= feed
    cut[2:-1] |= feed
    letter = _LETTER[before]
    letter[1:] |= (data[:-2] == 0xC3) & _LETTER_END[data[1:-1]]
    cut[1:-1] |= letter & _MARK[after]
    return cut


def white_space_cuts(flat: Flat) -> np.ndarray:
    """Cuts for encodings that drop white space: before every space and line feed."""
    cut = np.zeros(len(flat.data) + 1, bool)
    cut[:-1] = (flat.data == 0x20) | (flat.data == 0x0A)
    return cut


def _joinable(pieces: Flat, mark: bytes) -> np.ndarray:
    """Pieces of visible ASCII and U+00C0 to U+00FF after at most one space, without the
    separator's `mark`: nothing in them can merge with a separator. Others go through the
    library one by one."""
    data, starts = pieces.data, pieces.offsets[:-1]
    pair = np.zeros(len(data) + 1, bool)
    pair[1:-1] = (data[:-1] == 0xC3) & ((data[1:] & 0xC0) == 0x80)
    # Two pieces share no character.
    pair[pieces.offsets] = False
    fine = (_VISIBLE[data] & (data != mark[0])) | pair[:-1] | pair[1:]
    spaced = starts[(data[starts] == 0x20) & (np.diff(pieces.offsets) > 1)]
    fine[spaced] = True
    return np.logical_and.reduceat(fine, starts)


# How to cut, and a separator for joined pieces that always encodes to one id of its own
# and to nothing else where no piece holds its visible character.
CUTS = {"byte_level": (byte_level_cuts, "\n"), "white_space": (white_space_cuts, " | ")}
# Pieces joined into one call of the library, which costs less than a call for each.
JOINED = 4_000


class _Known:
    """Pieces with the place of their ids: a hash table of arrays, some 50 bytes a piece."""

    def __init__(self, capacity: int):
        self.mask = (1 << max(4, (2 * capacity).bit_length())) - 1
        self.slots = np.full(self.mask + 1, -1, np.int32)
        self.size = 0
        self.hashes = np.zeros(capacity, np.uint64)
        self.starts = np.zeros(capacity, np.int32)
        self.counts = np.zeros(capacity, np.int32)
        self.ends = np.zeros(capacity + 1, np.int64)
        self.data = np.zeros(0, np.uint8)

    def find(self, hashes: np.ndarray, keys: Flat) -> np.ndarray:
        """Row of each key, -1 where it is new."""
        rows = np.full(len(hashes), -1, np.int64)
        place = (hashes & np.uint64(self.mask)).astype(np.int64)
        live = np.arange(len(hashes))
        while len(live):
            held = self.slots[place[live]]
            same = (held >= 0) & (self.hashes[held] == hashes[live])
            rows[live[same]] = held[same]
            live = live[(held >= 0) & ~same]
            place[live] = (place[live] + 1) & self.mask
        self._verify(rows, keys)
        return rows

    def _verify(self, rows: np.ndarray, keys: Flat) -> None:
        """A key that only shares its hash is new."""
        found = np.flatnonzero(rows >= 0)
        lengths = np.diff(keys.offsets)[found]
        held = rows[found]
        wrong = self.ends[held + 1] - self.ends[held] != lengths
        rows[found[wrong]] = -1
        found, lengths, held = found[~wrong], lengths[~wrong], held[~wrong]
        mine = gather(keys.data, keys.offsets[found], lengths)
        theirs = gather(self.data, self.ends[held], lengths)
        differ = np.flatnonzero(mine != theirs)
        if len(differ):
            owner = np.searchsorted(np.cumsum(lengths), differ, "right")
            rows[found[owner]] = -1

    def add(
        self, hashes: np.ndarray, keys: Flat, chosen: np.ndarray, starts: np.ndarray, counts: np.ndarray
    ) -> np.ndarray:
        """Rows of new keys, `chosen` among `keys`."""
        first, n = self.size, len(hashes)
        rows = np.arange(first, first + n)
        self.size += n
        self.hashes[rows], self.starts[rows], self.counts[rows] = hashes, starts, counts
        lengths = np.diff(keys.offsets)[chosen]
        self.ends[rows + 1] = self.ends[first] + np.cumsum(lengths)
        self.data = np.concatenate((self.data, gather(keys.data, keys.offsets[chosen], lengths)))
        place = (hashes & np.uint64(self.mask)).astype(np.int64)
        live = np.arange(n)
        while len(live):
            at = place[live]
            free = self.slots[at] < 0
            # Of several keys for one slot the last is in; the others go on.
            self.slots[at[free]] = rows[live[free]]
            live = live[self.slots[at] != rows[live]]
            place[live] = (place[live] + 1) & self.mask
        return rows


class Encoder:
    """Ids of many texts; keeps what it learned about pieces for the next batch."""

    def __init__(self, path: str, cuts: str | None = None, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.cuts, self.separator = CUTS[cuts] if cuts else (None, "")
        self.remembered = remembered
        if cuts:
            (self.separator_id,) = self._plain([self.separator])[0].tolist()
        self._forget()

    def _forget(self) -> None:
        self.known = _Known(self.remembered)
        self.ids = np.zeros(0, np.uint32)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in encoded]

    def _joined(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and lengths of pieces that do not hold the separator."""
        join, found, lengths = self.separator.encode().join, [], []
        for at in range(0, len(pieces), JOINED):
            some = pieces[at : at + JOINED]
            ids = self._plain([join(some).decode()])[0]
            edges = np.flatnonzero(ids == self.separator_id)
            if len(edges) != len(some) - 1:
                raise ValueError("the separator does not encode to an id of its own")
            lengths.append(np.diff(np.concatenate(([-1], edges, [len(ids)]))) - 1)
            found.append(ids[ids != self.separator_id])
        return np.concatenate(found), np.concatenate(lengths)

    def _learn(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of new pieces, and where each piece's ids start and how many they are."""
        if self.cuts:
            apart = ~_joinable(flatten(new), self.separator.strip(" ").encode())
        else:
            apart = np.ones(len(new), bool)
        pieces = new.to_pylist()
        alone, together = list(compress(pieces, apart)), list(compress(pieces, ~apart))
        texts = self._plain([p.decode("utf-8", "replace") for p in alone]) if alone else []
        ids, lengths = [*texts], [np.fromiter(map(len, texts), np.int64, len(texts))]
        if together:
            more = self._joined(together)
            ids.append(more[0])
            lengths.append(more[1])
        # Back in the order of the pieces.
        length, ids = np.concatenate(lengths), np.concatenate(ids)
        starts = np.cumsum(length) - length
        order = np.empty(len(pieces), np.int64)
        order[apart] = np.arange(len(alone))
        order[~apart] = len(alone) + np.arange(len(together))
        return ids, starts[order], length[order]

    def encode(self, flat: Flat) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the number of ids of each text."""
        n = len(flat.offsets) - 1
        if len(flat.data) < 3 or self.cuts is None:
            cut = np.zeros(len(flat.data) + 1, bool)
        else:
            cut = self.cuts(flat)
        cut[flat.offsets] = True
        cut[-1] = True
        edges = np.flatnonzero(cut)
        if len(edges) < 2:
            return np.zeros(0, np.uint32), np.zeros(n, np.int64)
        pieces = binary_array(flat.data, np.diff(edges)).dictionary_encode()
        distinct = pieces.dictionary
        hashes = hash_bytes(distinct, 64).view(np.uint64)
        if self.known.size + len(distinct) > self.remembered:
            self._forget()
            if len(distinct) > self.remembered:
                self.known = _Known(len(distinct))
        known = self.known
        keys = flatten(distinct)
        rows = known.find(hashes, keys)
        fresh = np.flatnonzero(rows < 0)
        if len(fresh):
            ids, starts, counts = self._learn(distinct.take(pa.array(fresh)))
            rows[fresh] = known.add(
                hashes[fresh], keys, fresh, starts + len(self.ids), counts
            )
            self.ids = np.concatenate((self.ids, ids))
        rows = rows[pieces.indices.to_numpy(zero_copy_only=False)]
        lengths, starts = known.counts[rows].astype(np.int64), known.starts[rows]
        ids = gather(self.ids, starts, lengths)
        upto = np.concatenate(([0], np.cumsum(lengths)))
        return ids, np.diff(upto[np.searchsorted(edges[:-1], flat.offsets)])


@functools.lru_cache(maxsize=2)
def encoder(path: str, cuts: str | None = None) -> Encoder:
    """The encoder of this worker process, kept between tasks."""
    return Encoder(path, cuts)


def encode_column(column, path: str, cuts: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    return encoder(path, cuts).encode(flatten(column))


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Append `end_id` to every text."""
    stops = np.cumsum(counts)
    return np.insert(ids, stops, np.uint32(end_id)), counts + 1
