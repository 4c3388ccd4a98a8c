"""Text columns as flat byte arrays, and their words without a Python loop.

Everything here works on one Arrow batch inside a task. A batch is cut into parts of a
few megabytes, so memory follows the longest single text, never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PART_BYTES = 2 << 20


class Flat(NamedTuple):
    """Texts laid end to end; text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than texts

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def flatten(column: pa.Array) -> Flat:
    """The UTF-8 bytes of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    n = len(column)
    _, ends, data = column.buffers()
    if n == 0 or data is None:
        return Flat(np.zeros(0, np.uint8), np.zeros(n + 1, np.int64))
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + n + 1]
    held = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return Flat(held, offsets - offsets[0])


def parts(batch: pa.RecordBatch, text: str, limit: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most `limit` bytes of text, or one longer text."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        # What the part needed goes back to the system, not to a pool that only grows.
        pa.default_memory_pool().release_unused()
        start = stop


class Words(NamedTuple):
    """Words of several texts in order, as codes into a dictionary of distinct words."""

    codes: np.ndarray  # int64, one per word
    terms: pa.Array  # distinct words, binary
    bounds: np.ndarray  # words of text i are codes[bounds[i]:bounds[i + 1]]
    starts: np.ndarray  # first byte of each word in the flat data
    ends: np.ndarray  # one past its last byte


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table over the 256 byte values, true inside the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# Digits, letters, and every byte of a character outside ASCII.
LETTERS_AND_DIGITS = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
# Everything but the ASCII white space.
NOT_SPACE = ~byte_set((0x09, 0x0D), (0x20, 0x20))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def spans(data: np.ndarray, offsets: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past last byte of every run of `kept` bytes within one text."""
    inside = np.concatenate(([False], kept[data], [False]))
    begins = inside[1:] & ~inside[:-1]
    stops = inside[:-1] & ~inside[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    # Texts touch, so a run ends with its text.
    touching = inner[inside[1 + inner] & inside[inner]]
    begins[touching] = True
    stops[touching] = True
    return np.flatnonzero(begins), np.flatnonzero(stops)


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs data[s:s + n], one after the other."""
    total = int(lengths.sum())
    if total == 0:
        return data[:0]
    before = np.cumsum(lengths) - lengths
    return data[np.repeat(starts - before, lengths) + np.arange(total)]


def binary_array(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.Array.from_buffers(
        pa.large_binary(),
        len(lengths),
        [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))],
    )


def words(flat: Flat, kept: np.ndarray) -> Words:
    """Maximal runs of `kept` bytes as words."""
    starts, ends = spans(flat.data, flat.offsets, kept)
    found = binary_array(flat.data[kept[flat.data]], ends - starts).dictionary_encode()
    return Words(
        found.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        found.dictionary,
        np.searchsorted(starts, flat.offsets).astype(np.int64),
        starts,
        ends,
    )


# Longer values are hashed one by one, so that a single long one costs no more than itself.
_LONG = 48


def hash_bytes(terms: pa.Array, bits: int, seed: int = 0) -> np.ndarray:
    """A hash of each binary value, folded to `bits` bits."""
    flat = flatten(terms)
    whole = np.diff(flat.offsets)
    long = np.flatnonzero(whole > _LONG)
    lengths = np.where(whole > _LONG, 0, whole)
    out = np.full(len(lengths), 0x9E3779B97F4A7C15 ^ seed, np.uint64)
    prime = np.uint64(0x100000001B3)
    with np.errstate(over="ignore"):
        order = np.argsort(-lengths, kind="stable")
        live = len(lengths)
        begin = flat.offsets[:-1][order]
        sorted_lengths = lengths[order]
        held = out[order]
        for at in range(int(lengths.max(initial=0))):
            # Longest first, so those that still have a byte stand in front.
            live = int(np.searchsorted(-sorted_lengths[:live], -at, "left"))
            held[:live] = (held[:live] ^ flat.data[begin[:live] + at]) * prime
        out[order] = held
        for i in long.tolist():
            out[i] = xxhash.xxh64_intdigest(flat.text(i), seed)
        return mix(out, bits)


def mix(values: np.ndarray, bits: int) -> np.ndarray:
    """Spread 64-bit values and keep the upper `bits` bits."""
    with np.errstate(over="ignore"):
        values = values.astype(np.uint64)
        values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        # 64 bits fill the sign as well.
        return (values >> np.uint64(64 - bits)).view(np.int64)
