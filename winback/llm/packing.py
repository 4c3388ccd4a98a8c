"""Pack whole corpora into sequences of bounded length, best-fit after linear grouping.

Pieces are numbered within their length by position: the task that encodes a piece counts
it, and the counts of earlier partitions are added. `packing_plan` turns the counts of
lengths (one number per possible length) into runs of sequences, so no piece is compared
with another, no piece moves for the plan, and a length that a third of all pieces share
is dealt like any other. Encoded pieces are stored once in the shared folder.

Only documents longer than the capacity are cut. A null text is empty and packs as its end
id alone. Repeated rows are packed separately. An empty table packs to no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from winback.llm.encoding import encode_column, with_end
from winback.llm.packing_plan import Run, best_plan
from winback.llm.texts import parts
from winback.session import materialise

_PIECES = (
    "part int, doc_id long, piece int, start long, length long, ids_crc32 long, place long{ids}"
)
_PACKED = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, "
    "offset long{ids}"
)


def _ranks_within(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Position of each piece among those of its length; `seen` counts earlier batches."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    fresh = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    index = np.arange(len(order))
    ranks = np.empty(len(order), np.int64)
    ranks[order] = index - np.maximum.accumulate(np.where(fresh, index, 0)) + seen[ordered]
    np.add.at(seen, lengths, 1)
    return ranks


def pieces(
    documents: DataFrame,
    capacity: int,
    tokenizer: str,
    cuts: str | None = None,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Encoded documents cut at the capacity, with their place within their length."""
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for some in parts(batch, "text"):
                ids, counts = with_end(*encode_column(some.column("text"), tokenizer, cuts), end_id)
                each = -(-counts // capacity)
                document = np.repeat(np.arange(len(counts)), each)
                piece = np.arange(len(document)) - np.repeat(np.cumsum(each) - each, each)
                start = piece * capacity
                length = np.minimum(counts[document] - start, capacity)
                edges = np.concatenate(([0], np.cumsum(length)))
                data = memoryview(ids.astype("<u4").tobytes())
                held = [data[4 * a : 4 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                columns = {
                    "part": pa.array(np.full(len(piece), part), pa.int32()),
                    "doc_id": some.column("doc_id").take(pa.array(document)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start),
                    "length": pa.array(length),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in held], pa.int64()),
                    "place": pa.array(_ranks_within(length, seen)),
                }
                if with_ids:
                    columns["ids"] = pa.array([bytes(x) for x in held], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return texts.mapInArrow(cut, _PIECES.format(ids=", ids binary" if with_ids else ""))


def _lookup(runs: list[Run]) -> tuple[np.ndarray, ...]:
    """Runs as columns ordered by length and first occurrence, with one search key."""
    table = np.array(sorted(runs), np.int64).reshape(-1, 6)
    return tuple(np.ascontiguousarray(table[:, i]) for i in range(6))


def pack(
    documents: DataFrame,
    capacity: int,
    tokenizer: str,
    cuts: str | None = None,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Every piece with its sequence and its gapless offset there; `with_ids` adds its ids."""
    found = materialise(
        pieces(documents, capacity, tokenizer, cuts, end_id, id_column, text_column, with_ids),
        "pieces",
    )
    by_part = materialise(found.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    # At most one row per possible length reaches the driver.
    counts = {
        int(r.length): int(r.n)
        for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    runs, _ = best_plan(counts, capacity)
    lengths, firsts, _, each, sequences, offsets = _lookup(runs)
    # Occurrences of a length start at one point of a common axis.
    base = np.zeros(capacity + 2, np.int64)
    for length, n in counts.items():
        base[length + 1] = n
    base = np.cumsum(base)
    keys = base[lengths] + firsts
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    numbered = found.join(before, ["part", "length"]).withColumn(
        "place", F.col("place") + F.col("before")
    )
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "place"] + ["ids"] * with_ids

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            length = batch.column("length").to_numpy()
            place = batch.column("place").to_numpy()
            run = np.searchsorted(keys, base[length] + place, "right") - 1
            sequence, slot = np.divmod(place - firsts[run], each[run])
            columns = {name: batch.column(name) for name in names if name not in ("place", "ids")}
            columns["sequence_id"] = pa.array(sequences[run] + sequence)
            columns["offset"] = pa.array(offsets[run] + slot * length)
            if with_ids:
                columns["ids"] = batch.column("ids")
            yield pa.RecordBatch.from_pydict(columns)

    return numbered.select(*names).mapInArrow(
        settle, _PACKED.format(ids=", ids binary" if with_ids else "")
    )
