"""Token ids of documents as Re-Pair shards in a table, and their decoding.

A shard holds whole documents in ascending id order and is compressed by its own grammar
(`repair`). The table under `<path>/shards` has a row per shard: `part` and `shard` give
the order, `start` the ids before it within its part, `doc_ids` and `doc_starts` its
documents, `payload` the bytes. `<path>/parts` has the ids before each part. Spark writes
and commits both, so a lost executor leaves nothing half done.

Rows without text encode to the end id alone. Rows without an id come first. Rows that
repeat an id stay separate, in the order of their texts' hashes. Only the id and the text
column are read; other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from winback.llm import repair
from winback.llm.encoding import encode_column, encoder, with_end
from winback.llm.texts import parts

SHARD_IDS = 1 << 20

_SHARDS = (
    "part int, shard int, start long, n_ids long, doc_ids array<long>, "
    "doc_starts array<long>, payload binary"
)
_DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def write(
    documents: DataFrame,
    path: str,
    tokenizer: str,
    cuts: str | None = None,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode whole texts, append `end_id` to each, and write them as shards under `path`.

    Range partitions in id order make the shards of one part follow those of the part
    before. A hot id is spread by the hash of its text. A shard is closed at `shard_ids`
    ids; only a single longer document exceeds it.
    """
    placed = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
        F.xxhash64(F.col(text_column)).alias("tie"),
    )
    placed = placed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first_symbol = max(
            encoder(tokenizer, cuts).tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1
        )
        number, start = 0, 0
        ids, counts, names = np.zeros(0, np.uint32), np.zeros(0, np.int64), pa.array([], pa.int64())

        def closed(docs: int) -> pa.RecordBatch:
            nonlocal number, start, ids, counts, names
            held = counts[:docs]
            size = int(held.sum())
            row = [
                [part],
                [number],
                [start],
                [size],
                [names[:docs]],
                [np.cumsum(held) - held],
                [repair.pack(ids[:size], first_symbol)],
            ]
            number, start = number + 1, start + size
            ids, counts, names = ids[size:], counts[docs:], names[docs:]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, _SHARD_TYPES)], names=_SHARD_NAMES
            )

        for batch in batches:
            for piece in parts(batch, "text"):
                more, each = with_end(*encode_column(piece.column("text"), tokenizer, cuts), end_id)
                ids, counts = np.concatenate((ids, more)), np.concatenate((counts, each))
                names = pa.concat_arrays([names, piece.column("doc_id")])
                while len(ids) >= shard_ids:
                    fits = int(np.searchsorted(np.cumsum(counts), shard_ids, "right"))
                    yield closed(max(1, fits))
        if len(counts):
            yield closed(len(counts))

    placed.mapInArrow(shards, _SHARDS).write.parquet(f"{path}/shards")
    sizes = (
        documents.sparkSession.read.schema(_SHARDS)
        .parquet(f"{path}/shards")
        .groupBy("part")
        .agg(F.sum("n_ids").alias("n_ids"))
    )
    # A row per part, not per shard or document.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before")).coalesce(
        1
    ).write.parquet(f"{path}/parts")


_SHARD_NAMES = ["part", "shard", "start", "n_ids", "doc_ids", "doc_starts", "payload"]
_SHARD_TYPES = [
    pa.int32(),
    pa.int32(),
    pa.int64(),
    pa.int64(),
    pa.list_(pa.int64()),
    pa.list_(pa.int64()),
    pa.binary(),
]


def read(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """Documents back from their shards: id, ids before it in the whole corpus, number of
    ids, and the ids as little-endian unsigned 32-bit integers.

    `only` names the documents wanted; their shards alone are opened, and of these only
    the symbols that cover the documents are expanded.
    """
    shards = spark.read.schema(_SHARDS).parquet(f"{path}/shards")
    if only is not None:
        wanted = F.array(*[F.lit(int(i)).cast("long") for i in only]).cast("array<long>")
        shards = shards.filter(F.arrays_overlap("doc_ids", wanted))
    offsets = spark.read.schema("part int, before long").parquet(f"{path}/parts")
    placed = shards.join(offsets, "part").select(
        (F.col("before") + F.col("start")).alias("start"), "doc_ids", "doc_starts", "payload"
    )
    chosen = None if only is None else set(only)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                start, names, begins, payload = (c[i] for c in batch.columns)
                shard = repair.unpack(payload.as_buffer())
                decoder = repair.Decoder(shard)
                names = names.values
                begins = begins.values.to_numpy(zero_copy_only=False)
                stops = np.append(begins[1:], shard.n_ids)
                if chosen is not None:
                    rows = [j for j, name in enumerate(names.to_pylist()) if name in chosen]
                    names, begins, stops = names.take(pa.array(rows)), begins[rows], stops[rows]
                    ids = [decoder.ids(int(a), int(b)) for a, b in zip(begins, stops)]
                    data = np.concatenate(ids)
                else:
                    data = decoder.ids()
                lengths = stops - begins
                edges = np.zeros(len(lengths) + 1, np.int32)
                np.cumsum(4 * lengths, out=edges[1:])
                held = pa.Array.from_buffers(
                    pa.binary(),
                    len(lengths),
                    [None, pa.py_buffer(edges), pa.py_buffer(data.astype("<u4"))],
                )
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(start.as_py() + begins), pa.array(lengths), held],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return placed.mapInArrow(documents, _DOCUMENTS)
