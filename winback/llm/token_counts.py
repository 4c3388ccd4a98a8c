"""Exact histogram of encoded lengths, and what a context limit would keep.

Documents are counted by encoded length; running sums over the distinct lengths, from
both ends, then answer every limit: documents that fit, documents cut, tokens kept when
each document is cut at the limit, and quantiles. Texts are read once.

A null or empty text has length 0 (plus the end id, if any). Repeated rows count each.
An empty table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winback.functions.ordered import with_running_totals
from winback.llm.encoding import encode_column
from winback.llm.texts import parts


def encoded_lengths(
    documents: DataFrame,
    tokenizer: str,
    cuts: str | None = None,
    end_ids: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id and the number of ids of its whole text, `end_ids` included."""
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in parts(batch, "text"):
                _, lengths = encode_column(piece.column("text"), tokenizer, cuts)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(lengths + end_ids)],
                    names=["doc_id", "n_tokens"],
                )

    return texts.mapInArrow(count, "doc_id long, n_tokens long")


def histogram(lengths: DataFrame, length_column: str = "n_tokens") -> DataFrame:
    """One row per distinct length, with sums over shorter and over longer documents.

    `n_docs`, `n_tokens`: documents of this length and their tokens. `docs_up_to`,
    `tokens_up_to`: those of at most this length. `docs_from`, `tokens_from`: those of at
    least this length. `docs_cut`, `tokens_kept`, `tokens_cut`: with this length as the
    context limit. `share_up_to`: the quantile this length stands for.
    """
    counted = (
        lengths.filter(F.col(length_column).isNotNull())
        .groupBy(F.col(length_column).cast("long").alias("length"))
        .agg(F.count("*").alias("n_docs"))
        .withColumn("n_tokens", F.col("length") * F.col("n_docs"))
    )
    running = with_running_totals(
        counted,
        [],
        [F.col("length")],
        {"docs_up_to": F.col("n_docs"), "tokens_up_to": F.col("n_tokens")},
    )
    docs, tokens = F.col("docs_up_to_total"), F.col("tokens_up_to_total")
    longer = docs - F.col("docs_up_to")
    kept = F.col("tokens_up_to") + longer * F.col("length")
    return running.select(
        "length",
        "n_docs",
        "n_tokens",
        "docs_up_to",
        "tokens_up_to",
        (longer + F.col("n_docs")).alias("docs_from"),
        (tokens - F.col("tokens_up_to") + F.col("n_tokens")).alias("tokens_from"),
        longer.alias("docs_cut"),
        kept.alias("tokens_kept"),
        (tokens - kept).alias("tokens_cut"),
        (F.col("docs_up_to") / docs).alias("share_up_to"),
    )


def at_limits(counted: DataFrame, limits: Sequence[int]) -> DataFrame:
    """What each context limit keeps, from `histogram`, all limits in one aggregation."""
    length, docs = F.col("length"), F.col("n_docs")
    wanted = sorted({int(limit) for limit in limits})
    measures, rows = [F.sum("n_tokens").alias("tokens"), F.sum("n_docs").alias("docs")], []
    for i, limit in enumerate(wanted):
        measures.append(F.sum(F.when(length <= limit, docs).otherwise(0)).alias(f"fit_{i}"))
        measures.append(F.sum(F.least(length, F.lit(limit)) * docs).alias(f"kept_{i}"))
        names = {"n_docs": "docs", "docs_fit": f"fit_{i}", "tokens_kept": f"kept_{i}", "n_tokens": "tokens"}
        row = [F.coalesce(F.col(source), F.lit(0)).alias(name) for name, source in names.items()]
        rows.append(F.struct(F.lit(limit).cast("long").alias("context"), *row))
    return counted.agg(*measures).select(F.inline(F.array(*rows)))


def quantiles(counted: DataFrame, shares: Sequence[float]) -> DataFrame:
    """For each share the smallest length that at least this share of documents reaches."""
    picks = [
        F.min(F.when(F.col("share_up_to") >= F.lit(float(s)), F.col("length"))).alias(f"q{i}")
        for i, s in enumerate(shares)
    ]
    pairs = [
        F.struct(F.lit(float(s)).alias("share"), F.col(f"q{i}").alias("length"))
        for i, s in enumerate(shares)
    ]
    return counted.agg(*picks).select(F.inline(F.array(*pairs)))
