"""The training-text pipeline: stages over `documents`, each written and read again.

Every stage but the last returns the columns it was given. Decisions are made per row, named
by its place in the stored files: rows without an id are judged like any other, and so is each
of several rows with one id. Texts are never exchanged: rows go by bitmaps of their places.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.llm import packing, positional_index, quality, simhash, toxicity
from winback.llm.queries import (
    CONTEXT,
    QUALITY_CUT,
    TOXIC_CUT,
    quality_model,
    table,
    toxicity_model,
)
from winback.llm.rows import free_name, with_row_key, without_rows
from winback.session import materialise, new_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of quality: those the classifier accepts."""
    name = free_name(docs, "_quality")
    scored = quality.with_score(docs, quality_model(spark, docs, sf_dir), name)
    return scored.filter(F.col(name) >= QUALITY_CUT).select(*[f"`{c}`" for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the random field does not find toxic."""
    name = free_name(docs, "_toxicity")
    scored = toxicity.with_score(docs, toxicity_model(spark, docs, sf_dir), name)
    return scored.filter(F.col(name) < TOXIC_CUT).select(*[f"`{c}`" for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked fingerprints: the one with the smallest id (none is
    larger than any), of several the one that stands first in the stored files."""
    keyed = with_row_key(docs)
    key = keyed.key
    found = simhash.near_duplicates(keyed.frame, id_column=key).withColumnRenamed("doc_id", key)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", key)
    ids = keyed.frame.select(key, "doc_id").join(found.select(key, "component_id"), key)
    ids = materialise(ids, "components")
    kept = ids.groupBy("component_id").agg(F.min(order)[key].alias(key))
    return without_rows(keyed, ids.select(key).join(kept.select(key), key, "left_anti"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is inside a benchmark window."""
    keyed = with_row_key(docs)
    path = new_folder(spark, "positional-index")
    positional_index.build(keyed.frame, path, id_column=keyed.key)
    found = positional_index.search(spark, path, table(spark, sf_dir, "benchmark"), unnamed=True)
    hit = positional_index.contamination(found).filter("contaminated")
    return without_rows(keyed, hit.select(F.col("doc_id").alias(keyed.key)))


def pack_best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each in its place of a sequence."""
    return packing.pack(docs, CONTEXT, public_tokenizers.path("word_bpe_49k.json"), "white_space")


STAGES = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_best_fit),
]

# Tokenizers and fitted classifiers have no SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
