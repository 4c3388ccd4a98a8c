"""The queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.llm import (
    i_match,
    language,
    neighbours,
    packing,
    positional_index,
    quality,
    ranked_search,
    simhash,
    spelling,
    token_counts,
    token_shards,
    toxicity,
    url_filter,
)
from winback.llm.learning import held_out
from winback.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]

CONTEXT = 2048


# Rows of an Arrow batch: with Spark's 10,000 a batch of long texts would not fit a worker.
BATCH_ROWS = "1000"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_shards(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "token-shards")
    token_shards.write(
        table(spark, folder, "documents"),
        path,
        public_tokenizers.path("byte_bpe_50k.json"),
        "byte_level",
    )
    return token_shards.read(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


TOXIC_CUT = 0.5


def toxicity_model(spark: SparkSession, documents: DataFrame, folder: str) -> toxicity.Model:
    return toxicity.fit(
        documents, table(spark, folder, "labels"), "toxic", ~held_out("doc_id", 5, 0)
    )


def op2_toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = toxicity_model(spark, documents, folder)
    return toxicity.with_score(documents.select("doc_id", "text"), model, spans="spans").select(
        "doc_id",
        held_out("doc_id", 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_CUT).cast("int").alias("predicted"),
        "spans",
    )


def op3_packed_sequences(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(
        table(spark, folder, "documents"),
        CONTEXT,
        public_tokenizers.path("word_bpe_49k.json"),
        "white_space",
    )


def op4_languages(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = language.fit(documents, ~held_out("doc_id", 5, 0))
    return language.with_language(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score"
    )


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "positional-index")
    positional_index.build(table(spark, folder, "documents"), path)
    found = positional_index.search(spark, path, table(spark, folder, "benchmark"), unnamed=True)
    return positional_index.contamination(found)


def op6_length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    lengths = token_counts.encoded_lengths(
        table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        "byte_level",
    )
    return token_counts.histogram(lengths)


URL_RULES = (
    (url_filter.ALLOW, "com/"),
    (url_filter.BLOCK, "example.com/en/"),
    (url_filter.ALLOW, "www.example.com/en/"),
    (url_filter.BLOCK, "net/es/"),
    (url_filter.BLOCK, "net/fr/"),
)


def op7_url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"), URL_RULES)


def op8_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.withColumn("fingerprint", simhash.hex_digits("fingerprint"))


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


QUALITY_CUT = 0.7


def quality_model(spark: SparkSession, documents: DataFrame, folder: str) -> quality.Model:
    return quality.fit(
        documents, table(spark, folder, "labels"), "quality", ~held_out("doc_id", 4, 2)
    )


def op10_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = quality_model(spark, documents, folder)
    return quality.with_score(documents.select("doc_id", "text"), model).select(
        "doc_id",
        held_out("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"),
    )


def op11_i_match(spark: SparkSession, folder: str) -> DataFrame:
    return i_match.against_edits(table(spark, folder, "documents"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    counted = spelling.word_counts(table(spark, folder, "documents"), damage=97)
    return spelling.variants(counted)


# Bytes of an Arrow batch, where the session has no size of its own: a row of the index is a
# segment of some megabytes, and Spark's 64 MB of them are held twice on the way to a worker.
BATCH_SIZE = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "4m"


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    if spark.conf.get(BATCH_SIZE, None) is None:
        spark.conf.set(BATCH_SIZE, BATCH_BYTES)
    path = new_folder(spark, "ranked-index")
    ranked_search.build(table(spark, folder, "documents"), path)
    return ranked_search.search(spark, path, table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_shards,
        op2_toxicity_scores,
        op3_packed_sequences,
        op4_languages,
        op5_decontamination,
        op6_length_histogram,
        op7_url_verdicts,
        op8_simhash_components,
        op9_neighbours,
        op10_quality_scores,
        op11_i_match,
        op12_spelling_variants,
        op13_ranked_search,
    )
}


def _words_sql(text: str) -> str:
    lowered = (
        f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _likeness_sql(left: str, right: str) -> str:
    nothing = i_match.NOTHING
    pairs = f"list_filter(list_zip({left}, {right}), lambda x: x[1] != '{nothing}' OR x[2] != '{nothing}')"
    return (
        f"CASE WHEN len({pairs}) = 0 THEN 1.0 "
        f"ELSE len(list_filter({pairs}, lambda x: x[1] = x[2])) / CAST(len({pairs}) AS DOUBLE) END"
    )


# Tokenizers, fitted models, XXH64 and approximate search have no SQL; the tests compare those
# operators with brute force.
SQL: dict[str, str] = {
    "op5_decontamination": f"""
WITH w AS (SELECT doc_id, {_words_sql('text')} AS ws FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words_sql('text')} AS ws FROM benchmark),
windows AS (SELECT DISTINCT item, n, array_to_string(ws[p:p + n - 1], ' ') AS g
  FROM (SELECT item, ws, least(13, len(ws)) AS n,
      unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS p FROM i WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS g
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p
    FROM w, sizes WHERE len(ws) >= n)),
matches AS (SELECT DISTINCT doc_id, p, n, item FROM grams JOIN windows USING (n, g)),
hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM matches) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM matches) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op11_i_match": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
o AS (SELECT doc_id, text, n, lead(doc_id) OVER (ORDER BY doc_id DESC) AS after FROM d),
p AS (SELECT o.doc_id, o.text, o.n, x.doc_id AS after, x.text AS follower
  FROM o JOIN d AS x ON x.doc_id = coalesce(o.after, (SELECT max(doc_id) FROM d))),
e AS (SELECT *, substr(text, 1, n - n // 2) || substr(follower, 1, n // 2) AS edited FROM p),
t AS (SELECT doc_id, 'own' AS kind, list_distinct({_words_sql('text')}) AS ts FROM e
  UNION ALL SELECT doc_id, 'edited', list_distinct({_words_sql('edited')}) FROM e),
u AS (SELECT doc_id, kind, unnest(ts) AS term FROM t),
lexicon AS (SELECT term FROM u WHERE kind = 'own' GROUP BY term
  HAVING count(*) * {i_match.MOST} <= (SELECT count(*) FROM d)
    AND count(*) * {i_match.LEAST} >= (SELECT count(*) FROM d)),
f AS (SELECT u.* FROM u JOIN lexicon USING (term)),
whole AS (SELECT doc_id, kind, string_agg(term, ' ' ORDER BY term) AS w FROM f GROUP BY ALL),
outside AS (SELECT doc_id, kind, string_agg(term, ' ' ORDER BY term) AS w
  FROM u ANTI JOIN whole USING (doc_id, kind) GROUP BY ALL),
grid AS (SELECT j, h, j * 100 + h AS slot
  FROM range({i_match.FAMILIES}) AS a(j), (SELECT unnest({list(i_match.HALVINGS)}) AS h)),
drawn AS (SELECT term, j, CAST('0x' || substr(sha256(term), 4 * j + 1, 4) AS BIGINT) AS draw
  FROM lexicon, range({i_match.FAMILIES}) AS a(j)),
subsets AS (SELECT doc_id, kind, slot, string_agg(term, ' ' ORDER BY term) AS w
  FROM f JOIN drawn USING (term) JOIN grid USING (j) WHERE draw < (65536 >> h) GROUP BY ALL),
hashes AS (SELECT doc_id, kind, -1 AS slot, w FROM whole UNION ALL SELECT doc_id, kind, -1, w FROM outside
  UNION ALL SELECT doc_id, kind, slot, w FROM subsets),
every AS (SELECT doc_id, kind, slot FROM t, (SELECT -1 AS slot UNION ALL SELECT slot FROM grid)),
fp AS (SELECT doc_id, kind, list(coalesce(substr(md5(w), 1, {i_match.DIGITS}), '{i_match.NOTHING}')
    ORDER BY slot) AS hs FROM every LEFT JOIN hashes USING (doc_id, kind, slot) GROUP BY ALL),
j AS (SELECT e.doc_id, e.n, e.edited, a.hs AS own, b.hs AS changed, c.hs AS next
  FROM e JOIN fp AS a ON a.doc_id = e.doc_id AND a.kind = 'own'
  JOIN fp AS b ON b.doc_id = e.doc_id AND b.kind = 'edited'
  JOIN fp AS c ON c.doc_id = e.after AND c.kind = 'own')
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
  array_to_string(own, '') AS fingerprint, array_to_string(changed, '') AS edited_fingerprint,
  {_likeness_sql('own', 'changed')} AS near_edited, {_likeness_sql('own', 'next')} AS near_next
FROM j""",
    "op13_ranked_search": f"""
WITH w AS (SELECT doc_id, {_words_sql('text')} AS ws FROM documents),
c AS (SELECT count(*) FILTER (len(ws) > 0) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM w),
p AS (SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n, unnest(ws) AS term FROM w) GROUP BY ALL),
t AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1)))
    AS BIGINT) AS weight FROM p, c GROUP BY term),
q AS (SELECT DISTINCT item_id, unnest({_words_sql('text')}) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf)
    // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN t USING (term), c GROUP BY item_id, doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank
  FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10""",
}
