"""I-Match fingerprints: hashes of a document's terms of middling rarity.

A document's terms are its distinct runs of ASCII digits and letters (A-Z lowered) and of
characters outside ASCII. The lexicon holds the terms whose inverse document frequency lies
in a band: words that stand everywhere say nothing, and words that stand nearly nowhere are
mostly errors. The fingerprint hashes a document's sorted lexicon terms, once all of them and
once for each of several randomised subsets of the lexicon. There are `FAMILIES` families of
subsets; those of a family keep each term with a chance of 1/8, 1/32, 1/128 or 1/512, by two
bytes of the term's SHA-256. Equal term sets give equal hashes, and the fewer terms a subset keeps, the
more edits its hash survives, so the share of agreeing hashes falls gradually.

All of it is built-in functions on the JVM. Counting terms is one aggregation that combines
before it exchanges. The lower end of the band bounds the lexicon: a term in it stands in at
least one of `LEAST` documents, so there are at most `LEAST` times the mean number of terms of
a document, whatever the size of the corpus. Up to `HELD` terms it enters as one value, a table
of buckets in which a document's terms are looked up, and documents are not exchanged at all;
beyond, terms and lexicon are joined.

Null and empty texts and texts without a term have the hash of nothing everywhere. A text whose terms
all lie outside the lexicon is hashed by all of its terms in the place of the whole lexicon:
it is like texts of the same terms only. Equal texts, repeated rows and rows of equal or null
id keep a row each, and an empty table gives no row.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.functions.ordered import with_rank
from winback.llm.rows import with_row_key
from winback.session import materialise

# The band: terms of at most one in MOST and at least one in LEAST documents, an inverse
# document frequency of ln(10) to ln(1000).
MOST = 10
LEAST = 1000
FAMILIES = 8
HALVINGS = (3, 5, 7, 9)
# Terms of a lexicon that enters as a value, some 30 MB.
HELD = 500_000
# Hexadecimal digits of a hash.
DIGITS = 4

# What stands between terms once A-Z are lowered.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_HASHES = 1 + FAMILIES * len(HALVINGS)
# The hash of no term.
NOTHING = hashlib.md5(b"").hexdigest()[:DIGITS]
_DRAWS = [f"draw{family}" for family in range(FAMILIES)]


def terms(text: Column) -> Column:
    """The distinct terms of a text; none of a null."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), _CAPITALS, _CAPITALS.lower())
    # Extracting all matches takes time with the square of a text's length, splitting does not.
    return F.array_remove(F.array_distinct(F.split(lowered, _BETWEEN)), "")


def lexicon(
    documents: DataFrame, text_column: str = "text", most: int = MOST, least: int = LEAST
) -> DataFrame:
    """The terms of the band, each with the number that each family draws for it; stored."""
    texts = documents.select(F.col(text_column).alias("text"))
    n = texts.count()
    counted = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").count()
    digest = F.sha2("term", 256)
    draws = [
        F.conv(F.substring(digest, 4 * family + 1, 4), 16, 10).cast("int").alias(name)
        for family, name in enumerate(_DRAWS)
    ]
    band = (F.col("count") * most <= n) & (F.col("count") * least >= n)
    return materialise(counted.filter(band).select("term", *draws), "lexicon")


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _held(terms_of_band: DataFrame, buckets: int) -> Column:
    """The lexicon as one value: for each bucket its terms with their draws."""
    spark = terms_of_band.sparkSession
    filled = terms_of_band.groupBy(_bucket(F.col("term"), buckets).alias("bucket")).agg(
        F.collect_list(F.struct("term", *_DRAWS)).alias("entries")
    )
    every = spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    table = every.join(filled, "bucket", "left").agg(
        F.array_sort(F.collect_list(F.struct("bucket", "entries"))).alias("table")
    )
    packed = materialise(table.select(F.col("table.entries").alias("table")), "lexicon-table")
    return packed.scalar()


def _in_lexicon(rows: DataFrame, key: str, text: str, band: DataFrame, held: int) -> DataFrame:
    """The rows with a column `found`: `every` term of the text, sorted, and of those the
    entries that the `lexicon` has."""
    size = band.count()
    every = F.array_sort(terms(F.col(text)))
    if size <= held:
        buckets = max(16, 2 * size)

        def entry(term: Column) -> Column:
            held_there = F.get(F.col("table"), _bucket(term, buckets))
            return F.get(F.filter(held_there, lambda e: e["term"] == term), F.lit(0))

        def both(sorted_terms: Column) -> Column:
            inside = F.filter(F.transform(sorted_terms, entry), lambda e: e.isNotNull())
            return F.struct(sorted_terms.alias("every"), inside.alias("lexicon"))

        # The value must be read where it is used, or every row would carry it. The optimiser
        # merges the two steps as long as nothing that is computed is used twice in the
        # second one; so the terms are bound to a name, as the only element of an array.
        looked_up = F.get(F.transform(F.array(every), both), F.lit(0))
        with_table = rows.withColumn("table", _held(band, buckets))
        return with_table.withColumn("found", looked_up).drop("table")
    each = rows.select(key, F.explode(terms(F.col(text))).alias("term")).join(band, "term")
    found = each.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("term", *_DRAWS))).alias("lexicon")
    )
    nothing = F.array().cast(found.schema["lexicon"].dataType)
    inside = F.coalesce("lexicon", nothing).alias("lexicon")
    joined = rows.join(found, key, "left")
    return joined.withColumn("found", F.struct(every.alias("every"), inside)).drop("lexicon")


def _hash(chosen: Column) -> Column:
    return F.substring(F.md5(F.array_join(chosen, " ").cast("binary")), 1, DIGITS)


def with_fingerprint(
    rows: DataFrame, key: str, text: str, band: DataFrame, name: str, held: int = HELD
) -> DataFrame:
    """The rows with the fingerprint of a text, an array of hashes, as a further column. `key`
    names each row."""

    def drawn(entries: str | Column, draw: str, halving: int) -> Column:
        return F.filter(entries, lambda e: e[draw] < (1 << 16 >> halving))

    inside = F.col("found")["lexicon"]
    whole = F.when(F.size(inside) > 0, inside["term"]).otherwise(F.col("found")["every"])
    found = _in_lexicon(rows, key, text, band, held)
    # The largest subset of each family, of which the others are subsets.
    largest = {draw: drawn(inside, draw, HALVINGS[0]) for draw in _DRAWS}
    subsets = [_hash(drawn(draw, draw, halving)["term"]) for draw in _DRAWS for halving in HALVINGS]
    hashed = found.withColumns(largest).withColumn(name, F.array(_hash(whole), *subsets))
    return hashed.drop("found", *_DRAWS)


def likeness(left: Column, right: Column) -> Column:
    """The share of agreeing hashes among those that one of two fingerprints has; 1 if
    neither has any."""

    alike = F.size(F.filter(F.zip_with(left, right, lambda a, b: a == b), lambda same: same))
    both = F.zip_with(left, right, lambda a, b: (a == NOTHING) & (b == NOTHING))
    neither = F.size(F.filter(both, lambda nothing: nothing))
    return F.when(neither == _HASHES, 1.0).otherwise((alike - neither) / (_HASHES - neither))


def followers(documents: DataFrame, key: str, id_column: str, text_column: str) -> DataFrame:
    """For each row its length and its `next` row in descending order of the id, the first
    after the last. Rows without an id come last; equal ids are ordered by their text."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    narrow = documents.select(
        F.col(key).alias("key"),
        F.col(id_column).alias("doc_id"),
        F.char_length(text).cast("long").alias("n_chars"),
        F.xxhash64(text).alias("digest"),
    )
    order = [F.col("doc_id").desc_nulls_last(), F.col("digest"), F.col("key")]
    ranked = materialise(with_rank(materialise(narrow, "lengths"), [], order).drop("digest"), "ranked")
    following = ranked.select(F.col("rank").alias("place"), F.col("key").alias("next"))
    after = F.col("rank") % F.col("rank_of") + 1 == F.col("place")
    return ranked.join(following, after).select("key", "doc_id", "n_chars", "next")


def against_edits(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    most: int = MOST,
    least: int = LEAST,
    held: int = HELD,
) -> DataFrame:
    """Each document's fingerprint beside that of its edited text, whose last half is the
    next document's beginning, and its likeness to that text and to the next document.

    Texts are exchanged once, by the row's key, and the halves that go to another row once
    more; nothing else of a text moves.
    """
    keyed = with_row_key(documents)
    band = lexicon(documents, text_column, most, least)
    places = followers(keyed.frame, keyed.key, id_column, text_column)
    texts = keyed.frame.select(
        F.col(keyed.key).alias("key"),
        F.col(text_column).cast("string").alias("text"),
    )
    texts = with_fingerprint(texts, "key", "text", band, "fingerprint", held)
    text, half = F.coalesce("text", F.lit("")), F.floor(F.col("n_chars") / 2).cast("int")
    given = texts.join(places.withColumnRenamed("key", "to"), F.col("key") == F.col("next")).select(
        F.col("to").alias("key"),
        "doc_id",
        "n_chars",
        F.substring(text, F.lit(1), half).alias("tail"),
        F.col("fingerprint").alias("next_fingerprint"),
    )
    edited = F.concat(F.substring(text, F.lit(1), (F.col("n_chars") - half).cast("int")), F.col("tail"))
    digest = F.sha2(edited.cast("binary"), 256)
    edits = texts.join(given, "key").withColumns({"edited": edited, "edited_sha256": digest})
    edits = edits.drop("text", "tail")
    edits = with_fingerprint(edits, "key", "edited", band, "edited_fingerprint", held)
    return edits.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.array_join("fingerprint", "").alias("fingerprint"),
        F.array_join("edited_fingerprint", "").alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
