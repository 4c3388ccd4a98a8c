"""Language of whole texts: first the family, then the language within it.

A text is the mean of its byte n-grams (pairs, triples and quadruples over lowered letters,
everything else as a space), hashed. Linear support vector machines with hinge loss tell a
family from the others; within a family one machine per pair of languages votes, and the
summed margins settle ties. All weights of an n-gram lie side by side, so one pass over the
bytes serves every machine.

Learned from a bounded number of distinct texts per language, drawn by the hash of the text.
A text that is null or has no letter is `und` with score 0; so is every text if nothing was
learned. The score is the product of the family's and of the weakest pairwise probability.
"""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winback.llm.learning import dual_coordinate_descent, sigmoid
from winback.llm.rows import free_name
from winback.llm.texts import Flat, byte_set, flatten, lower_ascii, parts

# Families of ISO 639-1 codes; a code that is not here is its own family.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "rm", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "indo-aryan": ("as", "bn", "gu", "hi", "mr", "ne", "or", "pa", "sd", "si", "ur"),
    "turkic": ("az", "ba", "kk", "ky", "tk", "tr", "tt", "ug", "uz"),
    "uralic": ("et", "fi", "hu", "se"),
    "semitic": ("am", "ar", "he", "mt", "ti"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "austronesian": ("id", "jv", "mg", "ms", "su", "tl"),
    "celtic": ("br", "cy", "ga", "gd", "gv", "kw"),
    "baltic": ("lt", "lv"),
    "iranian": ("fa", "ku", "ps", "tg"),
}
PER_LANGUAGE = 500
ORDERS = (2, 3, 4)
TABLE_BITS = 16
# Brings the mean of n-grams to a length near one.
SCALE = 10.0

_LETTERS = byte_set((0x61, 0x7A), (0x80, 0xFF))
_SIZE = len(ORDERS) << TABLE_BITS


class Model(NamedTuple):
    languages: list[str]
    families: list[str]
    family_of: np.ndarray  # family number per language
    pairs: list[tuple[int, int]]  # languages of each machine within a family
    weights: np.ndarray  # features x (families, then pairs), float32
    biases: np.ndarray


def family(language: str) -> str:
    return next((name for name, codes in FAMILIES.items() if language in codes), language)


def _grams(flat: Flat):
    """(feature, text) arrays of all n-grams that hold a letter and stay in their text."""
    data = lower_ascii(flat.data)
    data = np.where(_LETTERS[data], data, 0x20).astype(np.uint32)
    text = np.repeat(np.arange(len(flat.offsets) - 1, dtype=np.int32), np.diff(flat.offsets))
    value = data
    for order in range(2, max(ORDERS) + 1):
        if len(data) < order:
            return
        value = (value[:-1] << np.uint32(8)) | data[order - 1 :] if order <= 4 else value
        if order not in ORDERS:
            continue
        n = len(data) - order + 1
        blank = np.uint32(int.from_bytes(b" " * order, "big"))
        kept = (text[:n] == text[order - 1 :]) & (value != blank)
        with np.errstate(over="ignore"):
            mixed = value[kept] * np.uint32(2654435761)
        mixed ^= mixed >> np.uint32(15)
        feature = (mixed & np.uint32((1 << TABLE_BITS) - 1)).astype(np.int64)
        yield feature + (ORDERS.index(order) << TABLE_BITS), text[:n][kept]


def _examples(flat: Flat) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for i in range(len(flat.offsets) - 1):
        one = np.frombuffer(flat.text(i), np.uint8)
        grams = [feature for feature, _ in _grams(Flat(one, np.array([0, len(one)])))]
        at, counts = np.unique(np.concatenate(grams) if grams else np.zeros(0, np.int64), return_counts=True)
        out.append((at, SCALE * counts / max(1, counts.sum())))
    return out


def fit(
    documents: DataFrame,
    learned: Column,
    per_language: int = PER_LANGUAGE,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
) -> Model | None:
    """Machines from at most `per_language` distinct texts of each language, the first by
    their hash; None if there is nothing to learn from."""
    rows = documents.select(
        F.col(id_column).alias(id_column),
        F.col(language_column).cast("string").alias("language"),
        F.col(text_column).cast("string").alias("text"),
    ).filter(learned & F.col("language").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("language", "text")
    # Copies of a text are one text, whatever their ids, so many copies cannot fill the sample.
    key = F.xxhash64(F.lit(7), "text")
    counted = rows.groupBy("language").agg(F.approx_count_distinct(key).alias("texts")).collect()
    if not counted:
        return None
    # About twice as many texts as wanted are drawn by their hash, then the first of those.
    share = F.create_map(
        *[
            F.lit(x)
            for language, texts in sorted(map(tuple, counted))
            for x in (language, int(2e6 * per_language / max(texts, 1)) + 1)
        ]
    )
    drawn = rows.filter(F.pmod(key, F.lit(1_000_000)) < share[F.col("language")]).distinct()
    place = F.row_number().over(Window.partitionBy("language").orderBy(key, "text"))
    drawn = drawn.withColumn("_place", place).filter(F.col("_place") <= per_language)
    drawn = drawn.select("language", "text")
    sample = drawn.orderBy("language", "text").toArrow()
    languages = sorted(set(sample.column("language").to_pylist()))
    if not languages:
        return None
    classes = np.array([languages.index(x) for x in sample.column("language").to_pylist()])
    examples = _examples(flatten(sample.column("text")))
    families = sorted({family(x) for x in languages})
    family_of = np.array([families.index(family(x)) for x in languages])
    pairs = [p for p in combinations(range(len(languages)), 2) if family_of[p[0]] == family_of[p[1]]]
    found = []
    if len(families) > 1:
        for f in range(len(families)):
            found.append(_machine(examples, np.where(family_of[classes] == f, 1.0, -1.0)))
    else:
        found.append(np.zeros(_SIZE + 1))
    for a, b in pairs:
        rows_of = np.flatnonzero((classes == a) | (classes == b))
        signs = np.where(classes[rows_of] == a, 1.0, -1.0)
        found.append(_machine([examples[i] for i in rows_of], signs))
    table = np.stack(found, 1)
    return Model(
        languages, families, family_of, pairs, (SCALE * table[:-1]).astype(np.float32), table[-1]
    )


def _machine(examples, signs: np.ndarray) -> np.ndarray:
    share = np.array([(signs < 0).mean(), (signs > 0).mean()])
    cost = 5.0 / np.maximum(share[(signs > 0).astype(int)], 1e-9)
    return dual_coordinate_descent(examples, signs, _SIZE, cost)


def _margins(flat: Flat, model: Model) -> np.ndarray:
    n = len(flat.offsets) - 1
    totals, counts = np.zeros((n, len(model.biases))), np.zeros(n)
    for feature, text in _grams(flat):
        if not len(feature):
            continue
        begins = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
        owner = text[begins]
        totals[owner] += np.add.reduceat(model.weights[feature], begins, axis=0)
        counts[owner] += np.diff(np.append(begins, len(text)))
    return totals / np.maximum(counts, 1)[:, None] + model.biases


def _predict(flat: Flat, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Number of the language and the score of each text."""
    margins = _margins(flat, model)
    n, first = len(margins), len(model.families)
    best = margins[:, :first].argmax(1)
    score = sigmoid(4 * margins[np.arange(n), best]) if first > 1 else np.ones(n)
    votes = np.zeros((n, len(model.languages)))
    sums = np.zeros_like(votes)
    for k, (a, b) in enumerate(model.pairs):
        margin = margins[:, first + k]
        votes[np.arange(n), np.where(margin >= 0, a, b)] += 1
        sums[:, a] += margin
        sums[:, b] -= margin
    rank = votes + 0.5 * np.tanh(sums / max(1, len(model.languages)))
    rank[model.family_of[None, :] != best[:, None]] = -np.inf
    language = rank.argmax(1)
    weakest = np.ones(n)
    for k, (a, b) in enumerate(model.pairs):
        margin = margins[:, first + k]
        for own, sign in ((a, 1), (b, -1)):
            here = language == own
            weakest[here] = np.minimum(weakest[here], sigmoid(4 * sign * margin[here]))
    return language, score * weakest


def with_language(
    documents: DataFrame,
    model: Model | None,
    language: str = "lang_pred",
    score: str = "score",
    text_column: str = "text",
) -> DataFrame:
    """All rows and columns of the documents, the predicted language and its score."""
    text = F.col(text_column).cast("string")
    if model is None:
        return documents.withColumns({language: F.lit("und"), score: F.lit(0.0)})

    @F.arrow_udf("struct<language:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        found = [_predict(flatten(some.column("text")), model) for some in parts(batch, "text")]
        numbers = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        scores = np.concatenate([f[1] for f in found]) if found else np.zeros(0)
        names = pa.array(model.languages, pa.string()).take(pa.array(numbers))
        return pa.StructArray.from_arrays([names, pa.array(scores)], names=["language", "score"])

    has_letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    found, letter = free_name(documents, "_found"), free_name(documents, "_letter")
    return (
        documents.withColumns({found: predict(text), letter: has_letter})
        .withColumns(
            {
                language: F.when(F.col(letter), F.col(found)["language"]).otherwise("und"),
                score: F.when(F.col(letter), F.col(found)["score"]).otherwise(0.0),
            }
        )
        .drop(found, letter)
    )
