"""Quality of texts by naive Bayes support vectors.

A text is the set of its n-grams: words and word pairs in lower case, and single, double
and triple forms of words (what classes of characters follow one another, and whether a
word repeats the one before). N-grams are hashed. Each indicator is scaled by the log ratio
of its counts in the two classes, the set is brought to length one, and a hinge loss is
fitted by dual coordinate descent on a bounded sample per class. Margins become
probabilities by a logistic curve on a part of the sample that the fit did not see, with
the classes weighted as all labels have them.

The model (a weight per hashed n-gram) is a few megabytes whatever the corpus. Null and
empty texts have no n-grams and get the curve's value at the bias. Without labels of both
classes every score is the share of label 1, evenly smoothed.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winback.llm.learning import (
    class_weights,
    classes_of,
    curve_rows,
    dual_coordinate_descent,
    labelled_texts,
    logistic,
    score_column,
    sigmoid,
)
from winback.llm.texts import (
    NOT_SPACE,
    PART_BYTES,
    Flat,
    Words,
    binary_array,
    flatten,
    hash_bytes,
    lower_ascii,
    parts,
    words,
)

FEATURE_BITS = 18
PER_CLASS = 2_000
# Texts whose n-grams are sorted together: their number and the feature fill 31 bits.
TOGETHER = 1 << 13

# Upper case, lower case (and everything outside ASCII), digits; other bytes stand for themselves.
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[0x41:0x5B] = ord("A")
_CLASS[0x61:0x7B] = ord("a")
_CLASS[0x80:] = ord("a")
_CLASS[0x30:0x3A] = ord("0")


# Odd factors that keep kinds of n-grams and their places apart.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class Model(NamedTuple):
    weights: np.ndarray  # weight times log ratio per feature, float32
    bias: float
    curve: tuple[float, float]
    constant: float | None


def _forms(terms: pa.Array) -> pa.Array:
    """Each word's classes of characters, runs as one."""
    flat = flatten(terms)
    classes = _CLASS[flat.data]
    kept = np.ones(len(classes), bool)
    kept[1:] = classes[1:] != classes[:-1]
    starts = flat.offsets[:-1][np.diff(flat.offsets) > 0]
    kept[starts] = True
    upto = np.concatenate(([0], np.cumsum(kept)))
    return binary_array(classes[kept], np.diff(upto[flat.offsets]))


def _features(found: Words, lowered: np.ndarray, forms: np.ndarray, bits: int):
    """(text, feature) of every n-gram, text by text in no order."""
    texts = np.repeat(np.arange(len(found.bounds) - 1, dtype=np.uint32), np.diff(found.bounds))
    codes = found.codes
    word, form = lowered[codes], forms[codes].copy()
    same = np.zeros(len(codes), bool)
    same[1:] = (word[1:] == word[:-1]) & (texts[1:] == texts[:-1])
    form[same] ^= np.uint64(0x5851F42D4C957F2D)
    shift = np.uint64(64 - bits)
    with np.errstate(over="ignore"):
        one, two, three = map(np.uint64, _FACTORS)
        pairs = texts[1:] == texts[:-1]
        triples = pairs[1:] & pairs[:-1]
        for owner, value in (
            (texts, word * one),
            (texts[1:][pairs], (word[:-1] * two + word[1:] * three)[pairs]),
            (texts, form * two),
            (texts[1:][pairs], (form[:-1] * three + form[1:] * one)[pairs]),
            (texts[2:][triples], (form[:-2] * one + form[1:-1] * two + form[2:] * three)[triples]),
        ):
            value = (value ^ (value >> np.uint64(29))) * two
            yield owner, (value >> shift).astype(np.uint32)


def n_grams(flat: Flat, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of all texts end to end, and how many each text has."""
    found = words(flat, NOT_SPACE)
    terms = flatten(found.terms)
    lowered = hash_bytes(binary_array(lower_ascii(terms.data), np.diff(terms.offsets)), 63)
    forms = hash_bytes(_forms(found.terms), 63, 1)
    out, counts = [], []
    for at in range(0, len(found.bounds) - 1, TOGETHER):
        bounds = found.bounds[at : at + TOGETHER + 1]
        some = found._replace(codes=found.codes[bounds[0] : bounds[-1]], bounds=bounds - bounds[0])
        keys = np.concatenate(
            [
                (owner << np.uint32(bits)) | feature
                for owner, feature in _features(
                    some, lowered.astype(np.uint64), forms.astype(np.uint64), bits
                )
            ]
        )
        keys.sort()
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        keys = keys[first]
        out.append(keys & np.uint32((1 << bits) - 1))
        counts.append(np.bincount(keys >> np.uint32(bits), minlength=len(bounds) - 1))
    if not out:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(counts)


def fit(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    learned: Column,
    per_class: int = PER_CLASS,
    bits: int = FEATURE_BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Model:
    """A model from at most `per_class` labelled texts of each class."""
    sample, sizes = labelled_texts(
        documents, labels, label, learned, per_class, id_column, text_column
    )
    classes = sample.column("label").to_numpy()
    present = {v: sizes[v] for v in (0, 1) if (classes == v).any()}
    constant = classes_of(present)
    size = 1 << bits
    if constant is not None:
        return Model(np.zeros(size, np.float32), 0.0, (0.0, 0.0), constant)
    rows = []
    for batch in sample.select(["text"]).to_batches():
        for some in parts(batch, "text"):
            features, counts = n_grams(flatten(some.column("text")), bits)
            rows += np.split(features.astype(np.int32), np.cumsum(counts)[:-1])
    curve_part = curve_rows(classes)
    fit_part = ~curve_part if not curve_part.all() else curve_part
    counts = np.ones((2, size))
    for i in np.flatnonzero(fit_part):
        counts[classes[i], rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    examples = [(r, (ratio[r] / np.sqrt(max(1, len(r)))).astype(np.float32)) for r in rows]
    chosen = np.flatnonzero(fit_part)
    signs = np.where(classes[chosen] == 1, 1.0, -1.0)
    share = np.array([(classes[chosen] == v).mean() for v in (0, 1)])
    found = dual_coordinate_descent(
        [examples[i] for i in chosen], signs, size, 0.5 / share[classes[chosen]]
    )
    margins = np.array([found[r] @ v + found[size] for r, v in examples])
    weighted = class_weights(classes[curve_part], present)
    slope, level = logistic(margins[curve_part, None], classes[curve_part], weighted)
    return Model(
        (found[:size] * ratio).astype(np.float32), float(found[size]), (float(slope), float(level)), None
    )


def scorer(model: Model, bits: int = FEATURE_BITS):
    """A column function from whole texts to the probability of label 1."""

    def score(texts: pa.Array) -> np.ndarray:
        if model.constant is not None:
            return np.full(len(texts), model.constant)
        batch, out = pa.RecordBatch.from_arrays([texts], names=["text"]), []
        for some in parts(batch, "text", PART_BYTES):
            features, counts = n_grams(flatten(some.column("text")), bits)
            totals = np.concatenate(([0.0], np.cumsum(model.weights[features], dtype=np.float64)))
            ends = np.cumsum(counts)
            sums = totals[ends] - totals[ends - counts]
            margins = sums / np.sqrt(np.maximum(counts, 1)) + model.bias
            out.append(sigmoid(model.curve[0] * margins + model.curve[1]))
        return np.concatenate(out) if out else np.zeros(0)

    return score_column(score)


def with_score(
    documents: DataFrame, model: Model, name: str = "score", text_column: str = "text"
) -> DataFrame:
    """All rows and columns of the documents and their score."""
    return documents.withColumn(name, scorer(model)(F.col(text_column).cast("string")))
