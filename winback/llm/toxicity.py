"""Toxic spans by a linear-chain conditional random field, and scores of whole documents.

Words are tagged toxic or not. Chains are the words between two ends of sentences, however
many; every word of a text is in one chain. The potential of a word's tag adds the
weights of the word, its prefixes and suffix, and of its two neighbours (hashed), and a
tag's potential depends on the tag before.

Labelled tokens come from labelled documents: a word is tagged toxic in a toxic document if
it, or one of its prefixes, is so much more common in toxic documents that chance does not
explain it (binomial bound), and most documents that have it are toxic. Weights are fitted by
gradient steps on the likelihood of these chains. Forward-backward gives each word its
marginal; the largest and the sum of those above one half, also per hundred words, make the document's
score through a logistic curve (fitted on every fourth text, which the rest did not see), and
runs of words above one half are the offending spans.

Null and empty texts, and texts without words, have no spans and the curve's lowest score.
Without labels of both classes every score is the evenly smoothed share of label 1 and no
word is toxic. Rows are scored alone, so repeated rows get equal scores. Model and sample
have a fixed bound; the model travels with the column function.
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
    labelled_texts,
    logistic,
    sigmoid,
)
from winback.llm.rows import free_name
from winback.llm.texts import (
    LETTERS_AND_DIGITS,
    Flat,
    Words,
    binary_array,
    byte_set,
    flatten,
    hash_bytes,
    lower_ascii,
    parts,
    words,
)

FEATURE_BITS = 20
PER_CLASS = 800
# Words whose messages are passed one by one; longer chains are joined from stretches of so many.
STRETCH = 64
# Words count towards a document's sum if they are toxic rather than not.
LIKELY = 0.5
# Bytes of a word that its prefixes (if the word goes on) and its suffix take.
PREFIXES = (3, 4, 5, 6, 7, 8)
SUFFIX = 3
# Evidence, in nats, that a feature's documents are not toxic by chance, and the share of
# documents with the feature that must be toxic.
EVIDENCE = 10.0
PRECISION = 0.75

_ENDS = byte_set((0x0A, 0x0A), (0x0D, 0x0D), (0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))


class Chains(NamedTuple):
    """Words of a batch in order, cut into chains."""

    found: Words
    own: np.ndarray  # distinct words x features of the word itself
    beside: np.ndarray  # distinct words x (as left neighbour, as right neighbour)
    first: np.ndarray  # true where a chain begins


def _cut(flat: Flat, bits: int) -> Chains:
    lowered = flat._replace(data=lower_ascii(flat.data))
    found = words(lowered, LETTERS_AND_DIGITS)
    terms = flatten(found.terms)
    lengths = np.diff(terms.offsets)
    own = [hash_bytes(found.terms, bits)]
    for k, size in enumerate(PREFIXES):
        beginning = hash_bytes(_slices(terms, lengths, size, False), bits, 11 + k)
        # The last number stands for no feature.
        own.append(np.where(lengths > size, beginning, 1 << bits))
    own.append(hash_bytes(_slices(terms, lengths, SUFFIX, True), bits, 31))
    beside = [hash_bytes(found.terms, bits, 41), hash_bytes(found.terms, bits, 43)]
    n = len(found.codes)
    first = np.zeros(n, bool)
    if n:
        ends = np.concatenate(([0], np.cumsum(_ENDS[flat.data])))
        text_starts = found.bounds[:-1]
        first[text_starts[text_starts < n]] = True
        first[1:] |= ends[found.starts[1:]] != ends[found.ends[:-1]]
    return Chains(
        found, np.stack(own, 1).astype(np.int32), np.stack(beside, 1).astype(np.int32), first
    )


def _slices(terms: Flat, lengths: np.ndarray, size: int, last: bool) -> pa.Array:
    """The first or last `size` bytes of each word."""
    each = np.minimum(lengths, size)
    starts = terms.offsets[1:] - each if last else terms.offsets[:-1]
    at = np.repeat(starts - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))
    return binary_array(terms.data[at], each)


class Field(NamedTuple):
    """Weights of the features, and of a tag given the one before (rows: before)."""

    weights: np.ndarray
    moves: np.ndarray  # 2 x 2
    start: float


def _potentials(chains: Chains, weights: np.ndarray) -> np.ndarray:
    """How much more each word speaks for toxic than against."""
    codes, first = chains.found.codes, chains.first
    own = weights[chains.own].sum(1)
    left, right = weights[chains.beside[:, 0]], weights[chains.beside[:, 1]]
    out = own[codes]
    inner = ~first[1:]
    out[1:][inner] += left[codes[:-1]][inner]
    out[:-1][inner] += right[codes[1:]][inner]
    return out


def _live(lengths: np.ndarray) -> list[int]:
    """How many stretches, longest first, are longer than each step."""
    return [int(np.searchsorted(-lengths, -step, "left")) for step in range(int(lengths[0]) + 1)]


def _step_ahead(before: np.ndarray, moves) -> np.ndarray:
    (m00, m01), (m10, m11) = moves
    return np.logaddexp(m01, m11 + before) - np.logaddexp(m00, m10 + before)


def _step_behind(after: np.ndarray, moves) -> np.ndarray:
    (m00, m01), (m10, m11) = moves
    return np.logaddexp(m10, m11 + after) - np.logaddexp(m00, m01 + after)


def _fill_ahead(ahead, potentials, begins, lengths, moves) -> None:
    """Forward messages of stretches whose first one is there."""
    order = np.argsort(-lengths, kind="stable")
    begins, live = begins[order], _live(lengths[order])
    for step in range(1, len(live) - 1):
        at = begins[: live[step]] + step
        ahead[at] = potentials[at] + _step_ahead(ahead[at - 1], moves)


def _fill_behind(behind, potentials, begins, lengths, moves) -> None:
    """Backward messages of stretches whose last one is there."""
    order = np.argsort(-lengths, kind="stable")
    begins, live = begins[order], _live(lengths[order])
    for step in range(len(live) - 2, 0, -1):
        at = begins[: live[step]] + step
        behind[at - 1] = _step_behind(potentials[at] + behind[at], moves)


def _transfers(potentials, begins, lengths, moves) -> np.ndarray:
    """Per stretch, 2 x 2: the log weight of all tags in it, from the tag before its first
    word to the tag of its last."""
    order = np.argsort(-lengths, kind="stable")
    begins, live = begins[order], _live(lengths[order])
    out = np.empty((2, 2, len(begins)))
    out[:] = np.asarray(moves)[:, :, None]
    out[:, 1] += potentials[begins]
    for step in range(1, len(live) - 1):
        n = live[step]
        off, on = out[:, 0, :n].copy(), out[:, 1, :n].copy()
        out[:, 0, :n] = np.logaddexp(off + moves[0][0], on + moves[1][0])
        out[:, 1, :n] = np.logaddexp(off + moves[0][1], on + moves[1][1]) + potentials[begins[:n] + step]
    unsorted = np.empty_like(out)
    unsorted[:, :, order] = out
    return unsorted


def _forward_backward(
    potentials: np.ndarray, first: np.ndarray, field: Field
) -> tuple[np.ndarray, np.ndarray]:
    """Log ratios (toxic to not) of the forward and of the backward messages at each word.

    With two tags a message is one ratio. All stretches take a step together. A chain of
    several stretches is passed through by their transfers first, which is exact: the message
    that enters a stretch and the product of its steps give the one that leaves it.
    """
    n = len(potentials)
    ahead, behind = np.zeros(n), np.zeros(n)
    if not n:
        return ahead, behind
    moves = field.moves
    index = np.arange(n)
    since = index - np.maximum.accumulate(np.where(first, index, 0))
    begins = np.flatnonzero(since % STRETCH == 0)
    lengths = np.diff(np.append(begins, n))
    start = since[begins] == 0
    heads, rest = begins[start], begins[~start]
    ahead[heads] = potentials[heads] + field.start
    _fill_ahead(ahead, potentials, heads, lengths[start], moves)
    if len(rest):
        # Stretches by their number in the chain: each number is one step for all chains.
        number = since[rest] // STRETCH
        order = np.argsort(number, kind="stable")
        rest, more = rest[order], lengths[~start][order]
        through = _transfers(potentials, rest, more, moves)
        last = rest + more - 1
        edges = np.searchsorted(number[order], np.arange(1, int(number.max()) + 2))
        spans = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        for a, b in spans:
            before = ahead[rest[a:b] - 1]
            ahead[rest[a:b]] = potentials[rest[a:b]] + _step_ahead(before, moves)
            ahead[last[a:b]] = _step_ahead(before, through[:, :, a:b])
        for a, b in reversed(spans):
            behind[rest[a:b] - 1] = _step_behind(behind[last[a:b]], through[:, :, a:b])
        _fill_ahead(ahead, potentials, rest, more, moves)
    _fill_behind(behind, potentials, begins, lengths, moves)
    return ahead, behind


def marginals(chains: Chains, field: Field) -> np.ndarray:
    ahead, behind = _forward_backward(_potentials(chains, field.weights), chains.first, field)
    return sigmoid(ahead + behind)


def _fit_field(
    chains: Chains, tags: np.ndarray, learned: np.ndarray, bits: int, rounds: int = 60
) -> Field:
    """Gradient steps (with a running scale per weight) on the mean log likelihood of the
    chains of learned words."""
    size = (1 << bits) + 1
    codes, first = chains.found.codes, chains.first
    inner = np.flatnonzero(~first[1:] & learned[1:])
    weights, moves, start = np.zeros(size), np.zeros((2, 2)), -2.0
    flat = np.zeros(size + 5)
    flat[-5:] = (0.0, -2.0, 0.0, 0.0, start)
    mean, square = np.zeros_like(flat), np.zeros_like(flat)
    n_terms = len(chains.own)
    total = max(1.0, tags[learned].sum())
    seen = np.bincount((2 * tags[inner] + tags[inner + 1]).astype(int), minlength=4)
    for step in range(1, rounds + 1):
        weights, moves, start = flat[:size], flat[size:-1].reshape(2, 2), flat[-1]
        field = Field(weights, moves, start)
        potentials = _potentials(chains, weights)
        ahead, behind = _forward_backward(potentials, first, field)
        error = np.where(learned, sigmoid(ahead + behind) - tags, 0)
        slope = np.zeros_like(flat)
        per_term = np.bincount(codes, error, n_terms)
        for k in range(chains.own.shape[1]):
            slope[:size] += np.bincount(chains.own[:, k], per_term, size)
        for k, (owner, other) in enumerate(((1, 0), (0, 1))):
            # The word beside, seen from the word whose tag it speaks for.
            per_term = np.bincount(codes[inner + other], error[inner + owner], n_terms)
            slope[:size] += np.bincount(chains.beside[:, k], per_term, size)
        # Expected moves between neighbours: forward, move, potential and backward.
        after = potentials[inner + 1] + behind[inner + 1]
        before = ahead[inner]
        joint = np.stack(
            (0 * after + moves[0, 0], after + moves[0, 1], before + moves[1, 0], before + after + moves[1, 1])
        ).astype(np.float32)
        joint -= joint.max(0)
        np.exp(joint, out=joint)
        joint /= joint.sum(0)
        slope[size:-1] = joint.sum(1, dtype=np.float64) - seen
        slope[-1] = error[first].sum()
        slope = slope / total + 1e-4 * flat
        slope[size - 1] = 0
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        flat = flat - 0.2 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return Field(flat[:size].astype(np.float32), flat[size:-1].reshape(2, 2).copy(), float(flat[-1]))


class Model(NamedTuple):
    field: Field | None
    curve: np.ndarray | None
    constant: float | None
    bits: int


def _tags(
    chains: list[Chains],
    classes: np.ndarray,
    weights: np.ndarray,
    learned: np.ndarray,
    texts: list[int],
    bits: int,
) -> list[np.ndarray]:
    """Tags of all words, from how common words and prefixes are in the learned toxic texts."""
    size = (1 << bits) + 1
    seen = np.zeros((2, size))
    kinds = chains[0].own.shape[1] - 1 if chains else 0
    at = 0
    for some, n in zip(chains, texts):
        for i in np.flatnonzero(learned[at : at + n]).tolist():
            a, b = some.found.bounds[i : i + 2]
            held = np.unique(some.own[np.unique(some.found.codes[a:b]), :kinds])
            seen[classes[at + i], held] += 1
        at += n
    # By chance a feature's document is toxic with the toxic share, smoothed; the tail of
    # the binomial distribution is bounded by the divergence of the two shares.
    share = (classes[learned].sum() + 1) / (learned.sum() + 2)
    count = seen.sum(0)
    rate = np.clip(seen[1] / np.maximum(count, 1), share, 1 - 1e-9)
    evidence = count * (
        rate * np.log(rate / share) + (1 - rate) * np.log((1 - rate) / (1 - share))
    )
    each = [weights[classes == v].mean() for v in (0, 1)]
    precision = each[1] * seen[1] / np.maximum(each[0] * seen[0] + each[1] * seen[1], 1e-9)
    strong = (evidence >= EVIDENCE) & (precision >= PRECISION)
    strong[-1] = False
    out, at = [], 0
    for some, n in zip(chains, texts):
        toxic = np.repeat(classes[at : at + n] == 1, np.diff(some.found.bounds))
        word = strong[some.own[:, :kinds]].any(axis=1)
        out.append((word[some.found.codes] & toxic).astype(float))
        at += n
    return out


def _joined(chains: list[Chains]) -> Chains:
    """Several batches as one, with distinct words per batch."""
    shift = np.cumsum([0] + [len(c.own) for c in chains])
    codes = np.concatenate([c.found.codes + s for c, s in zip(chains, shift)])
    before = np.cumsum([0] + [len(c.found.codes) for c in chains])
    bounds = [c.found.bounds[:-1] + b for c, b in zip(chains, before)] + [before[-1:]]
    found = Words(codes, pa.array([], pa.binary()), np.concatenate(bounds), before[:0], before[:0])
    return Chains(
        found,
        np.concatenate([c.own for c in chains]),
        np.concatenate([c.beside for c in chains]),
        np.concatenate([c.first for c in chains]),
    )


def _evidence(marginal: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: the largest marginal, and the logarithms of one plus the sum of the toxic
    ones, in all and per hundred words."""
    n = len(bounds) - 1
    out = np.zeros((n, 3))
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        begins = bounds[:-1][some]
        out[some, 0] = np.maximum.reduceat(marginal, begins)
        sums = np.add.reduceat(np.where(marginal >= LIKELY, marginal, 0), begins)
        out[some, 1] = np.log1p(sums)
        out[some, 2] = np.log1p(100 * sums / np.diff(bounds)[some])
    return out


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
    # Copies of a text would count as evidence each.
    sample = sample.group_by("text", use_threads=False).aggregate([("label", "min")])
    classes = sample.column("label_min").to_numpy()
    present = {v: sizes[v] for v in (0, 1) if (classes == v).any()}
    constant = classes_of(present)
    if constant is not None:
        return Model(None, None, constant, bits)
    chains, texts = [], []
    for batch in sample.select(["text"]).to_batches():
        for some in parts(batch, "text"):
            chains.append(_cut(flatten(some.column("text")), bits))
            texts.append(some.num_rows)
    weights = class_weights(classes, present)
    curve_part = curve_rows(classes)
    seen = ~curve_part if not curve_part.all() else curve_part
    tags = _tags(chains, classes, weights, seen, texts, bits)
    every, tags = _joined(chains), np.concatenate(tags)
    del chains
    sizes_in_words = np.diff(every.found.bounds)
    field = _fit_field(every, tags, np.repeat(seen, sizes_in_words), bits)
    evidence = _evidence(marginals(every, field), every.found.bounds)
    curve = logistic(evidence[curve_part], classes[curve_part], weights[curve_part])
    return Model(field, curve, None, bits)


_RESULT = "struct<score:double,spans:array<struct<first:int,stop:int>>>"


def scorer(model: Model):
    """A column function from whole texts to a score and the character offsets of toxic spans."""

    @F.arrow_udf(_RESULT)
    def tagged(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        found = [_tagged(flatten(some.column("text")), model) for some in parts(batch, "text")]
        scores = np.concatenate([f[0] for f in found]) if found else np.zeros(0)
        first = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        stop = np.concatenate([f[2] for f in found]) if found else np.zeros(0, np.int64)
        counts = np.concatenate([f[3] for f in found]) if found else np.zeros(0, np.int64)
        spans = pa.StructArray.from_arrays(
            [pa.array(first, pa.int32()), pa.array(stop, pa.int32())], names=["first", "stop"]
        )
        edges = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
        return pa.StructArray.from_arrays(
            [pa.array(scores, pa.float64()), pa.ListArray.from_arrays(edges, spans)],
            names=["score", "spans"],
        )

    return tagged


def _tagged(flat: Flat, model: Model):
    n = len(flat.offsets) - 1
    nothing = np.zeros(0, np.int64)
    if model.constant is not None:
        return np.full(n, model.constant), nothing, nothing, np.zeros(n, np.int64)
    chains = _cut(flat, model.bits)
    found = chains.found
    marginal = marginals(chains, model.field)
    scores = sigmoid(_evidence(marginal, found.bounds) @ model.curve[:-1] + model.curve[-1])
    toxic = np.concatenate(([False], marginal >= 0.5, [False]))
    begins = toxic[1:-1] & (~toxic[:-2] | chains.first)
    ends = toxic[1:-1] & (~toxic[2:] | np.append(chains.first[1:], True))
    first, stop = found.starts[begins], found.ends[ends]
    owner = np.searchsorted(flat.offsets, first, "right") - 1
    # Offsets count characters, so bytes that continue one do not.
    upto = np.concatenate(([0], np.cumsum((flat.data & 0xC0) != 0x80)))
    base = upto[flat.offsets[owner]]
    return scores, upto[first] - base, upto[stop] - base, np.bincount(owner, minlength=n)


def with_score(
    documents: DataFrame,
    model: Model,
    name: str = "score",
    spans: str | None = None,
    text_column: str = "text",
) -> DataFrame:
    """All rows and columns of the documents, their score, and their toxic spans if named."""
    tagged = scorer(model)(F.col(text_column).cast("string"))
    held = free_name(documents, "_tagged")
    out = documents.withColumn(held, tagged).withColumn(name, F.col(held)["score"])
    if spans:
        out = out.withColumn(spans, F.col(held)["spans"])
    return out.drop(held)
