"""The fitted classifiers: held-out accuracy, defined results at the edges, and the parts
they are made of against slower versions."""

import random
import time
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from winback.llm import language, quality, toxicity
from winback.llm.learning import dual_coordinate_descent, held_out, labelled_texts, logistic
from winback.llm.texts import flatten

EDGES = [(9001, None), (9002, ""), (9003, " \n"), (9004, "!!"), (None, "plain words"), (9005, "a")]


def sentences(words, n, seed):
    random.seed(seed)
    return [" ".join(random.choices(words, k=random.randint(5, 40))) + "." for _ in range(n)]


PLAIN = "the of and to in that was for with this from have".split()


@pytest.fixture(scope="module")
def marked():
    """(doc_id, text, label): label 1 texts hold insults and keep to sentences; 0 shout."""
    rows = []
    for i, text in enumerate(sentences(PLAIN, 300, 1)):
        kind = i % 3
        if kind == 1:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if kind == 2:
            at = text.split()
            at.insert(len(at) // 2, random.choice(["grobnaxa", "grobnaxi", "grobnaxung", "vilefoo"]))
            text = " ".join(at)
        rows.append((i, text, int(kind != 1), int(kind == 2)))
    return rows


def tables(spark, frame, rows):
    labels = spark.createDataFrame(
        [(i, q, t, "?") for i, _, q, t in rows] + [(None, 1, 1, "?"), (7777, None, None, "?")],
        "doc_id long, quality int, toxic int, text string",
    )
    return frame([(i, t) for i, t, _, _ in rows] + EDGES), labels


def test_quality_is_learned_and_whole(spark, frame, marked):
    docs, labels = tables(spark, frame, marked)
    model = quality.fit(docs, labels, "quality", ~held_out("doc_id", 4, 2))
    scored = quality.with_score(docs, model, "quality_score")
    assert scored.columns == [*docs.columns, "quality_score"]
    got = {r.doc_id: r.quality_score for r in scored.collect()}
    assert len(got) == len(marked) + len(EDGES)
    assert all(0 <= s <= 1 for s in got.values())
    out = [(i, q) for i, _, q, _ in marked if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(out) > 30
    assert np.mean([(got[i] >= 0.5) == bool(q) for i, q in out]) >= 0.97
    assert got[9001] == got[9002] == got[9003]


def test_toxicity_scores_and_offsets(spark, frame, marked):
    docs, labels = tables(spark, frame, marked)
    model = toxicity.fit(docs, labels, "toxic", ~held_out("doc_id", 5, 0))
    scored = toxicity.with_score(docs, model, "toxic_score", "toxic_spans")
    got = {r.doc_id: (r.toxic_score, r.toxic_spans) for r in scored.collect()}
    assert len(got) == len(marked) + len(EDGES)
    out = [(i, t, x) for i, t, _, x in marked if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i][0] >= 0.5) == bool(x) for i, _, x in out]) >= 0.97
    for i, text, x in out:
        tagged = [text[s.first : s.stop] for s in got[i][1]]
        if x:
            assert tagged == [w for w in text.rstrip(".").split() if w not in PLAIN]
        else:
            assert tagged == []
    assert got[9001] == got[9002] and got[9001][1] == []


def test_offsets_count_characters(marked):
    bits = 12
    field = toxicity.Field(np.zeros((1 << bits) + 1), np.zeros((2, 2)), 0.0)
    chains = toxicity._cut(flatten(pa.array(["é日 bad 𝔘!"])), bits)
    word = chains.found.terms.to_pylist().index(b"bad")
    field.weights[:] = -1
    field.weights[chains.own[word, 0]] = 60
    model = toxicity.Model(field, np.array([1.0, 0.0, 0.0, 0.0]), None, bits)
    _, first, stop, counts = toxicity._tagged(flatten(pa.array(["é日 bad 𝔘!", "", None])), model)
    assert (first.tolist(), stop.tolist(), counts.tolist()) == ([3], [6], [1, 0, 0])


def test_forward_backward_equals_the_sum_over_all_tags():
    random = np.random.default_rng(3)
    first = np.array([True, False, False, False, True, True, False])
    potentials, moves, start = random.normal(size=7), random.normal(size=(2, 2)), 0.3
    field = toxicity.Field(np.zeros(1), moves, start)
    ahead, behind = toxicity._forward_backward(potentials, first, field)
    got = 1 / (1 + np.exp(-(ahead + behind)))
    want, at = [], 0
    for length in (4, 1, 2):
        mass = np.zeros((length, 2))
        for tags in product((0, 1), repeat=length):
            total = start * tags[0] + sum(p for p, t in zip(potentials[at:], tags) if t)
            total += sum(moves[a, b] for a, b in zip(tags, tags[1:]))
            for place, tag in enumerate(tags):
                mass[place, tag] += np.exp(total)
        want += (mass[:, 1] / mass.sum(1)).tolist()
        at += length
    assert np.allclose(got, want)


def test_field_gradient_points_uphill():
    """The fitted field explains its tags better than it did before fitting."""
    chains = toxicity._cut(flatten(pa.array(["a b c bad d. bad e", "c d e. a b"])), 10)
    tags = np.array([chains.found.terms[c].as_py() == b"bad" for c in chains.found.codes.tolist()], float)
    field = toxicity._fit_field(chains, tags, np.ones(len(tags), bool), 10)
    assert ((toxicity.marginals(chains, field) > 0.5) == tags.astype(bool)).all()


def test_long_sentences_are_one_chain():
    """Messages passed stretch by stretch equal those passed word by word."""
    rng = np.random.default_rng(4)
    first = np.zeros(1000, bool)
    first[[0, 1, 64, 65, 129, 300, 428, 990]] = True
    potentials = rng.normal(size=1000) * 2
    field = toxicity.Field(np.zeros(1), np.array([[0.3, -1.0], [0.2, 1.1]]), -0.7)
    ahead, behind = toxicity._forward_backward(potentials, first, field)
    (m00, m01), (m10, m11) = field.moves
    for t in range(1000):
        want = field.start
        if not first[t]:
            r = ahead[t - 1]
            want = np.logaddexp(m01, m11 + r) - np.logaddexp(m00, m10 + r)
        assert ahead[t] == pytest.approx(potentials[t] + want, abs=1e-9)
    for t in range(999, -1, -1):
        want = 0.0
        if t < 999 and not first[t + 1]:
            r = potentials[t + 1] + behind[t + 1]
            want = np.logaddexp(m10, m11 + r) - np.logaddexp(m00, m01 + r)
        assert behind[t] == pytest.approx(want, abs=1e-9)


def test_a_text_without_sentence_ends_is_one_chain():
    chains = toxicity._cut(flatten(pa.array([" ".join(["word"] * 300_000), "a b. c"])), 12)
    assert np.flatnonzero(chains.first).tolist() == [0, 300_000, 300_002]
    field = toxicity.Field(np.zeros((1 << 12) + 1), np.array([[0.0, -2.0], [0.0, 0.0]]), -2.0)
    begun = time.time()
    assert len(toxicity.marginals(chains, field)) == 300_003
    assert time.time() - begun < 20


@pytest.mark.parametrize("module, label", [(quality, "quality"), (toxicity, "toxic")])
@pytest.mark.parametrize("seen", [[], [1, 1, 1]])
def test_without_two_classes_the_score_is_the_smoothed_share(spark, frame, module, label, seen):
    docs = frame([(i, "some words here") for i in range(3)] + EDGES)
    rows = [(i, v, v) for i, v in enumerate(seen)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    model = module.fit(docs, labels, label, F.lit(True))
    got = {r.s for r in module.with_score(docs, model, "s").collect()}
    assert got == {(len(seen) + 1) / (len(seen) + 2)}
    assert module.with_score(frame([]), model, "s").count() == 0


def test_sample_is_bounded_per_class_and_settles_conflicts(spark, frame):
    docs = frame([(i, f"text {i}") for i in range(50)] + [(0, "a smaller text"), (0, None)])
    rows = [(i, i % 2) for i in range(50)] + [(0, 1), (0, 1), (3, None)]
    labels = spark.createDataFrame(rows, "doc_id long, y int")
    sample, sizes = labelled_texts(docs, labels, "y", F.lit(True), 10)
    assert sizes == {0: 24, 1: 26}
    assert sorted(sample.column("label").to_pylist()) == [0] * 10 + [1] * 10
    every, _ = labelled_texts(docs, labels, "y", F.lit(True), 100)
    assert every.num_rows == 50
    assert (1, "") in zip(*every.to_pydict().values())


def test_support_vectors_meet_the_optimality_conditions():
    random = np.random.default_rng(0)
    x = random.normal(size=(80, 5))
    signs = np.where(x[:, 0] + 0.2 * random.normal(size=80) > 0, 1.0, -1.0)
    examples = [(np.arange(5), row) for row in x]
    weights = dual_coordinate_descent(examples, signs, 5, 1.0, rounds=3000, tolerance=1e-10)

    def loss(w):
        return 0.5 * w @ w + np.maximum(0, 1 - signs * (x @ w[:5] + w[5])).sum()

    best = loss(weights)
    for _ in range(300):
        assert loss(weights + 0.01 * random.normal(size=6)) >= best - 1e-9


def test_logistic_curve_is_calibrated():
    random = np.random.default_rng(1)
    x = random.normal(size=(4000, 1))
    y = random.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))
    slope, level = logistic(x, y.astype(float), np.ones(4000), 1e-6)
    assert abs(slope - 2) < 0.25 and abs(level + 1) < 0.2


def test_distinct_n_grams_are_counted_once():
    features, counts = quality.n_grams(flatten(pa.array(["a b a b a b", "", None, "X"])), 18)
    # a, b, "a b", "b a", the form, the form repeated never, pairs and triples of forms.
    assert counts.tolist() == [7, 0, 0, 2]
    assert len(features) == counts.sum()


VOCABULARY = {
    "en": "the and with which water bright thought over".split(),
    "de": "und nicht mit der schlüssel über zwischen ich".split(),
    "fr": "le et avec où être château peut-être beaucoup".split(),
    "es": "el y con dónde niño español mañana muchos".split(),
    "xx": "qaqa zuzu qizi wawu xaxo zezo".split(),
}


@pytest.mark.parametrize("names", [["en", "de", "fr", "es", "xx"], ["en", "de"], ["fr"]])
def test_languages(spark, names):
    rows, i = [], 0
    for name in names:
        for text in sentences(VOCABULARY[name], 60, ord(name[0])):
            rows.append((i, text, name, "?"))
            i += 1
    rows += [(i + k, t, None, "?") for k, t in enumerate([None, "", "12 34 !?", "\n"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, other string")
    model = language.fit(docs, ~held_out("doc_id", 5, 0))
    got = language.with_language(docs, model).collect()
    assert len(got) == len(rows)
    right = [r.lang_pred == r.lang for r in got if r.lang and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean(right) >= 0.98
    assert {(r.lang_pred, r.score) for r in got if r.lang is None} == {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in got)


def test_sample_of_languages_is_bounded_by_text(spark, monkeypatch):
    """A thousand rows of one id, and copies, give no more than the bound of each language."""
    seen = []
    real = language._examples
    monkeypatch.setattr(language, "_examples", lambda flat: seen.append(len(flat.offsets) - 1) or real(flat))
    texts = sentences(VOCABULARY["en"], 1000, 3)
    rows = [(7, t, "en") for t in texts] + [(None, t, "de") for t in sentences(VOCABULARY["de"], 1000, 4)]
    rows += [(8, texts[0], "en")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, F.lit(True), per_language=20)
    assert seen == [40] and model.languages == ["de", "en"]


def test_nothing_learned_is_und(spark, frame, messy):
    docs = frame(messy)
    assert language.fit(docs, F.lit(True)) is None
    got = language.with_language(docs, None).select("lang_pred", "score").distinct().collect()
    assert [tuple(r) for r in got] == [("und", 0.0)]


def test_families_hold_each_code_once():
    codes = [c for group in language.FAMILIES.values() for c in group]
    assert len(codes) == len(set(codes))
    assert language.family("xx") == "xx"
