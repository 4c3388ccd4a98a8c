"""Spelling variants against plain Python over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from winback.llm import queries, spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_counts(rows, damage=97, least_length=5, least_count=3):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(CAPITALS)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damage and h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    at = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[at:] == b[at + 1 :] or (len(a) == len(b) and a[at + 1 :] == b[at + 1 :])


def plain_variants(counts):
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def found(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def variants_of(spark, counts):
    frame = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    rows = spelling.variants(frame).collect()
    assert len(rows) == len(counts)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_counts_of_messy_texts(spark, messy, frame):
    long = "Ab" * 3000
    rows = [*messy, (50, f"{long} ÀÉÿ× {long} àéÿ÷aB b's O'Neillé"), (51, long), (None, "wordy Wordy wORDy")]
    for damage in (97, 2):
        counted = spelling.word_counts(frame(rows), damage=damage)
        assert {r.word: r.n for r in counted.collect()} == plain_counts(rows, damage)
    plain = spelling.word_counts(frame(rows), least_length=1, least_count=1)
    assert {r.word: r.n for r in plain.collect()} == plain_counts(rows, None, 1, 1)


def test_pairs_of_few_letters(spark):
    """Words over two letters: repeated grams, ties of rarity, many neighbours."""
    random.seed(1)
    words = {"".join(random.choices("ab", k=random.randint(5, 9))) for _ in range(250)}
    words |= {"aaaaa", "aaaaaa", "aaaaaaa", "bbbbbb", "ababab", "bababa", "a" * 300, "a" * 301}
    counts = {w: random.randint(3, 60) for w in words}
    assert variants_of(spark, counts) == plain_variants(counts)


def test_pairs_of_many_letters(spark):
    random.seed(2)
    letters = "abcdefgéèàñz"
    base = ["".join(random.choices(letters, k=random.randint(5, 12))) for _ in range(120)]
    words = set(base)
    for w in base:
        for _ in range(4):
            at, c = random.randrange(len(w) + 1), random.choice(letters)
            words |= {w[:at] + c + w[at:], w[:at] + c + w[at + 1 :], w[:at] + w[at + 1 :]}
    counts = {w: random.choice([3, 3, 6, 12, 25, 100]) for w in words if len(w) >= 5}
    assert variants_of(spark, counts) == plain_variants(counts)


def test_chain_of_forms(spark):
    counts = {"a" * 5 + "b" * k: 3 * 2**k for k in range(12)}
    got = variants_of(spark, counts)
    assert got == plain_variants(counts)
    assert got["aaaaa"][1] == "a" * 5 + "b" * 11


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = np.random.default_rng(3)
    places = np.sort(np.array([rng.choice(9, 3, replace=False) for _ in range(300)]), axis=1)
    costs = rng.integers(0, 20, places.shape)
    for p, c, chosen in zip(places.tolist(), costs.tolist(), spelling._choose(places, costs).tolist(), strict=True):
        cost = dict(zip(p, c, strict=True))
        pairs = [(a, b) for a in p for b in p if b - a >= 2]
        assert tuple(chosen) in pairs
        assert cost[chosen[0]] + cost[chosen[1]] == min(cost[a] + cost[b] for a, b in pairs)


def test_empty_table(spark):
    counted = spelling.word_counts(spark.createDataFrame([], "doc_id long, text string"), damage=97)
    assert spelling.variants(counted).collect() == []


def test_query_equals_plain_python(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    counts = plain_counts(rows)
    # All pairs of words would take long here: words one apart share a word less one letter.
    shorter = {}
    for w in counts:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            shorter.setdefault(v, []).append(w)
    near = {w: set() for w in counts}
    for group in shorter.values():
        for w in group:
            near[w].update(v for v in group if one_apart(w, v))
    got = found(queries.op12_spelling_variants(spark, folder))
    assert {w: (n, k) for w, (_, _, n, k, _) in got.items()} == {w: (counts[w], len(near[w])) for w in counts}
    for w, (form, _, n, _, form_n) in got.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        assert form == (best if best and counts[best] >= 2 * n else None)
        assert form_n == (counts[form] if form else None)
