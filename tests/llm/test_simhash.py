"""SimHash fingerprints and components against all pairs, one by one."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from winback.llm import simhash
from winback.llm.components import components
from winback.llm.texts import flatten

LOWER = {c: c + 32 for c in range(65, 91)}


def fingerprint(text, size=3):
    held = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    lines = [" ".join(held[i : i + size]) for i in range(max(1, len(held) - size + 1))] if held else []
    hashes = [xxhash.xxh64_intdigest(line.encode(), 42) for line in lines]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, distance=3):
    """For each value the smallest position it reaches."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= distance:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def test_fingerprints_follow_the_definition(messy):
    texts = [t for _, t in messy if len(t or "") < 10_000]
    got = simhash.fingerprints_of(flatten(pa.array(texts, pa.string())), 3)
    assert got.tolist() == [fingerprint(t) for t in texts]


@pytest.mark.parametrize("distance, prefix", [(3, 8), (3, 4), (0, 8), (5, 6)])
def test_links_join_what_all_pairs_join(spark, distance, prefix):
    random.seed(distance * 100 + prefix)
    values = [random.getrandbits(64) for _ in range(60)]
    # Chains of near values, at the budget and one beyond it, also across subtrees.
    for v in list(values[:30]):
        for _ in range(4):
            v ^= sum(1 << b for b in random.sample(range(64), random.choice([1, 3, distance, distance + 1])))
            values.append(v)
    values += [0, 1, (1 << 64) - 1, (1 << 64) - 2, 1 << 63]
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    rows = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    found = components(simhash.links(rows, distance, prefix))
    got = {r.node: r.root for r in found.collect()}
    groups = {}
    for s, c in zip(signed, classes(values, distance)):
        groups.setdefault(c, set()).add(s)
    for group in groups.values():
        if len(group) == 1:
            assert next(iter(group)) not in got
        else:
            assert {got[s] for s in group} == {min(group)}


def test_components_of_documents(spark, frame, messy):
    rows = messy + [(900 + i, None) for i in range(3)] + [(None, ""), (950, messy[0][1])]
    got = simhash.near_duplicates(frame(rows)).collect()
    assert len(got) == len(rows)
    values = [fingerprint(t) for _, t in rows]
    least = {}
    for (i, _), c in zip(rows, classes(values)):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = sorted(
        (i is not None, i or 0, f"{v:016x}", least.get(c))
        for (i, _), v, c in zip(rows, values, classes(values))
    )
    digits = spark.createDataFrame(
        [(r.doc_id, r.fingerprint, r.component_id) for r in got], "doc_id long, f long, c long"
    ).select("doc_id", simhash.hex_digits("f").alias("f"), "c")
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.f, r.c) for r in digits.collect()) == want
    assert simhash.near_duplicates(frame([])).count() == 0


def test_long_chains_and_loops_become_one_component(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 500), (300, 301), (301, 300), (302, 300)]
    got = components(spark.createDataFrame(edges, "u long, v long"))
    found = {r.node: r.root for r in got.collect()}
    assert found == {i: 0 for i in range(201)} | {300: 300, 301: 300, 302: 300}
    assert got.count() == len(found)


def test_a_dense_group_is_one_tree_of_links(spark):
    values = np.array([a << 60 | b for a in range(4) for b in range(256)], np.uint64).view(np.int64)
    rows = spark.createDataFrame([(int(v),) for v in values], "fingerprint long")
    links = simhash.links(rows, 3)
    assert len({r.root for r in components(links).collect()}) == 1
    # Each meeting reports less links than members, never the pairs.
    assert links.count() < 8 * len(values)
