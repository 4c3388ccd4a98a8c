"""Packing: every piece once, gapless, within the capacity, in few sequences."""

from collections import Counter, defaultdict

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.test_token_shards import WORDS, crc, encoded
from winback.llm import packing
from winback.llm.packing_plan import best_plan, groups_of, plan


def check(counts, runs, sequences, capacity):
    held, seen = defaultdict(list), defaultdict(list)
    for run in runs:
        for place in range(run.first, run.stop):
            later, slot = divmod(place - run.first, run.each)
            held[run.sequence + later].append((run.offset + slot * run.length, run.length))
            seen[run.length].append(place)
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(n)) for k, n in counts.items()}
    assert set(held) == set(range(sequences))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity


@settings(max_examples=120, deadline=None)
@given(
    lengths=st.lists(st.integers(1, 24), max_size=80),
    groups=st.sampled_from([1, 3, 40]),
    small=st.sampled_from([0.0, 0.1, 0.5, 1.0]),
)
def test_plan_places_every_length(lengths, groups, small):
    counts = Counter(lengths)
    check(counts, *plan(counts, 24, groups, small), 24)


def test_groups_have_equal_cardinality():
    found = groups_of({9: 5, 7: 4, 3: 3}, 4)
    assert [sum(n for _, n in group) for group in found] == [3, 3, 3, 3]
    assert [group[0][0] for group in found] == [9, 9, 7, 3]


def test_plan_is_near_the_bound_and_does_not_grow_with_counts():
    counts = {length: 1 + (length * 37) % 11 for length in range(20, 2000, 3)}
    many = {k: v * 100_000 for k, v in counts.items()}
    runs, sequences = best_plan(many, 2048)
    bound = -(-sum(k * v for k, v in many.items()) // 2048)
    assert bound <= sequences <= 1.02 * bound
    assert len(runs) < 20_000


def test_pieces_are_whole_and_gapless(spark, frame, messy):
    got = packing.pack(frame(messy), 64, WORDS, "white_space", with_ids=True).collect()
    want = Counter()
    for (name, _), ids in zip(messy, encoded(messy, WORDS)):
        for at in range(0, len(ids), 64):
            held = ids[at : at + 64]
            want[name, at // 64, at, len(held), crc(held)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert all(len(r.ids) == 4 * r.length for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(sequences) <= 1.05 * total / 64 + 1


def test_no_documents_pack_to_nothing(spark, frame):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.pack(frame([]), 64, path, "white_space").count() == 0


def test_a_length_that_most_pieces_share(spark, frame):
    rows = [(i, "one two three") for i in range(300)] + [(1000 + i, "four " * i) for i in range(60)]
    got = packing.pack(frame(rows), 64, WORDS, "white_space").collect()
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got) == 360
    assert len({r.sequence_id for r in got}) <= sum(r.length for r in got) / 64 * 1.1 + 1
