"""Token shards: the encoding equals the library's, and every shard decodes to its ids."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from winback.llm import repair, token_counts, token_shards
from winback.llm.encoding import Encoder
from winback.llm.texts import flatten
from winback.session import new_folder

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = " \n\t\r aé　́'sB1.,|<> 日"


@pytest.fixture(scope="module", params=[(BYTES, "byte_level"), (WORDS, "white_space"), (BYTES, None)])
def coder(request):
    return Encoder(*request.param, remembered=50)


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=ODD, max_size=30), max_size=8))
def test_encoding_equals_the_library(coder, texts):
    ids, counts = coder.encode(flatten(pa.array(texts, pa.string())))
    want = [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_a_mark_does_not_make_another_piece_of_its_word():
    coder = Encoder(BYTES, "byte_level")
    words = [f"w{chr(97 + i)}{last}" for i in range(20) for last in ("n", "é", "÷", "'s")]
    texts = [" ".join(w + mark for w in words for mark in ",.!?%") for _ in range(2)]
    texts += ["end.<|endoftext|>! of,endoftext|>", "Ã.\u00d7,", "it's,'re.'d!"]
    ids, counts = coder.encode(flatten(pa.array(texts, pa.string())))
    want = [e.ids for e in coder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    # Words and marks, not their products; a sign of division is no letter.
    assert coder.known.size < 3 * 20 + 5 * 20 + 30


@settings(max_examples=150, deadline=None)
@given(
    ids=st.lists(st.integers(0, 6), max_size=300),
    wide=st.booleans(),
    ends=st.tuples(st.integers(0, 300), st.integers(0, 300)),
)
def test_grammar_gives_back_every_range(ids, wide, ends):
    base = 70_000 if wide else 7
    data = repair.pack(np.array(ids, np.uint32), base, 2)
    decoder = repair.Decoder(repair.unpack(data))
    assert decoder.ids().tolist() == ids
    start, stop = sorted(ends)
    assert decoder.ids(start, stop).tolist() == ids[start:stop]


def test_grammar_shortens_repetition_and_keeps_lengths():
    ids = np.array([1, 2, 3, 1, 2, 3, 4] * 3000, np.uint32)
    shard = repair.unpack(repair.pack(ids, 50_000))
    assert len(shard.symbols) < len(ids) / 50
    decoder = repair.Decoder(shard)
    assert decoder.sizes[50_000:].tolist() == shard.lengths.tolist()
    assert decoder.ids(9_999, 10_020).tolist() == ids[9_999:10_020].tolist()
    with pytest.raises(ValueError):
        repair.unpack(repair.pack(ids, 50_000)[:-1])


def encoded(rows, path=BYTES, end=True):
    library = Tokenizer.from_file(path)
    texts = [t or "" for _, t in rows]
    return [e.ids + [0] * end for e in library.encode_batch(texts, add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_documents_come_back_in_order(spark, frame, messy):
    path = new_folder(spark, "test-shards")
    token_shards.write(frame(messy), path, BYTES, "byte_level", shard_ids=500)
    got = sorted(token_shards.read(spark, path).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in got:
        assert r.start == at
        assert len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    want = sorted((i is not None, i or 0, crc(e)) for (i, _), e in zip(messy, encoded(messy)))
    assert sorted((r.doc_id is not None, r.doc_id or 0, zlib.crc32(r.ids)) for r in got) == want
    some = token_shards.read(spark, path, only=[7, 12]).collect()
    by_start = {r.start: bytes(r.ids) for r in got}
    assert {r.doc_id for r in some} == {7, 12}
    assert all(by_start[r.start] == bytes(r.ids) for r in some)


def test_no_documents_give_no_shards(spark, frame):
    path = new_folder(spark, "test-shards")
    token_shards.write(frame([]), path, BYTES, "byte_level")
    assert token_shards.read(spark, path).count() == 0


def test_histogram_answers_every_limit(spark, frame, messy):
    lengths = np.array([len(e) for e in encoded(messy, end=False)])
    counted = token_counts.histogram(
        token_counts.encoded_lengths(frame(messy), BYTES, "byte_level")
    ).cache()
    rows = counted.collect()
    assert sorted(r.length for r in rows) == sorted(set(lengths.tolist()))
    for r in rows:
        assert r.n_docs == (lengths == r.length).sum()
        assert r.docs_up_to == (lengths <= r.length).sum()
        assert r.docs_from == (lengths >= r.length).sum()
        assert r.tokens_from == lengths[lengths >= r.length].sum()
        assert r.tokens_kept == np.minimum(lengths, r.length).sum()
        assert r.tokens_cut == (lengths - np.minimum(lengths, r.length)).sum()
    for r in token_counts.at_limits(counted, [0, 7, 100, 10**6]).collect():
        assert r.tokens_kept == np.minimum(lengths, r.context).sum()
        assert r.docs_fit == (lengths <= r.context).sum()
    ordered = np.sort(lengths)
    for r in token_counts.quantiles(counted, [0.1, 0.5, 1.0]).collect():
        assert r.length == ordered[int(np.ceil(r.share * len(ordered))) - 1]
    empty = token_counts.histogram(token_counts.encoded_lengths(frame([]), BYTES, "byte_level"))
    assert empty.count() == 0
    assert [r.tokens_kept for r in token_counts.at_limits(empty, [5]).collect()] == [0]
