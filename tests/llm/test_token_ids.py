import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import pyarrow as pa

from triagelake.llm.common import stored
from triagelake.llm.packing import WordEncoder
from triagelake.llm.token_ids import (counts, decode_batch, decode_ranks, encode_batch, encode_ranks, ranking, read_token_files,
                                       token_ids, tokens, write_token_files)

from .conftest import clashing

PATH = public_tokenizers.path("word_bpe_49k.json")
HARD = ["", "a<|endoftext|>b <|ENDOFTEXT|> it's İstanbul don't!! \x1c \x85 ﬁ", "“fine”. 😀! wow 😀, ok a…! →, ™. 5°. —, •) İ!",
        "वह अच्छी है, और ภาษาที่. 日本語　テキスト", "a b c​d e\x1fz", "x" * 5000, "ΑΣ ΟΔΟΣ. ẛ̣ Ⅷ"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def words(encoder, text):
    return np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist()


def test_words_equal_the_whole_text(tokenizer):
    encoder = WordEncoder(PATH)
    for text in HARD:
        assert words(encoder, text) == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=40))
def test_words_equal_the_whole_text_for_any_text(tokenizer, text):
    assert words(WordEncoder(PATH), text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_code_round_trip():
    dice = np.random.default_rng(3)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = np.concatenate([dice.integers(0, 300, n), dice.integers(0, 1 << 32, n // 3, dtype=np.uint64)]).astype(np.int64)
        control, data = encode_ranks(ranks)
        assert len(control) == -(-len(ranks) // 4)
        assert decode_ranks(control, data, len(ranks)).tolist() == ranks.tolist()
    small = encode_ranks(np.arange(256))
    assert small[1] == bytes(range(256))  # a rank below 256 is one byte


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, (1 << 32) - 1), max_size=11), max_size=9))
def test_batch_code_equals_the_code_of_each_row(rows):
    n = np.array([len(r) for r in rows], dtype=np.int64)
    flat = np.array([v for r in rows for v in r], dtype=np.int64)
    control, data = encode_batch(flat, n)
    assert [(c, d) for c, d in zip(control.to_pylist(), data.to_pylist())] == [encode_ranks(np.array(r, dtype=np.int64)) for r in rows]
    assert decode_batch(control, data, n).tolist() == flat.tolist()
    if len(rows) > 1:  # a slice of a batch reads its own rows only
        assert decode_batch(control.slice(1), data.slice(1), n[1:]).tolist() == [v for r in rows[1:] for v in r]


def plain(rows, tokenizer):
    """The contract by hand: (doc_id, n_tokens, crc) of each row, ids with the end id."""
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return sorted(out, key=repr)


def holds(found, rows, tokenizer):
    """Rows in ascending doc_id (null first) by start, starts a running sum from 0, and each row's ids those of the tokenizer."""
    found = sorted(found, key=lambda r: r.start)
    assert [r.start for r in found] == [sum(f.n_tokens for f in found[:i]) for i in range(len(found))]
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert keys == sorted(keys)
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in found], key=repr) == plain(rows, tokenizer)


def test_query_equals_brute_force(documents, odd_rows, tokenizer, spark):
    rows = [*odd_rows, (19, HARD[1]), (20, HARD[2]), (21, HARD[3]), (22, HARD[4]), (23, HARD[6])]
    docs = clashing(documents(rows, parts=4))
    holds(token_ids(docs, PATH).collect(), rows, tokenizer)


def test_repeated_ids_null_ids_and_blocks(documents, tokenizer, spark, monkeypatch, tmp_path):
    from triagelake.llm import token_ids as module

    monkeypatch.setattr(module, "BLOCK_IDS", 7)  # many blocks per task
    rows = [(5, "b a"), (5, "b a"), (5, "a b c"), (None, "first"), (1, None), (2, "x y z " * 30), (3, "")]
    docs = documents(rows, parts=3)
    path = write_token_files(docs, str(tmp_path / "files"), PATH, parts=2)
    blocks = spark.read.parquet(f"{path}/blocks").collect()
    assert len(blocks) > 2
    found = read_token_files(spark, path, with_ids=True).collect()
    holds(found, rows, tokenizer)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in found)
    vocabulary = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").collect()
    assert [(v["count"], v.id) for v in vocabulary] == sorted([(v["count"], v.id) for v in vocabulary], key=lambda c: (-c[0], c[1]))
    assert sum(v["count"] for v in vocabulary) == sum(r.n_tokens for r in found)


def test_empty_table(documents, spark):
    assert token_ids(documents([]).where("false"), PATH).count() == 0


def test_a_full_cache_starts_anew(tokenizer, monkeypatch):
    from triagelake.llm import packing

    monkeypatch.setattr(packing, "WORDS_KEPT", 3)
    encoder = WordEncoder(PATH)
    for texts in (["a b", "c"], ["a b c d e", "a"], ["b"]):
        for text in texts:
            assert words(encoder, text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_counts_come_with_the_tokens_and_no_ids_are_read_for_them(documents, tokenizer):
    rows = [*enumerate(HARD), (None, None), (3, "the same id, the same id")]
    made = stored(tokens(documents(rows), PATH), "token-counts")
    wanted = Counter(i for _, t in rows for i in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])
    assert {r["id"]: r["count"] for r in counts(made).collect()} == wanted
    ranked = ranking(made)
    assert [r["id"] for r in ranked.orderBy("rank").collect()] == sorted(wanted, key=lambda i: (-wanted[i], i))
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "control" not in plan
    assert made.where("n IS NOT NULL").count() == len(rows)
    assert counts(tokens(documents([]), PATH)).collect() == []


@pytest.fixture(scope="module")
def forgetful():
    return WordEncoder(PATH, 6)


def flat_lists(encoder, texts):
    ids, n = encoder.flat([t if isinstance(t, bytes) else t.encode() for t in texts], 2)
    return [i.tolist() for i in np.split(ids, np.cumsum(n)[:-1])] if len(n) else []


def test_texts_together_equal_the_whole_texts(tokenizer):
    texts = [*HARD, " a  b ", "\n", "été, ÉTÉ. naïve### don't*** a,b, C.", "été été, naïve", "<|endoftext|>", "é" * 300 + " é.", "Ünder the, the."]
    wanted = [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    for kept in (None, 1, 5, 40):  # words may be forgotten while a slice is looked up
        encoder = WordEncoder(PATH, kept)
        for _ in range(3):
            assert flat_lists(encoder, texts) == wanted
        assert flat_lists(encoder, texts[:1]) == [[2]] and flat_lists(encoder, [""] * 3) == [[2]] * 3
    assert encoder.flat([], 2)[0].tolist() == []


def test_bytes_that_are_no_text_equal_the_word_by_word_path():
    texts = [b"a \xff\xfe b, \xc3", b"\xe2\x80", b"ok \xc3\xa9."]
    assert flat_lists(WordEncoder(PATH), texts) == [
        [*np.frombuffer(t, "<u4").tolist(), 2] for t in WordEncoder(PATH).encode(texts)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet=st.characters(codec="utf-8"), max_size=30),
                          st.text(alphabet="aAbéÉß.,'<|> \n1#", max_size=30)), min_size=1, max_size=5))
def test_any_texts_together_equal_the_whole_texts(tokenizer, forgetful, texts):
    assert flat_lists(forgetful, texts) == [[*tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_a_word_is_looked_up_once_and_new_words_go_to_the_model_together(monkeypatch):
    encoder = WordEncoder(PATH)
    asked, single = [], []
    many = encoder.many
    monkeypatch.setattr(encoder, "many", lambda words: asked.append(words) or many(words))
    monkeypatch.setattr(encoder, "unit", lambda letters: single.append(letters))  # the model, word by word
    encoder.flat([b"alpha beta alpha, gamma. " * 50, "beta élan ".encode() * 3], 2)
    assert len(asked) == 1 and sorted(asked[0]) == sorted([b"", b"alpha", b"beta", b",", b"gamma", b".", "élan".encode()])
    assert single == []


def test_units_without_ends_are_found_one_by_one():
    encoder = WordEncoder(PATH)
    wanted = encoder._units(["alpha", "beta"])
    encoder.closes[:] = False
    assert encoder._units(["alpha", "beta"]) == wanted == [encoder._unit("alpha"), encoder._unit("beta")]


def test_slices_of_texts_keep_their_rows(documents, tokenizer, monkeypatch):
    from triagelake.llm import token_ids as module

    rows = [*enumerate(HARD * 3), (None, None), (40, "a long text " * 99)]
    monkeypatch.setattr(module, "SLICE_BYTES", 20)
    holds(token_ids(documents(rows, parts=2), PATH).collect(), rows, tokenizer)
