import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from triagelake.llm.packing import WordEncoder, first_fit, pack

from .conftest import clashing

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "a<|endoftext|>b <|ENDOFTEXT|> it's İstanbul don't!! foo'sbar 12ab ẛ̣ Ⅷ ΑΣ \x1c \x85 ﬁ", "isn't. é, é., .. a'.' 'll 'tis! É ß ẞ x,<|endoftext|>.",
       "ĳ ſ it´s ̈x ä é", "Émile's çà; (ünïcödé)… — “q” \xa0nbsp\xa0 日本語 🙂 👩‍👩‍👧", "UPPER!! lower*** x&&& 3.14 +1 (555)"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_word_by_word_equals_the_whole_text(tokenizer, prose, monkeypatch):
    from triagelake.llm import packing

    for kept in (packing.WORDS_KEPT, 3):
        monkeypatch.setattr(packing, "WORDS_KEPT", kept)
        texts = [*ODD, prose(300, 1), "x" * 5000]
        for text, ids in zip(texts, WordEncoder(PATH).encode([t.encode() for t in texts])):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_first_fit():
    sizes = np.array([60, 50, 50, 40, 30, 10, 5, 5])
    bins, offsets = first_fit(sizes, 100)
    assert bins.tolist() == [0, 1, 1, 0, 2, 2, 2, 2] and offsets.tolist() == [0, 0, 50, 60, 0, 30, 40, 45]
    dice = np.random.default_rng(0)
    sizes = -np.sort(-dice.integers(1, 100, 500))
    bins, offsets = first_fit(sizes, 100)
    room: list[int] = []
    for size, b, o in zip(sizes, bins, offsets):  # the plain way
        first = next((i for i, r in enumerate(room) if r >= size), len(room))
        room += [100] * (first == len(room))
        assert (b, o) == (first, 100 - room[first])
        room[first] -= size


def test_round_trip(documents, odd_rows, tokenizer, prose):
    rows = [*odd_rows, *((100 + i, t) for i, t in enumerate(ODD)), (7, "same id again"), (None, "no id"), (None, None),
            *((1000 + i, prose(20 + 13 * i, i)) for i in range(80))]
    found = pack(clashing(documents(rows)), PATH, with_ids=True).collect()
    sequences, texts = {}, {}
    for r in found:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        texts.setdefault((r.doc_id, r.copy), []).append((r.start, ids, r.doc_tokens))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    made = []
    for (doc_id, _), pieces in texts.items():
        ids = []
        for start, own, total in sorted(pieces):
            assert start == len(ids)
            ids += own
        assert len(ids) == total and ids[-1] == 2
        made.append((doc_id, ids))
    wanted = [(i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows]
    assert sorted(made, key=repr) == sorted(wanted, key=repr)
    total = sum(r.length for r in found)
    assert len(sequences) <= 1.1 * total / 4096 + 1
    assert pack(documents([]), PATH).collect() == []


def test_signs_before_punctuation_and_all_white_space(tokenizer):
    texts = ["“fine”.", "😀!", "wow 😀, ok", "a…!", "→,", "™.", "5°.", "—,", "•)", "İ!", "वह अच्छी है, और", "ภาษาที่.", "a\x1cb.",
             "x y. z　w!", "É.", "ß,", "ǅ!"]
    for text, ids in zip(texts, WordEncoder(PATH).encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8"), max_size=30))
def test_any_text_equals_the_tokenizer(tokenizer, text):
    ids = WordEncoder(PATH).encode([text.encode()])[0]
    assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_lower_case_and_signs_before_the_split_change_nothing(tokenizer):
    # H, T, W, Y with these marks exist in one character in lower case only; special tokens are told apart by case.
    texts = ["H̱ T̈ W̊ Y̊ J̌ A, b", "<|ENDOFTEXT|> A, b. <|endoftext|> C", "Yes?!, no... ok, É, é, “A”, 日, x. ", "K, Å, ſ, A. B,\xa0C.\x85D, \x1c, e",
             "ΑΣ, A, Á, Á, b", "don't, 'S, 5, 6. 7 , . a.b, c", "a ,  b .  c,  d.\n", "—A, B— “C”, D. …E, F"]
    for text, ids in zip(texts, WordEncoder(PATH).encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_a_word_is_tokenized_once_in_all_its_spellings_and_kept_while_used(monkeypatch):
    from triagelake.llm import packing

    encoder, calls = WordEncoder(PATH), []
    unit = encoder.unit
    monkeypatch.setattr(encoder, "unit", lambda word: calls.append(word) or unit(word))
    encoder.encode([b"Oueonth oueonth, OUEONTH. oueonth", "Ça oueonth. ÇA".encode()])
    assert calls.count("oueonth") == 1
    monkeypatch.setattr(packing, "WORDS_KEPT", 20)
    for i in range(200):
        encoder.encode([b"oueonth w" + bytes([97 + i // 26, 97 + i % 26])])
    assert calls.count("oueonth") == 1 and len(encoder) + len(encoder.older) <= 20
