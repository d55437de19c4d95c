import random
import time

import numpy as np
import pytest

from triagelake.llm.toxicity import Letters, Restorer, drop_toxic, learn, letter_model, restore, score, toxicity

from .conftest import clashing

BAD = ["idiot", "moron", "scum", "loser", "trash"]
PLAIN = "this is some text about the garden and the river where people walk in the evening with their friends and talk of moon loser idiot".split()


@pytest.fixture(scope="module")
def letters(spark):
    words = " ".join([*PLAIN, *BAD] * 20)
    return letter_model(spark.createDataFrame([(1, words), (2, None), (3, "")], "doc_id long, text string"))


def test_letter_model_is_a_distribution(letters):
    assert np.allclose(np.exp(-letters.cost).sum(axis=2), 1)
    assert letters.cost[0, 0, 9] < letters.cost[0, 0, 26]


@pytest.mark.parametrize("hidden, word", [
    ("1d10t", "idiot"), ("m0r0n", "moron"), ("l0$er", "loser"), ("i.d.i.o.t", "idiot"), ("iiidiooot", "idiot"), ("tr4sh", "trash"),
    ("s-c-u-m", "scum"), ("m o r o n", "moron"), ("moon", "moon"), ("garden", "garden")])
def test_restore(letters, hidden, word):
    assert restore(hidden, letters) == word


def test_viterbi_finds_the_best_of_all_paths(letters):
    from itertools import product

    from triagelake.llm.toxicity import _choices, _code

    for stretch in ("l0$3r", "iidd1oot", "$c.um", "0", "b@@d"):
        best = None
        for path in product(*_choices(stretch)):
            text, cost, a, b = "", 0.0, 0, 0
            for found, extra in path:
                cost += extra
                for letter in found:
                    code = _code(letter)
                    cost, a, b, text = cost + float(letters.cost[a, b, code]), b, code, text + letter
            best = min(best or (9e9, ""), (cost + float(letters.cost[a, b, 0]), text))
        assert restore(stretch, letters) == best[1]


def test_words_with_one_path_are_untouched(letters):
    restorer = Restorer(letters)
    assert restorer.forms("Garden".encode()) == ("garden",) and restorer.forms(b"***") == () and restorer.forms("é".encode()) == ("é",)
    assert "idiot" in restorer.forms(b"(1d10t!!)") and "scum" in restorer.spaced(b"you are a s c u m now")
    assert restorer.forms(b"x" * 30000) and restorer.spaced(b"") == []


@pytest.mark.parametrize("token, word", [
    ("$cum", "scum"), ("!diot", "idiot"), ("|oser", "loser"), ("+rash", "trash"), ("(!diot!)", "idiot"), ("iiddiioott", "idiot"), ("looserr", "loser"),
    ("i" * 60 + "diot", "idiot"), ("m0" + "r" * 90 + "on", "moron"), ("-" * 50 + "m.o.r.o.n", "moron")])
def test_no_token_is_exempt_from_its_lattice(letters, token, word):
    """Signs at the edge may be letters, doubled letters are decoded, and no length is too long."""
    assert word in Restorer(letters).forms(token.encode())


def test_long_tokens_take_linear_time(letters):
    start = time.perf_counter()
    assert Restorer(letters).forms(b"aB3/" * 20000)
    assert time.perf_counter() - start < 20


@pytest.mark.parametrize("text, word", [
    ("you i d i o t!", "idiot"), ("i d i o t, go", "idiot"), ('so "s c u m" it is', "scum"), ("(s c u m)", "scum"), ("i d 1 0 t", "idiot"),
    ("m 0 r 0 n", "moron"), ("$ c u m", "scum"), ("s c\tu\u00a0m", "scum"), ("t h e i d i o t w a l k", "idiot"),
    (" ".join("the garden and the river where people walk in the evening with their moron friends" * 3).replace("   ", " "), "moron")])
def test_spaced_words(letters, text, word):
    """Any neighbour but a letter or digit, look-alikes, words in the middle of a row of words, and rows of any length."""
    assert word in Restorer(letters).spaced(text.encode())


def test_words_of_a_row_fit_the_letter_model(letters):
    words = Restorer(letters).spaced(" ".join("thegardenandtheriver").encode())
    assert {"the", "garden", "and", "river"} <= set(words) and "enandt" not in words
    assert Restorer(letters).spaced("\u00e9 \u00e8 \u00e9".encode()) and Restorer(letters).spaced(b"a 2 b 6 c") == []


def corpus(n=900):
    dice, rows, labels = random.Random(1), [], []
    for i in range(n):
        words = [dice.choice(PLAIN[:20]) for _ in range(dice.randrange(5, 60))]
        bad = i % 4 == 0
        for _ in range(bad * dice.randrange(1, 4)):
            words.insert(dice.randrange(len(words)), dice.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad), 1))
    return rows, labels


def test_held_out_and_hidden_words(spark, documents):
    rows, labels = corpus()
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, None, 1), (10_000, 1, None)], "doc_id long, toxic int, quality int")
    hidden = [(5000, "you are an 1d10t my friend"), (5001, "what a l0ser and m-o-r-o-n"), (5002, "s c u m of the river"), (5003, None), (5004, ""),
              (5005, "the evening " * 20000)]
    docs = clashing(documents([*rows, *hidden, (0, rows[0][1])]))
    found = toxicity(docs, marks).collect()
    wanted = dict((i, y) for i, y, _ in labels) | {5000: 1, 5001: 1, 5002: 1, 5003: 0, 5004: 0, 5005: 0}
    assert len(found) == len(rows) + len(hidden) + 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    wrong = [r for r in found if r.predicted != wanted[r.doc_id]]
    assert len(wrong) <= 3 and not any(r.doc_id >= 5000 for r in wrong)
    kept = drop_toxic(docs, marks)
    assert kept.schema == docs.schema and kept.count() == sum(1 - r.predicted for r in found)


def test_hidden_words_are_scored(spark, documents):
    rows, labels = corpus(600)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    garden = "theriverandthegardenwherepeoplewalkintheevening"
    hidden = [(5000, "the river $cum of the garden", 1), (5001, " ".join(garden + "youmoron" + garden), 1), (5002, "you say: 's c u m'!", 1),
              (5003, " ".join(garden * 5), 0), (5004, "the llooosseerr of the garden", 1), (5005, "the (garden) and the river!", 0)]
    found = toxicity(documents([*rows, *(h[:2] for h in hidden)]), marks).where("doc_id >= 5000").collect()
    assert {r.doc_id: r.predicted for r in found} == {i: y for i, _, y in hidden}


def test_without_labels(spark, documents):
    docs = documents([(1, "some text"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert [r.predicted for r in toxicity(docs, none).collect()] == [0, 0]
    assert toxicity(documents([]), none).collect() == []
    with pytest.raises(ValueError):
        score(clashing(docs), learn(docs, none, Letters(np.zeros((28, 28, 28)))))
