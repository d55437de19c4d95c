import math
import random

import numpy as np

import triagelake.llm.language as language_module
from triagelake.llm.language import ORDER, SYMBOLS, Model, folded, grams, languages, learn, predict, symbols

from .conftest import clashing

SYLLABLES = {"en": "th er on an re he in ed nd ha", "de": "en er ch ge ein sch ü ä ß", "fr": "es le on eau é è ou ez ai", "es": "os ar ción ñ ó as qu el"}


def text(language, n, dice):
    return " ".join("".join(dice.choice(SYLLABLES[language].split()) for _ in range(dice.randrange(1, 4))) for _ in range(n))


def corpus(n=300):
    dice = random.Random(3)
    return [(i, text(x, dice.randrange(5, 60), dice), x) for i, x in ((i, list(SYLLABLES)[i % 4]) for i in range(n))]


def test_held_out_documents(documents):
    rows = corpus()
    odd = [(9000, None, "en"), (9001, "", "en"), (9002, "123 -- !!", None), (9003, "The " * 30000, None), (9004, "DIE SCHÜSSE", None), (9005, "—…“”", "fr")]
    found = languages(clashing(documents([*rows, *odd, rows[0]]))).collect()
    wanted = {r[0]: r[2] for r in rows} | {9000: "und", 9001: "und", 9002: "und", 9003: "en", 9004: "de", 9005: "und"}
    assert len(found) == len(rows) + len(odd) + 1
    assert all(0 <= r.score <= 1 for r in found) and any(r.held_out for r in found)
    assert [r.doc_id for r in found if r.lang_pred != wanted[r.doc_id]] == []
    assert languages(documents([])).collect() == []
    assert {r.lang_pred for r in languages(documents([(1, "some", None), (2, None, "en")])).collect()} == {"und"}


def plain_cost(counts, history, symbol):
    """Code length of a symbol by method C, from the longest context down."""
    cost = 0.0
    for order in range(ORDER, -1, -1):
        context = history[len(history) - order:]
        seen = counts.get(context, {})
        total = sum(seen.values())
        if symbol in seen:
            return cost - math.log(seen[symbol] / (total + len(seen)))
        if total:
            cost -= math.log(len(seen) / (total + len(seen)))
    return cost + math.log(SYMBOLS)


def test_code_lengths_follow_from_the_context_trees(documents):
    rows = [r for r in corpus(60)]
    model = learn(documents(rows))
    table, lengths = symbols(model.high), model.code_lengths()
    for i in range(len(model.languages)):
        counts: dict = {}
        for gram, n in zip(*model.counts[i]):
            own = tuple(int(gram) // SYMBOLS ** k % SYMBOLS for k in range(ORDER, -1, -1))
            for order in range(ORDER + 1):
                seen = counts.setdefault(own[ORDER - order: ORDER], {})
                seen[own[-1]] = seen.get(own[-1], 0) + int(n)
        sample = "   Schöne neue thing ción zzz! ÄÖ".encode()
        code = table[folded(sample)].tolist()
        for at in range(3, len(sample)):
            assert abs(lengths[grams(sample, table)[at], i] - plain_cost(counts, tuple(code[at - 3: at]), code[at])) < 1e-4


def test_any_number_of_languages(documents, monkeypatch):
    """More languages than tables: nothing fails, and code lengths and scores are those of the tables."""
    rows = corpus(120) + [(1000 + i, "q" * (1 + i % 3) + f" stray {chr(97 + i % 26) * 4}", f"x{i:02}") for i in range(60)]
    found = {r.doc_id: r.lang_pred for r in languages(documents(rows)).collect()}
    assert len(found) == len(rows) and sum(found[r[0]] == r[2] for r in rows[:120]) >= 115
    model = learn(documents(corpus(60)))
    lengths, wanted = model.code_lengths(), np.arange(0, SYMBOLS ** (ORDER + 1), 7)
    for i in range(len(model.languages)):
        assert np.array_equal(model.code_lengths_of(i, wanted), lengths[wanted, i])
    few = predict(documents(corpus(40)), model).select("doc_id", "lang_pred", "score").collect()
    monkeypatch.setattr(language_module, "TABLES", 2)
    assert sorted(predict(documents(corpus(40)), model).select("doc_id", "lang_pred", "score").collect()) == sorted(few)


def test_batches_do_not_matter(documents, spark):
    rows = corpus(40)
    model = learn(documents(rows))
    one = {r.doc_id: r.score for r in predict(documents(rows, 1), model).collect()}
    many = {r.doc_id: r.score for r in predict(documents(rows, 9), model).collect()}
    assert one.keys() == many.keys() and np.allclose([one[k] for k in one], [many[k] for k in one])
    assert isinstance(model, Model) and model.languages == sorted(SYLLABLES)
