import random

import pytest

from triagelake.llm.quality_rules import BELIEVED, RULES, judged, posterior, reliabilities, voted
from triagelake.llm.votes import estimate

from . import plain
from .conftest import clashing


def test_base_against_plain_version(documents, odd_rows, prose):
    dice = random.Random(4)
    rows = [*odd_rows, (7, "repeated id"), (None, "no id")]
    for i in range(60):
        own = prose(dice.randrange(80), i, dice.choice([2, 3, 50])).split(" ")
        rows.append((100 + i, dice.choice([" ", "\n", "\n\n", " | ", "*** "]).join(own)))
    found = sorted((tuple(r)[:7] for r in judged(clashing(documents(rows))).collect()), key=repr)
    assert found == sorted(((i, *plain.base_measures(t)) for i, t in rows), key=repr)
    assert judged(documents([])).collect() == []


def test_junk_goes_and_clean_documents_stay(documents, prose):
    junk = [lambda t: " ".join(w + "***" for w in t), lambda t: " | ".join(t), lambda t: " ".join(w.upper() + "!!" for w in t),
            lambda t: "\n".join([" ".join(t[:12])] * 8), lambda t: " ".join(t[:7] * 9)]
    clean = [(i, ". ".join(" ".join(f"{'abcdefgh'[k % 8]}ord{'lmnop'[k % 5]}{chr(97 + (k * i) % 26)}ing" for k in range(s, s + 9)) for s in range(i % 5 + 4)))
             for i in range(300)]
    bad = [(1000 + i, junk[i % 5](prose(70, i, 5000).replace("w", "wo").split())) for i in range(60)]
    found = {r.doc_id: r for r in judged(documents([*clean, *bad])).collect()}
    assert all(found[i].kept for i, t in clean if not found[i].base_failed)
    assert not any(found[i].kept for i, _ in bad if i % 5 < 2)
    assert sum(found[i].kept for i, _ in bad) < 20


def test_posterior_is_what_the_reliabilities_say(spark, documents, prose):
    import math

    rows = voted(documents([(i, prose(30 + i, i)) for i in range(40)]))
    found = reliabilities(rows)
    for r in rows.selectExpr("votes", f"{posterior(found)} AS p").distinct().collect():
        assert r.p == pytest.approx(1 / (1 + math.exp(-found.log_odds(r.votes))))


def test_estimation_finds_the_accuracies():
    dice, counts, truth = random.Random(0), {}, ((0.9, 0.02), (0.7, 0.1), (0.6, 0.2), (0.8, 0.05))
    for _ in range(40_000):
        good = dice.random() < 0.8
        votes = tuple(-1 if dice.random() < (on_good if good else on_bad) else 1 for on_bad, on_good in truth)
        counts[votes] = counts.get(votes, 0) + 1
    found = estimate(counts, 0.7, [((0.5, 0.1, 0.4), (0.1, 0.1, 0.8))] * 4, trust=0.001)
    assert found.prior == pytest.approx(0.8, abs=0.02)
    for (bad, good), (on_bad, on_good) in zip(found.given, truth):
        assert bad[0] == pytest.approx(on_bad, abs=0.05) and good[0] == pytest.approx(on_good, abs=0.03)
    assert estimate({}, 0.85, [BELIEVED] * len(RULES)).prior == 0.85
