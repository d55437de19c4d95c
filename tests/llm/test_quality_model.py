import random

import numpy as np
import pytest

from triagelake.llm.quality_model import (AGAIN, CAPITALS, LINE, REACH, SIGNS, UNITS, WIDTH, fit, index_vectors, quality, unit_vectors,
                                          units)

from .conftest import clashing


def test_units():
    def rows(text):
        return units([text.encode()])[0].tolist()

    the, dog, line = rows("the")[0], rows("dog")[0], LINE
    assert rows("The dog") == [the, dog, line] and the >= SIGNS
    assert rows("THE DOG") == [CAPITALS, the, CAPITALS, dog, line]
    assert rows("dog dog the") == [dog, AGAIN, dog, the, line]
    assert rows("the***") == [the, rows("***")[0], line] and rows("***")[0] < SIGNS
    assert rows("") == [line] and rows("\n\n") == [line, line, line] and rows("ÜBER") == rows("ÜBER")
    found, first = units([b"the dog", b"", b"dog"])
    assert [found[a:b].tolist() for a, b in zip(first, first[1:])] == [[the, dog, line], [line], [dog, line]]


def test_vectors_are_sums_of_the_index_vectors_of_neighbours(documents):
    texts = ["a b c d a", "b *** c", "", None, "A A\nb"]
    index, wanted = index_vectors(), np.zeros((UNITS, WIDTH))
    rows = units([(t or "").encode() for t in texts])[0].tolist()
    for i, row in enumerate(rows):
        for j in range(max(0, i - REACH), min(len(rows), i + REACH + 1)):
            if i != j:
                wanted[row] += index[rows[j]]
    wanted /= np.maximum(np.linalg.norm(wanted, axis=1, keepdims=True), 1)
    docs = documents(list(enumerate(texts))).coalesce(1).sortWithinPartitions("doc_id")
    assert np.allclose(unit_vectors(docs), wanted, atol=1e-6)


def test_fit_learns_and_calibrates():
    random_ = np.random.default_rng(0)
    x = random_.normal(size=(3000, 5))
    chance = 1 / (1 + np.exp(-2 * x[:, 0] * x[:, 1]))
    y = (random_.random(3000) < chance).astype(float)
    p = fit(x, y).chances(x)
    assert np.mean((p > 0.5) == (chance > 0.5)) > 0.9
    for low in (0.1, 0.3, 0.5, 0.7):
        inside = (p >= low) & (p < low + 0.2)
        assert abs(y[inside].mean() - p[inside].mean()) < 0.08
    assert fit(x[:0], y[:0]).chances(x[:2]) == pytest.approx([0.5, 0.5])
    assert (fit(x[:9], np.ones(9)).chances(x[:2]) > 0.99).all()


def test_held_out_documents(spark, documents):
    dice, rows, labels = random.Random(2), [], []
    words = "the river and a garden of some people who walk there in the evening".split()
    for i in range(600):
        text = [dice.choice(words) for _ in range(dice.randrange(10, 80))]
        bad = i % 3 == 0
        if bad:
            text = [[w + "***" for w in text], [w.upper() + "!!" for w in text], [w for w in text[:9] for _ in range(5)]][i // 3 % 3]
        rows.append((i, " ".join(text)))
        labels.append((i, 1 - int(bad)))
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, quality int")
    odd = [(9000, None), (9001, ""), (9002, "x" * 50000), (9003, "\n\n\n")]
    found = quality(clashing(documents([*rows, *odd, rows[0]])), marks).collect()
    assert len(found) == len(rows) + len(odd) + 1
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    wanted = dict(labels)
    held = [r for r in found if r.held_out and r.doc_id in wanted]
    assert np.mean([r.predicted == wanted[r.doc_id] for r in held]) > 0.97
    assert quality(documents([]), marks).collect() == []
