import random

import pytest

from triagelake.llm.substring_dedup import remove_repeats

from . import plain
from .conftest import clashing


def result(docs, window=50):
    return sorted(tuple(r)[:4] for r in remove_repeats(docs, window).collect())


def test_odd_rows(documents, odd_rows):
    assert result(clashing(documents(odd_rows))) == sorted(plain.repeats(odd_rows, 50))


@pytest.mark.parametrize("vocabulary", [2, 5000])
def test_shared_passages_of_all_lengths(documents, prose, vocabulary):
    """Passages that overlap, touch, repeat within a document, and are cut at any place; with two words nearly all phrases recur."""
    dice, source = random.Random(vocabulary), prose(400, 5, vocabulary).split()
    rows = []
    for i in range(60):
        own = prose(dice.randrange(150), 100 + i, vocabulary).split()
        for _ in range(dice.randrange(4)):
            start = dice.randrange(len(source))
            at = dice.randrange(len(own) + 1)
            own[at:at] = source[start: start + dice.randrange(40, 130)]
        rows.append((dice.randrange(10_000), dice.choice([" ", "\n", " \t "]).join(own)))
    assert result(documents(rows)) == sorted(plain.repeats(rows, 50))


def test_kept_text_and_rows_without_id(documents, prose):
    passage = prose(60, 9)
    rows = [(1, f"first {passage}"), (2, f"{passage} second"), (None, f"third {passage}"), (None, None)]
    found = {(r.doc_id, r.n_removed): r.kept_text for r in remove_repeats(documents(rows)).collect()}
    assert found == {(1, 0): f"first {passage}", (2, 60): "second", (None, 0): found[None, 0]}
    assert remove_repeats(documents([])).collect() == []
