import numpy as np
import pytest

from triagelake.llm.mixing import leaf_quotas, mix, mixed_sizes, targets

from . import plain
from .conftest import clashing


def expected_targets(sizes):
    """Words by source: weights 5, 2, 1, at most three times the size, the excess reshared."""
    weights, capped = [(5, 2, 1)[i % 3] for i in range(len(sizes))], {}
    while True:
        rest = sum(sizes) - sum(capped.values())
        free = {i: w for i, w in enumerate(weights) if i not in capped}
        shares = {i: rest * w / sum(free.values()) for i, w in free.items()}
        over = {i: 3 * sizes[i] for i in shares if shares[i] > 3 * sizes[i]}
        if not over:
            return [capped.get(i, shares.get(i)) for i in range(len(sizes))]
        capped |= over


@pytest.fixture
def rows(prose):
    names = [None, "", "b", "a", "Z", "é"]
    out = [(i, prose(1 + (i * 7919) % 90, i), "en", names[i % 6] if i % 4 else "a") for i in range(400)]
    return [*out, (400, None, "en", "b"), (401, " \n", "en", "b"), (5, "same id again", "en", "b"), (5, "same id again", "en", "b")]


def test_targets():
    for sizes in ([10, 10, 10], [1, 100, 5, 7], [0, 5], [1000, 1, 1, 1], [0, 0], []):
        assert targets(sizes) == pytest.approx(expected_targets(sizes))


def test_each_source_meets_its_target(documents, rows):
    found = mixed_sizes(clashing(documents(rows)), shards=8).collect()
    assert sorted((r.doc_id, r.size) for r in found) == sorted((r[0], len(plain.words(r[1]))) for r in rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(plain.words(r[1]))
    order = sorted((s for s in sizes if s is not None)) + [None]
    goal = dict(zip(order, expected_targets([sizes[s] for s in order])))
    source = {(r[0], len(plain.words(r[1]))): r[3] for r in rows}
    taken = dict.fromkeys(order, 0)
    for r in found:
        s = source[r.doc_id, r.size]
        assert (r.source_size, r.target) == (sizes[s], pytest.approx(goal[s]))
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 0.5 for s in order)
    again = mixed_sizes(documents(rows, 7), shards=8).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, found))


def test_mixed_rows_hold_what_is_taken(documents, rows):
    docs = clashing(documents(rows))
    mixed = mix(docs, shards=8)
    assert mixed.schema == docs.schema
    by_id = {}
    for r in mixed.collect():
        by_id[r.doc_id] = by_id.get(r.doc_id, 0) + len(plain.words(r.text))
    wanted = {}
    for r in mixed_sizes(documents(rows), shards=8).collect():
        wanted[r.doc_id] = wanted.get(r.doc_id, 0) + r.taken
    assert {k: v for k, v in wanted.items() if v} == by_id


def test_tree_splits_quotas_exactly():
    quotas = np.array([100, 0, 7, 1013])
    for shards in (1, 2, 7, 16):
        leaves = [leaf_quotas(quotas, shards, s, 3) for s in range(shards)]
        assert (sum(h for h, _ in leaves) == quotas).all()
        for s in range(1, shards):
            assert (leaves[s][1] == leaves[s - 1][0] + leaves[s - 1][1]).all()
        totals = [int(h.sum()) for h, _ in leaves]
        assert max(totals) - min(totals) <= 1
    shares = np.mean([leaf_quotas(quotas, 4, 0, seed)[0] for seed in range(300)], axis=0)
    assert np.allclose(shares, quotas / 4, atol=1.5)


def test_empty_tables(documents):
    assert mixed_sizes(documents([])).collect() == [] and mix(documents([])).collect() == []
    assert [r.taken for r in mixed_sizes(documents([(1, None), (2, "")])).collect()] == [0, 0]
