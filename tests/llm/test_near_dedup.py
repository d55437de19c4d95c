import random

import numpy as np
import pytest

from triagelake.llm.near_dedup import BINS, components, drop_near_duplicates, near_duplicates, sketch
from triagelake.llm.words import mix

from . import plain
from .conftest import clashing


def changed(text, share, seed):
    dice = random.Random(seed)
    return " ".join(f"new{seed}_{i}" if dice.random() < share else w for i, w in enumerate(text.split()))


@pytest.mark.parametrize("size", [2, 5])
def test_against_plain_version(documents, odd_rows, prose, size):
    """Copies with few and many changes, so that similarities lie on both sides of 0.8, in chains and stars."""
    rows = list(odd_rows)
    for g in range(6):
        base = prose(150, 50 + g, 3000)
        for c in range(8):
            base_or_copy = base if c % 2 else changed(base, 0.02 * c / size, 7 * g + c)
            rows.append((1000 + 97 * g + 11 * c, changed(base_or_copy, 0.015 * (c % 5), 31 * g + c)))
    found = sorted(map(tuple, near_duplicates(clashing(documents(rows)), size).collect()))
    assert found == sorted(plain.near(rows, size))
    assert any(r[2] != r[0] for r in found)


def test_crowded_buckets_are_compared_as_a_whole(documents, prose, monkeypatch):
    """Many copies of one text with different changes: most pairs fall short of the threshold, some chains do not; in one tile and in many."""
    from triagelake.llm import near_dedup

    base = prose(150, 77, 3000)
    rows = [(i, changed(base, 0.004 * (i % 23), 500 + i)) for i in range(120)]
    wanted = sorted(plain.near(rows, 2))
    assert len({r[2] for r in wanted}) > 5
    for tile in (near_dedup.TILE, 3000):
        monkeypatch.setattr(near_dedup, "TILE", tile)
        assert sorted(map(tuple, near_duplicates(documents(rows), 2).collect())) == wanted


def test_tiles_are_bounded_by_sets_too(documents, prose, monkeypatch):
    from triagelake.llm import near_dedup

    base = prose(150, 77, 3000)
    rows = [(i, changed(base, 0.004 * (i % 23), 500 + i)) for i in range(60)]
    monkeypatch.setattr(near_dedup, "TILE_SETS", 7)
    monkeypatch.setattr(near_dedup, "CELLS", 50)
    assert sorted(map(tuple, near_duplicates(documents(rows), 2).collect())) == sorted(plain.near(rows, 2))


def test_many_small_sets_need_little_memory():
    """Sets that share a template, all in components of their own; the last is close to the first."""
    import tracemalloc

    from triagelake.llm.near_dedup import _links

    n = 6000
    sets = [np.sort(mix(np.array([1, 2, 3, 4, 5, *(10 * k + np.arange(10, 15))], dtype=np.uint64))).view(np.int64) for k in range(1, n)]
    sets.append(sets[0])
    tracemalloc.start()
    found = _links(sets, np.arange(n), np.arange(n), 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(n - 1, 0)] and peak < 400e6


def test_rows_without_id_and_repeated_rows(documents):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (7, "a b c d e f"), (None, None)]
    found = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(documents(rows)).collect()), key=repr)
    assert found == sorted([(None, None, True), (None, None, True), (5, 5, True), (5, 5, True), (7, 5, False)], key=repr)


def test_stage_and_empty_table(documents, odd_rows):
    docs = clashing(documents(odd_rows))
    kept = drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in plain.near(odd_rows, 5) if r[3])
    assert near_duplicates(documents([])).collect() == []


def test_every_coordinate_is_filled_and_estimates_hold():
    for n in (1, 2, 7, 100, 3000):
        own = sketch(mix(np.arange(n, dtype=np.uint64)))
        assert len(own) == BINS and own.max() < np.iinfo(np.uint64).max
    shares = []
    for k in range(40):
        a = mix(np.arange(1000 * k, 1000 * k + 200, dtype=np.uint64))
        b = mix(np.arange(1000 * k + 50, 1000 * k + 250, dtype=np.uint64))
        shares.append(np.mean(sketch(a) == sketch(b)))
    assert abs(np.mean(shares) - 150 / 250) < 0.03


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, k) for k in range(101, 150)]
    edges = spark.createDataFrame([*chain, *star, (300, 200), (200, 250), (250, 300), (5, 5)], "a long, b long").repartition(3)
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{k: 100 for k in range(101, 150)}, 250: 200, 300: 200}
    assert components(edges.limit(0)).collect() == []
