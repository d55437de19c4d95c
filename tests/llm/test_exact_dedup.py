from triagelake.llm.exact_dedup import MAX_DEPTH, build_index, drop_exact_duplicates, exact_duplicates, lookup, split_buckets

from . import plain
from .conftest import clashing


def test_against_plain_version(documents, odd_rows):
    rows = [*odd_rows, (19, None), (7, "other text, same id"), (20, "one "), (20, "one ")]
    found = sorted(map(tuple, exact_duplicates(documents(rows)).collect()), key=repr)
    assert found == sorted(plain.exact(rows), key=repr)


def test_rows_without_id(documents):
    rows = [(None, "a"), (1, "a"), (None, "b"), (None, "b")]
    found = {(r.doc_id, r.text_sha256): r.kept for r in exact_duplicates(documents(rows)).collect()}
    assert found == {(None, plain.sha("a")): False, (1, plain.sha("a")): True, (None, plain.sha("b")): True}


def test_empty_table_and_further_columns(documents, odd_rows):
    assert exact_duplicates(documents([])).collect() == []
    docs = clashing(documents(odd_rows))
    kept = drop_exact_duplicates(docs)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r[1] for r in plain.exact(odd_rows)})


def test_buckets_split_until_they_fit(documents):
    sizes = {0: 5, 1: 5, 40000: 3}
    buckets = split_buckets(sizes, 4)
    assert [b[0] for b in buckets] == sorted(b[0] for b in buckets)
    assert buckets[0] == (0, 0, MAX_DEPTH) and buckets[-1][1] == (1 << MAX_DEPTH) - 1
    assert all(b[1] + 1 == c[0] for b, c in zip(buckets, buckets[1:]))
    assert sum(s for c, s in sizes.items() for b in buckets if b[0] <= c <= b[1]) == 13
    assert split_buckets({}, 4) == [(0, (1 << MAX_DEPTH) - 1, 0)]

    docs = documents([(i, f"text {i % 150}") for i in range(300)])
    index = build_index(docs, capacity=8)
    rows = index.entries.collect()
    assert len(rows) == 150 and index.depth > 3
    assert max(sum(r.bucket == b for r in rows) for b in {r.bucket for r in rows}) <= 8
    assert lookup(docs, index).where("kept").count() == 150


def test_colliding_keys_are_chained_by_bytes(documents, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(1).cast("long") + F.length(c[-1]) * 0)
    index = build_index(documents([(1, "a"), (2, "b"), (3, "a"), (4, "c")]))
    assert sorted((r.chain, r.keep_id) for r in index.entries.collect()) == [
        (n + 1, i) for n, (_, i) in enumerate(sorted((plain.sha(t), i) for t, i in (("a", 3), ("b", 2), ("c", 4))))]
    found = exact_duplicates(documents([(1, "a"), (2, "b"), (3, "a"), (4, "c")])).collect()
    assert sorted(tuple(r)[:3] for r in found) == [(1, 3, 2), (2, 2, 1), (3, 3, 2), (4, 4, 1)]
