import hashlib
import zlib

import pytest

from triagelake.llm import manifest as module
from triagelake.llm.manifest import manifest

from .conftest import clashing


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def f(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, source, lang, n_chars, text):
    return h(*map(f, (doc_id, source, lang, n_chars, text)))


def build(nodes):
    """Levels of a tree with runs of three: the first level is ``nodes``; a lone node stays as it is."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 3]) for i in range(0, len(last), 3)])
    return levels


def path(levels, i):
    """(left, right) siblings at each level below the top."""
    out = []
    for level in levels[:-1]:
        start = i - i % 3
        out.append(("".join(level[start:i]), "".join(level[i + 1:start + 3])))
        i //= 3
    return out


def brute(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, leaf(*r))
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: build([leaf(*r) for r in sorted([r for r in rows if r[1] == s], key=key)]) for s in sources}
    ordered = {s: sorted([r for r in rows if r[1] == s], key=key) for s in sources}
    top = build([trees[s][-1][0] for s in sources])
    root = top[-1][0]
    out = []
    for s in sources:
        for i, r in enumerate(ordered[s]):
            steps = path(trees[s], i) + path(top, sources.index(s))
            proof = h(*[a + b for a, b in steps])
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            folded = leaf(r[0], r[1], r[2], r[3], text)
            for a, b in steps:
                folded = h(a, folded, b)
            out.append((r[0], leaf(*r), trees[s][-1][0], root, proof, folded, folded == root))
    return sorted(out, key=repr)


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def rows_of(n_sources, per_source):
    rows = []
    for s in range(n_sources):
        for i in range(per_source + 7 * s):
            text = None if i % 11 == 5 else f"line {i}\nof {s}\n" * (i % 4)
            rows.append((1000 * s + i, f"src{s}", None if i % 13 == 2 else "en", None if i % 17 == 3 else len(text or ""), text))
    return rows


@pytest.mark.parametrize("depth", [1, 2, 8])
def test_equals_a_plain_tree(spark, monkeypatch, depth):
    monkeypatch.setattr(module, "DEPTH", depth)
    rows = rows_of(4, 40) + [(None, "src1", "en", 1, "x"), (5, None, "en", 2, "a\nb"), (6, None, None, None, None),
                             (1001, "src1", "en", 4, "dup\n"), (1001, "src1", "en", 4, "dup\n"), (7, "é", "fr", 1, "\n"), (8, "z", "en", 1, "a")]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    found = manifest(clashing(docs)).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)
    assert any(not r.verified for r in found) and any(r.verified for r in found)


def test_a_lone_leaf_and_one_source(spark):
    rows = [(2, "only", "en", 3, "a\nb")]
    found = manifest(spark.createDataFrame(rows, COLUMNS)).collect()
    assert [(r.leaf == r.subroot == r.root, r.proof_sha256) for r in found] == [(True, h())]
    assert sorted(map(tuple, manifest(spark.createDataFrame(rows, COLUMNS)).drop("source").collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert manifest(spark.createDataFrame([], COLUMNS)).count() == 0
