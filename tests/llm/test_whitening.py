import math

import numpy as np
import pytest

from triagelake.llm.whitening import solve_upper, whiten

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """The contract by hand with numpy's symmetric eigensolver."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max({len(v) for _, v in kept}, key=lambda m: ([len(v) for _, v in kept].count(m), m))
    kept = [(i, v) for i, v in kept if len(v) == d]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in kept], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    a = x - s / n
    e, w = np.linalg.eigh(a.T @ a / n)
    order = np.argsort(-e)
    deviation = [sum(int(n * int(v) - int(t)) ** 2 for v, t in zip(row, s)) for row in x]
    return kept, n, e[order], w[:, order], a, deviation


def test_equals_eigen_decomposition(spark):
    dice = np.random.default_rng(5)
    basis = dice.normal(size=(12, 12)) * np.geomspace(1, 1e-3, 12)
    rows = [(i, [float(c) for c in (dice.normal(size=12) @ basis.T * 0.3)]) for i in range(400)]
    rows += [(400, None), (401, [0.1] * 11 + [float("nan")]), (402, [0.1] * 11 + [None]), (403, [0.1] * 5), (404, [float("inf")] * 12),
             (3, rows[3][1]), (7, rows[7][1])]  # dropped rows, a malformed length, repeated rows
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    found = whiten(table.withColumn("n", table.vec_id)).collect()  # a clashing column
    kept, n, e, w, a, deviation = brute(rows)
    assert len(found) == len(kept) * 8 and {r.n for r in found} == {n}
    assert sorted((r.vec_id, r.deviation) for r in found if r.component == 1) == sorted(zip([i for i, _ in kept], deviation))
    trace = e.sum()
    for r in found[:64]:
        assert r.explained == pytest.approx(e[r.component - 1] / trace, rel=1e-6)
    assert max(r.identity_error for r in found) <= 1e-4 and len({r.identity_error for r in found}) == 1
    # The whitened values of one row equal the projection on eigh's vectors, up to one sign per component.
    signs = {}
    for (i, v), row in zip(kept, a):
        for c in range(8):
            expected = row @ w[:, c] / math.sqrt(e[c])
            got = next(r.whitened for r in found if r.vec_id == i and r.component == c + 1)
            sign = signs.setdefault(c, 1.0 if expected * got >= 0 else -1.0)
            assert got == pytest.approx(sign * expected, rel=1e-6, abs=1e-8)
        if i > 20:
            break


def test_few_rows_and_constant_dimensions(spark):
    rows = [(1, [0.5, 0.25, 0.0]), (2, [0.5, 0.75, 0.0])]
    found = whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).orderBy("vec_id", "component").collect()
    assert [(r.vec_id, r.component) for r in found] == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2), (2, 3)]
    assert [r.whitened for r in found if r.component > 1] == [None] * 4  # no variance left
    assert {round(r.whitened, 9) for r in found if r.component == 1} == {-1.0, 1.0}
    assert found[0].explained == pytest.approx(1.0) and found[0].identity_error == pytest.approx(0, abs=1e-9)
    one = whiten(spark.createDataFrame([(1, [0.5], 0)], SCHEMA)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, None, None)]


def test_empty_table(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).count() == 0


def test_triangular_solve():
    dice = np.random.default_rng(1)
    r = np.triu(dice.normal(size=(6, 6))) + 3 * np.eye(6)
    a = dice.normal(size=(10, 6))
    assert np.allclose(solve_upper(a, r) @ r, a)
