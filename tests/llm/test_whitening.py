import math

import numpy as np
import pytest

from slatework.llm import whitening
from tests.llm import cases

SCHEMA = "vec_id bigint, embedding array<float>, x string, n string, row string, place string, component string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], SCHEMA)


def usable(rows):
    return [
        (i, [math.floor(256 * float(np.float32(c))) for c in v])
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) and abs(c) * 256 < 2**63 for c in v)
    ]


def check(out, rows, components=4):
    """Against a dense eigendecomposition, exact deviations and the covariance of the results."""
    rows = usable(rows)
    out = out.collect()
    d = len(rows[0][1])
    k = min(components, d)
    assert len(out) == len(rows) * k
    distinct = sorted({tuple(x) for _, x in rows})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array(distinct, float) - np.array([s / n for s in sums])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    trace = values.sum()
    exact = {}
    for i, x in rows:
        exact.setdefault(i, []).append(sum((n * c - s) ** 2 for c, s in zip(x, sums)))
    for c in range(k):
        own = [r for r in out if r.component == c + 1]
        assert len(own) == len(rows) and {r.n for r in own} == {n}
        if trace <= 0:
            assert all(r.whitened is None and r.explained is None and r.identity_error is None for r in own)
            continue
        assert all(r.explained == pytest.approx(values[c] / trace, rel=1e-9, abs=1e-12) for r in own)
        if values[c] <= 1e-10 * trace:
            assert all(r.whitened is None for r in own)
            continue
        assert all(r.identity_error < 1e-9 for r in own)
        gaps = [abs(values[c] - values[o]) for o in range(d) if o != c]
        if min(gaps, default=1) > 1e-3 * values[0]:
            want = {}
            for i, x in rows:
                w = (np.array(x, float) - np.array(sums) / n) @ axes[:, c] / math.sqrt(values[c])
                want.setdefault(i, []).append(w)
            sign = 1 if sum(want[r.vec_id][0] * r.whitened for r in own) > 0 else -1
            for i, w in want.items():
                mine = sorted(sign * r.whitened for r in own if r.vec_id == i)
                assert mine == pytest.approx(sorted(w), rel=1e-8, abs=1e-8)
    for i, w in exact.items():
        assert sorted(r.deviation for r in out if r.vec_id == i and r.component == 1) == sorted(w)


def test_embeddings(spark):
    table = cases.table(spark, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in table.select("vec_id", "embedding").collect()]
    check(whitening.whiten(table), rows)


ODD = [
    (1, None), (2, []), (3, [1.0, None, 2.0]), (4, [float("nan"), 0.0, 0.0]), (5, [float("inf"), 0.0, 0.0]),
    (6, [0.5, -0.25, 0.001]), (6, [0.5, -0.25, 0.001]), (7, [-0.0, 0.0, -1e-9]), (None, [3.0, 1.0, 0.0]),
    (8, [0.1, 0.2, 0.3]), (9, [1e30, 0.0, 0.0]), (10, [2.0, 2.0, -7.5]),
]


def test_odd_rows(spark):
    check(whitening.whiten(frame(spark, ODD)), ODD)


def test_other_lengths_take_no_part(spark):
    out = whitening.whiten(frame(spark, ODD + [(11, [1.0, 2.0]), (12, [1.0] * 5)])).collect()
    assert {r.vec_id for r in out} == {6, 7, None, 8, 10}


def test_empty_single_and_flat(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, ODD[:5])).count() == 0
    for rows in ([(1, [0.5, 0.25])], [(k, [0.5, 0.25, 1.0, 2.0, 3.0]) for k in range(5)]):
        check(whitening.whiten(frame(spark, rows)), rows)
    line = [(k, [0.1 * k, 0.2 * k, 0.0, 1.0, 5.0, -0.3 * k]) for k in range(20)]
    check(whitening.whiten(frame(spark, line)), line)


def test_equal_eigenvalues(spark):
    rows = [(2 * k + s, [(-1) ** s * float(k == j) for j in range(6)]) for k in range(6) for s in (0, 1)]
    check(whitening.whiten(frame(spark, rows)), rows)


def test_huge_entries_have_exact_or_null_deviations(spark):
    rows = [(1, [1e7, 0.0]), (2, [0.0, 3.0]), (3, [-2e7, 5.0])]
    out = whitening.whiten(frame(spark, rows)).collect()
    x = {i: v for i, v in usable(rows)}
    sums = [sum(c) for c in zip(*x.values())]
    for r in out:
        exact = sum((3 * c - s) ** 2 for c, s in zip(x[r.vec_id], sums))
        assert r.deviation == (exact if exact < 2**63 else None)


@pytest.mark.parametrize("d, decay", [(64, 0.0), (64, 0.02), (200, 0.001), (5, 0.0), (300, 0.3)])
def test_solver_reaches_double_precision(d, decay):
    rng = np.random.default_rng(d)
    x = rng.standard_normal((2 * d + 50, d)) * np.exp(-decay * np.arange(d))
    a = x.T @ x / len(x)
    values, vectors, norms = whitening.leading_pairs(lambda v: a @ v, d)
    want = np.linalg.eigvalsh(a)[::-1][: len(values)]
    assert values == pytest.approx(want, rel=1e-13)
    assert norms.max() <= 1e-13 * want[0]
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-13


def test_minres_solves_the_projected_equation():
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    a = turn @ np.diag(np.r_[-2, -1, np.linspace(2, 4, 38)]) @ turn.T  # indefinite
    basis = np.linalg.qr(rng.standard_normal((40, 3)))[0]
    right = rng.standard_normal(40)
    solver = whitening.minres(0.3, basis, right, 40, 1e-14)
    [found] = whitening._corrections(lambda v: a @ v, [solver])
    project = np.eye(40) - basis @ basis.T
    residual = project @ (a - 0.3 * np.eye(40)) @ project @ found - project @ right
    assert np.linalg.norm(residual) < 1e-8 and np.abs(basis.T @ found).max() < 1e-10
