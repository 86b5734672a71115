import numpy as np
import pytest
from llm_helpers import wide

from fleetlake.llm import spectrum_whitening as w


def frame(spark, rows):
    return wide(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))


def check(rows, found, components=32):
    """Against exact integers and a dense eigensolver."""
    x = np.floor(64 * np.array([v for _, v in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    n, d = x.shape
    sums = x.sum(axis=0)
    y = x - sums / n
    values, axes = np.linalg.eigh(y.T @ y / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    m = min(components, d)
    deviation = {i: sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums)) for (i, _), v in zip(rows, x)}
    assert {r["vec_id"]: r["deviation"] for r in found} == deviation
    assert all(r["n"] == n and len(r["whitened"]) == m for r in found)
    assert found[0]["values"] == pytest.approx(values[:m], rel=1e-9, abs=1e-9)
    by = {r["vec_id"]: r["whitened"] for r in found}
    z = np.array([by[i] for i, _ in rows])
    truth = y @ axes / np.sqrt(values)
    sign = np.sign((z * truth).sum(axis=0))
    assert np.abs(z - truth * sign).max() < 1e-7
    assert found[0]["identity_error"] == pytest.approx(np.abs(z.T @ z / n - np.eye(m)).max(), abs=1e-9)
    assert found[0]["identity_error"] < 1e-10
    trace = (y * y).sum() / n
    assert found[0]["explained"] == pytest.approx(values[:m] / trace, rel=1e-9)


def test_whole_table(load):
    rows = [(r["vec_id"], r["embedding"]) for r in load("embeddings").collect()]
    check(rows, w.whiten(load("embeddings")).collect())


def test_spread_spectrum_and_left_out_rows(spark):
    draw = np.random.default_rng(4)
    rows = [(i, (draw.standard_normal(12) * np.logspace(2, -1, 12) + 30).tolist()) for i in range(300)]
    odd = [(900, None), (901, []), (902, [1.0] * 11), (903, [None] * 12), (904, [float("nan")] * 12),
           (905, [float("-inf")] + [1.0] * 11)]
    check(rows, w.whiten(frame(spark, rows + odd)).collect())


def test_degenerate_tables(spark):
    assert w.whiten(frame(spark, [(1, [1.0])]).limit(0)).count() == 0
    assert w.whiten(frame(spark, [(1, None)])).count() == 0
    one = w.whiten(frame(spark, [(1, [1.0, 2.0, 3.0])])).collect()
    assert [(r["deviation"], r["whitened"], r["n"], r["identity_error"]) for r in one] == [(0, [None] * 3, 1, 0.0)]
    # Two repeated rows and a null id: one direction, the others are null.
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [3.0, 0.0])]
    found = w.whiten(frame(spark, rows)).collect()
    assert sorted(round(abs(r["whitened"][0]), 6) for r in found) == [0.707107, 0.707107, 1.414214]
    assert all(r["whitened"][1] is None and r["explained"] == [1.0, 0.0] for r in found)


def test_equal_eigenvalues(spark):
    # The corners of a cube: all eigenvalues are the same.
    rows = [(i, [float(i >> b & 1) for b in range(5)]) for i in range(32)]
    found = w.whiten(frame(spark, rows)).collect()
    z = np.array([r["whitened"] for r in found])
    assert np.abs(z.T @ z / 32 - np.eye(5)).max() < 1e-10 and found[0]["values"] == pytest.approx([1024.0] * 5)


def test_inertia_counts():
    draw = np.random.default_rng(5)
    for d in (1, 2, 5, 40):
        for v in (draw.standard_normal((d, d)), np.kron(np.eye(d), [[0.0, 1.0], [1.0, 0.0]]), np.ones((d, d))):
            v = v + v.T
            values = np.linalg.eigvalsh(v)
            for s in (-3.3, -0.5, 0.1, 0.7, 2.9):
                assert w.above(v, s) == (values > s).sum()


def test_leading_eigenvalues_of_clustered_spectra():
    draw = np.random.default_rng(6)
    for values in ([5.0] * 6 + [1.0] * 4, np.r_[1 + 1e-9 * np.arange(6), 0.1, 0.0, 0.0, 0.0], np.logspace(6, -8, 10),
                   np.zeros(10)):
        q, _ = np.linalg.qr(draw.standard_normal((10, 10)))
        v = (q * np.sort(values)[::-1]) @ q.T
        v = (v + v.T) / 2
        found, axes = w.leading(v, 8)
        assert np.abs(found - np.linalg.eigvalsh(v)[::-1][:8]).max() <= 1e-12 * max(np.abs(v).max(), 1)
        assert np.abs(axes.T @ axes - np.eye(8)).max() < 1e-10
