import numpy as np
import pytest

from promptmill.llm import queries, whitening

TYPE = "vec_id long, embedding array<float>, x string, n long"


def plain(rows):
    """Restatement with one eigenvalue decomposition."""
    kept = [(k, v) for k, v, *_ in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in kept)
    xs = [tuple(int(np.floor(256.0 * float(np.float32(c)))) for c in v) + (0,) * (width - len(v))
          for _, v in kept]
    fit = sorted(set(xs))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for (key, _), x in zip(kept, xs):
        away = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for i in range(min(4, int((values > 1e-12 * values[0]).sum()))):
            y = (np.array(x) - np.array(sums) / n) @ vectors[:, i] / np.sqrt(values[i])
            out.setdefault((key, i + 1), []).append(
                (n, away, y, values[i] / values.sum()))
    return out


def compare(got, want):
    rows = [r.asDict() for r in got.collect()]
    assert len(rows) == sum(map(len, want.values()))
    signs = {}
    for r in rows:
        n, away, y, share = want[r["vec_id"], r["component"]][0]
        assert (r["n"], r["deviation"]) == (n, away)
        assert r["explained"] == pytest.approx(share, rel=1e-9)
        assert r["identity_error"] < 1e-9
        sign = signs.setdefault(r["component"], np.sign(y * r["whitened"])) if abs(y) > 1e-3 \
            else signs.get(r["component"], 0)
        if sign:
            assert r["whitened"] * sign == pytest.approx(y, rel=1e-8, abs=1e-8)


def vectors(n=80, width=6, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width)) * np.array([3, 2, 1, .5, .3, .2])[:width]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(i + n, rows[0][1]) for i in range(40)]
    rows += [(500, None), (501, [None] * width), (502, [float("nan")] * width),
             (503, [float("inf")] + [0.0] * (width - 1)), (None, rows[1][1]), (7, rows[2][1]),
             (504, [0.25, -0.5])]
    return rows


def test_query_rows(spark, tmp_path):
    rows = vectors()
    spark.createDataFrame([(*r, "own", 1) for r in rows], TYPE).repartition(5) \
        .write.parquet(f"{tmp_path}/embeddings.parquet")
    want = plain(rows)
    # vec_id 7 stands twice, with different vectors
    want = {k: v for k, v in want.items() if k[0] != 7}
    out = queries.op11_lanczos_whitening(spark, str(tmp_path))
    assert out.where("vec_id = 7").count() == 8
    compare(out.where("vec_id IS NULL OR vec_id != 7"), want)


def test_rank_below_the_width(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-3, 4, (30, 2))
    rows = [(i, [float(a), float(b), float(a + b), 0.0, 2.0], "", 0)
            for i, (a, b) in enumerate(base)]
    got = whitening.whitened(spark.createDataFrame(rows, TYPE))
    assert {r["component"] for r in got.select("component").distinct().collect()} == {1, 2}
    compare(got, plain(rows))


def test_equal_eigenvalues(spark):
    """Every unit vector and its negative: all eigenvalues are the same."""
    rows = []
    for i in range(5):
        for sign in (1.0, -1.0):
            v = [0.0] * 5
            v[i] = sign
            rows.append((len(rows), v, "", 0))
    out = whitening.whitened(spark.createDataFrame(rows, TYPE)).collect()
    assert len(out) == 40 and {r["n"] for r in out} == {10}
    assert all(r["explained"] == pytest.approx(0.2) and r["identity_error"] < 1e-9 for r in out)


def test_single_vector_and_empty_table(spark):
    one = spark.createDataFrame([(1, [0.5, 1.0], "", 0), (2, [0.5, 1.0], "", 0)], TYPE)
    assert whitening.whitened(one).count() == 0
    none = whitening.whitened(one.limit(0))
    assert none.count() == 0 and none.columns[:3] == ["vec_id", "component", "n"]
    assert whitening.whitened(spark.createDataFrame([(1, [], "", 0)], TYPE)).count() == 0


def test_bidiagonalisation():
    """X = U B V', with orthonormal sides."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((200, 12))
    right, alphas, betas, left = whitening.bidiagonal(lambda p: x.T @ (x @ p), 12)
    sides = x @ left.T
    assert np.allclose(right @ right.T, np.eye(12), atol=1e-12)
    assert np.allclose(sides.T @ sides, np.eye(12), atol=1e-10)
    assert np.allclose(sides @ (np.diag(alphas) + np.diag(betas, 1)) @ right, x, atol=1e-9)


def test_large_deviations():
    x = np.array([[3, -2], [1 << 40, 5]])
    assert whitening.deviations(x, 7, [10, 4]) == [(21 - 10) ** 2 + (-14 - 4) ** 2, None]
    assert whitening.deviations(x[:1], 7, [10, 4]) == [445]
    big = np.array([[1 << 27, 0]])
    assert whitening.deviations(big, 10, [0, 1]) == [(10 << 27) ** 2 + 1]
