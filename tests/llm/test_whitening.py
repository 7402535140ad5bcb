"""Whitening: the qd solver against numpy, the query against plain linear algebra."""
import numpy as np
import pytest

from featurejudge.llm import queries, whitening
from featurejudge.llm.common import load

SF = "/root/testdata/sf0.01"


def cases():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 40))
    twice = base.copy()
    twice[:, 20:] = twice[:, :20]
    gone = base.copy()
    gone[:, 3], gone[:, 7] = 0, gone[:, 8]
    u, _ = np.linalg.qr(rng.normal(size=(300, 40)))
    v, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    near = np.ones(40)
    near[20:] += rng.normal(size=20) * 1e-12
    return {"plain": base, "one": base[:, :1], "two": base[:, :2], "rank": twice, "zero columns": gone, "graded": base * np.logspace(0, -7, 40),
            "clusters": u * near @ v.T, "equal": np.eye(40) * 3}


@pytest.mark.parametrize("name", cases())
def test_solver(name):
    a = cases()[name]
    squares, vectors, total = whitening.principal(np.linalg.qr(a, mode="r"), a.shape[1])
    want = np.linalg.svd(a, compute_uv=False) ** 2
    k = len(squares)
    assert k == np.linalg.matrix_rank(a, tol=1e-12)
    assert np.allclose(squares, want[:k], rtol=1e-11, atol=0)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-11
    assert np.abs(a.T @ (a @ vectors) - vectors * squares).max() < 1e-12 * want[0]
    assert total == pytest.approx(want.sum(), rel=1e-12)


def test_small_singular_values_are_accurate():
    a, b = np.array([1.0, 1e-8, 1e-3, 1e-12]), np.array([0.5, 1e-6, 1e-9])
    got = np.sqrt(whitening.dqds(a, b))
    assert np.prod(got) == pytest.approx(np.prod(a), rel=1e-13)
    # the smallest one by exact rational arithmetic on the inverse
    inverse = np.linalg.inv(np.diag(a) + np.diag(b, 1))
    assert got[0] == pytest.approx(1 / np.linalg.norm(inverse, 2), rel=1e-9)


def by_hand(vectors, k=whitening.COMPONENTS):
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = n * x - s
    v = (y.astype(float).T / n) @ (y.astype(float) / n) / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return [sum(int(c) ** 2 for c in row) for row in y], (y / n) @ u / np.sqrt(e), e / np.trace(v)


def test_given_embeddings(spark):
    rows = load(spark, SF, "embeddings", "vec_id", "embedding").toPandas().sort_values("vec_id")
    deviation, whitened, explained = by_hand(np.stack(rows["embedding"]))
    got = queries.QUERIES["op12_whitening"](spark, SF).toPandas().sort_values(["vec_id", "component"])
    n, k = len(rows), 32
    assert got["vec_id"].tolist() == np.repeat(rows["vec_id"].to_numpy(), k).tolist()
    assert got["component"].tolist() == list(range(1, k + 1)) * n
    assert (got["n"] == n).all()
    assert got["deviation"].tolist() == np.repeat(deviation, k).tolist()
    w = got["whitened"].to_numpy().reshape(n, k)
    assert np.abs(np.abs(w) - np.abs(whitened)).max() < 1e-8
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-9
    assert np.allclose(got["explained"].to_numpy().reshape(n, k), explained, rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


def test_many_parts_are_folded(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rows = load(spark, SF, "embeddings", "vec_id", "embedding").where("vec_id % 3 = 0").repartition(9)
    plain = rows.toPandas().sort_values("vec_id")
    deviation, whitened, _ = by_hand(np.stack(plain["embedding"]), 5)
    got = whitening.whiten(rows, 5).toPandas().sort_values(["vec_id", "component"])
    assert np.abs(np.abs(got["whitened"].to_numpy().reshape(-1, 5)) - np.abs(whitened)).max() < 1e-8


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, -1.0]), (None, [0.5, 0.25]), (4, None), (5, [1.0, None]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, []), (9, [1.0]), (10, [0.0, 9.0])]
    frame = spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], "vec_id long, embedding array<double>, n long, component string, whitened double")
    got = whitening.whiten(frame).collect()
    kept = [r for r in rows if r[0] in (1, 2, None, 10)]
    deviation, whitened, explained = by_hand([r[1] for r in kept])
    assert sorted((str(r["vec_id"]), r["component"], r["n"], r["deviation"]) for r in got) == sorted(
        (str(r[0]), c, 5, d) for r, d in zip(kept, deviation) for c in (1, 2))
    assert whitening.whiten(frame.where("vec_id = 1")).count() == 0          # equal vectors have no component
    assert whitening.whiten(frame.where("false")).count() == 0
    assert whitening.whiten(frame.where("vec_id in (4, 8)")).count() == 0
    # beyond 64 bits: no exact deviation, still a row
    huge = spark.createDataFrame([(1, [1e30]), (2, [-1e30]), (3, [1.0])], "vec_id long, embedding array<double>")
    assert {r["vec_id"]: r["deviation"] is None for r in whitening.whiten(huge).collect()} == {1: True, 2: True, 3: False}
