"""Whitening of embeddings by a bidiagonal qd solver (operator 12).

1. Entries become exact integers; their sums are exact, and a centred entry is
   ``(n*x - S) / n`` with an exact numerator.
2. Every task reduces its centred rows to the triangular factor of a blockwise
   QR; factors are stacked and reduced again, ``FAN`` at a time, in tasks.
   The covariance matrix is never formed, so small components stay accurate.
3. The last factor (dimension x dimension, the only thing the driver gets) is
   made bidiagonal by Householder reflections.  dqds, with Laguerre shifts,
   gives its singular values, and twisted factorisations their right vectors.
4. Rows are projected in tasks; a further pass merges the centred moments of
   the projections and states how far their covariance is from the identity.

Rows whose vector is null, or holds null or non-finite entries, are left out;
so are vectors whose length is not the most frequent one (of equally frequent
lengths the larger counts) and empty ones.  Components without variance (up to
rounding: singular value at most dimension * epsilon of the largest) are not
returned, so identical vectors give no row, and nor does an empty table.
Repeated rows and null ids stay.  Entries beyond 2**53 in size count as 2**53;
a deviation that is not a 64-bit integer is null.  Other columns are not carried.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurejudge.llm.common import cut_lineage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
FAN = 32                  # factors or moments that are merged at once
BLOCK = 4_096             # rows of a block
EPS = float(np.finfo(np.float64).eps)


# -- singular values and right vectors of a small matrix ---------------------------------------

def _reflector(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(v, beta, alpha) with (I - beta v v') x = alpha e1."""
    v = x.copy()
    norm = float(np.linalg.norm(x))
    if norm == 0.0:
        return v, 0.0, 0.0
    alpha = -math.copysign(norm, x[0])
    v[0] -= alpha
    return v, 2.0 / float(v @ v), alpha


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder: r = Q B P' with B upper bidiagonal; returns its diagonal,
    its superdiagonal and P."""
    a, d = np.array(r, np.float64), r.shape[0]
    p = np.eye(d)
    for k in range(d):
        v, beta, _ = _reflector(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v, beta, _ = _reflector(a[k, k + 1:])
            a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ v, v)
            p[:, k + 1:] -= beta * np.outer(p[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def _laguerre(q: list[float], e: list[float]) -> float:
    """Lower bound of the smallest eigenvalue of B'B, from the first two
    derivatives of its characteristic polynomial at zero."""
    n, d, d1, d2, t1, t2 = len(q), q[0], -1.0, 0.0, 0.0, 0.0
    for i in range(n):
        h = d + (e[i] if i < n - 1 else 0.0)              # pivot and its derivatives by the shift
        u, w = d1 / h, d2 / h
        t1 -= u
        t2 -= w - u * u
        if i < n - 1:
            r = q[i + 1] * e[i] / h
            d, d1, d2 = q[i + 1] * (d / h), r * u - 1.0, r * (w - 2.0 * u * u)
    inside = (n - 1) * (n * t2 - t1 * t1)
    bound = n / (t1 + math.sqrt(max(inside, 0.0)))
    return bound if math.isfinite(bound) and bound > 0 else 0.0


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential quotient-difference step; None if the shift was too large."""
    d, qq, ee = q[0] - shift, [], []
    for i in range(len(e)):
        if d < 0:
            return None
        h = d + e[i]
        qq.append(h)
        if h == 0.0:
            ee.append(0.0)
            d = -shift if q[i + 1] == 0.0 else q[i + 1] - shift
        else:
            ee.append(e[i] * (q[i + 1] / h))
            d = d * (q[i + 1] / h) - shift
    if d < 0:
        return None
    qq.append(d)
    return qq, ee


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the upper bidiagonal matrix, rising, to high
    relative accuracy."""
    out: list[float] = []
    work = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0)]
    tol = (4 * EPS) ** 2
    while work:
        q, e, sigma = work.pop()
        while q:
            n = len(q)
            if n == 1:
                out.append(q[0] + sigma)
                break
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= tol * (sigma + q[i + 1]) or e[i] <= tol * (sigma + q[i])), None)
            if cut is not None:
                work.append((q[cut + 1:], e[cut + 1:], sigma))
                q, e = q[:cut + 1], e[:cut]
                continue
            shift = _laguerre(q, e) * (1 - 1e-6) if min(q) > 0 else 0.0
            step = _dqds_step(q, e, shift)
            while step is None:
                shift = shift / 2 if shift > EPS * (sigma + max(q)) else 0.0
                step = _dqds_step(q, e, shift)
            (q, e), sigma = step, sigma + shift
    return np.sort(np.array(out))


def _twisted(a: np.ndarray, b: np.ndarray, lam: float, taken: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of B'B for ``lam`` by the twisted factorisation whose
    twist element is the smallest; of a cluster, orthogonal to the ``taken`` ones."""
    n = len(a)
    big, low = a * a, b / a[:-1]
    tiny = EPS ** 2 * float(big.max())
    s, plus = np.empty(n), np.empty(max(n - 1, 0))
    s[0] = -lam
    for i in range(n - 1):
        pivot = s[i] + big[i]
        pivot = pivot if abs(pivot) > tiny else -tiny
        plus[i] = big[i] * low[i] / pivot
        s[i + 1] = plus[i] * low[i] * s[i] - lam
    p, minus = np.empty(n), np.empty(max(n - 1, 0))
    p[n - 1] = big[n - 1] - lam
    for i in range(n - 2, -1, -1):
        pivot = big[i] * low[i] ** 2 + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        t = big[i] / pivot
        minus[i] = low[i] * t
        p[i] = p[i + 1] * t - lam
    twist = np.abs(s + p + lam)
    best = None
    for r in np.argsort(twist, kind="stable")[: 2 * len(taken) + 1]:
        z = np.zeros(n)
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -plus[i] * z[i + 1]
            if abs(z[i]) > 1e100:
                z[i:] *= 1e-100
        for i in range(r, n - 1):
            z[i + 1] = -minus[i] * z[i]
            if abs(z[i + 1]) > 1e100:
                z[:i + 2] *= 1e-100
        z /= np.linalg.norm(z)
        left = z.copy()
        for _ in range(2):
            for other in taken:
                left -= (other @ left) * other
        norm = float(np.linalg.norm(left))
        if best is None or norm > best[0]:
            best = norm, left / norm if norm else left
        if norm > 0.5:
            break
    return best[1]


def principal(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Of a matrix r: the largest squared singular values (falling), their right
    singular vectors as columns, and the sum of all squared singular values."""
    d = r.shape[0]
    a, b, p = bidiagonal(r)
    norm = max(float(np.abs(a).max(initial=0.0)), float(np.abs(b).max(initial=0.0)))
    if norm == 0.0:
        return np.empty(0), np.empty((d, 0)), 0.0
    a, b = a / norm, b / norm
    # within the error that r itself has
    a = np.where(np.abs(a) < EPS * 1e-3, EPS * 1e-3, a)
    b = np.where(np.abs(b) < EPS, 0.0, b)
    found, at = [], 0
    for end in [*(np.flatnonzero(b == 0.0) + 1).tolist(), d]:
        block = slice(at, end)
        aa, bb = a[block], b[at:end - 1]
        values, cluster = dqds(aa, bb)[::-1], []
        for k, lam in enumerate(values.tolist()):
            if cluster and values[k - 1] - lam > 1e-3 * values[k - 1]:
                cluster = []
            z = _twisted(aa, bb, lam, cluster)
            cluster.append(z)
            found.append((lam, at, z))
        at = end
    total = math.fsum(lam for lam, _, _ in found)
    found.sort(key=lambda f: -f[0])
    keep = [f for f in found[:components] if math.sqrt(f[0]) > d * EPS * math.sqrt(found[0][0])]
    vectors = np.zeros((d, len(keep)))
    for k, (_, at, z) in enumerate(keep):
        vectors[at:at + len(z), k] = z
    return np.array([f[0] for f in keep]) * norm ** 2, p @ vectors, total * norm ** 2


# -- passes over the rows ----------------------------------------------------------------------

def usable(vec: Column) -> Column:
    """The vector is there, not empty, and all its entries are finite numbers."""
    def bad(c: Column) -> Column:
        c = c.cast("double")
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return vec.isNotNull() & (F.size(vec) > 0) & ~F.coalesce(F.exists(vec, bad), F.lit(True))


def _blocks(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integers of rows x dim) of a batch, a block at a time."""
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.column(batch.num_columns - 1).slice(at, BLOCK)
        c = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
        yield at, np.clip(np.floor(SCALE * c), -2.0 ** 53, 2.0 ** 53).astype(np.int64) + OFFSET


class Centre:
    """n and S of the fit list, and exact differences to the mean."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n*x - S: 64-bit integers, or Python's where those could run over."""
        top = max(int(x.max(initial=0)), -int(x.min(initial=0)), 1) * self.n + max(map(abs, self.sums))
        kind = np.int64 if top < 2 ** 63 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (self.scaled(x) / self.n).astype(np.float64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact squared distance of n*x to S; None beyond 64 bits."""
        y = self.scaled(x)
        if y.dtype == np.int64 and float(np.abs(y.astype(np.float64)).max(initial=0)) ** 2 * y.shape[1] < 2.0 ** 62:
            return (y * y).sum(axis=1).tolist()
        exact = [sum(v * v for v in map(int, row)) for row in y]
        return [v if v < 2 ** 63 else None for v in exact]


def _fold(parts: DataFrame, merge) -> bytes | None:
    """The merge of all rows of ``parts`` (part int, state binary): ``FAN`` a
    task until at most ``FAN`` are left; the order is that of the parts."""
    parts = cut_lineage(parts)

    def some(frame):
        import pandas as pd
        frame = frame.sort_values("part")
        return pd.DataFrame({"part": [int(frame["part"].iloc[0]) // FAN], "state": [merge(list(frame["state"]))]})
    while parts.count() > FAN:
        parts = cut_lineage(parts.groupBy(F.floor(F.col("part") / FAN).alias("__group")).applyInPandas(some, "part long, state binary"))
    states = [bytes(r["state"]) for r in sorted(parts.collect(), key=lambda r: r["part"])]
    return merge(states) if states else None


def _stacked(factors: list[bytes]) -> bytes:
    dim = math.isqrt(len(factors[0]) // 8)
    stack = np.concatenate([np.frombuffer(f).reshape(dim, dim) for f in factors])
    return np.ascontiguousarray(np.linalg.qr(stack, mode="r")).tobytes()


def _moments(y: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    mean = y.mean(axis=0)
    centred = y - mean
    return len(y), mean, centred.T @ centred


def _joined(a, b):
    """Moments of two sets of rows from those of each."""
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def _pack(m) -> bytes:
    return np.concatenate([[float(m[0])], m[1], m[2].ravel()]).tobytes()


def _unpack(state: bytes, k: int):
    v = np.frombuffer(state)
    return v[0], v[1:k + 1], v[k + 1:].reshape(k, k)


def whiten(rows: DataFrame, components: int = COMPONENTS, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a
    row for each usable row and component."""
    spark = rows.sparkSession
    key_type = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {key_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    source = rows.where(usable(F.col(vec))).select(F.col(key).alias("__key"), F.col(vec).alias("__vec"))
    # a row for each length that occurs
    lengths = source.groupBy(F.size("__vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim = lengths["d"]
    source = source.where(F.size("__vec") == dim)
    vectors = source.select("__vec")

    def sums(batches):
        n, total = 0, [0] * dim
        for batch in batches:
            for _, x in _blocks(batch, dim):
                n += len(x)
                total = [a + int(b) for a, b in zip(total, x.astype(object).sum(axis=0) if np.abs(x).max() > 2 ** 48 else x.sum(axis=0))]
        if n:
            yield pa.record_batch([pa.array(range(dim), pa.int32()), pa.array(total, pa.decimal128(38, 0)), pa.array([n] * dim, pa.int64())],
                                  names=["d", "s", "n"])
    found = (vectors.mapInArrow(sums, "d int, s decimal(38,0), n long").groupBy("d").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
             .orderBy("d").collect())
    centre = Centre(found[0]["n"], [int(r["s"]) for r in found])

    def factors(batches):
        r = np.zeros((0, dim))
        for batch in batches:
            for _, x in _blocks(batch, dim):
                r = np.linalg.qr(np.concatenate([r, centre.rows(x)]), mode="r")
        if len(r):
            square = np.zeros((dim, dim))
            square[:len(r)] = r
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([square.tobytes()], pa.binary())],
                                  names=["part", "state"])
    r = np.frombuffer(_fold(vectors.mapInArrow(factors, "part long, state binary"), _stacked)).reshape(dim, dim)
    squares, directions, total = principal(r, components)
    k = len(squares)
    if k == 0:
        return spark.createDataFrame([], schema)
    projection = directions / np.sqrt(squares / centre.n)
    explained = squares / total

    def second_moments(batches):
        state = None
        for batch in batches:
            for _, x in _blocks(batch, dim):
                m = _moments(centre.rows(x) @ projection)
                state = m if state is None else _joined(state, m)
        if state is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([_pack(state)], pa.binary())],
                                  names=["part", "state"])

    def merged(states: list[bytes]) -> bytes:
        out = _unpack(states[0], k)
        for s in states[1:]:
            out = _joined(out, _unpack(s, k))
        return _pack(out)
    moments = _unpack(_fold(vectors.mapInArrow(second_moments, "part long, state binary"), merged), k)
    error = float(np.abs(moments[2] / centre.n - np.eye(k)).max())

    def project(batches):
        for batch in batches:
            for at, x in _blocks(batch, dim):
                m = len(x)
                each = np.repeat(np.arange(m), k)
                yield pa.record_batch([
                    batch.column(0).slice(at, m).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, centre.n, np.int64)),
                    pa.array(centre.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array((centre.rows(x) @ projection).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ], names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return source.mapInArrow(project, schema)
