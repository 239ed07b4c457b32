"""Embedding whitening: a covariance in double-double across tasks, and a divide-and-conquer eigen-solve of it.

Sums and centred outer products are pairs of doubles (high, low), added and multiplied by error-free transformations, so
a covariance of vectors far from zero loses nothing. A task keeps one accumulator, whatever its rows; tasks' pairs are
merged row of the matrix by row of the matrix on Spark, and only the matrix, which the number of dimensions bounds,
reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.common import fresh_name, let_go, needs, stored

CELLS_AT_ONCE = 1 << 19  # products that a task holds at a time
EPS = np.finfo(np.float64).eps

Pair = tuple[np.ndarray, np.ndarray]


# --- double-double ---


def two_sum(a, b) -> Pair:
    """a + b rounded, and exactly what rounding lost."""
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


def _halves(a) -> Pair:
    """a as the sum of two numbers of at most 26 bits."""
    t = a * 134217729.0  # 2 ** 27 + 1
    high = t - (t - a)
    return high, a - high


def two_product(a, b) -> Pair:
    """a * b rounded, and exactly what rounding lost."""
    p = a * b
    (ah, al), (bh, bl) = _halves(a), _halves(b)
    return p, ((ah * bh - p) + ah * bl + al * bh) + al * bl


def add_pairs(x: Pair, y: Pair) -> Pair:
    s, e = two_sum(x[0], y[0])
    t, f = two_sum(x[1], y[1])
    s, e = two_sum(s, e + t)
    return two_sum(s, e + f)


def multiply_pairs(x: Pair, y: Pair) -> Pair:
    p, e = two_product(x[0], y[0])
    return two_sum(p, e + (x[0] * y[1] + x[1] * y[0]))


def sum_pairs(x: Pair) -> Pair:
    """The sum over the first axis, by halves."""
    high, low = x
    while len(high) > 1:
        half = len(high) // 2
        s = add_pairs((high[:half], low[:half]), (high[half : 2 * half], low[half : 2 * half]))
        odd = slice(2 * half, None)
        high, low = np.concatenate([s[0], high[odd]]), np.concatenate([s[1], low[odd]])
    return high[0], low[0]


def pair_of(value: Fraction) -> tuple[float, float]:
    high = float(value)
    return high, float(value - Fraction(high))


def fraction_of(high: float, low: float) -> Fraction:
    return Fraction(float(high)) + Fraction(float(low))


# --- sums and covariance on Spark ---


def _merged(parts: DataFrame) -> DataFrame:
    """(row, high, low) of many tasks as one for each row; a task holds an accumulator for each of its rows, no list."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, Pair] = {}
        for batch in batches:
            for row, high, low in zip(batch["row"], batch["high"], batch["low"], strict=True):
                pair = (np.asarray(high), np.asarray(low))
                held[row] = add_pairs(held[row], pair) if row in held else pair
        for row, (high, low) in held.items():
            yield pd.DataFrame({"row": [row], "high": [high], "low": [low]})
        let_go()

    return parts.repartition("row").mapInPandas(of, parts.schema)


_PARTS = "row int, high array<double>, low array<double>"


def _rows_at_once(batch: pd.Series, cells: int, kind: type = np.float64) -> Iterator[np.ndarray]:
    step = max(1, CELLS_AT_ONCE // max(cells, 1))
    for at in range(0, len(batch), step):
        yield np.stack(batch.iloc[at : at + step].to_list()).astype(kind)


def vector_sums(df: DataFrame, column: str) -> tuple[int, list[Fraction]]:
    """The number of rows and the sum of each dimension: exact for integers whose sums stay under 2 ** 105."""
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, held = 0, None
        for batch in batches:
            for x in _rows_at_once(batch[column], len(batch[column].iloc[0]) if len(batch) else 1):
                n += len(x)
                pair = sum_pairs((x, np.zeros_like(x)))
                held = pair if held is None else add_pairs(held, pair)
        if held is not None:
            yield pd.DataFrame({"row": [0, 1], "high": [held[0], [float(n)]], "low": [held[1], [0.0]]})
        let_go()

    found = {r["row"]: r for r in _merged(df.select(column).mapInPandas(of, _PARTS)).collect()}
    if not found:
        return 0, []
    return int(found[1]["high"][0]), [fraction_of(h, low) for h, low in zip(found[0]["high"], found[0]["low"], strict=True)]


def covariance(df: DataFrame, column: str, n: int, sums: list[Fraction]) -> Pair:
    """The covariance (divisor n) of vectors, as a pair of matrices; each is centred before it is multiplied."""
    mean = np.array([pair_of(s / n) for s in sums]).reshape(-1, 2)
    d = len(sums)
    rows, cols = np.triu_indices(d)
    begins = np.searchsorted(rows, np.arange(d))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = (np.zeros(len(rows)), np.zeros(len(rows)))
        for batch in batches:
            for x in _rows_at_once(batch[column], 4 * len(rows)):
                high, low = two_sum(x, -mean[:, 0])
                high, low = two_sum(high, low - mean[:, 1])
                products = multiply_pairs((high[:, rows], low[:, rows]), (high[:, cols], low[:, cols]))
                held = add_pairs(held, sum_pairs(products))
        for i in range(d):
            of_row = slice(begins[i], begins[i] + d - i)
            yield pd.DataFrame({"row": [i], "high": [held[0][of_row]], "low": [held[1][of_row]]})
        let_go()

    high, low = np.zeros((d, d)), np.zeros((d, d))
    for r in _merged(df.select(column).mapInPandas(of, _PARTS)).collect():
        exact = [pair_of(fraction_of(h, e) / n) for h, e in zip(r["high"], r["low"], strict=True)]
        i = r["row"]
        high[i, i:], low[i, i:] = [h for h, _ in exact], [e for _, e in exact]
        high[i:, i], low[i:, i] = high[i, i:], low[i, i:]
    return high, low


# --- eigenvalues and eigenvectors of a symmetric matrix ---


def scaled(x: np.ndarray, least: float = 0.0) -> tuple[np.ndarray, int]:
    """(x / 2 ** k, k) with the larger of x's largest entry and ``least`` brought between a half and one."""
    k = int(np.frexp(max(np.abs(x).max(), least))[1])
    return np.ldexp(x, -k), k


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, diagonal, off-diagonal) with a = q t q^T, by Householder reflections."""
    a, n = a.copy(), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = scaled(a[k + 1 :, k])[0]  # a small column's squares would underflow, and its reflection not be orthogonal
        x[0] += np.copysign(np.linalg.norm(x), x[0])
        size = np.linalg.norm(x)
        if size == 0:
            continue
        v = x / size
        a[k + 1 :, :] -= 2 * np.outer(v, v @ a[k + 1 :, :])
        a[:, k + 1 :] -= 2 * np.outer(a[:, k + 1 :] @ v, v)
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return q, np.diag(a).copy(), np.diag(a, -1).copy()


def _secular(d: np.ndarray, z2: np.ndarray, rho: float) -> np.ndarray:
    """Gaps d_i - root_j of 1 + rho * sum(z2_i / (d_i - root)) = 0 for rising, different d, as a matrix (i, j).

    Every root is found as its distance from the nearer of the two poles around it, by bisection down to neighbouring
    doubles; so the gaps are right to the last digits even where a root all but meets a pole.
    """
    k = len(d)
    upper = np.append(d[1:], d[-1] + rho * z2.sum())
    middle = d + (upper - d) / 2
    at_middle = 1 + rho * (z2[:, None] / (d[:, None] - middle[None, :])).sum(axis=0)
    right = at_middle < 0  # the root lies in the right half, as the function rises between two poles
    right[-1] = False
    origin = np.where(right, np.arange(k) + 1, np.arange(k)).clip(0, k - 1)
    from_pole = d[:, None] - d[origin][None, :]
    width = upper - d
    low, high = np.where(right, -(width - (middle - d)), 0.0), np.where(right, 0.0, width)
    for _ in range(1200):
        step = low + (high - low) / 2
        if np.all((step == low) | (step == high)):
            break
        # Where both ends are far apart in size the geometric middle reaches the root's size sooner.
        small, large = np.minimum(np.abs(low), np.abs(high)), np.maximum(np.abs(low), np.abs(high))
        far = (small > 0) & (large > 4 * small)
        step = np.where(far, np.copysign(np.sqrt(small) * np.sqrt(large), step), step)
        from_zero = (small == 0) & (large > 1e-290)
        step = np.where(from_zero, np.copysign(large * 2.0**-16, step), step)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            value = 1 + rho * (z2[:, None] / (from_pole - step[None, :])).sum(axis=0)
        below = value < 0
        low, high = np.where(below, step, low), np.where(below, high, step)
    return from_pole - np.where(right, low, high)[None, :]


def _joined(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of diag(d) + rho z z^T with rho > 0."""
    order = np.argsort(d, kind="stable")
    d, size = scaled(d[order], rho * float(z @ z))  # weights over small gaps would overflow
    z, rho = z[order].copy(), float(np.ldexp(rho, -size))
    n, turned = len(d), np.eye(len(d))
    tiny = 8 * EPS * max(np.abs(d).max(), rho * float(z @ z))
    last = -1
    for i in range(n):  # of equal entries of d a rotation leaves all but one without weight
        if rho * abs(z[i]) * np.linalg.norm(z) <= tiny:
            z[i] = 0.0
            continue
        if last >= 0:
            r = np.hypot(z[i], z[last])
            c, s = z[i] / r, z[last] / r
            if abs((d[i] - d[last]) * c * s) <= tiny:
                z[i], z[last] = r, 0.0
                turned[:, [last, i]] = turned[:, [last, i]] @ np.array([[c, s], [-s, c]])
                d[last], d[i] = d[last] * c * c + d[i] * s * s, d[last] * s * s + d[i] * c * c
        last = i
    live = np.flatnonzero(z)
    live = live[np.argsort(d[live], kind="stable")]
    values, vectors = d.copy(), np.eye(n)
    if len(live):
        dl, zl = d[live], z[live]
        gaps = _secular(dl, zl * zl, rho)
        # Weights for which the roots found are exact, so that the vectors are orthogonal to the last digits.
        between = dl[None, :] - dl[:, None]
        np.fill_diagonal(between, 1.0)
        ratio = -gaps / np.where(np.eye(len(dl), dtype=bool), 1.0, between)
        zh = np.copysign(np.sqrt(np.abs(np.prod(ratio, axis=1))), zl)
        with np.errstate(divide="ignore", invalid="ignore"):
            w = zh[:, None] / gaps
        hit = gaps == 0
        w[:, hit.any(axis=0)] = hit[:, hit.any(axis=0)].astype(float)
        w /= np.linalg.norm(w, axis=0)
        nearest = np.abs(gaps).argmin(axis=0)
        values[live] = dl[nearest] - gaps[nearest, np.arange(len(dl))]
        vectors[np.ix_(live, live)] = w
    out = np.empty((n, n))
    out[order] = turned @ vectors
    return np.ldexp(values, size), out


def _conquered(d: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and vectors of a symmetric tridiagonal matrix, by halves and a rank-one joint."""
    n = len(d)
    if n == 1:
        return d.copy(), np.ones((1, 1))
    m = n // 2
    rho, sign = abs(e[m - 1]), 1.0 if e[m - 1] >= 0 else -1.0
    first, second = d[:m].copy(), d[m:].copy()
    first[-1] -= rho
    second[0] -= rho
    (d1, q1), (d2, q2) = _conquered(first, e[: m - 1]), _conquered(second, e[m:])
    q = np.zeros((n, n))
    q[:m, :m], q[m:, m:] = q1, q2
    both = np.concatenate([d1, d2])
    if rho == 0:
        return both, q
    values, vectors = _joined(both, np.concatenate([q1[-1], sign * q2[0]]), rho)
    return values, q @ vectors


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    size = np.abs(a).max() if a.size else 0.0
    if size == 0:
        return np.zeros(len(a)), np.eye(len(a))
    q, d, e = tridiagonal(a / size)
    values, vectors = _conquered(d, e)
    vectors = q @ vectors
    order = np.argsort(-values, kind="stable")
    return values[order] * size, vectors[:, order] / np.linalg.norm(vectors[:, order], axis=0)


# --- the operator ---


@dataclass(frozen=True)
class Whitening:
    """n vectors' exact sums, the components (columns), their eigenvalues and the covariance's trace."""

    n: int
    sums: list[Fraction]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def apply(self, df: DataFrame, vector: str, out: str) -> DataFrame:
        """df with ``out``: the vector less the mean, projected on each component, over the root of its eigenvalue."""
        mean = np.array([pair_of(s / self.n) for s in self.sums]).reshape(-1, 2)
        turn = self.components / np.sqrt(self.eigenvalues)

        @F.pandas_udf("array<double>")
        def of(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in vectors:
                rows = []
                for x in _rows_at_once(batch, len(mean)) if len(batch) else ():
                    rows += list(((x - mean[:, 0]) - mean[:, 1]) @ turn)
                yield pd.Series(rows, dtype=object)

        return df.withColumn(out, of(F.col(vector)))


def fit(df: DataFrame, vector: str, components: int = 8) -> Whitening | None:
    """The whitening of vectors of equal length; None of no vectors.

    A component whose eigenvalue is zero to double precision has no direction and nothing to divide by: it is left out.
    """
    n, sums = vector_sums(df, vector)
    if not n:
        return None
    high, _ = covariance(df, vector, n, sums)
    values, vectors = eigen(high)
    kept = [k for k in range(min(components, len(values))) if values[k] > len(values) * EPS * values[0]]
    return Whitening(n, sums, vectors[:, kept], values[kept], float(np.trace(high)))


def identity_error(df: DataFrame, whitened: str) -> float:
    """The largest absolute entry of a column's covariance less the identity."""
    n, sums = vector_sums(df, whitened)
    if not n or not sums:
        return 0.0
    high, low = covariance(df, whitened, n, sums)
    return float(np.abs((high - np.eye(len(high))) + low).max())


def finite(vector: Column) -> Column:
    """Whether a vector is neither null nor empty and all its entries are finite numbers."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & (F.size(vector) > 0), F.lit(False))


def quantised(vector: Column) -> Column:
    """floor(1024 * c) + 100000 of each entry c taken as a double; beyond 2 ** 52 either way it is clipped."""
    def of(c: Column) -> Column:
        scaled = F.least(F.greatest(c.cast("double") * 1024, F.lit(-(2.0**52))), F.lit(2.0**52))
        return F.floor(scaled) + F.lit(100000).cast("long")

    return F.transform(vector, of)


def whiten(vectors: DataFrame, vector: str = "embedding", components: int = 8, prepared: Column | None = None) -> tuple[DataFrame, Whitening | None]:
    """vectors' usable rows with x (the vector that counts), whitened and deviation, stored; and the whitening.

    ``prepared`` makes x of the vector (by default the entries as doubles). deviation is the exact sum over dimensions
    of (n * x - S) ^ 2 for integer x: a decimal of 38 digits, null where it has more.

    Nulls: a vector that is null, empty or holds a null or non-finite entry is left out. Vectors must agree in length;
    those of another length than the most frequent one (of equally frequent ones the longest) are left out as well.
    Zero vectors stay. Ties and repeated rows: each is a row and counts. An empty table gives no rows. New columns that
    clash with one of vectors get a leading underscore.
    """
    needs(vectors, vector)
    names = {c: fresh_name(vectors.columns, c) for c in ("x", "whitened", "deviation")}
    x, white, dev = names.values()
    rows = vectors.filter(finite(F.col(vector))).withColumn(x, prepared if prepared is not None else F.col(vector).cast("array<double>"))
    lengths = rows.groupBy(F.size(x).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = stored(rows.filter(F.size(x) == (lengths["d"] if lengths else 0)), "vectors")
    found = fit(rows, x, components)
    if found is None:
        return rows.withColumn(white, F.lit(None).cast("array<double>")).withColumn(dev, F.lit(None).cast("decimal(38,0)")), None
    whole = all(s.denominator == 1 for s in found.sums)
    exact = _deviation(found.n, [int(s) for s in found.sums])(F.col(x)) if whole else F.lit(None)
    return stored(found.apply(rows, x, white).withColumn(dev, exact.cast("decimal(38,0)")), "whitened"), found


def _deviation(n: int, sums: list[int]):
    """A function of integer vectors x: the decimal digits of sum((n * x - S) ^ 2), exactly."""
    @F.pandas_udf("string")
    def of(vectors: Iterator[pd.Series]) -> Iterator[pd.Series]:
        s = np.array(sums, object)
        for batch in vectors:
            rows = []
            for x in _rows_at_once(batch, len(sums), np.int64) if len(batch) else ():
                largest = n * int(np.abs(x).max()) + max(map(abs, sums))
                if largest < 1 << 62:  # no difference overflows; its square is taken in parts of 31 bits
                    y = np.abs(n * x - s.astype(np.int64))
                    a, b = y >> 31, y & ((1 << 31) - 1)
                    total = [(int(p) << 62) + (int(q) << 32) + int(r) for p, q, r in zip(*map(_whole_sums, (a * a, a * b, b * b)), strict=True)]
                else:
                    total = [sum((n * int(v) - m) ** 2 for v, m in zip(row, sums, strict=True)) for row in x]
                rows += [str(t) if t < 10**38 else None for t in total]
            yield pd.Series(rows, dtype=object)

    return of


def _whole_sums(x: np.ndarray) -> list[int]:
    """Exact sums of the rows of non-negative longs."""
    return [(int(h) << 31) + int(low) for h, low in zip((x >> 31).sum(axis=1), (x & ((1 << 31) - 1)).sum(axis=1), strict=True)]


def op13_query(spark, sf_dir: str) -> DataFrame:
    """Whitened components of all usable vectors, one row for each component; deviation is null beyond a long."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    rows, found = whiten(vectors, prepared=quantised(F.col("embedding")))
    error = identity_error(rows, "whitened") if found else 0.0
    share = F.array(*[F.lit(float(e / found.trace)) for e in found.eigenvalues]) if found else F.array().cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(found.n if found else 0).cast("long").alias("n"),
        F.when(F.col("deviation") < F.lit(str(1 << 63)).cast("decimal(38,0)"), F.col("deviation").cast("long")).alias("deviation"),
        "whitened", F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
