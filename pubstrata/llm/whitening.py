"""Whitening of embeddings: distributed centred covariance, leading eigenvectors, broadcast projection.

Entries c become the integers x = floor(1024 c) + 100000. Two passes over the vectors, each with map-side sums in
NumPy, give the exact sums S and then the covariance of x - S/n. Its leading eigenvectors come from a Householder
tridiagonalisation, bisection on Sturm counts (all wanted eigenvalues at once), and inverse iteration on the
tridiagonal matrix, in which vectors of close eigenvalues are orthogonalised against each other; the reflections
bring them back. The matrix is dims x dims whatever the number of rows; one task holds it. The model (at most
``COMPONENTS`` vectors a dimension) is broadcast and every row projected where it is.

Vectors of different dimension cannot share a covariance: each dimension is a fit list of its own. Models
are broadcast in batches of at most ``BROADCAST_BYTES``, so any number of dimensions works.

Defined results: vectors that are null, empty or hold null or non-finite entries take no part; null vec_ids are rows
like others; repeated rows count as often as they occur; x stops at +-2^62 and deviation at the limits of
long; a component whose eigenvalue is zero to rounding (below 1e-12 of the trace) has no rows, so a table of equal
vectors gives none; an empty table gives an empty result; only vec_id and the vector column are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubstrata.llm.common import BROADCAST_BYTES, Scratch, read_table, rows_of, ship_package

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: eigenvalues closer than this share of the matrix' norm are one cluster of inverse iteration
CLUSTER = 1e-3
#: eigenvalues up to this share of the trace count as zero
ZERO = 1e-12
_TOP = 2**62
_LONG = 2**63 - 1


# ---- eigenvectors of a symmetric matrix ---------------------------------------------------------

def tridiagonalise(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflections): Householder vectors u_k with T = H .. A .. H; u_k acts on rows k+1.. ."""
    a = np.array(a, dtype=np.float64)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1:, k]
        # scaled, so that the squares of small columns stay in range
        peak = np.abs(x[1:]).max(initial=0.0)
        u = np.zeros_like(x)
        if peak > 0:
            scale = max(peak, abs(x[0]))
            u = x / scale
            u[0] += math.copysign(np.linalg.norm(u), u[0])
            u /= np.linalg.norm(u)
            block = a[k + 1:, k + 1:]
            p = block @ u
            q = p - (u @ p) * u
            block -= 2.0 * (np.outer(u, q) + np.outer(q, u))
            a[k + 1:, k] = a[k, k + 1:] = x - 2.0 * (u @ x) * u
        reflections.append(u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def sturm_counts(d: np.ndarray, e2: np.ndarray, at: np.ndarray, tiny: float) -> np.ndarray:
    """Number of eigenvalues of the tridiagonal matrix below each value of ``at``: negative pivots of T - at I."""
    pivot = d[0] - at
    below = (pivot < 0).astype(np.int64)
    for i in range(1, len(d)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d[i] - at - e2[i - 1] / pivot
        below += pivot < 0
    return below


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection until the interval has no double inside."""
    n = len(d)
    r = np.abs(np.concatenate([e, [0.0]])) + np.abs(np.concatenate([[0.0], e]))
    norm = float(max(np.abs(d + r).max(), np.abs(d - r).max()))
    if norm == 0:
        return np.zeros(k)
    lo = np.full(k, float((d - r).min()) - 1e-15 * norm)
    hi = np.full(k, float((d + r).max()) + 1e-15 * norm)
    want = n - np.arange(k)  # the j-th largest has n - j eigenvalues at or below it
    tiny = max(np.finfo(float).tiny, 1e-300 * norm, (np.finfo(float).eps * norm) ** 2 * 1e-8 / norm)
    for _ in range(120):
        mid = (lo + hi) / 2
        if np.all((mid <= lo) | (mid >= hi) | (hi - lo <= 1e-16 * norm)):
            break
        enough = sturm_counts(d, e * e, mid, tiny) >= want
        hi, lo = np.where(enough, mid, hi), np.where(enough, lo, mid)
    return (lo + hi) / 2


def _solve_shifted(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, eps: float) -> np.ndarray:
    """(T - shift I)^-1 b by elimination with row exchanges; zero pivots become ``eps``."""
    n = len(d)
    x = b.tolist()
    diag, up = (d - shift).tolist(), e.tolist() + [0.0]
    up2 = [0.0] * n
    for i in range(n - 1):
        low = e[i]
        if abs(diag[i]) >= abs(low):
            p = diag[i] = diag[i] if abs(diag[i]) > eps else eps
            f = low / p
            diag[i + 1] -= f * up[i]
            x[i + 1] -= f * x[i]
        else:  # exchange rows i and i + 1
            f = diag[i] / low
            nxt_d, nxt_u = diag[i + 1], up[i + 1]
            diag[i + 1], up[i + 1] = up[i] - f * nxt_d, -f * nxt_u
            diag[i], up[i], up2[i] = low, nxt_d, nxt_u
            x[i], x[i + 1] = x[i + 1], x[i] - f * x[i + 1]
    diag[-1] = diag[-1] if abs(diag[-1]) > eps else eps
    for i in range(n - 1, -1, -1):
        s = x[i] - (up[i] * x[i + 1] if i + 1 < n else 0.0) - (up2[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = s / diag[i]
        if abs(x[i]) > 1e150:
            peak = abs(x[i])
            x = [v / peak for v in x]
    return np.array(x)


def tridiagonal_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) for falling ``values`` by inverse iteration, clusters orthogonalised in every step."""
    n, norm = len(d), float(np.abs(d).max() + 2 * np.abs(e).max(initial=0.0)) or 1.0
    eps = np.finfo(float).eps * norm
    out = np.zeros((n, len(values)))
    first, shift = 0, None
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        # equal eigenvalues get shifts that differ, or every step would give the same vector
        shift = value if j == first else min(value, shift - 4 * eps)
        v = np.random.default_rng(j + 1).uniform(-1, 1, n)
        for step in range(8):
            before = v / np.linalg.norm(v)
            v = _solve_shifted(d, e, shift, before, eps)
            v /= np.abs(v).max()
            for _ in range(2):
                v = v - out[:, first:j] @ (out[:, first:j].T @ v)
            v /= np.linalg.norm(v)
            if step >= 2 and min(np.abs(v - before).max(), np.abs(v + before).max()) < 4e-15:
                break
        out[:, j] = v
    return out


def leading_components(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows), the k largest of a symmetric matrix, falling."""
    n, size = len(a), float(np.abs(a).max()) or 1.0
    k = min(k, n)
    a = a / size  # squares of its entries stay in range
    d, e, reflections = tridiagonalise(a)
    values = leading_eigenvalues(d, e, k)
    v = tridiagonal_vectors(d, e, values)
    for i in range(len(reflections) - 1, -1, -1):
        u = reflections[i]
        v[i + 1:] -= 2.0 * np.outer(u, u @ v[i + 1:])
    q, r = np.linalg.qr(v)  # clusters are orthogonal already; this takes off the last rounding
    v = q * np.where(np.diag(r) < 0, -1.0, 1.0)
    return np.array([x @ a @ x for x in v.T]) * size, v.T


# ---- passes over the vectors --------------------------------------------------------------------

def integers(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """x of a column of vectors of one dimension, as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    c = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    with np.errstate(over="ignore"):
        f = np.floor(c * SCALE)
    big = np.abs(f) >= 2.0**61
    return np.where(big, np.where(f > 0, _TOP, -_TOP), np.where(big, 0.0, f).astype(np.int64) + SHIFT)


def by_dimension(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for b in batches:
        if b.num_rows:
            dims = b.column(b.schema.get_field_index("dim")).to_numpy()
            for dim in np.unique(dims):
                yield int(dim), b if (dims == dim).all() else b.filter(pa.array(dims == dim))


def _column(b: pa.RecordBatch, name: str) -> pa.Array:
    return b.column(b.schema.get_field_index(name))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and dimension: rows and exact sums, as decimal text."""
    n: dict[int, int] = {}
    s: dict[int, np.ndarray] = {}
    for dim, b in by_dimension(batches):
        x = integers(_column(b, "embedding"), dim)
        n[dim] = n.get(dim, 0) + len(x)
        small_ = np.abs(x.astype(np.float64)).max() * len(x) < 2.0**62
        part = (x if small_ else x.astype(object)).sum(axis=0).astype(object)
        s[dim] = s.get(dim, 0) + part
    rows = [(dim, i, n[dim], str(int(v))) for dim in n for i, v in enumerate(s[dim])]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["dim", "i", "n", "s"])


def _centred_products(means: dict[int, np.ndarray]):
    """Per task and dimension: the sum of (x - mean)(x - mean)', a row per dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: dict[int, np.ndarray] = {}
        for dim, b in by_dimension(batches):
            w = integers(_column(b, "embedding"), dim) - means[dim]
            m[dim] = m.get(dim, 0) + w.T @ w
        for dim, rows in m.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array(rows.tolist(), pa.list_(pa.float64()))],
                names=["dim", "i", "products"])
    return run


def _solve(k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("i")
        v = np.array(rows["products"].tolist()) / float(rows["n"].iloc[0])
        v = (v + v.T) / 2
        trace = float(np.trace(v))
        values, vectors = leading_components(v, k) if trace > 0 else (np.zeros(0), np.zeros((0, len(v))))
        keep = values > ZERO * trace
        return pd.DataFrame({"dim": len(v), "component": np.arange(1, len(values) + 1)[keep], "eigenvalue": values[keep],
                             "explained": values[keep] / trace if trace else values[keep], "vector": pd.Series(list(vectors[keep]), dtype=object)}).astype(
                                 {"dim": "int32", "component": "int32"})
    return run


def _project(models: dict[int, tuple]):
    """models: dim -> (n, sums as Python integers, projection matrix, components)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, b in by_dimension(batches):
            n, sums, mean, onto = models[dim]
            x = integers(_column(b, "embedding"), dim)
            white = (x - mean) @ onto
            peak = float(np.abs(x.astype(np.float64) - mean).max()) * n * 1.0000001 + 1
            if n * float(np.abs(x.astype(np.float64)).max()) < 2.0**62 and peak * peak * dim < 2.0**63:
                deviation = ((n * x - np.array([int(v) for v in sums], dtype=np.int64)) ** 2).sum(axis=1)
            else:
                wide = ((n * x.astype(object) - sums) ** 2).sum(axis=1)
                deviation = np.array([min(int(v), _LONG) for v in wide], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [_column(b, "vec_id"), pa.array([dim] * len(x), pa.int32()), pa.array(deviation, pa.int64()),
                 pa.array(white.tolist(), pa.list_(pa.float64()))], names=["vec_id", "dim", "deviation", "white"])
    return run


def whiten(vectors: DataFrame, components: int = COMPONENTS, vec_col: str = "embedding", id_col: str = "vec_id") -> tuple[DataFrame, DataFrame]:
    """(rows, model): rows (vec_id, dim, deviation, white array<double>) of every vector that takes part, and model
    (dim, component, n, eigenvalue, explained, vector) with the components' unit vectors."""
    spark = vectors.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "whiten")
    good = F.forall(F.col("embedding"), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    v = rows_of(vectors, id_col, vec_col).toDF("vec_id", "embedding").where(F.size("embedding") > 0).where(good)
    v = v.withColumn("dim", F.size("embedding"))
    sums = v.select("dim", "embedding").mapInArrow(_sums, "dim long, i long, n long, s string").selectExpr("int(dim) dim", "int(i) i", "n", "s")
    sums = sums.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = scratch.cut(sums.select("dim", "i", "n", F.col("s").cast("string").alias("s")), "sums")
    models, rows = [], []
    for dims in _batches([(r.dim, r.dim * (components + 2) * 8 * 2) for r in sums.select("dim").distinct().orderBy("dim").collect()]):
        part, mine = v.where(F.col("dim").isin(dims)), sums.where(F.col("dim").isin(dims))
        count, total = {}, {}
        for r in mine.orderBy("dim", "i").collect():
            count[r.dim] = r.n
            total.setdefault(r.dim, []).append(int(r.s))
        means = {d: np.array([s // count[d] + (s % count[d]) / count[d] for s in total[d]]) for d in total}
        products = part.select("dim", "embedding").mapInArrow(_centred_products(means), "dim int, i int, products array<double>")
        products = products.groupBy("dim", "i").agg(_array_sum("products").alias("products"))
        products = products.join(F.broadcast(mine.select("dim", "i", "n")), ["dim", "i"])
        model = products.groupBy("dim").applyInPandas(
            _solve(components), "dim int, component int, eigenvalue double, explained double, vector array<double>")
        model = scratch.cut(model, "model")
        onto = {d: np.zeros((d, 0)) for d in dims}
        for r in model.orderBy("dim", "component").collect():
            onto[r.dim] = np.column_stack([onto[r.dim], np.array(r.vector) / math.sqrt(r.eigenvalue)])
        send = {d: (count[d], np.array(total[d], dtype=object), means[d], onto[d]) for d in dims}
        rows.append(part.select("vec_id", "dim", "embedding").mapInArrow(
            _project(send), f"vec_id {v.schema['vec_id'].dataType.simpleString()}, dim int, deviation long, white array<double>"))
        models.append(model.join(F.broadcast(mine.where("i = 0").select("dim", "n")), "dim"))
    if not rows:
        empty_model = "dim int, component int, eigenvalue double, explained double, vector array<double>, n long"
        return (spark.createDataFrame([], f"vec_id {v.schema['vec_id'].dataType.simpleString()}, dim int, deviation long, white array<double>"),
                spark.createDataFrame([], empty_model))
    white, fitted = rows[0], models[0]
    for r, m in zip(rows[1:], models[1:]):
        white, fitted = white.unionByName(r), fitted.unionByName(m)
    return scratch.cut(white, "white"), fitted


def _batches(sized: list[tuple[int, int]]) -> Iterator[list[int]]:
    """Dimensions in batches whose models stay within the broadcast bound."""
    now, held = [], 0
    for dim, width in sized:
        if now and held + width > BROADCAST_BYTES:
            yield now
            now, held = [], 0
        now.append(dim)
        held += width
    if now:
        yield now


def _array_sum(name: str):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    return vector_to_array(Summarizer.sum(array_to_vector(F.col(name))))


def identity_error(white: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row, identity_error: the largest absolute entry of the whitened entries' covariance minus the identity,
    over all dimensions. Means first, then products of centred entries, both as map-side sums."""
    k = range(components)
    at = [F.get("white", F.lit(i)) for i in k]
    means = white.groupBy("dim").agg(*[F.avg(at[i]).alias(f"m{i}") for i in k]).withColumnRenamed("dim", "m_dim")
    c = white.join(F.broadcast(means), F.col("dim") == F.col("m_dim")).select("dim", *[(at[i] - F.col(f"m{i}")).alias(f"c{i}") for i in k])
    pairs = [(i, j) for i in k for j in k if i <= j]
    cov = c.groupBy("dim").agg(*[F.avg(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"v{i}_{j}") for i, j in pairs])
    off = [F.abs(F.col(f"v{i}_{j}") - F.lit(1.0 if i == j else 0.0)) for i, j in pairs]
    return cov.agg(F.max(F.array_max(F.array(*off))).alias("identity_error"))


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """Contract query: all ``embeddings`` whitened, a row per vector and component."""
    white, model = whiten(read_table(spark, sf_dir, "embeddings"))
    fitted = model.groupBy(F.col("dim").alias("m_dim")).agg(
        F.first("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("component", "explained"))), lambda s: s["explained"]).alias("e"))
    error = F.lit(identity_error(white).first()[0]).cast("double").alias("identity_error")
    # a row per dimension
    out = white.join(F.broadcast(fitted), F.col("dim") == F.col("m_dim"))
    out = out.select("vec_id", "n", "deviation", error, "e", F.posexplode("white").alias("i", "whitened"))
    return out.select("vec_id", (F.col("i") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
                      F.element_at("e", F.col("i") + 1).alias("explained"), "identity_error")
