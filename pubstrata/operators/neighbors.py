"""Exact k-nearest neighbours and the density-clustering distances built on them.

``knn`` is a blocked self-join. Vectors are hashed into blocks and every
unordered block pair (i <= j) becomes one group, a task of its own. There are at
most ``GRID`` blocks until one holds ``TASK_ROWS`` rows, so a vector is copied
``GRID`` times however many there are: the rows moved grow with the input, not
with its square. Inside the group NumPy scores tiles of at most
``TILE`` x ``TILE`` (or ``block_rows``) pairs in single precision (``_screen``); a pair whose score, with
its greatest possible error, may come before a row's k-th nearest so far is measured in double precision. Each row keeps its k nearest by (distance, id),
which is the order of the final cut: copies of one vector, however many, add k
rows each. Only those candidates are shuffled; the final top-k per point is a
``row_number`` window partitioned by point id (k candidates per point and block).
No group ever holds all vectors and no group emits all of its pairs.

Exact kNN costs n^2 * d; the tile bounds the matrices of a task, the block pairs
spread the work over the cluster.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubstrata.deploy import ship_package

METRICS = ("cosine", "euclidean")
#: blocks of a join, and rows of a block beyond which there are more of them
GRID, TASK_ROWS = 8, 1 << 17
#: rows of a side of a distance tile at most: larger ones leave the processor's cache
TILE = 1024
#: pairs measured at a time
PAIRS = 1 << 13


def block_count(n: int, block_rows: int, min_blocks: int) -> int:
    """Blocks of n rows: of about ``block_rows`` each up to ``GRID`` of them, of up to ``TASK_ROWS`` beyond."""
    fine = max(1, math.ceil(n / block_rows), min(min_blocks, n))
    return max(min(fine, GRID), math.ceil(n / TASK_ROWS))


def narrow_vector(df: DataFrame, vec_col: str):
    """The vector column as array<double>, or as it is if its elements are floats: tasks widen them, shuffles move half."""
    from pyspark.sql.types import ArrayType, FloatType

    kind = df.schema[vec_col].dataType
    return F.col(vec_col) if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else F.col(vec_col).cast("array<double>")


def _distances(x: np.ndarray, y: np.ndarray, metric: str) -> np.ndarray:
    if metric == "cosine":
        xn = x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]
        yn = y / np.maximum(np.linalg.norm(y, axis=1), 1e-300)[:, None]
        d = xn @ yn.T
        return np.subtract(1.0, d, out=d)
    sq, xy = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :], x @ y.T
    xy *= 2.0
    sq -= xy
    return np.sqrt(np.maximum(sq, 0.0, out=sq), out=sq)


def _nearest(dist: np.ndarray, ids: np.ndarray, k: int):
    """(row, col) of each row's k smallest entries by (distance, id): k a row at most, also where very many tie."""
    n, m = dist.shape
    if m == 0 or k <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if m <= k:
        return np.divmod(np.arange(n * m), m)
    kth = np.partition(dist, k - 1, axis=1)[:, k - 1]
    within = dist <= kth[:, None]
    crowded = np.flatnonzero(within.sum(axis=1) > k)
    if len(crowded):
        by_id = np.argsort(ids, kind="stable")
        for r in crowded:
            order = by_id[np.argsort(dist[r, by_id], kind="stable")[:k]]
            within[r] = False
            within[r, order] = True
    return np.nonzero(within)


def _exact(x: np.ndarray, y: np.ndarray, metric: str) -> np.ndarray:
    """Distances of the pairs of rows x[i], y[i] in double precision; ``cosine`` takes rows of length 1. Copies of one vector have the same distances.

    Products of two rows by two, of which the diagonals count, round as a product of whole blocks does. ``fuzzy_weights`` asks which
    distances are positive, and the rounds of the spanning tree compare listed distances with those of a scan: both need that rounding.
    """
    out = np.empty(len(x))
    for a in range(0, len(x), PAIRS):
        p, q = x[a:a + PAIRS], y[a:a + PAIRS]
        u, v = (np.vstack([m, m[-1:]])[:len(m) + len(m) % 2].reshape(-1, 2, m.shape[1]) for m in (p, q))
        with np.errstate(all="ignore"):
            dot = np.einsum("bii->bi", u @ v.transpose(0, 2, 1)).ravel()[:len(p)]
            out[a:a + PAIRS] = 1.0 - dot if metric == "cosine" else np.sqrt(np.maximum((p * p).sum(1) + (q * q).sum(1) - 2.0 * dot, 0.0))
    return out


class _Side:
    """Rows of one block in id order, their k nearest so far and the score from which on an entry may come before the k-th."""

    def __init__(self, pdf: pd.DataFrame, k: int, metric: str):
        pdf = pdf.sort_values("id", kind="stable")
        self.metric, self.ids = metric, pdf["id"].to_numpy(np.int64)
        x = np.vstack(pdf["v"].to_numpy()).astype(np.float64) if len(pdf) else np.empty((0, 0))
        with np.errstate(all="ignore"):
            self.x = x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None] if metric == "cosine" else x
        finite = np.isfinite(self.x).all(axis=1)  # the others are at no distance from any vector
        self.ids, self.x = self.ids[finite], self.x[finite]
        self.d, self.i = np.full((len(self.ids), k), np.inf), np.zeros((len(self.ids), k), np.int64)

    def scores_from(self, margin: float, kind) -> None:
        # scores are finite, what must not be taken has -inf
        self.margin, self.none = margin, np.finfo(kind).min
        self.least = np.full(len(self.ids), self.none, dtype=kind)
        self.waiting: dict[int, list] = {}  # first row of a tile -> entries found since its last merge, about k a row

    def take(self, rows: slice, score: np.ndarray, hit: np.ndarray, other: "_Side", cols: slice, turned: bool = False) -> None:
        """Measure a tile's candidates exactly: ``score`` has rows of this side x rows of the other, or is ``turned``; ``hit``: room for as many flags."""
        k = self.d.shape[1]
        least, ids = self.least[rows], other.ids[cols]
        first = len(ids) > k and (least == self.none).any()
        r, c = ((), ()) if first else _at_least(score, least, hit, turned)
        if first or len(r) > 4 * k * len(least) and len(ids) > k:
            # each row's k best scores bound its k-th distance in this tile
            score = np.ascontiguousarray(score.T) if turned else score
            kth = np.partition(score, len(ids) - k, axis=1)[:, len(ids) - k]
            r, c = _at_least(score, np.maximum(least, kth - 2.0 * self.margin).astype(score.dtype), hit)
        if len(r) == 0:
            return
        mine, theirs = self.x[rows], other.x[cols]
        found = np.concatenate([_exact(mine[r[a:a + PAIRS]], theirs[c[a:a + PAIRS]], self.metric) for a in range(0, len(r), PAIRS)])
        # ids of a later tile are larger, so an equal distance never comes before
        keep = found < self.d[rows.start + r, -1]
        waiting = self.waiting.setdefault(rows.start, [])
        waiting.append((rows.start + r[keep], ids[c[keep]], found[keep]))
        if sum(len(w[0]) for w in waiting) >= k * len(least):
            self.merge(rows.start)

    def merge(self, start: int) -> None:
        """The k nearest of those so far and of what waits for the rows of the tile at ``start``, by (distance, id)."""
        r, i, d = (np.concatenate(x) for x in zip(*self.waiting.pop(start)))
        if len(r) == 0:
            return
        k, touched = self.d.shape[1], np.unique(r)
        row = np.concatenate([r, np.repeat(touched, k)])
        d, i = np.concatenate([d, self.d[touched].ravel()]), np.concatenate([i, self.i[touched].ravel()])
        order = np.lexsort((i, d, row))
        at = order[np.searchsorted(row[order], touched)[:, None] + np.arange(k)]
        self.d[touched], self.i[touched] = d[at], i[at]
        kth = self.d[touched, -1]
        # cast to the scores' type: an error that the margin covers
        bound = 1.0 - kth - self.margin if self.metric == "cosine" else np.where(kth > 0, -0.5 * kth * kth - self.margin, np.inf)
        self.least[touched] = np.maximum(bound, self.none)

    def merge_all(self) -> None:
        for start in list(self.waiting):
            self.merge(start)


def _at_least(score: np.ndarray, least: np.ndarray, hit: np.ndarray, turned: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(row, other) of the scores that reach their row's least one; ``turned``: the rows are the columns of ``score``."""
    flat, width = hit[:score.size], score.shape[1]
    np.greater_equal(score, least[None, :] if turned else least[:, None], out=flat.reshape(score.shape))
    if flat.size % 8 == 0:
        some = np.flatnonzero(flat.view(np.uint64) != 0)  # few entries are hit: eight are looked at at a time
        at = (some[:, None] * 8 + np.arange(8)).ravel()
        at = at[flat[at]]
    else:
        at = np.flatnonzero(flat)
    r, c = np.divmod(at, width)
    return (c, r) if turned else (r, c)


def _screen(left: _Side, right: _Side) -> tuple[np.ndarray, np.ndarray]:
    """Factors whose product scores all pairs: the score falls with the distance and is off by ``margin`` at most.

    Cosine: 1 - distance; euclidean: -distance^2 / 2, of rows with the mean taken out. Scores are in single precision, in which a
    product of n terms is off by (n + 2) 2^-24 times the sum of their sizes at most; the margin is twice that and more. They only choose
    the pairs that are measured, in double precision. Where single precision cannot hold them they are doubles, and
    where squares overflow all pairs are measured.
    """
    sides, dim = (left, right), left.x.shape[1]
    if left.metric == "cosine":
        kind, size, factors = np.float32, 1.0, [s.x for s in sides]
    else:
        with np.errstate(all="ignore"):
            raw = sum(np.sqrt((s.x * s.x).sum(1).max(initial=0.0)) for s in sides)
            mid = sum(s.x.sum(0) for s in sides) / (len(left.ids) + len(right.ids))
            rows = [s.x - mid for s in sides]
            reach = sum(np.sqrt((x * x).sum(1).max(initial=0.0)) for x in rows)
        kind = np.float32
        if not (np.isfinite(raw) and 1e-15 < reach < 1e15 and raw < reach * 1e6):
            kind, reach, rows = np.float64, raw, [s.x for s in sides]
        if not raw < 1e150:
            for s in sides:
                s.scores_from(np.inf, kind)
            return np.zeros((len(left.ids), 1)), np.zeros((len(right.ids), 1))
        size, half = reach * reach, [0.5 * (x * x).sum(1) for x in rows]
        one = [np.ones(len(x)) for x in rows]
        factors = [np.column_stack([rows[0], one[0], -half[0]]), np.column_stack([rows[1], -half[1], one[1]])]
    # the second part: what the measured distances themselves are off by
    margin = (dim + 8) * (np.finfo(kind).eps * size + (0.0 if left.metric == "cosine" else 2.0 * np.finfo(np.float64).eps * raw * raw))
    for s in sides:
        s.scores_from(margin, kind)
    return tuple(np.ascontiguousarray(f, dtype=kind) for f in factors)


def _block_fn(k: int, metric: str, include_self: bool, tile: int):
    def run(pdf):
        same = int(pdf["bi"].iloc[0]) == int(pdf["bj"].iloc[0])
        sides = [_Side(pdf[pdf["side"] == s], k, metric) for s in ((0,) if same else (0, 1))]
        left, right = sides[0], sides[-1]
        if k > 0 and len(left.ids) and len(right.ids):
            fl, fr = _screen(left, right)
            cells = min(tile, len(left.ids)) * min(tile, len(right.ids))
            scores, hit = np.empty(cells, dtype=fl.dtype), np.empty(cells, dtype=bool)
            # both tile loops rise, so every row meets the other rows in id order
            for a in range(0, len(left.ids), tile):
                for b in range(a if same else 0, len(right.ids), tile):
                    rows, cols = slice(a, a + tile), slice(b, b + tile)
                    x, y = fl[rows], fr[cols]
                    score = np.matmul(x, y.T, out=scores[:len(x) * len(y)].reshape(len(x), len(y)))
                    if same and a == b and not include_self:
                        np.fill_diagonal(score, -np.inf)
                    left.take(rows, score, hit, right, cols)
                    if not same or a != b:
                        right.take(cols, score, hit, left, rows, turned=True)
            for s in sides:
                s.merge_all()
        outs = []
        for s in sides:
            r, c = np.nonzero(np.isfinite(s.d))
            outs.append((s.ids[r], s.i[r, c], s.d[r, c]))
        return pd.DataFrame({
            "id": np.concatenate([o[0] for o in outs]),
            "neighbor": np.concatenate([o[1] for o in outs]),
            "distance": np.concatenate([o[2] for o in outs]),
        })

    return run


def knn(vectors: DataFrame, k: int = 50, metric: str = "cosine", id_col: str = "id", vec_col: str = "embedding",
        block_rows: int = 2048, include_self: bool = False, min_blocks: int = 4) -> DataFrame:
    """(id, neighbor, rank, distance): the k nearest other points of every point.

    ``metric='cosine'`` gives 1 - cosine similarity, ``'euclidean'`` the L2
    distance. Ties are ordered by neighbour id.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    ship_package(vectors.sparkSession)
    v = vectors.select(F.col(id_col).cast("long").alias("id"), narrow_vector(vectors, vec_col).alias("v"))
    n = v.count()  # loop-control count: sizes the block grid
    nb = block_count(n, block_rows, min_blocks)
    v = v.withColumn("b", F.pmod(F.xxhash64("id"), F.lit(nb)).cast("int"))
    left = v.select("id", "v", F.col("b").alias("bi"), F.explode(F.sequence("b", F.lit(nb - 1))).alias("bj"),
                    F.lit(0).alias("side"))
    right = v.select("id", "v", F.explode(F.sequence(F.lit(0), "b")).alias("bi"), F.col("b").alias("bj"),
                     F.lit(1).alias("side")).where(F.col("bi") < F.col("bj"))
    # a pair per task: few bytes, much work, so pairs must not be coalesced by their size
    pairs = left.unionByName(right).withColumn("pair", F.expr("bj * (bj + 1) div 2 + bi").cast("int"))
    cand = pairs.repartitionById(nb * (nb + 1) // 2, F.col("pair")).groupBy("pair").applyInPandas(
        _block_fn(k, metric, include_self, min(block_rows, TILE)), "id long, neighbor long, distance double"
    )
    w = Window.partitionBy("id").orderBy("distance", "neighbor")
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "id", "neighbor", F.col("rank").cast("int").alias("rank"), "distance"
    )


def core_distances(knn_df: DataFrame, min_samples: int, include_self: bool = True) -> DataFrame:
    """(id, core_distance): distance to the min_samples-th nearest point.

    With ``include_self`` the point counts as its own first neighbour, so the
    core distance is the (min_samples - 1)-th other point.
    """
    r = min_samples - 1 if include_self else min_samples
    if r <= 0:
        return knn_df.select("id").distinct().withColumn("core_distance", F.lit(0.0))
    return knn_df.where(F.col("rank") == r).select("id", F.col("distance").alias("core_distance"))


def mutual_reachability(knn_df: DataFrame, core: DataFrame) -> DataFrame:
    """(id, neighbor, distance, mr) with mr = max(core(id), core(neighbor), distance)."""
    ci = core.select(F.col("id"), F.col("core_distance").alias("core_i"))
    cj = core.select(F.col("id").alias("neighbor"), F.col("core_distance").alias("core_j"))
    j = knn_df.join(ci, "id").join(cj, "neighbor")
    return j.select("id", "neighbor", "distance", F.greatest("distance", "core_i", "core_j").alias("mr"))
