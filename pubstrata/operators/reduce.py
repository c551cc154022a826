"""Dimension reduction of the embedding table (1024 -> 16 in the original).

* ``reduce_pca`` - the linear path: MLlib ``PCA`` (distributed covariance).
* ``reduce_umap`` - the manifold path (McInnes, Healy, Melville 2018) as table
  jobs over the kNN graph:
  - ``fuzzy_weights``: per point rho (nearest positive distance) and sigma
    by bisection so that sum_j exp(-max(0, d_ij - rho_i) / sigma_i) = log2(k);
    vectorised over a batch of points in a pandas UDF (k values per point);
  - ``fuzzy_union``: w = a + b - a * b over (i, j) and (j, i), a full outer
    join of the edge table with itself on swapped keys;
  - ``spectral_init`` (``spectral.py``): Chebyshev-filtered subspace iteration;
  - ``layout`` (``layout.py``): gradient epochs on vertex partitions with ghosts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from pubstrata.deploy import ship_package
from pubstrata.operators.layout import find_ab, layout
from pubstrata.operators.neighbors import knn
from pubstrata.operators.spectral import spectral_init
from pubstrata.session import cut_lineage, free

# Smoothing constants of the fuzzy simplicial set construction.
SMOOTH_K_TOLERANCE = 1e-5
MIN_K_DIST_SCALE = 1e-3
BISECTION_STEPS = 64

__all__ = ["find_ab", "fuzzy_union", "fuzzy_weights", "layout", "reduce_pca", "reduce_umap", "spectral_init"]


def reduce_pca(vectors: DataFrame, k: int = 16, vec_col: str = "embedding", id_col: str = "id") -> DataFrame:
    """(id, embedding array<double>[k]) projected on the top-k principal components."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    src = vectors.select(F.col(id_col).alias("id"), array_to_vector(F.col(vec_col)).alias("__v"))
    model = PCA(k=k, inputCol="__v", outputCol="__p").fit(src)
    return model.transform(src).select("id", vector_to_array("__p").alias("embedding"))


# --- C2 / C3 -------------------------------------------------------------------------------

def _smooth(dists: np.ndarray, k: int, mean_all: float):
    """Vectorised bisection over rows of a (m, k-1) distance matrix -> (rho, sigma).

    ``mean_all`` is the mean distance of the whole graph, whatever rows a batch holds.
    """
    m = dists.shape[0]
    target = math.log2(k)
    pos = np.where(dists > 0, dists, np.inf)
    rho = pos.min(axis=1)
    rho = np.where(np.isfinite(rho), rho, 0.0)
    lo = np.zeros(m)
    hi = np.full(m, np.inf)
    mid = np.ones(m)
    for _ in range(BISECTION_STEPS):
        d = np.maximum(dists - rho[:, None], 0.0)
        psum = np.exp(-d / mid[:, None]).sum(axis=1)
        done = np.abs(psum - target) < SMOOTH_K_TOLERANCE
        up = psum > target
        hi = np.where(~done & up, mid, hi)
        lo = np.where(~done & ~up, mid, lo)
        nxt = np.where(np.isfinite(hi), (lo + hi) / 2.0, mid * 2.0)
        mid = np.where(done, mid, nxt)
    mean_d = dists.mean(axis=1)
    floor = MIN_K_DIST_SCALE * np.where(rho > 0, mean_d, mean_all)
    return rho, np.maximum(mid, floor)


def fuzzy_weights(knn_df: DataFrame, k: int) -> DataFrame:
    """(id, neighbor, distance, w, rho, sigma): directed membership strengths of the kNN edges.

    ``knn_df`` holds the k-1 nearest other points of every point (the point
    itself is the k-th member of its neighbourhood, distance 0).
    """
    ship_package(knn_df.sparkSession)
    per = knn_df.groupBy("id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "distance"))), lambda s: s["distance"]).alias("d")
    )
    mean_all = knn_df.agg(F.avg("distance").alias("mean_all")).withColumn("__one", F.lit(1))
    per = per.withColumn("__one", F.lit(1)).join(F.broadcast(mean_all), "__one")
    schema = StructType([StructField("rho", DoubleType()), StructField("sigma", DoubleType())])

    @F.pandas_udf(schema)
    def smooth(d: pd.Series, mean_all: pd.Series) -> pd.DataFrame:
        lens = d.map(len).to_numpy()
        rho = np.zeros(len(d))
        sigma = np.ones(len(d))
        for L in np.unique(lens):  # rows of equal length are processed together
            idx = np.nonzero(lens == L)[0]
            if L == 0:
                continue
            mat = np.vstack([np.asarray(d.iloc[i], dtype=np.float64) for i in idx])
            r, s = _smooth(mat, k, float(mean_all.iloc[0]))
            rho[idx], sigma[idx] = r, s
        return pd.DataFrame({"rho": rho, "sigma": sigma})

    rs = per.select("id", smooth("d", "mean_all").alias("rs")).select("id", "rs.rho", "rs.sigma")
    e = knn_df.join(rs, "id")
    w = F.exp(-F.greatest(F.col("distance") - F.col("rho"), F.lit(0.0)) / F.col("sigma"))
    return e.select("id", "neighbor", "distance", w.alias("w"), "rho", "sigma")


def fuzzy_union(weights: DataFrame) -> DataFrame:
    """(i, j, w) with w = a + b - a*b for every ordered pair that has an edge either way."""
    a = weights.select(F.col("id").alias("i"), F.col("neighbor").alias("j"), F.col("w").alias("wa"))
    b = weights.select(F.col("neighbor").alias("i"), F.col("id").alias("j"), F.col("w").alias("wb"))
    u = a.join(b, ["i", "j"], "full")
    wa, wb = F.coalesce("wa", F.lit(0.0)), F.coalesce("wb", F.lit(0.0))
    return u.select("i", "j", (wa + wb - wa * wb).alias("w"))


# --- C6 ------------------------------------------------------------------------------------

def reduce_umap(vectors: DataFrame, n_neighbors: int = 50, n_components: int = 16, min_dist: float = 0.1,
                n_epochs: int = 200, spectral_iters: int = 30, seed: int = 42, vec_col: str = "embedding",
                id_col: str = "id") -> DataFrame:
    """(id, embedding array<double>[n_components]) by kNN (cosine) -> fuzzy graph -> spectral init -> layout."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("embedding"))
    kn = cut_lineage(knn(v, n_neighbors - 1, "cosine"), "umap")
    graph = cut_lineage(fuzzy_union(fuzzy_weights(kn, n_neighbors)), "umap")
    free(kn)
    init = cut_lineage(spectral_init(graph, v.select("id"), n_components, spectral_iters, seed), "umap")
    y = layout(graph, init, n_epochs, min_dist, seed=seed)  # a table of its own
    free(graph, init)
    return y.select("id", F.col("y").alias("embedding"))
