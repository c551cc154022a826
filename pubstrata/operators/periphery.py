"""Soft membership and attachment of noise points ("periphery").

* ``membership_distance`` - per point and topic, the share of the inverse
  distance to the topic's nearest exemplar (exemplars: all core points that
  have the topic's greatest probability);
* ``calibrate_periphery`` - thresholds tau / delta as the q-quantiles of the
  top membership p1 and of the margin p1 - p2 over a sample of core points;
  both are rounded to binary16 before the quantile, as in the original;
* ``attach_periphery`` - a noise point joins its best topic when
  p1 >= tau and p1 - p2 >= delta (unrounded values); its probability becomes
  half(p1) and it stays non-core.

The core sample is exact-size and repeatable: points are ranked by
``xxhash64(seed, id)`` with a two-level rank (bucket offsets from a
4096-row count table, then ``row_number`` inside each hash bucket), so no
task sorts the whole table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubstrata.functions.vectors import half_round_scalar

HASH_BUCKET_BITS = 12
#: entries of a distance matrix inside a task
CELLS = 1 << 20


def hash_rank(df: DataFrame, id_col: str, seed: int = 0) -> DataFrame:
    """Add ``hrank`` (1-based) = position of each row in the order of xxhash64(seed, id), id."""
    h = F.xxhash64(F.lit(int(seed)), F.col(id_col))
    d = df.withColumn("__h", h).withColumn("__bk", F.shiftrightunsigned("__h", 64 - HASH_BUCKET_BITS))
    counts = d.groupBy("__bk").agg(F.count(F.lit(1)).alias("__c"))
    # at most 2^12 rows: a single ordered window over it is bounded
    offsets = counts.withColumn(
        "__off",
        F.coalesce(F.sum("__c").over(Window.orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).select("__bk", "__off")
    w = Window.partitionBy("__bk").orderBy("__h", id_col)
    return (
        d.join(F.broadcast(offsets), "__bk")
        .withColumn("hrank", F.col("__off") + F.row_number().over(w))
        .drop("__h", "__bk", "__off")
    )


def top2(membership: DataFrame) -> DataFrame:
    """(id, c1, p1, p2): best topic (ties -> smaller topic), its p, the second largest p (0 if none).

    Two aggregations with map-side maxima; a point's memberships are never gathered.
    """
    m = membership.select("id", "topic", F.col("p").cast("double").alias("p"))
    best = m.groupBy("id").agg(F.max(F.struct(F.col("p"), (-F.col("topic")).alias("k"))).alias("b"))
    rest = m.join(best, "id").groupBy("id", "b").agg(F.max(F.when(F.col("topic") != -F.col("b.k"), F.col("p"))).alias("p2"))
    return rest.select("id", (-F.col("b.k")).alias("c1"), F.col("b.p").alias("p1"), F.coalesce("p2", F.lit(0.0)).alias("p2"))


def exemplars(clusters: DataFrame, vectors: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """(id, topic, v): the core points with their topic's greatest probability, every tie included."""
    core = clusters.where(F.col("is_core") & (F.col("topic") != -1)).select("id", "topic", "probability")
    best = core.groupBy("topic").agg(F.max("probability").alias("best"))
    top = core.join(best, "topic").where(F.col("probability").eqNullSafe(F.col("best"))).select("id", "topic")
    return top.join(vectors.select("id", F.col(vec_col).cast("array<double>").alias("v")), "id").select("id", "topic", "v")


def nearest_exemplars(x: np.ndarray, e: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Distance of each row of x to the nearest row of each run of e that begins at ``starts``.

    Rows of x are taken in slices, so that a matrix has at most ``CELLS`` entries however many exemplars a tile holds.
    """
    out = np.empty((len(x), len(starts)))
    ee, step = (e * e).sum(1)[None, :], max(1, CELLS // max(1, len(e)))
    for a in range(0, len(x), step):
        part = x[a:a + step]
        sq = (part * part).sum(1)[:, None] + ee - 2.0 * (part @ e.T)
        out[a:a + step] = np.sqrt(np.maximum(np.minimum.reduceat(sq, starts, axis=1), 0.0))
    return out


def membership_distance(vectors: DataFrame, clusters: DataFrame, vec_col: str = "embedding",
                        block_rows: int = 4096, points: DataFrame | None = None, table: bool = True):
    """(id, topic, p) for every point (or the ids of ``points``) over every topic with exemplars.

    Blocks of points meet tiles of topics in tasks of their own; no row of a point and topic is shuffled (``shares.memberships``).
    Without ``table``: what ``density.membership_vectors`` needs to weigh the distances where they are found (``shares.Distances``).
    """
    from pubstrata.operators import shares

    dist = shares.Distances(vectors, clusters, vec_col, block_rows, points)
    return shares.memberships(dist) if table else dist


def core_sample(clusters: DataFrame, core_sample_frac: float = 0.2, core_sample_min: int = 0,
                core_sample_max: int = 999_999_999, seed: int = 0) -> DataFrame:
    """(id): the exact-size, repeatable sample of core points used for calibration."""
    core = clusters.where(F.col("topic") != -1).select("id")
    n_core = core.agg(F.count(F.lit(1)).alias("n_core"))
    size = F.least(
        F.greatest(F.lit(int(core_sample_min)), F.floor(F.col("n_core") * float(core_sample_frac)).cast("long")),
        F.lit(int(core_sample_max)),
        F.col("n_core"),
    )
    bounds = n_core.select(size.alias("n_sample")).withColumn("__one", F.lit(1))
    ranked = hash_rank(core, "id", seed).withColumn("__one", F.lit(1))
    return ranked.join(F.broadcast(bounds), "__one").where(F.col("hrank") <= F.col("n_sample")).select("id")


def best_two(membership: DataFrame) -> DataFrame:
    """(id, c1, p1, p2) of a membership table (id, topic, p), or the table itself if it holds them already."""
    return membership if "p1" in membership.columns else top2(membership)


def calibrate_periphery(membership: DataFrame, clusters: DataFrame, core_sample_frac: float = 0.2,
                        core_sample_min: int = 0, core_sample_max: int = 999_999_999,
                        core_quantile: float = 0.05, seed: int = 0) -> DataFrame:
    """One row (tau, delta, n_core, n_sample). Fails at run time when there is no core point.

    ``membership``: (id, topic, p), or (id, c1, p1, p2) as ``membership.best_memberships`` gives it.
    """
    if core_sample_min > core_sample_max:
        raise ValueError("core_sample_min must not exceed core_sample_max")
    core = clusters.where(F.col("topic") != -1).select("id")
    n_core = core.agg(F.count(F.lit(1)).alias("n_core"))
    size = F.least(
        F.greatest(F.lit(int(core_sample_min)), F.floor(F.col("n_core") * float(core_sample_frac)).cast("long")),
        F.lit(int(core_sample_max)),
        F.col("n_core"),
    )
    size = F.when(F.col("n_core") > 0, size).otherwise(F.raise_error(F.lit("no core point to calibrate on")))
    bounds = n_core.select(F.col("n_core"), size.cast("long").alias("n_sample")).withColumn("__one", F.lit(1))
    ranked = hash_rank(core, "id", seed).withColumn("__one", F.lit(1))
    sample = ranked.join(F.broadcast(bounds), "__one").where(F.col("hrank") <= F.col("n_sample")).select("id")
    t2 = best_two(membership.join(sample, "id", "left_semi"))
    p1h = half_round_scalar(F.col("p1"))
    mh = half_round_scalar(F.col("p1") - F.col("p2"))
    q = t2.agg(
        F.percentile(p1h, F.lit(float(core_quantile))).alias("tau"),
        F.percentile(mh, F.lit(float(core_quantile))).alias("delta"),
    ).withColumn("__one", F.lit(1))
    return q.join(F.broadcast(bounds), "__one").select("tau", "delta", "n_core", "n_sample")


def attach_periphery(clusters: DataFrame, membership: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Clusters with qualifying noise points attached; core flags and non-noise rows unchanged. ``membership`` as in calibration."""
    noise = clusters.where(F.col("topic") == -1).select("id")
    t2 = best_two(membership.join(noise, "id", "left_semi"))
    th = thresholds.select("tau", "delta").withColumn("__one", F.lit(1))
    t2 = t2.withColumn("__one", F.lit(1)).join(F.broadcast(th), "__one")
    ok = (F.col("p1") >= F.col("tau")) & ((F.col("p1") - F.col("p2")) >= F.col("delta"))
    upd = t2.where(ok).select("id", F.col("c1").alias("__t"), half_round_scalar(F.col("p1")).alias("__p"))
    j = clusters.join(upd, "id", "left")
    hit = F.col("__t").isNotNull() & (F.col("topic") == -1)
    return j.select(
        "id",
        F.when(hit, F.col("__t")).otherwise(F.col("topic")).cast("int").alias("topic"),
        F.col("is_core"),
        F.when(hit, F.col("__p")).otherwise(F.col("probability").cast("double")).alias("probability"),
    )
