"""Best two soft memberships of points, without a table of points x topics.

A point's membership in topic t is u_t / sum(u) (times the probability of being in any cluster, with a tree), where
u_t = 1 / distance to the topic's nearest exemplar, times exp(score_t) with a tree. Calibration and attachment need
the largest two only. Points are dealt into blocks, topics with all their exemplars into tiles; a task holds one block
and one tile and returns one row per point: the tile's sum, its two largest u and its best topic. A point's
few tile rows are merged in the JVM. Equal exemplars of a topic are one (copies of a vector); a topic whose exemplars
exceed a tile is spread over several tiles, whose distances are merged first and come back as columns of the point.

``score_t`` = lam_max(t) / (lam_max(t) - m), m = the largest lambda at which point and topic are one component: the lambda of the lowest common
ancestor of the point's lineage and the topic's, found by binary lifting over the lineage tree. The tree is broadcast if its counted size is
within ``TREE_BYTES``; beyond it ``best_memberships`` goes through ``density.membership_vectors``, a chain of joins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubstrata.deploy import ship_package
from pubstrata.operators.periphery import exemplars, membership_distance, nearest_exemplars, top2
from pubstrata.session import cut_lineage

TREE_BYTES = 32 << 20
#: points of a block, exemplars of a tile
BLOCK_ROWS = 4096


@dataclass
class Tree:
    """Lineages in id order: jump tables (``up[j]``: the 2^j-th ancestor, roots stay), depths, lambdas; per topic its lineage and largest lambda."""

    lins: np.ndarray
    up: np.ndarray
    depth: np.ndarray
    lam_form: np.ndarray
    topic_lin: dict[int, int]
    lam_max: dict[int, float]

    @staticmethod
    def build(lins: np.ndarray, parents: np.ndarray, lam_form: np.ndarray, topic_lin: dict[int, int], lam_max: dict[int, float]) -> Tree:
        """``parents``: lineage ids, -1 for roots; ``lins`` rising."""
        n = len(lins)
        first = np.where(parents < 0, np.arange(n), np.searchsorted(lins, np.maximum(parents, 0)))
        up, depth = [first.astype(np.int32)], (parents >= 0).astype(np.int32)
        while True:
            last = up[-1]
            if (last == last[last]).all():
                break
            depth = depth + depth[last]
            up.append(last[last])
        return Tree(lins, np.array(up), depth, lam_form, {t: int(np.searchsorted(lins, x)) for t, x in topic_lin.items()}, lam_max)

    def lca(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lowest common ancestor of the lineages (positions) a and b, elementwise; -1 in different trees."""
        a, b = np.broadcast_arrays(a, b)
        a, b = np.where(self.depth[a] >= self.depth[b], a, b), np.where(self.depth[a] >= self.depth[b], b, a)
        gap = self.depth[a] - self.depth[b]
        for j in range(len(self.up)):
            a = np.where(gap >> j & 1 == 1, self.up[j][a], a)
        for j in range(len(self.up) - 1, -1, -1):
            x, y = self.up[j][a], self.up[j][b]
            a, b = np.where(x != y, x, a), np.where(x != y, y, b)
        low = np.where(a == b, a, self.up[0][a])
        return np.where((a == b) | (self.up[0][a] == self.up[0][b]), low, -1)


def lineage_tree(h, selection: DataFrame, numbering: DataFrame) -> Tree | None:
    """The tree of a hierarchy for broadcasting; None if it is beyond ``TREE_BYTES``."""
    rows = h.lineages.select("lin", F.coalesce("parent", F.lit(-1)).alias("parent"), "lam_form")
    n = rows.count()
    if n * (24 + 4 * max(1, math.ceil(math.log2(n + 1)))) > TREE_BYTES:
        return None
    got = rows.toPandas().sort_values("lin")
    falls = h.falls.join(selection.select("lin", "sel").where("sel IS NOT NULL"), "lin").groupBy("sel").agg(F.max("lam").alias("lam_max"))
    topics = numbering.select("sel", "topic").join(falls, "sel", "left").toPandas()
    return Tree.build(got["lin"].to_numpy(np.int64), got["parent"].to_numpy(np.int64), got["lam_form"].to_numpy(np.float64),
                      dict(zip(topics["topic"].astype(int), topics["sel"].astype("int64"))), dict(zip(topics["topic"].astype(int), topics["lam_max"])))


def tree_scores(tree: Tree, lins: np.ndarray, lam: np.ndarray, topics: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, m, lam_max) for points (their lineage ids and lambdas) x topics."""
    of = np.array([tree.topic_lin[t] for t in topics.tolist()], dtype=np.int64)
    top = np.array([tree.lam_max[t] for t in topics.tolist()], dtype=np.float64)
    names, back = np.unique(lins, return_inverse=True)
    meet = tree.lca(np.searchsorted(tree.lins, names)[:, None], of[None, :])[back]
    form = np.where(meet < 0, 0.0, tree.lam_form[np.maximum(meet, 0)])
    m = np.where(meet == of[None, :], lam[:, None], np.minimum(lam[:, None], form))
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(m >= top, np.inf, np.where(np.isinf(top), 1.0, top / (top - m)))
    return score, m, np.broadcast_to(top, m.shape)


def tile_rows(ids: np.ndarray, topics: np.ndarray, dmin: np.ndarray, tree: Tree | None, lins=None, lam=None) -> pd.DataFrame:
    """One row per point: whether a score is infinite, the reference score, sum of u, the two largest u, the best topic, the
    topic with the largest m (its m and lam_max). u counts exp(score - reference); an infinite score leaves the others 0."""
    u = 1.0 / np.maximum(dmin, 1e-12)
    out = {"id": ids}
    if tree is None:
        infinite, ref = np.zeros(len(ids), bool), np.zeros(len(ids))
    else:
        score, m, top = tree_scores(tree, lins, lam, topics)
        ref = score.max(axis=1)
        infinite = np.isinf(ref)
        u = u * np.where(infinite[:, None], np.isinf(score), np.exp(np.where(np.isinf(score), 0.0, score) - np.where(infinite, 0.0, ref)[:, None]))
        ref = np.where(infinite, 0.0, ref)
        star = m.argmax(axis=1)  # topics rise: the first of equals is the smallest
        out |= {"m": m[np.arange(len(ids)), star], "m_topic": topics[star], "m_lam": top[np.arange(len(ids)), star]}
    best = u.argmax(axis=1)
    first = u[np.arange(len(ids)), best]
    rest = u.copy()
    rest[np.arange(len(ids)), best] = -1.0
    second = np.maximum(rest.max(axis=1), 0.0)
    return pd.DataFrame(out | {"inf": infinite, "ref": ref, "total": u.sum(axis=1), "u1": first, "c1": topics[best], "u2": second})


_TILE = "id long, inf boolean, ref double, total double, u1 double, c1 int, u2 double, m double, m_topic int, m_lam double"
_NAMES = [c.split()[0] for c in _TILE.split(", ")]


def _tile_task(tree):
    def run(points: pd.DataFrame, tile: pd.DataFrame) -> pd.DataFrame:
        if points.empty or tile.empty:
            return pd.DataFrame(columns=_NAMES)
        tile = tile.sort_values("topic", kind="stable")
        topics, starts = np.unique(tile["topic"].to_numpy(np.int32), return_index=True)
        dmin = nearest_exemplars(np.vstack(points["v"].to_numpy()), np.vstack(tile["v"].to_numpy()), starts)
        known = tree.value if tree is not None else None
        rows = tile_rows(points["id"].to_numpy(np.int64), topics, dmin, known, points["lin"].to_numpy(), points["lam"].to_numpy(np.float64))
        return rows.reindex(columns=_NAMES)
    return run


def _spread_task(points: pd.DataFrame, tile: pd.DataFrame) -> pd.DataFrame:
    """Distances to the exemplars of one tile of a topic that has several."""
    if points.empty or tile.empty:
        return pd.DataFrame({"id": [], "topic": [], "dmin": []})
    d = nearest_exemplars(np.vstack(points["v"].to_numpy()), np.vstack(tile["v"].to_numpy()), np.array([0]))[:, 0]
    return pd.DataFrame({"id": points["id"].to_numpy(np.int64), "topic": np.full(len(d), int(tile["topic"].iloc[0])), "dmin": d})


def _spread_rows(tree):
    def run(batches):
        for pdf in batches:
            for topics, rows in pdf.groupby(pdf["topics"].map(tuple)):
                known = tree.value if tree is not None else None
                out = tile_rows(rows["id"].to_numpy(np.int64), np.array(topics, dtype=np.int32), np.vstack(rows["dmin"].to_numpy()), known,
                                rows["lin"].to_numpy(), rows["lam"].to_numpy(np.float64))
                yield out.reindex(columns=_NAMES)
    return run


def _merged(tiles: DataFrame, with_tree: bool) -> DataFrame:
    """(id, c1, p1, p2) from a point's tile rows: as many as there are tiles."""
    g = tiles.groupBy("id").agg(F.max("inf").alias("any_inf"), F.max(F.when(~F.col("inf"), F.col("ref"))).alias("top_ref"),
                                F.collect_list(F.struct("inf", "ref", "total", "u1", "c1", "u2")).alias("t"),
                                F.max(F.struct("m", (-F.col("m_topic")).alias("k"), "m_lam")).alias("star"))

    def scale(t):
        return F.when(t["inf"] == F.col("any_inf"), F.when(t["inf"], 1.0).otherwise(F.exp(t["ref"] - F.col("top_ref")))).otherwise(0.0)

    total = F.aggregate("t", F.lit(0.0), lambda s, t: s + t["total"] * scale(t))
    tops = F.flatten(F.transform("t", lambda t: F.array(F.struct((t["u1"] * scale(t)).alias("u"), (-t["c1"]).alias("c")),
                                                        F.struct((t["u2"] * scale(t)).alias("u"), F.lit(-2**31).alias("c")))))
    g = g.select("id", "star", total.alias("total"), F.sort_array(tops, asc=False).alias("tops"))
    inside = F.lit(1.0)
    if with_tree:
        lam, top = F.col("lam"), F.col("star.m_lam")
        # lambda over the larger of the two; a topic of infinite lambda holds only points of infinite lambda
        inside = F.when(lam >= top, 1.0).when(top == float("inf"), 0.0).otherwise(lam / top)
    p = lambda i: F.col("tops")[i]["u"] / F.col("total")
    return g.select("id", (-F.col("tops")[0]["c"]).cast("int").alias("c1"), p(0).alias("q1"), p(1).alias("q2"), "star"), inside


def best_memberships(vectors: DataFrame, clusters: DataFrame, points: DataFrame | None = None, hierarchy=None, selection: DataFrame | None = None,
                     vec_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, c1, p1, p2): best topic (ties: the smaller), its membership and the second largest, for every point or the ids of ``points``.

    With ``hierarchy`` and ``selection`` (of ``density.hdbscan``) the full soft membership, else the distance share alone.
    """
    from pubstrata.operators import density as DN

    spark = vectors.sparkSession
    ship_package(spark)
    v = vectors.select(F.col("id").cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    if points is not None:
        v = v.join(points.select("id").distinct(), "id", "left_semi")
    tree = None
    if hierarchy is not None:
        tree = lineage_tree(hierarchy, selection, DN.cluster_numbering(selection, hierarchy.lineages))
        if tree is None:
            return top2(DN.membership_vectors(hierarchy, selection, membership_distance(vectors, clusters, vec_col, block_rows, points)))
        # the topics of the tree are those of the labels; a point outside every lineage is in no cluster
        v = v.join(hierarchy.falls.select("id", "lin", "lam"), "id")
        tree = spark.sparkContext.broadcast(tree)
    else:
        v = v.withColumn("lin", F.lit(None).cast("long")).withColumn("lam", F.lit(None).cast("double"))
    v = cut_lineage(v, "membership")
    ex = cut_lineage(exemplars(clusters, vectors, vec_col).select(F.col("topic").cast("int").alias("topic"), "v").distinct(), "exemplars")
    sizes = ex.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    nt = max(1, math.ceil(ex.count() / block_rows))
    big = cut_lineage(sizes.where(F.col("n") > block_rows), "big_topics")
    small_ex = ex.join(big.select("topic"), "topic", "left_anti").withColumn("tile", F.pmod(F.xxhash64("topic"), F.lit(nt)).cast("int"))
    nb = max(1, math.ceil(v.count() / block_rows))
    blocks = v.withColumn("blk", F.pmod(F.xxhash64("id"), F.lit(nb)).cast("int"))

    def paired(tiles: DataFrame, count: int, task, schema: str) -> DataFrame:
        """Every block with every tile (0 .. count - 1): bounded groups, the blocks copied per tile and the tiles per block."""
        left = blocks.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
        right = tiles.withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))
        return left.groupBy("blk", "tile").cogroup(right.groupBy("blk", "tile")).applyInPandas(task, schema)

    rows = paired(small_ex, nt, _tile_task(tree), _TILE)
    if not big.isEmpty():
        # the parts of a big topic are tiles of their own; they are numbered in a table with a row per big topic
        upto = Window.orderBy("topic").rowsBetween(Window.unboundedPreceding, -1)
        cut = big.withColumn("k", F.ceil(F.col("n") / block_rows).cast("int")).withColumn("from", F.coalesce(F.sum("k").over(upto), F.lit(0)).cast("int"))
        parts = ex.join(F.broadcast(cut), "topic").select("topic", (F.col("from") + F.pmod(F.xxhash64("v"), F.col("k"))).cast("int").alias("tile"), "v")
        near = paired(parts, cut.agg(F.sum("k")).first()[0], _spread_task, "id long, topic int, dmin double")
        near = near.groupBy("id", "topic").agg(F.min("dmin").alias("dmin"))
        per = near.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("topic", "dmin"))).alias("s"))
        per = per.join(v.select("id", "lin", "lam"), "id").select("id", "lin", "lam", F.col("s.topic").alias("topics"), F.col("s.dmin").alias("dmin"))
        rows = rows.unionByName(per.mapInPandas(_spread_rows(tree), _TILE))
    merged, inside = _merged(rows, tree is not None)
    if tree is not None:
        merged = merged.join(v.select("id", "lam"), "id")
    return merged.select("id", "c1", (F.col("q1") * inside).alias("p1"), (F.col("q2") * inside).alias("p2"))
