"""Layout of the neighbour graph: batched gradient epochs on vertex partitions with ghost vertices.

The vertices are range-partitioned once by a space-filling order of their first coordinates (Morton code), so that most
edges stay inside a partition. There are at most ``PARTS`` partitions until one holds ``MOST_ROWS`` vertices, so a vertex has fewer than
``PARTS`` ghosts however many vertices there are. A task holds one partition: its own vertices, the positions of the other ends of its edges
(ghosts, frozen, in single precision) and a sample of all positions for negative samples (frozen, too). It runs several
epochs on that and returns its own vertices; rounds of ``ROUND`` epochs exchange the ghosts' positions. The edges are
dealt out by partition, once; a round shuffles positions only: each vertex and one copy per partition that needs it.
A graph that fits one partition has no ghosts, and its epochs are one task's loop.

A vertex with more than ``HUB`` edges (copies of one vector may give a vertex a third of all vertices as neighbours) has no home:
its edges stay with their other ends, every such partition moves a mirror of it along its share of the edges, and between
rounds the mirrors are averaged, weighted by their numbers of edges. Edges between two hubs are dealt by hash. So a task holds
at most about ``MOST_ROWS`` vertices with ``HUB`` edges each, whatever the degrees; it multiplies ``EDGES`` edges at a time.

An epoch is one batch step of the usual objective: every edge pulls both ends (weight / largest weight) and takes
``negative_rate`` random vertices that push its end away; a vertex' sum of moves is clipped to 4 per coordinate and
scaled by the falling learning rate. Random numbers depend on seed, partition and epoch only.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubstrata.deploy import ship_package
from pubstrata.session import bucketed, cut_lineage, free

#: partitions, vertices of a partition beyond which there are more, edges taken at a time (their arrays stay in the processor's cache)
PARTS, MOST_ROWS, EDGES = 12, 1 << 16, 1 << 12
#: vertices of a partition up to ``PARTS`` of them, epochs between two exchanges, edges above which a vertex is mirrored, sampled positions of a round
ROWS, ROUND, HUB, POOL = 2048, 5, 1024, 8192
#: coordinates and bits of each in the space-filling order
ORDER_DIMS, ORDER_BITS = 4, 10


def find_ab(min_dist: float = 0.1, spread: float = 1.0):
    """Fit 1 / (1 + a x^(2b)) to the target membership curve (Gauss-Newton least squares)."""
    x = np.linspace(0, spread * 3, 300)[1:]
    t = np.where(x < min_dist, 1.0, np.exp(-(x - min_dist) / spread))
    a, b = 1.0, 1.0
    for _ in range(200):
        xb = x ** (2 * b)
        f = 1.0 / (1.0 + a * xb)
        r = f - t
        da = -xb * f * f
        db = -a * xb * 2 * np.log(x) * f * f
        J = np.stack([da, db], 1)
        step = np.linalg.lstsq(J, -r, rcond=None)[0]
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-12:
            break
    return float(a), float(b)


def morton(y: Column, reach: float, dims: int = ORDER_DIMS, bits: int = ORDER_BITS) -> Column:
    """Interleaved bits of the first ``dims`` coordinates, each scaled from [-reach, reach] to ``bits`` bits."""
    top = (1 << bits) - 1
    code = F.lit(0).cast("long")
    for c in range(dims):
        cell = F.least(F.greatest((F.coalesce(F.get(y, F.lit(c)), F.lit(0.0)) + reach) / (2 * reach) * (top + 1), F.lit(0.0)), F.lit(float(top))).cast("long")
        for b in range(bits):
            bit = F.shiftright(cell, b).bitwiseAND(F.lit(1).cast("long"))
            code = code.bitwiseOR(F.shiftleft(bit, b * dims + c))
    return code


def part_count(n: int, part_rows: int) -> int:
    """Partitions of n vertices: of ``part_rows`` each up to ``PARTS`` of them, of up to ``MOST_ROWS`` beyond."""
    return max(1, min(math.ceil(n / part_rows), PARTS), math.ceil(n / MOST_ROWS))


def _runs(src: np.ndarray) -> list[tuple[slice, np.ndarray, np.ndarray]]:
    """(edges, their rows, where each row's edges begin): runs of about ``EDGES`` edges with whole rows; ``src`` is sorted."""
    rows, starts = np.unique(src, return_index=True)
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(src), EDGES)), len(rows)))
    ends = np.append(starts, len(src))
    return [(slice(ends[a], ends[b]), rows[a:b], starts[a:b] - starts[a]) for a, b in zip(cuts[:-1], cuts[1:])]


def run_epochs(y: np.ndarray, moving: int, src: np.ndarray, dst: np.ndarray, p: np.ndarray, others: np.ndarray, epochs: range, n_epochs: int,
               a: float, b: float, rate: float, negative_rate: int, seed: tuple[int, ...]) -> np.ndarray:
    """Positions of the first ``moving`` rows of ``y`` after the epochs; ``src`` is sorted, ``others`` are the rows to sample from.

    A run of edges takes its rows of ``y`` once for all its forces, in arrays that are made once.
    """
    if len(src) == 0:
        return y[:moving]
    y, runs, dim = y.copy(), _runs(src), y.shape[1]
    most = max(t.stop - t.start for t, _, _ in runs)
    room = [np.empty((most, dim)) for _ in range(3)]

    for ep in epochs:
        rng = np.random.default_rng([*seed, ep])
        move = np.zeros((moving, dim))
        samples = [rng.integers(len(others), size=len(src)) for _ in range(negative_rate)]
        for t, rows, starts in runs:
            m = t.stop - t.start
            near, far, diff = (r[:m] for r in room)
            np.take(y, src[t], axis=0, out=near, mode="clip")
            np.subtract(near, np.take(y, dst[t], axis=0, out=far, mode="clip"), out=diff)
            d2 = np.einsum("ij,ij->i", diff, diff)
            with np.errstate(divide="ignore", invalid="ignore"):
                # an edge is taken once in each direction, and each time it pulls both ends: twice per end
                c = np.where(d2 > 0, -4.0 * a * b * d2 ** (b - 1.0) / (a * d2**b + 1.0), 0.0) * p[t]
            diff *= c[:, None]
            sums = np.add.reduceat(diff, starts, axis=0)
            for sample in samples:
                k = others[sample[t]]
                np.subtract(near, np.take(y, k, axis=0, out=far, mode="clip"), out=diff)
                d2 = np.einsum("ij,ij->i", diff, diff)
                c = np.where(k == src[t], 0.0, 2.0 * b / ((0.001 + d2) * (a * d2**b + 1.0)) * p[t])
                diff *= c[:, None]
                sums += np.add.reduceat(diff, starts, axis=0)
            move[rows] = sums
        y[:moving] += np.clip(move, -4.0, 4.0) * (rate * (1.0 - ep / n_epochs))
    return y[:moving]


def _round(epochs: range, n_epochs: int, a: float, b: float, rate: float, negative_rate: int, seed: int, pool):
    """(edges of a partition, positions it needs) -> its own positions and mirrors with their weights."""

    def run(edges: pd.DataFrame, needs: pd.DataFrame) -> pd.DataFrame:
        if needs.empty:
            return pd.DataFrame({"id": [], "y": [], "weight": []})
        # own vertices and mirrors (moves) first; ids order the rest, so that the result does not depend on the rows' order
        needs = needs.sort_values(["moves", "id"], ascending=[False, True])
        ids, moving = needs["id"].to_numpy(np.int64), int(needs["moves"].sum())
        y = np.concatenate([*needs["y"].iloc[:moving], *needs["ghost"].iloc[moving:]], dtype=np.float64).reshape(len(ids), -1)
        at = pd.Series(np.arange(len(ids)), index=ids)
        pool_ids, pool_y = pool.value
        if len(pool_ids):
            known = at.reindex(pool_ids)
            fresh = known.isna().to_numpy()
            others = known.fillna(0).to_numpy(np.int64)
            others[fresh] = len(ids) + np.arange(int(fresh.sum()))
            y = np.vstack([y, pool_y[fresh]])
        else:
            others = np.arange(moving)
        e = edges.sort_values(["i", "j"])
        src, dst = at[e["i"].to_numpy(np.int64)].to_numpy(), at[e["j"].to_numpy(np.int64)].to_numpy()
        order = np.argsort(src, kind="stable")
        src, dst, p = src[order], dst[order], e["p"].to_numpy()[order]
        part = int(needs["part"].iloc[0])
        out = run_epochs(y, moving, src, dst, p, others, epochs, n_epochs, a, b, rate, negative_rate, (seed, part))
        weight = np.where(needs["hub"].to_numpy()[:moving], np.bincount(src, minlength=moving)[:moving], 1.0)
        return pd.DataFrame({"id": ids[:moving], "y": list(out), "weight": weight})

    return run


def layout(graph: DataFrame, init: DataFrame, n_epochs: int = 200, min_dist: float = 0.1, negative_rate: int = 5,
           learning_rate: float = 1.0, seed: int = 42, part_rows: int = ROWS, round_epochs: int = ROUND, hub: int = HUB) -> DataFrame:
    """(id, y): positions after ``n_epochs`` batched gradient epochs of the cross-entropy objective.

    ``graph`` (i, j, w) holds both directions of every edge, ``init`` (id, y) the first positions. Points without edges stay.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    spark = graph.sparkSession
    ship_package(spark)
    a, b = find_ab(min_dist)
    pos = last = cut_lineage(init.select(F.col("id").cast("long").alias("id"), "y"), "layout")
    stat = pos.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("y", F.abs)))).first()
    n, parts = stat[0], part_count(stat[0], part_rows)
    if n == 0 or n_epochs <= 0:
        return pos
    wmax = graph.agg(F.max("w")).first()[0]
    e = graph.where("i <> j").select(F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), (F.col("w") / F.lit(wmax or 1.0)).alias("p"))
    degree = e.groupBy(F.col("i").alias("id")).agg(F.count(F.lit(1)).alias("degree"))
    ranged = pos.select("id", morton(F.col("y"), max(stat[1] or 0.0, 1e-9)).alias("z"))
    ranged = cut_lineage(ranged.repartitionByRange(parts, "z", "id").select("id", F.spark_partition_id().alias("part")), "layout")
    v = cut_lineage(ranged.join(degree, "id", "left").select("id", "part", (F.coalesce("degree", F.lit(0)) > hub).alias("hub")), "layout")
    hubs = not v.where("hub").isEmpty()
    # the partition in which an edge moves its end i
    e = e.join(v.select(F.col("id").alias("i"), F.col("part").alias("pi"), F.col("hub").alias("hi")), "i").join(
        v.select(F.col("id").alias("j"), F.col("part").alias("pj"), F.col("hub").alias("hj")), "j")
    home = F.when(~F.col("hi"), F.col("pi")).when(~F.col("hj"), F.col("pj")).otherwise(F.pmod(F.xxhash64("i", "j"), F.lit(parts)).cast("int"))
    edges = cut_lineage(e.select(home.alias("part"), "i", "j", "p"), "layout_edges").repartitionById(parts, F.col("part")).persist(StorageLevel.DISK_ONLY)
    try:
        own = v.where("NOT hub").select("part", "id", F.lit(True).alias("moves"))
        ends = edges.select("part", F.col("i").alias("id"), F.lit(True).alias("moves")).unionByName(
            edges.select("part", F.col("j").alias("id"), F.lit(False).alias("moves")))
        needs = own.unionByName(ends).groupBy("part", "id").agg(F.max("moves").alias("moves"))
        needs = needs.join(v.select("id", "hub", F.col("part").alias("home")), "id")
        # a hub moves wherever an edge moves it; any other vertex only at home, and so it does
        needs = needs.select("part", "id", "hub", F.when(F.col("hub"), F.col("moves")).otherwise(F.col("part") == F.col("home")).alias("moves"))
        with bucketed(needs, "id", tag="layout_needs") as needed:
            step = n_epochs if parts == 1 else round_epochs
            for first in range(0, n_epochs, step):
                epochs = range(first, min(first + step, n_epochs))
                pool = _pool(pos, n, parts, seed, first)
                around = needed.join(pos, "id").select("part", "id", "hub", "moves", F.when(F.col("moves"), F.col("y")).alias("y"),
                                                       F.when(~F.col("moves"), F.col("y").cast("array<float>")).alias("ghost"))
                moved = edges.groupBy("part").cogroup(around.repartitionById(parts, F.col("part")).groupBy("part")).applyInPandas(
                    _round(epochs, n_epochs, a, b, learning_rate, negative_rate, seed, pool), "id long, y array<double>, weight double")
                moved = cut_lineage(moved, "layout")
                free(last)
                pos, last = moved.select("id", "y"), moved
                if hubs:
                    means = moved.groupBy("id").agg(vector_to_array(Summarizer.mean(array_to_vector("y"), F.col("weight"))).alias("y"))
                    pos = last = cut_lineage(means, "layout")
                    free(moved)
                pool.unpersist()
    finally:
        edges.unpersist()
    return pos


def _pool(pos: DataFrame, n: int, parts: int, seed: int, first: int):
    """Broadcast (ids, positions) of about ``POOL`` vertices chosen by hash, anew each round; all of them if there are no more.

    The bound is ``POOL`` rows however many vertices there are. One partition holds every vertex itself and needs none.
    """
    sc = pos.sparkSession.sparkContext
    if parts == 1:
        return sc.broadcast((np.empty(0, np.int64), np.empty((0, 0))))
    share = min(1.0, POOL / n)
    chosen = pos.where(F.pmod(F.xxhash64(F.lit(seed), F.lit(first), "id"), F.lit(1 << 30)) < int(share * (1 << 30)) + (share >= 1.0))
    rows = sorted(chosen.collect(), key=lambda r: r.id)
    return sc.broadcast((np.array([r.id for r in rows], dtype=np.int64), np.array([r.y for r in rows], dtype=np.float64)))
