"""Memberships of every point in every topic, a row per pair, none of which is shuffled.

Points are dealt into blocks by id, topics with all their exemplars into tiles, and every block meets every tile in a task that
returns the rows of its pairs. There are at most ``BLOCKS`` and ``TILES`` of them until one holds ``TASK_ROWS`` rows, so what is
shuffled grows with the input, not with points x topics. A point's memberships add up to one over all topics: with one tile a
task sees them all; with several, a first pass returns a row per point and tile (sums, largest score), those are merged, and a second
pass over the same pairs, in the same order and thus with the same distances, returns the rows. A topic whose exemplars exceed a tile is
spread over several tasks; the least distances are merged and come back as a column of the point, in a tile of their own.

The results are those of the joins of ``density.membership_vectors``, NaN included: a topic of infinite lambda has no score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubstrata.deploy import ship_package
from pubstrata.operators.neighbors import TASK_ROWS, narrow_vector
from pubstrata.operators.periphery import CELLS, exemplars, nearest_exemplars
from pubstrata.session import cut_lineage

BLOCKS, TILES = 24, 8
POINT, EXEMPLAR, FALL, TOTAL, NEAR = range(5)
_SUMS = "id long, bad int, inf int, ref double, fin double, sinf double, m double, m_topic int, m_lam double"
_ROWS = "id long, topic int, p double"
#: a table with a column for every kind of row; numbers are never null, so they stay whole in the tasks
_BLANK = {"id": "0L", "key": "0L", "topic": "-1", "lin": "0L", "lam": "0D", "bad": "0", "inf": "0", "ref": "0D", "total": "0D", "m_lam": "0D",
          "topics": "cast(null as array<int>)", "dmin": "cast(null as array<double>)"}


@dataclass
class Distances:
    """The arguments of ``periphery.membership_distance``: its table, or what ``density.membership_vectors`` weighs in the tasks that find the distances."""

    vectors: DataFrame
    clusters: DataFrame
    vec_col: str = "embedding"
    block_rows: int = 4096
    points: DataFrame | None = None


def part_count(n: int, rows: int, most: int) -> int:
    """Parts of n rows: of about ``rows`` each up to ``most`` of them, of up to ``TASK_ROWS`` beyond."""
    return max(1, min(math.ceil(n / rows), most), math.ceil(n / TASK_ROWS))


def _stack(vs) -> np.ndarray:
    return np.vstack(vs.to_numpy()).astype(np.float64) if len(vs) else np.empty((0, 0))


class _Pair:
    """One block of points and one tile of topics. Ids lie in the order of their lineages, so a slice of them has few."""

    def __init__(self, pdf: pd.DataFrame, tree):
        of = {k: pdf[pdf["kind"] == k] for k in range(5)}
        self.tree = tree
        src = of[NEAR] if len(of[NEAR]) else of[POINT]
        ids = np.unique(src["id"].to_numpy(np.int64))
        if tree is None:
            falls = pd.DataFrame({"id": ids, "lin": 0, "lam": 0.0, "n": 1})
        else:
            falls = of[FALL].groupby(["id", "lin", "lam"], dropna=False).size().rename("n").reset_index().sort_values(["id", "lin", "lam"])
            known = np.minimum(np.searchsorted(tree.lins, falls["lin"].to_numpy(np.int64)), len(tree.lins) - 1)
            falls = falls[(tree.lins[known] == falls["lin"].to_numpy(np.int64)) & np.isin(falls["id"].to_numpy(np.int64), ids)]
        first = falls.drop_duplicates("id")
        ids = first["id"].to_numpy(np.int64)
        by = np.lexsort((ids, first["lin"].to_numpy(np.int64)))
        self.ids = ids[by]
        place = np.empty(len(ids), np.int64)
        place[by] = np.arange(len(ids))

        def at(rows):
            """The rows whose id takes part, and the ids' positions."""
            x = rows["id"].to_numpy(np.int64)
            j = np.minimum(np.searchsorted(ids, x), max(0, len(ids) - 1))
            held = ids[j] == x if len(ids) else np.zeros(len(x), bool)
            return rows[held], place[j[held]]

        ends = np.arange(len(ids) + 1)
        falls, pos = at(falls)
        order = np.lexsort((falls["lam"].to_numpy(), falls["lin"].to_numpy(np.int64), pos))
        self.owner, self.fall_at = pos[order], np.searchsorted(pos[order], ends)
        self.lin, self.lam, self.n = (falls[c].to_numpy(t)[order] for c, t in (("lin", np.int64), ("lam", np.float64), ("n", np.int64)))
        self.near = self.x = None
        if len(of[NEAR]):
            rows, pos = at(of[NEAR])
            self.topics = np.array(rows["topics"].iloc[0] if len(rows) else [], np.int32)
            self.near = _stack(rows["dmin"])[np.argsort(pos)]
            self.missing = np.zeros(len(self.topics), bool)
        else:
            rows, pos = at(of[POINT])
            order = np.lexsort((rows["key"].to_numpy(np.int64), pos))
            self.x, self.x_at = _stack(rows["v"])[order], np.searchsorted(pos[order], ends)
            ex = of[EXEMPLAR].sort_values(["topic", "key"], kind="stable")
            self.topics = np.unique(ex["topic"].to_numpy(np.int32))
            ex = ex[ex["v"].notna()]
            self.e = _stack(ex["v"])
            held, self.starts = np.unique(ex["topic"].to_numpy(np.int32), return_index=True)
            self.missing = ~np.isin(self.topics, held)
        if tree is not None:
            self.of = np.array([tree.topic_lin[t] for t in self.topics.tolist()], dtype=np.int64)
            self.top = np.array([tree.lam_max[t] for t in self.topics.tolist()], dtype=np.float64)
        if len(of[TOTAL]):
            rows, pos = at(of[TOTAL])
            self.totals = rows.iloc[np.argsort(pos)]

    def _inverse(self, a: int, b: int) -> np.ndarray:
        """1 / distance of the ids a .. b - 1 to every topic."""
        if self.near is not None:
            d = self.near[a:b]
        else:
            d = np.full((b - a, len(self.topics)), np.inf)
            if len(self.e):
                at = self.x_at[a:b] - self.x_at[a]
                rows = nearest_exemplars(self.x[self.x_at[a]:self.x_at[b]], self.e, self.starts)
                d[:, ~self.missing] = rows if len(rows) == b - a else np.fmin.reduceat(rows, at, axis=0)
        return 1.0 / np.fmax(d, 1e-12)  # a distance that is not a number counts as the least

    def slices(self):
        """(ids' range, falls' range, owners, inverse distances, scores, m) of slices of bounded size; score and m are -inf where point and topic share no tree."""
        if not len(self.ids) or not len(self.topics):
            return
        step = max(1, CELLS // len(self.topics))
        for a in range(0, len(self.ids), step):
            b = min(a + step, len(self.ids))
            r = slice(self.fall_at[a], self.fall_at[b])
            owner = self.owner[r] - a
            w = self._inverse(a, b)[owner]
            if self.tree is None:
                yield a, b, r, owner, w, np.zeros_like(w), np.zeros_like(w)
                continue
            names, back = np.unique(self.lin[r], return_inverse=True)
            meet = self.tree.lca(np.searchsorted(self.tree.lins, names)[:, None], self.of[None, :])[back]
            lam = self.lam[r][:, None]
            m = np.where(meet == self.of[None, :], lam, np.minimum(lam, self.tree.lam_form[np.maximum(meet, 0)]))
            with np.errstate(all="ignore"):
                gap = self.top[None, :] - m
                score = np.where((gap > 0) | np.isnan(gap), self.top[None, :] / gap, np.inf)
            apart = (meet < 0) | np.isnan(self.top)[None, :]
            yield a, b, r, owner, w, np.where(apart, -np.inf, score), np.where(apart, -np.inf, m)

    def sums(self, a: int, b: int, r: slice, owner, w, score, m) -> dict:
        """Per id, over its falls and the tile's topics: what its total and its share in some cluster are made of."""
        inf, finite = np.isposinf(score), np.isfinite(score)
        ref = np.where(finite, score, -np.inf).max(axis=1)
        with np.errstate(all="ignore"):
            fin = np.where(finite, w * np.exp(score - ref[:, None]), 0.0).sum(axis=1) * self.n[r]
        star = m.argmax(axis=1)  # topics rise: the first of equals is the smallest
        rows = np.arange(len(star))
        bad, any_inf, sinf, best, topic = np.isnan(score).any(axis=1), inf.any(axis=1), np.where(inf, w, 0.0).sum(axis=1) * self.n[r], m[rows, star], star
        if len(rows) > b - a:  # ids with several falls
            at = self.fall_at[a:b] - self.fall_at[a]
            top, most = np.maximum.reduceat(ref, at), np.maximum.reduceat(best, at)
            with np.errstate(all="ignore"):
                fin = np.add.reduceat(np.where(np.isfinite(ref), fin * np.exp(ref - top[owner]), 0.0), at)
            topic = np.minimum.reduceat(np.where(best == most[owner], topic, len(self.topics) - 1), at)
            bad, any_inf, sinf = np.logical_or.reduceat(bad, at), np.logical_or.reduceat(any_inf, at), np.add.reduceat(sinf, at)
            ref, best = top, most
        m_lam = self.top[topic] if self.tree is not None else np.zeros(len(topic))
        return {"id": self.ids[a:b], "bad": bad.astype(np.int32), "inf": any_inf.astype(np.int32), "ref": ref, "fin": fin, "sinf": sinf,
                "m": best, "m_topic": self.topics[topic], "m_lam": m_lam}

    def rows(self, a: int, b: int, r: slice, owner, w, score, m):
        """The rows (id, topic, p) of a slice."""
        if getattr(self, "totals", None) is not None:
            t = {c: self.totals[c].to_numpy()[a:b][owner] for c in ("bad", "inf", "ref", "total", "m_lam")}
        else:
            s = self.sums(a, b, r, owner, w, score, m)
            t = {c: s[c][owner] for c in ("bad", "inf", "ref", "m_lam")} | {"total": np.where(s["inf"] == 1, s["sinf"], s["fin"])[owner]}
        with np.errstate(all="ignore"):
            u = w * np.where(t["inf"][:, None] == 1, np.isposinf(score), np.exp(score - t["ref"][:, None]))
            p = np.where(t["bad"][:, None] == 1, np.nan, u / t["total"][:, None])
            if self.tree is not None:
                p = p * (self.lam[r] / np.maximum(self.lam[r], t["m_lam"]))[:, None]
        keep, n = ~np.isneginf(score) & ~self.missing[None, :], self.n[r]
        for k in range(int(n.max())):  # equal falls of an id are rows of their own
            i, j = np.nonzero(keep & (n > k)[:, None])
            yield pd.DataFrame({"id": self.ids[a + owner[i]], "topic": self.topics[j], "p": p[i, j]})


def _task(tree, sums: bool):
    def run(batches):
        got = [x for x in batches if len(x)]
        if not got:
            return
        pair = _Pair(pd.concat(got, ignore_index=True), tree.value if tree is not None else None)
        del got
        for part in pair.slices():
            if sums:
                yield pd.DataFrame(pair.sums(*part))
            else:
                yield from pair.rows(*part)
    return run


def _spread_task(batches):
    """(id, topic, dmin): the least distances to one part of a topic that has several."""
    got = [x for x in batches if len(x)]
    pdf = pd.concat(got, ignore_index=True) if got else None
    if pdf is None or not (pdf["kind"] == POINT).any() or not (pdf["kind"] == EXEMPLAR).any():
        return
    pts, ex = pdf[pdf["kind"] == POINT].sort_values(["id", "key"]), pdf[pdf["kind"] == EXEMPLAR].sort_values("key")
    d = nearest_exemplars(_stack(pts["v"]), _stack(ex["v"]), np.array([0]))[:, 0]
    yield pd.DataFrame({"id": pts["id"].to_numpy(np.int64), "topic": np.full(len(d), int(ex["topic"].iloc[0]), np.int32), "dmin": d})


def _totals(sums: DataFrame) -> DataFrame:
    """One row per id from its rows per tile: as many as there are tiles."""
    g = sums.groupBy("id").agg(F.max("bad").alias("bad"), F.max("inf").alias("inf"), F.max("ref").alias("ref"),
                               F.collect_list(F.struct(F.col("ref").alias("at"), "fin", "sinf")).alias("t"),
                               F.max(F.struct("m", (-F.col("m_topic")).alias("k"), "m_lam")).alias("star"))
    total = F.when(F.col("inf") == 1, F.aggregate("t", F.lit(0.0), lambda s, t: s + t["sinf"])).otherwise(
        F.aggregate("t", F.lit(0.0), lambda s, t: s + t["fin"] * F.exp(t["at"] - F.col("ref"))))
    return g.select("id", "bad", "inf", "ref", total.alias("total"), F.col("star.m_lam").alias("m_lam"))


def memberships(dist: Distances, falls: DataFrame | None = None, tree=None, topics: DataFrame | None = None) -> DataFrame:
    """(id, topic, p): the distance share of every point and topic; with ``falls``, ``tree`` (``membership.Tree``) and ``topics`` the full soft membership."""
    spark = dist.vectors.sparkSession
    ship_package(spark)
    v = dist.vectors.select(F.col("id").cast("long").alias("id"), narrow_vector(dist.vectors, dist.vec_col).alias("v"))
    if dist.points is not None:
        v = v.join(dist.points.select("id").distinct(), "id", "left_semi")
    kind = v.schema["v"].dataType
    ex = exemplars(dist.clusters, dist.vectors, dist.vec_col).select(F.col("topic").cast("int").alias("topic"), F.col("v").cast(kind).alias("v")).distinct()
    if topics is not None:
        ex = topics.select("topic").join(ex, "topic", "left")  # a topic without exemplars has a score nevertheless
        tree = spark.sparkContext.broadcast(tree)
    ex = cut_lineage(ex, "exemplars").withColumn("key", F.xxhash64("v"))
    # loop-control counts: size the parts
    n, ne = v.count(), ex.count()
    tile_rows = 8 * dist.block_rows
    nt, nb = part_count(ne, tile_rows, TILES), part_count(n, max(1, dist.block_rows // 8), BLOCKS)
    room = max(tile_rows, math.ceil(ne / nt))
    sizes = ex.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    big = cut_lineage(sizes.where(F.col("n") > room), "big_topics")
    n_big = big.count()
    blk = F.pmod(F.xxhash64("id"), F.lit(nb)).cast("int")

    def rows(df: DataFrame, what: int, parts: list[tuple[object, object]]) -> DataFrame:
        """``df`` as rows of one kind, with columns of the pairs they go to."""
        blank = {c: F.expr(e) for c, e in _BLANK.items()} | {"v": F.lit(None).cast(kind)}
        return df.withColumns(dict(parts)).select("blk", "tile", F.lit(what).alias("kind"), *[(F.col(c) if c in df.columns else e).alias(c) for c, e in blank.items()])

    def each(first: int, count: int):
        return F.explode(F.sequence(F.lit(first), F.lit(first + count - 1)))

    def paired(parts: list[DataFrame], count: int, task, schema: str) -> DataFrame:
        """A task per block and tile: few bytes, much work."""
        out = parts[0]
        for x in parts[1:]:
            out = out.unionByName(x)
        return out.withColumn("pair", (F.col("blk") * count + F.col("tile")).cast("int")).repartitionById(nb * count, F.col("pair")).mapInPandas(task, schema)

    pts = v.withColumn("key", F.xxhash64("v"))
    small = ex.join(F.broadcast(big.select("topic")), "topic", "left_anti") if n_big else ex
    tiles = nt + (1 if n_big else 0)
    parts = [rows(pts, POINT, [("blk", blk), ("tile", each(0, nt))]),
             rows(small, EXEMPLAR, [("tile", F.pmod(F.xxhash64("topic"), F.lit(nt)).cast("int")), ("blk", each(0, nb))])]
    if n_big:
        # the parts of a big topic are numbered in a table with a row per big topic
        upto = Window.orderBy("topic").rowsBetween(Window.unboundedPreceding, -1)
        cut = big.withColumn("k", F.ceil(F.col("n") / room).cast("int")).withColumn("from", F.coalesce(F.sum("k").over(upto), F.lit(0)).cast("int"))
        count = cut.agg(F.sum("k")).first()[0]
        split = ex.join(F.broadcast(cut), "topic").withColumn("tile", (F.col("from") + F.pmod("key", F.col("k"))).cast("int"))
        near = paired([rows(pts, POINT, [("blk", blk), ("tile", each(0, count))]), rows(split, EXEMPLAR, [("tile", F.col("tile")), ("blk", each(0, nb))])],
                      count, _spread_task, "id long, topic int, dmin double")
        near = near.repartition("id").groupBy("id", "topic").agg(F.min("dmin").alias("dmin"))
        near = near.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("topic", "dmin"))).alias("s"))
        near = cut_lineage(near.select("id", F.col("s.topic").alias("topics"), F.col("s.dmin").alias("dmin")), "near")
        parts.append(rows(near, NEAR, [("blk", blk), ("tile", F.lit(nt))]))
    if falls is not None:
        parts.append(rows(falls.select(F.col("id").cast("long").alias("id"), "lin", "lam").where("id IS NOT NULL"), FALL, [("blk", blk), ("tile", each(0, tiles))]))
    if tiles > 1:
        totals = cut_lineage(_totals(paired(parts, tiles, _task(tree, True), _SUMS)), "totals")
        parts.append(rows(totals, TOTAL, [("blk", blk), ("tile", each(0, tiles))]))
    # a NaN leaves a task as null
    return paired(parts, tiles, _task(tree, False), _ROWS).select("id", "topic", F.coalesce("p", F.lit(float("nan"))).alias("p"))
