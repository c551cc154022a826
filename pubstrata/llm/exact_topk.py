"""Exact inner-product top-k: ball-tree branch and bound per shard.

Vectors are hashed into shards of about ``SHARD`` rows. A task builds a ball tree
over one shard (centre and radius per node); for a query q an inner product in a node
is at most q.centre + |q| radius. Nodes are visited in order of that bound, and the
search ends when the next bound is below the query's current k-th score.

The k-th score is shared in two rounds: every query first searches its own shard, and
its k-th score there goes along to all other shards, which then report only vectors
that reach it. A round's tasks are (shard, block of ``QUERIES`` queries), so a task
holds one shard and one block; results are at most k rows per query and task, and a
window with a group limit merges them.

Scores are integers. They are computed in float64, which is exact below 2^53, and with
Python integers where a shard's or query's values could go beyond.

Defined results: vectors that are null or hold null or non-finite components, and rows
without vec_id, take no part; an empty vector has dimension 0; only vectors of the
query's dimension are its candidates; every row is a candidate and, by its id, a query of
its own, rows that share an id or are repeated as a whole included; ties go to the smaller vec_id; scores beyond 64 bits stop at the limits of long.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubstrata.llm.common import Scratch, read_table, rows_of, ship_package

SHARD, QUERIES, LEAF = 4096, 1024, 128
SCALE, EVERY, TOP = 1024, 100, 10
_LONG = 2**63 - 1


class BallTree:
    """Binary tree of balls over the rows of ``v`` (float64)."""

    def __init__(self, v: np.ndarray, leaf: int = LEAF):
        self.v = v
        self.rows: list[np.ndarray | None] = []
        self.kids: list[tuple[int, int] | None] = []
        self.centre, self.radius = [], []
        todo = [(np.arange(len(v)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            k = len(self.rows)
            if parent >= 0:
                self.kids[parent][side] = k
            part = v[rows]
            c = part.mean(axis=0)
            dist = np.sqrt(((part - c) ** 2).sum(axis=1))
            self.centre.append(c)
            self.radius.append(float(dist.max()))
            halves = self._split(part, dist) if len(rows) > leaf and dist.max() > 0 else None
            self.rows.append(None if halves is not None else rows)
            self.kids.append([0, 0] if halves is not None else None)
            if halves is not None:
                todo += [(rows[halves], k, 0), (rows[~halves], k, 1)]
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)

    @staticmethod
    def _split(part: np.ndarray, dist: np.ndarray) -> np.ndarray | None:
        a = part[dist.argmax()]
        b = part[((part - a) ** 2).sum(axis=1).argmax()]
        along = part @ (b - a)
        half = along <= np.median(along)
        if half.all():
            half = along < along.max()
        return half if half.any() and not half.all() else None

    def search(self, q: np.ndarray, floor: float, k: int, scores, tie: np.ndarray) -> list[tuple]:
        """The k best (score, -tie) of at least ``floor``; ``scores(rows)`` gives exact scores or None for rows to skip."""
        norm = math.sqrt(float(q @ q))
        mid = self.centre @ q
        # the margin covers rounding of the bound
        bound = mid + norm * self.radius
        bound += 1e-9 * (np.abs(mid) + norm * self.radius) + 1e-6
        best: list[tuple] = []
        heap = [(-bound[0], 0)]
        while heap:
            b, node = heapq.heappop(heap)
            least = max(floor, best[0][0] if len(best) == k else -math.inf)
            if -b < least:
                break
            rows = self.rows[node]
            if rows is None:
                for kid in self.kids[node]:
                    if bound[kid] >= least:
                        heapq.heappush(heap, (-bound[kid], kid))
                continue
            got = scores(rows)
            for s, r in zip(got.tolist(), rows.tolist()):
                if s is not None and s >= least and (len(best) < k or (s, -tie[r]) > best[0]):
                    (heapq.heappush if len(best) < k else heapq.heapreplace)(best, (s, -int(tie[r])))
                    if len(best) == k:
                        least = max(floor, best[0][0])
        return best


def _big(v: np.ndarray) -> bool:
    """Whether inner products of these rows with themselves could leave float64's exact integers."""
    m = np.abs(v.astype(np.float64)).max(initial=0.0)
    return m * m * max(1, v.shape[1]) >= 2.0**52


def search_shard(k: int):
    """One shard against one block of queries (cogrouped)."""
    def run(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(shard):
            ints = np.array(shard["q"].tolist(), dtype=np.int64).reshape(len(shard), -1)
            asks = np.array(queries["q"].tolist(), dtype=np.int64).reshape(len(queries), -1)
            big = _big(ints) or _big(asks)
            v = ints.astype(np.float64)
            tree = BallTree(v)
            ids, marks = shard["vec_id"].to_numpy(), shard["mark"].to_numpy()
            for (qid, qmark, floor), row in zip(queries[["vec_id", "mark", "floor"]].itertuples(index=False, name=None), asks):
                own = (ids == qid) & (marks == qmark)

                def scores(rows, row=row, own=own):
                    if big:
                        got = (ints[rows].astype(object) * row.astype(object)).sum(axis=1) if ints.shape[1] else np.zeros(len(rows), object)
                        got = np.array([max(-_LONG - 1, min(_LONG, int(x))) for x in got], dtype=object)
                    else:
                        got = (v[rows] @ row.astype(np.float64)).astype(np.int64).astype(object)
                    got[own[rows]] = None
                    return got

                least = -math.inf if pd.isna(floor) else (int(floor) if not big else float(floor))
                for s, t in tree.search(row.astype(np.float64), least, k, scores, ids):
                    out.append((qid, qmark, -t, s))
        return pd.DataFrame(out, columns=["query_id", "mark", "vec_id", "score"]).astype("int64")
    return run


_FOUND = "query_id long, mark long, vec_id long, score long"


def top_k(vectors: DataFrame, k: int = TOP, every: int = EVERY, scale: int = SCALE, shard: int = SHARD, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id is divisible by ``every`` its k best other rows.

    ``vectors``: vec_id, embedding.
    """
    ship_package(vectors.sparkSession)
    scratch = Scratch(vectors.sparkSession, "topk")
    good = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    v = rows_of(vectors, "vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL").where(good)
    v = v.select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("q"))
    # equal rows are counted and numbered, so that a mark tells each from the query's own row
    v = v.groupBy("vec_id", "q").agg(F.count("*").alias("n")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    v = scratch.cut(v.select("vec_id", "q", F.xxhash64("q", "copy").alias("mark"), F.size("q").alias("dim")), "vectors")
    count = v.agg(F.count("*"), F.sum(F.when(F.col("vec_id") % every == 0, 1))).first()
    shards, blocks = max(1, math.ceil(count[0] / shard)), max(1, math.ceil((count[1] or 0) / block))
    v = v.withColumn("shard", F.pmod(F.xxhash64("vec_id", "mark"), F.lit(shards)).cast("int"))
    asks = v.where(F.col("vec_id") % every == 0).withColumn("block", F.pmod(F.xxhash64("mark", "vec_id"), F.lit(blocks)).cast("int"))
    asks = scratch.cut(asks, "queries")
    bases = v.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def searched(queries):
        by = ("dim", "shard", "block")
        columns = ("vec_id", "mark", "q", "floor", *by)
        return (queries.select(*columns).groupBy(*by).cogroup(bases.select("vec_id", "mark", "q", *by).groupBy(*by))
                .applyInPandas(search_shard(k), _FOUND))

    home = scratch.cut(searched(asks.withColumn("floor", F.lit(None).cast("long"))), "home")
    floor = home.groupBy("query_id", "mark").agg(F.min("score").alias("floor"), F.count("*").alias("n")).where(F.col("n") == k)
    floor = floor.select(F.col("query_id").alias("vec_id"), "mark", "floor")
    others = asks.join(floor, ["vec_id", "mark"], "left").withColumnRenamed("shard", "own")
    others = others.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> own")
    # a table of its own: the cogroup may not see columns of one origin on both sides
    found = home.unionByName(searched(scratch.cut(others, "others"))) if shards > 1 else home
    rank = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_topk(spark, sf_dir: str) -> DataFrame:
    """Contract query: the 10 best rows for each query row of ``embeddings``."""
    return top_k(read_table(spark, sf_dir, "embeddings"))


ORACLE = f"""WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
  s AS (SELECT a.vec_id AS query_id, a.rid, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % {EVERY} = 0 AND len(a.q) = len(b.q) AND a.rid <> b.rid),
  r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
  SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {TOP}"""
