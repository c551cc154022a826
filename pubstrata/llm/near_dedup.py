"""Near-duplicate components by tensored MinHash banding with exact verification.

Two small collections of half-bands (``HALVES`` bands of ``ROWS`` minhashes each)
are computed per distinct shingle set. Every pair of a band of the first and a band
of the second collection keys one of HALVES^2 tables, so 2 * HALVES * ROWS minhashes
give the recall of HALVES^2 tables of 2 * ROWS rows each. With 8 and 2 a pair at
similarity 0.85 misses all tables with probability 7e-5. The threshold is an argument:
``op7`` takes ``PERCENT``, the pipeline's stage ``STAGE_PERCENT``, and ``halves_for`` adds
half-bands below 0.85 until a pair at the threshold is missed no more often (10 at 0.8: 7e-5).

Documents with equal sets form one class first. In each table bucket every class is
paired with one class of the bucket only, picked by a hash (a star, never all pairs),
and the links are confirmed on full sets. That joins nearly everything that belongs
together. Buckets that still hold several components are compared completely, block
against block inside tasks: members of the bucket's largest component only against
the others, pairs of one component not at all. A pair leaves a task only if it
collides first in this table, its sizes allow the similarity, and the similarity
estimated from two sketches of ``BINS`` bins is within ``SIGMAS`` standard deviations of
the threshold (missed with probability 3e-6); survivors are confirmed on full sets too. So
no link is lost to a bucket's size, and no bucket is gathered in one task. The bins'
shingles are a sample without replacement from the union of both sets, whose size is known
at the threshold, so sets that the bins hold nearly whole are told apart nearly exactly.

Shingles are compared by 64-bit hashes, sets of a class by a 128-bit digest.

Defined results: A-Z are lower-cased; null or wordless text has no shingles, is
linked with nothing and is kept; fewer than five words are one shingle; repeated
rows are copies of each other; a null id never is a component id unless the whole
component has none; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubstrata.llm.common import (ASCII_LOWER, LOWER, UPPER, Scratch, components, map_frames, packed, read_table, rows_of, ship_package, small, unpacked)
from pubstrata.llm.shingles import scramble, shingle_set

HALVES, ROWS = 8, 2
PERCENT = 85
#: threshold of the pipeline's stage, which has no contract of its own
STAGE_PERCENT = 80
#: greatest probability that a pair at the threshold misses all tables
MISS = 7.5e-5
BLOCK = 512
#: one-permutation sketch: bins (one byte each), and standard deviations below the threshold that still pass
BINS, SIGMAS = 1024, 4.5


def halves_for(percent: int) -> int:
    """Half-bands per collection: HALVES, or more where a pair at the threshold would be missed more often than MISS."""
    halves = HALVES
    while 2 * (1 - (percent / 100) ** ROWS) ** halves > MISS:
        halves += 1
    return halves


@functools.lru_cache
def _multipliers(count: int) -> np.ndarray:
    """Odd multipliers; a longer row begins with the shorter one."""
    return np.random.default_rng(20240607).integers(1, 2**63, size=(count, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhashes(shingles: np.ndarray, count: int = 2 * HALVES * ROWS) -> np.ndarray:
    """``count`` minhashes of 32 bits."""
    best = np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(shingles), 4096):
        y = shingles[None, k:k + 4096] * _multipliers(count)
        y ^= y >> np.uint64(32)
        np.minimum(best, (y * np.uint64(0x9E3779B97F4A7C15)).min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(np.uint64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Least hash of each bin as one byte, 0 for an empty bin."""
    out = np.zeros(BINS, dtype=np.uint8)
    y = np.sort(scramble(shingles * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)))
    bins = (y >> np.uint64(65 - BINS.bit_length())).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]]) if len(y) else bins
    out[bins[first]] = 1 + ((y[first] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(255)
    return out


def may_be_similar(one: np.ndarray, others: np.ndarray, n_one: int, n_others: np.ndarray,
                   percent: int = PERCENT) -> np.ndarray:
    """Whether sketches (rows of ``others``) agree with ``one`` as far as chance allows at the threshold.

    ``n_one`` and ``n_others`` are the sizes of the whole sets.
    """
    used = ((one > 0) | (others > 0)).sum(axis=1)
    equal = ((one == others) & (one > 0)).sum(axis=1)
    p = percent / 100
    union = (n_one + n_others) / (1 + p)
    unseen = np.maximum(union - used, 0) / np.maximum(union - 1, 1)
    return equal >= used * p - SIGMAS * np.sqrt(used * p * (1 - p) * unseen) - 1e-6


def _sign(batches: Iterator[pd.DataFrame], halves: int = HALVES) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        n, key, a, b, sk = [], [], [], [], []
        for text in pdf["text"]:
            s = shingle_set((text or "").translate(ASCII_LOWER))
            n.append(len(s))
            key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            m = minhashes(s, 2 * halves * ROWS).reshape(2 * halves, ROWS) if len(s) else np.zeros((2 * halves, ROWS), np.uint64)
            half = ((m[:, 0] << np.uint64(32)) | m[:, 1]).view(np.int64)
            a.append(half[:halves])
            b.append(half[halves:])
            sk.append(sketch(s).tobytes())
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "tk": pdf["tk"], "n": n, "set_key": key, "a": a, "b": b, "sk": sk})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        sets = [shingle_set((t or "").translate(ASCII_LOWER)).view(np.int64) for t in pdf["text"]]
        yield pd.DataFrame({"node": pdf["node"], "sh": sets})


def _block_pair(g: dict[str, np.ndarray], percent: int = PERCENT, halves: int = HALVES) -> list[tuple[int, int]]:
    """Pairs of different components in one block pair that may be similar enough and meet first in this table."""
    table, kind, i, j = (int(g[c][0]) for c in ("table", "kind", "i", "j"))
    n, comp, node, own, major = (g[c] for c in ("n", "comp", "node", "own", "major"))
    if kind == 1:
        left, right = np.flatnonzero(~major), np.flatnonzero(major)
    elif i == j:
        left = right = np.arange(len(node))
    else:
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    if len(left) == 0 or len(right) == 0 or (left is right and len(left) == 1):
        return []
    a, b = np.stack(g["a"]).astype(np.int64), np.stack(g["b"]).astype(np.int64)
    sk = np.frombuffer(b"".join(g["sk"]), dtype=np.uint8).reshape(len(node), -1)
    out = []
    for x in left:
        y = right[node[right] > node[x]] if left is right else right
        y = y[(comp[y] != comp[x]) & (100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x]))]
        # table (ta, tb) is the first where both halves agree
        y = y[(a[y] == a[x]).argmax(axis=1) * halves + (b[y] == b[x]).argmax(axis=1) == table]
        y = y[may_be_similar(sk[x], sk[y], n[x], n[y], percent)]
        out += [(node[x], node[z]) for z in y]
    return out


def _survivors(batches: Iterator[pd.DataFrame], percent: int, halves: int) -> Iterator[pd.DataFrame]:
    """Block pairs one after the other from rows sorted by block pair; holds one block pair at a time."""
    names = ["key", "kind", "i", "j"]
    held: pd.DataFrame | None = None

    def done(pdf, ends):
        cols = {c: pdf[c].to_numpy() for c in pdf.columns}
        out, begin = [], 0
        for end in ends:
            if end - begin > 1:
                out += _block_pair({c: v[begin:end] for c, v in cols.items()}, percent, halves)
            begin = end
        return pd.DataFrame(out, columns=["x", "y"], dtype="int64")

    for pdf in batches:
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        if len(pdf) == 0:
            continue
        keys = pdf[names].to_numpy()
        ends = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        if len(ends):
            yield done(pdf, ends)
            held = pdf.iloc[ends[-1]:].reset_index(drop=True)
        else:
            held = pdf
    if held is not None:
        yield done(held, [len(held)])


class _Run:
    """State of one run over ``docs`` (doc_id, text): texts are near copies from a similarity of ``percent`` / 100."""

    def __init__(self, docs: DataFrame, percent: int):
        ship_package(docs.sparkSession)
        self.percent, self.halves = percent, halves_for(percent)
        self.scratch = Scratch(docs.sparkSession, "near")
        self.docs = docs.select("doc_id", "text", F.md5(F.coalesce("text", F.lit(""))).alias("tk"))
        signed = map_frames(self.docs, functools.partial(_sign, halves=self.halves), "doc_id long, tk string, n long, set_key binary, a array<long>, b array<long>, sk binary")
        self.signed = self.scratch.cut(signed, "signed")
        some = self.signed.where("n > 0").groupBy("set_key").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "tk")).alias("rep"), F.min("n").alias("n"),
            F.min("a").alias("a"), F.min("b").alias("b"), F.min("sk").alias("sk"))
        classes = some.select(F.monotonically_increasing_id().alias("node"), "set_key", "rep.doc_id", "rep.tk", "n", "a", "b", "sk")
        self.classes = self.scratch.cut(classes, "classes")

    def bucket_members(self) -> DataFrame:
        """(key, table, node, center) of buckets with two classes or more."""
        keys = [F.struct(F.lit(i * self.halves + j).alias("table"), F.xxhash64(F.lit(i * self.halves + j), F.get("a", i), F.get("b", j)).alias("key"))
                for i in range(self.halves) for j in range(self.halves)]
        rows = self.classes.select("node", F.explode(F.array(*keys)).alias("k")).select("node", "k.table", "k.key")
        # the node that is least after XOR with the key: a different member in each table
        least = F.min(F.col("node").bitwiseXOR(F.col("key")))
        shared = rows.groupBy("key").agg(least.alias("least"), F.count("*").alias("size")).where(F.col("size") > 1)
        shared = shared.select("key", F.col("least").bitwiseXOR(F.col("key")).alias("center"))
        return self.scratch.cut(rows.join(shared, "key"), "members")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Those pairs (x, y) of classes that are similar enough on their full sets."""
        nodes = pairs.select(F.col("x").alias("node")).union(pairs.select("y")).distinct()
        where = nodes.join(self.classes.select("node", "doc_id", "tk"), "node")
        where = self.scratch.cut(where.select("node", F.col("doc_id").alias("w_id"), F.col("tk").alias("w_tk")), "where")
        texts = self.docs.join(small(where, 72), (F.col("tk") == F.col("w_tk")) & F.col("doc_id").eqNullSafe(F.col("w_id")))
        # rows repeated as a whole give one set
        sets = texts.select("node", "text").mapInPandas(_sets, "node long, sh array<long>").groupBy("node").agg(F.first("sh").alias("sh"))
        sets = self.scratch.cut(sets, "sets")
        both = pairs.join(sets.select(F.col("node").alias("y"), F.col("sh").alias("sy")), "y")
        both = both.join(sets.select(F.col("node").alias("x"), F.col("sh").alias("sx")), "x")
        both = both.withColumn("common", F.size(F.array_intersect("sx", "sy")))
        ok = 100 * F.col("common") >= self.percent * (F.size("sx") + F.size("sy") - F.col("common"))
        out = self.scratch.cut(both.where(ok).select(F.col("x").alias("a"), F.col("y").alias("b")), "links")
        self.scratch.free(sets, where)
        return out

    def rest_pairs(self, members: DataFrame, comp: DataFrame) -> DataFrame:
        """Unconfirmed pairs between different components of a bucket, each once.

        The bucket's center is out: the star has compared it with every member.
        """
        m = members.where("node <> center").select("key", "table", "node").join(comp, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
        per = m.groupBy("key", "comp").agg(F.count("*").alias("c"))
        stat = per.groupBy("key").agg(F.sum("c").alias("all"), F.max(F.struct("c", "comp")).alias("top"), F.count("*").alias("comps"))
        stat = stat.where("comps > 1").select(F.col("key"), F.col("top.comp").alias("top"),
                                              F.ceil((F.col("all") - F.col("top.c")) / BLOCK).cast("int").alias("sb"),
                                              F.ceil(F.col("top.c") / BLOCK).cast("int").alias("mb"))
        m = m.join(stat, "key").withColumn("major", F.col("comp") == F.col("top"))
        own = F.pmod(F.xxhash64("node"), F.when(F.col("major"), F.col("mb")).otherwise(F.col("sb"))).cast("int")
        m = m.withColumn("own", own).join(self.classes.select("node", "n", "a", "b", "sk"), "node")

        def upto(c):
            return F.sequence(F.lit(0), F.col(c) - 1)

        def task(kind, i, j):
            return F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"))

        others = F.concat(F.transform(upto("sb"), lambda k: task(0, F.least("own", k), F.greatest("own", k))),
                          F.transform(upto("mb"), lambda k: task(1, F.col("own"), k)))
        majors = F.transform(upto("sb"), lambda k: task(1, k, F.col("own")))
        m = m.withColumn("t", F.explode(F.when(F.col("major"), majors).otherwise(others)))
        m = m.select("key", "table", "t.*", "node", "comp", "own", "major", "n", "a", "b", "sk")
        m = m.repartition("key", "kind", "i", "j").sortWithinPartitions("key", "kind", "i", "j")
        return m.mapInPandas(functools.partial(_survivors, percent=self.percent, halves=self.halves), "x long, y long")

    def roots(self) -> DataFrame:
        """(node, root) of the classes that are linked."""
        members = self.bucket_members()
        star = members.where("node <> center").select(F.least("center", "node").alias("x"), F.greatest("center", "node").alias("y")).distinct()
        links = self.confirm(self.scratch.cut(star, "star"))
        comp = self.scratch.cut(components(links, self.scratch), "comp")
        rest = self.scratch.cut(self.rest_pairs(members, comp).distinct(), "rest")
        self.scratch.free(members)
        if rest.isEmpty():
            return comp
        more = self.confirm(rest)
        return self.scratch.cut(components(links.union(more), self.scratch), "comp")

    def labelled(self) -> DataFrame:
        """(set_key, component_id, best_tk): per class the component's smallest id and the text key of its first row."""
        c = self.classes.join(self.roots(), "node", "left").withColumn("root", F.coalesce("root", "node"))
        best = c.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "tk")).alias("best"))
        out = c.join(best, "root").select("set_key", F.col("best.doc_id").alias("component_id"), F.col("best.tk").alias("best_tk"))
        return self.scratch.cut(out, "labels")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    run = _Run(rows_of(docs, "doc_id", "text"), percent)
    labels = run.labelled().select(F.col("set_key").alias("k"), "component_id")
    d = run.signed.select("doc_id", "n", "set_key").join(small(labels, 48), F.col("set_key") == F.col("k"), "left")
    comp = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return d.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                    F.col("doc_id").eqNullSafe(comp).alias("kept"))


def keep_one(docs: DataFrame, percent: int = STAGE_PERCENT) -> DataFrame:
    """The documents without near duplicates: of each component the row with the smallest id (then text key) stays.

    Wordless texts are in no component and stay. Rows repeated as a whole count as one.
    """
    run = _Run(rows_of(docs, "doc_id", "text"), percent)
    reps = run.labelled().select(F.col("component_id").alias("r_id"), F.col("best_tk").alias("r_tk")).distinct()
    reps = run.scratch.cut(reps, "reps")
    again = run.signed.where("n > 0").groupBy("doc_id", "tk").count().where("count > 1")
    base = packed(docs).withColumn("tk_", F.md5(F.coalesce("row_.text", F.lit(""))))
    worded = F.rlike(F.coalesce("row_.text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]"))
    same = (F.col("tk_") == F.col("r_tk")) & F.col("row_.doc_id").eqNullSafe(F.col("r_id"))
    out = base.withColumn("worded_", worded).join(small(reps, 72), same, "left").where("NOT worded_ OR r_tk IS NOT NULL")
    if not again.isEmpty():
        order = Window.partitionBy("row_.doc_id", "tk_").orderBy(F.xxhash64("row_"))
        out = out.withColumn("no_", F.when(F.col("worded_"), F.row_number().over(order)).otherwise(1)).where("no_ = 1")
    return unpacked(out.select("row_"))


def op7_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: near-duplicate components of ``documents``."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


ORACLE = f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT rid, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS sh FROM d),
  n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
  pair AS (SELECT a.rid AS x, b.rid AS y, count(*) AS shared FROM s a JOIN s b USING (sh) GROUP BY a.rid, b.rid),
  link AS (SELECT x, y FROM pair JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * shared >= {PERCENT} * (a.n + b.n - shared)),
  reach AS (SELECT x, y FROM link UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
  c AS (SELECT x AS rid, min(doc_id) AS least FROM reach JOIN d ON d.rid = y GROUP BY x)
  SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(least, doc_id) AS component_id, doc_id IS NOT DISTINCT FROM coalesce(least, doc_id) AS kept
  FROM d LEFT JOIN n USING (rid) LEFT JOIN c USING (rid)"""
