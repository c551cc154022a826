"""Mixing sources to target weights along a time-varying curriculum (DataFrame functions only).

Every source gets a share of the corpus' words by weight, at most ``MAX_EPOCHS``
times its own size (the excess goes to the others by weight). Its documents stand
in a fixed pseudo-random order, one pass after the other, and the running word
count of that order is the source's cumulative token demand. The source's weight
schedule w(t), t from 0 to 1, is integrated to F(t); a copy that begins after the
share y of the source's target is trained at t = F^-1(y). Documents are then
range-sorted by t.

Running sums are two-level: words per (source, bucket of the order) first, sums
over the buckets next, rows within a bucket last. A source with a third of all
rows is spread over ``BUCKETS`` tasks' keys; the bucket table has at most
``BUCKETS`` rows per source, the source table one.

Defined results: null text has size 0; a null source is a source of its own and
comes last; documents of size 0 take no words and have no position; rows that are
equal in id and text are ranked among each other in any order (they are alike, so the
result is the same set of rows); an empty table gives an empty result; only
doc_id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubstrata.llm.common import Scratch, packed, read_table, rows_of, small

#: weights by the source's rank, repeating
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
BUCKETS = 4096
SEED = "mix-1"
#: knots (t, relative weight) of each class' schedule, linear between knots: the first
#: class fades out, the second is steady, the third fades in
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def schedule_integral(knots) -> list[tuple[float, float, float, float, float]]:
    """Segments (y0, t0, dt, w0, w1): y0 is the normalised integral where the segment begins."""
    if len(knots) < 2 or knots[0][0] != 0.0 or knots[-1][0] != 1.0 or any(w < 0 for _, w in knots):
        raise ValueError("a schedule runs from t=0 to t=1 with weights of 0 or more")
    total = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:]))
    if total <= 0:
        raise ValueError("a schedule needs some weight")
    out, y = [], 0.0
    for a, b in zip(knots, knots[1:]):
        out.append((y, a[0], b[0] - a[0], a[1] / total, b[1] / total))
        y += (b[0] - a[0]) * (a[1] + b[1]) / 2 / total
    return out


def invert(share: Column, knots) -> Column:
    """t at which the schedule's normalised integral reaches ``share``."""
    out = None
    for y0, t0, dt, w0, w1 in schedule_integral(knots):
        if dt == 0 or w0 + w1 == 0:
            continue
        over = F.greatest(share - F.lit(y0), F.lit(0.0))
        # w0 x + (w1 - w0) x^2 / (2 dt) = over, in the form that has no cancellation
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2.0 * (w1 - w0) / dt) * over, F.lit(0.0)))
        t = F.lit(t0) + F.least(F.when(over > 0, F.lit(2.0) * over / (F.lit(w0) + root)).otherwise(F.lit(0.0)), F.lit(dt))
        out = t if out is None else F.when(share >= F.lit(y0), t).otherwise(out)
    return out


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, klass, target) from (source, source_size): one row per source.

    With caps c = max_epochs * size and weights w, the targets are min(c, lam * w)
    for the level lam that uses up the total; sources that stop are those with the
    smallest c / w, so lam comes from running sums in that order. This is one window
    over the table of sources, which holds a row per source and not per document.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), F.col("klass") + 1)
    t = sizes.withColumn("klass", ((F.row_number().over(by_name) - 1) % n).cast("int"))
    t = t.withColumn("w", w.cast("long")).withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    t = (t.withColumn("total", F.sum("source_size").over(every))
         .withColumn("done", F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("left_w", F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("level", (F.col("total") - F.col("done")).cast("double") / F.col("left_w").cast("double")))
    t = t.withColumn("no", F.row_number().over(order))
    # the first source in this order that does not stop sets the level (of equal cap / w too: a later one has lost the others' caps)
    open_ = F.col("w") * F.col("level") <= F.col("cap")
    t = t.withColumn("lam", F.min_by(F.when(open_, F.col("level")), F.when(open_, F.col("no"))).over(every))
    level = F.col("w").cast("double") * F.col("lam")
    return t.select("source", "source_size", "klass",
                    F.when(F.col("lam").isNull() | (level > F.col("cap")), F.col("cap").cast("double")).otherwise(level).alias("target"))


def size_of(text: Column) -> Column:
    """Number of words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def plan(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, max_epochs: int = MAX_EPOCHS, seed: str = SEED, whole: bool = False) -> DataFrame:
    """One row per document, without its text: doc_id, source, text_key, size, source_size, target, taken, position.

    ``taken`` counts words: whole passes over the document, and in the source's last
    pass the words up to its target (the one document on the edge is cut there). With
    ``whole`` that document is taken whole if half of it or more lies before the target, else not,
    so that a source's words miss its target by half a document at most.
    ``position`` is the training time of the document's first copy.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    d = docs.select("doc_id", "source", F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), size_of(F.col("text")).alias("size"))
    rank = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_key"))
    d = d.withColumn("rank", rank).withColumn("bucket", F.conv(F.substring("rank", 1, 3), 16, 10).cast("int") % BUCKETS)
    d = scratch.cut(d, "sizes")
    sums = d.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scratch.cut(sums.withColumn("before", F.coalesce(F.sum("words").over(upto), F.lit(0))), "buckets")
    per_source = scratch.cut(targets(offsets.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs), "targets")
    offsets = offsets.join(small(per_source.withColumnRenamed("source", "s"), 64), F.col("source").eqNullSafe(F.col("s")))
    offsets = offsets.select(F.col("source").alias("o_source"), F.col("bucket").alias("o_bucket"), "before", "source_size", "klass", "target")
    offsets = scratch.cut(offsets, "offsets")
    inside = Window.partitionBy("source", "bucket").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = d.join(small(offsets, 64), F.col("source").eqNullSafe(F.col("o_source")) & (F.col("bucket") == F.col("o_bucket")))
    begin = F.col("before") + F.col("inside")
    want = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = want - passes * F.col("source_size")
    last = F.least(F.greatest(rest - begin, F.lit(0)), F.col("size"))
    if whole:
        last = F.when(2 * last >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    taken = passes * F.col("size") + last
    d = d.withColumn("begin", begin).withColumn("taken", taken.cast("long"))
    share = F.col("begin").cast("double") / F.greatest(F.col("target"), F.lit(1.0))
    d = d.withColumn("position", F.when(F.col("taken") > 0, place(share, schedules)))
    return d.select("doc_id", "source", "text_key", "size", "source_size", "klass", "target", "taken", "begin", "position")


def place(share: Column, schedules) -> Column:
    out = None
    for k, knots in enumerate(schedules):
        t = invert(share, knots)
        out = t if out is None else F.when(F.col("klass") % len(schedules) == k, t).otherwise(out)
    return out


def mix(docs: DataFrame, weights=WEIGHTS, schedules=SCHEDULES, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The training stream: the documents' columns, one row per copy, range-sorted by training time.

    Documents are whole (``plan`` with ``whole``). Copies of documents that the mix does not take are absent.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixed")
    p = plan(rows_of(docs, "doc_id", "text", "source"), weights, schedules, max_epochs, seed, whole=True)
    p = p.where("taken > 0").select(
        "klass", "size", "source_size", "target", "begin", "taken", F.col("doc_id").alias("p_id"),
        F.col("source").alias("p_source"), F.col("text_key").alias("p_key"))
    # rows that are equal in id, source and text are interchangeable: number them on both sides
    alike = Window.partitionBy("p_id", "p_source", "p_key").orderBy(F.desc("taken"), "begin")
    p = scratch.cut(p.withColumn("p_no", F.row_number().over(alike)), "plan")
    base = packed(docs).withColumn("key_", F.md5(F.coalesce("row_.text", F.lit(""))))
    same = [F.col("row_.doc_id").eqNullSafe(F.col("p_id")), F.col("row_.source").eqNullSafe(F.col("p_source")), F.col("key_") == F.col("p_key")]
    if p.where("p_no > 1").isEmpty():
        joined = base.join(p, same)
    else:
        row = Window.partitionBy("row_.doc_id", "row_.source", "key_").orderBy(F.xxhash64("row_"))
        joined = base.withColumn("no_", F.row_number().over(row)).join(p, [*same, F.col("no_") == F.col("p_no")])
    passes = F.expr("taken DIV size").cast("int")
    copies = joined.withColumn("pass_", F.explode(F.sequence(F.lit(1), passes)))
    share = (F.col("begin") + (F.col("pass_") - 1) * F.col("source_size")).cast("double") / F.greatest(F.col("target"), F.lit(1.0))
    copies = copies.withColumn("at_", place(share, schedules))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = copies.repartitionByRange(n, "at_", "row_.source", "row_.doc_id", "pass_")
    return ordered.sortWithinPartitions("at_", "row_.source", "row_.doc_id", "pass_").select("row_.*")


def op2_mix(spark, sf_dir: str) -> DataFrame:
    """Contract query: the mix of ``documents``, range-sorted by position."""
    p = plan(rows_of(read_table(spark, sf_dir, "documents"), "doc_id", "text", "source"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    out = p.repartitionByRange(n, F.col("position").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")
    return out.select("doc_id", "size", "source_size", "target", "taken", "position")


def _invert_sql(knots) -> str:
    out = None
    for y0, t0, dt, w0, w1 in schedule_integral(knots):
        over = f"greatest(share - {y0!r}::DOUBLE, 0.0::DOUBLE)"
        t = (f"({t0!r}::DOUBLE + least(CASE WHEN {over} > 0 THEN 2.0::DOUBLE * {over} / ({w0!r}::DOUBLE + sqrt(greatest({w0 * w0!r}::DOUBLE"
             f" + {2.0 * (w1 - w0) / dt!r}::DOUBLE * {over}, 0.0::DOUBLE))) ELSE 0.0::DOUBLE END, {dt!r}::DOUBLE))")
        out = t if out is None else f"CASE WHEN share >= {y0!r}::DOUBLE THEN {t} ELSE {out} END"
    return out


def _oracle() -> str:
    return f"""WITH d AS (SELECT doc_id, source, md5(coalesce(text, '')) AS text_key, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS klass FROM d GROUP BY source),
    c AS (SELECT *, klass + 1 AS w, {MAX_EPOCHS} * source_size AS cap, (SELECT CAST(sum(source_size) AS BIGINT) FROM s) AS total FROM s),
    lev AS (SELECT a.source, CAST(a.total - coalesce(sum(b.cap) FILTER (WHERE (b.cap::DOUBLE / b.w, b.source IS NULL, coalesce(b.source, '')) < (a.cap::DOUBLE / a.w, a.source IS NULL, coalesce(a.source, ''))), 0) AS DOUBLE)
              / CAST(sum(b.w) FILTER (WHERE (b.cap::DOUBLE / b.w, b.source IS NULL, coalesce(b.source, '')) >= (a.cap::DOUBLE / a.w, a.source IS NULL, coalesce(a.source, ''))) AS DOUBLE) AS level, a.w, a.cap
            FROM c a, c b GROUP BY a.source, a.total, a.w, a.cap),
    lam AS (SELECT level AS lam FROM lev WHERE w * level <= cap ORDER BY cap::DOUBLE / w, source IS NULL, source LIMIT 1),
    t AS (SELECT c.source, source_size, klass, CASE WHEN CAST(w AS DOUBLE) * lam > cap THEN CAST(cap AS DOUBLE) ELSE CAST(w AS DOUBLE) * lam END AS target FROM c, lam),
    o AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || text_key)
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin FROM d),
    j AS (SELECT o.doc_id, o.size, t.source_size, t.klass, t.target, o.begin, CAST(round(t.target) AS BIGINT) AS want
          FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source),
    k AS (SELECT *, CASE WHEN source_size > 0 THEN want // source_size ELSE 0 END AS passes FROM j),
    r AS (SELECT *, CAST(passes * size + least(greatest(want - passes * source_size - begin, 0), size) AS BIGINT) AS taken,
            CAST(begin AS DOUBLE) / greatest(target, 1.0::DOUBLE) AS share FROM k)
    SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN
      CASE klass WHEN 0 THEN {_invert_sql(SCHEDULES[0])} WHEN 1 THEN {_invert_sql(SCHEDULES[1])} ELSE {_invert_sql(SCHEDULES[2])} END END AS position FROM r"""


ORACLE = _oracle()
