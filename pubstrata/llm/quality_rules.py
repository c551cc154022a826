"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the raw corpus (DataFrame functions only).

Words and word pairs of every document are hashed into buckets whose number grows with
the corpus (``buckets_for``). Two multinomials over the buckets, one of the trusted
documents (quality label 1) and one of all documents, give a log ratio per bucket,
shrunk by ``PRIOR`` counts: log((good + PRIOR) / (expected + PRIOR)), expected being the
trusted count that the raw share would give. A bucket without evidence counts 0 at every
corpus size. A document's score is the mean log ratio of its n-grams, so that length
does not matter. Documents that score below a cutoff or fail the base rules are
rejected; the cutoff is set from the labelled documents' scores (``choose_cutoff``).

Counts are map-side sums over large splits (``COUNT_BYTES``), which are whole splits of the input
run by one task. The table of ratios, a row per bucket, is broadcast if its
counted size allows, else in chunks of ``CHUNK`` buckets (``chunked``: an array of ratios, 4 bytes a bucket,
up to ``CHUNKS_BYTES`` times that size: 2^25 buckets, some 190 GB of text), so n-grams are not moved. Only beyond
that are just the hottest buckets broadcast (at most ``HOT``, as each
holds 1/HOT of all n-grams or more) and the others joined by shuffle, so that no
bucket is a hot key. N-grams' ratios are added up per row inside the map task; what
leaves it is one narrow row per document. Ratios are fixed-point numbers (``UNIT``), so
that sums do not depend on their order.

Windows are compared by 64-bit hashes within one document.

Defined results: null or blank text has no words, fails the base rules and is not
kept; n-grams need at least one word; several labels of one id count as trusted if
any is 1, null ids match no label; without trusted documents every ratio is 0 and
only the base rules decide; each input row gives one row, repeats included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubstrata.llm.common import BROADCAST_BYTES, Scratch, packed, read_table, rows_of, small, unpacked, words

MIN_BUCKETS = 1 << 14
PRIOR = 16.0
UNIT = 1 << 20
HOT = 4096
#: buckets of one row of the packed table of ratios, and times ``BROADCAST_BYTES`` that it may take
CHUNK, CHUNKS_BYTES = 1024, 4
#: text that one task counts, and tasks at least: a task sends a row per bucket that it has met, and a small split meets most buckets
COUNT_BYTES, COUNT_TASKS = 128 << 20, 12
#: a document's score must be below this to be rejected, whatever the labels say
MAX_CUTOFF = -0.1
#: a share of good documents lost weighs as much as this many times that share of bad documents kept
GOOD_WEIGHT = 20
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = "#*$%&|<>"


def with_hashes(d: DataFrame) -> DataFrame:
    """Adds h1 and h2, the 64-bit hashes of the words and of the word pairs of array ``w``.

    Arrays that a lambda reads by position are columns of their own; an expression
    inside a lambda would be built again for every element.
    """
    d = d.withColumn("h1", F.transform("w", lambda x: F.xxhash64(x)))
    pairs = F.slice("h1", F.lit(1), F.greatest(F.size("h1") - 1, F.lit(0)))
    return d.withColumn("h2", F.transform(pairs, lambda x, i: F.xxhash64(x, F.get("h1", i + 1))))


def buckets_for(text_bytes: int) -> int:
    """Number of buckets: a power of two that grows like the distinct n-grams of a corpus (its bytes to the power 2/3)."""
    return max(MIN_BUCKETS, 1 << max(0, int(text_bytes ** (2 / 3)) - 1).bit_length())


def best_label(labels: DataFrame, scratch: Scratch) -> DataFrame:
    """(t_id, quality): the best label of every id."""
    best = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return scratch.cut(best.select(F.col("doc_id").alias("t_id"), "quality"), "labels")


def bucket(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets))


def fit(docs: DataFrame, best: DataFrame, scratch: Scratch, buckets: int, prior: float = PRIOR, text_bytes: int = 0) -> DataFrame:
    """(b, n, ratio): n-grams and log ratio (in 1/UNIT) of every bucket that occurs."""
    trusted = scratch.cut(best.where("quality = 1").select("t_id"), "trusted")
    flagged = docs.join(small(trusted, 16), F.col("doc_id") == F.col("t_id"), "left")
    hashed = with_hashes(flagged.select(F.col("t_id").isNotNull().cast("long").alias("good"), words(F.col("text")).alias("w")))
    hashed = hashed.coalesce(max(COUNT_TASKS, -(-text_bytes // COUNT_BYTES)))
    grams = hashed.select("good", F.explode(F.concat("h1", "h2")).alias("h")).select("good", bucket(F.col("h"), buckets).alias("b"))
    per = scratch.cut(grams.groupBy("b").agg(F.count("*").alias("n"), F.sum("good").alias("good")), "counts")
    total = per.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    expected = F.col("n") * F.lit((total.good or 0) / (total.n or 1))
    ratio = F.round(F.log((F.col("good") + prior) / (expected + prior)) * UNIT).cast("long")
    return scratch.cut(per.select("b", "n", ratio.alias("ratio")), "ratios")


def chunked(ratios: DataFrame) -> DataFrame:
    """(chunk, ratios array<int>): the ratios of ``CHUNK`` buckets by place, null where a bucket does not occur.

    A ratio is a fixed-point logarithm of counts, at most 40 * ``UNIT``, and fits an int.
    """
    place = F.pmod(F.col("b"), F.lit(CHUNK)).cast("int")
    found = ratios.groupBy(F.floor(F.col("b") / CHUNK).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct(place.alias("at"), F.col("ratio").cast("int").alias("ratio")))).alias("s"))
    # in front of every bucket nulls for those that were left out since the one before
    left_out = lambda x, i: F.array_repeat(F.lit(None).cast("int"), x["at"] - F.coalesce(F.get("s", i - 1)["at"], F.lit(-1)) - 1)
    filled = F.transform("s", lambda x, i: F.concat(left_out(x, i), F.array(x["ratio"])))
    return found.select("chunk", F.flatten(filled).alias("ratios"))


def with_ratio(grams: DataFrame, ratios: DataFrame, buckets: int) -> DataFrame:
    """``grams`` (b, row_no and other columns; b null in a row without n-grams) with their bucket's ``ratio``."""
    if ratios.count() * 24 <= BROADCAST_BYTES:
        every = F.broadcast(ratios.select(F.col("b").alias("b_"), "ratio"))
        return grams.join(every, F.col("b") == F.col("b_"), "left").drop("b_")
    if buckets * 4 <= CHUNKS_BYTES * BROADCAST_BYTES:
        ratio = F.get("ratios", F.pmod(F.col("b"), F.lit(CHUNK)).cast("int")).cast("long")
        near = grams.join(F.broadcast(chunked(ratios)), F.floor(F.col("b") / CHUNK) == F.col("chunk"), "left")
        return near.withColumn("ratio", ratio).drop("chunk", "ratios")
    total = ratios.agg(F.sum("n")).first()[0]
    # at most HOT rows can hold 1/HOT of all n-grams each
    hot = F.broadcast(ratios.where(F.col("n") * HOT >= total).select(F.col("b").alias("hot_b"), F.col("ratio").alias("hot_ratio")))
    rest = ratios.where(F.col("n") * HOT < total).select(F.col("b").alias("b_"), "ratio")
    near = grams.join(hot, F.col("b") == F.col("hot_b"), "left")
    # what is answered goes through the second join under a key of its row, which is no bucket's
    by = F.when(F.col("hot_b").isNull() & F.col("b").isNotNull(), F.col("b")).otherwise(-1 - F.col("row_no"))
    far = near.withColumn("by", by).join(rest, F.col("by") == F.col("b_"), "left")
    return far.withColumn("ratio", F.coalesce("hot_ratio", "ratio")).drop("by", "b_", "hot_b", "hot_ratio")


def with_repeat_words(d: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in windows of five words that occur twice or more."""
    n = F.greatest(F.size("h1") - (WINDOW - 1), F.lit(0))
    # words 0-1, 2-3 and 4 of the window
    d = d.withColumn("h", F.transform(F.slice("h2", F.lit(1), n), lambda x, i: F.xxhash64(x, F.get("h2", i + 2), F.get("h1", i + 4))))
    by_hash = F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
    d = d.withColumn("by_hash", F.when(F.size(F.array_distinct("h")) < F.size("h"), by_hash)).drop("h")
    again = F.filter("by_hash", lambda s, i: F.coalesce(s.h == F.get("by_hash", i + 1).h, F.lit(False))
                     | F.coalesce(s.h == F.get("by_hash", i - 1).h, F.lit(False)))
    d = d.withColumn("at", F.sort_array(F.transform(again, lambda s: s["at"]))).drop("by_hash")
    # a window adds five words, or as many as lie before the next such window
    steps = F.transform("at", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - x, F.lit(WINDOW))))
    count = F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)
    return d.withColumn("n_repeat_words", F.coalesce(count, F.lit(0)).cast("long")).drop("at")


def _key_halves(text: Column) -> list[Column]:
    """120 bits of the text's digest as two longs, which an aggregate can carry in place."""
    digest = F.md5(F.coalesce(text, F.lit("")))
    return [F.conv(F.substring(digest, at, 15), 16, 10).cast("long") for at in (1, 16)]


def text_key(text: Column) -> Column:
    return F.concat_ws("-", *_key_halves(text))


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, ratios: DataFrame, buckets: int) -> DataFrame:
    """One narrow row per input row: doc_id, text_key, the base features, base_failed, score. ``docs``: doc_id, text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    k1, k2 = _key_halves(F.col("text"))
    d = docs.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "text", k1.alias("k1"), k2.alias("k2"), words(F.col("text")).alias("w"))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    d = with_repeat_words(with_hashes(d)).select("row_no", "doc_id", "k1", "k2", "w", "h1", "h2", "n_repeat_words", lines.alias("lines"),
                                                 F.array_join("w", "").alias("solid"))
    d = d.select(
        "row_no", "doc_id", "k1", "k2", F.size("w").cast("long").alias("n_words"), F.length("solid").cast("long").alias("word_chars"),
        (F.length("solid") - F.length(F.translate("solid", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", F.concat("h1", "h2").alias("h"))
    # a step of its own: what stands beside a generator is computed for every row that it makes
    grams = d.select("row_no", "doc_id", "k1", "k2", *_COUNTS, F.explode_outer("h").alias("h"))
    grams = grams.withColumn("b", bucket(F.col("h"), buckets)).drop("h")
    per = with_ratio(grams, ratios, buckets).groupBy("row_no").agg(
        *[F.max(c).alias(c) for c in ("doc_id", "k1", "k2", *_COUNTS)],
        F.sum("ratio").alias("sum"), F.count("ratio").alias("n"))
    score = F.when(F.col("n") > 0, F.col("sum") / F.col("n") / UNIT).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return per.select("doc_id", F.concat_ws("-", "k1", "k2").alias("text_key"), *_COUNTS, failed.alias("base_failed"), score.alias("score"))


def choose_cutoff(scored: DataFrame, best: DataFrame) -> float:
    """The cutoff, at most ``MAX_CUTOFF``, that loses least: GOOD_WEIGHT * share of good lost + share of bad kept.

    Labelled rows that pass the base rules are counted in steps of 1/1000 of score (a
    score stays within 40, so the counts are bounded); of equal cutoffs the lowest.
    """
    step = F.floor(F.col("score") * 1000).cast("int")
    known = scored.where("NOT base_failed").join(small(best, 20), F.col("doc_id") == F.col("t_id"))
    counts = sorted(known.groupBy(step.alias("at")).agg(F.count_if(F.col("quality") == 1).alias("good"),
                                                        F.count_if(F.col("quality") != 1).alias("bad")).collect())
    good, bad = max(1, sum(r.good for r in counts)), max(1, sum(r.bad for r in counts))
    lost, caught, found = 0, 0, [(0.0, -1_000_000)]
    for at, g, b in counts:
        lost, caught = lost + g, caught + b
        found.append((GOOD_WEIGHT * lost / good - caught / bad, at + 1))
    top = MAX_CUTOFF * 1000
    return min(f for f in found if f[1] <= top)[1] / 1000


def verdicts(docs: DataFrame, labels: DataFrame, buckets: int | None = None) -> DataFrame:
    """``measured`` with the column kept."""
    scratch = Scratch(docs.sparkSession, "quality")
    docs = rows_of(docs, "doc_id", "text")
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if buckets is None:
        buckets = buckets_for(text_bytes)
    best = best_label(rows_of(labels, "doc_id", "quality"), scratch)
    ratios = fit(docs, best, scratch, buckets, text_bytes=text_bytes)
    scored = scratch.cut(measured(docs, ratios, buckets), "scores")
    cutoff = choose_cutoff(scored, best)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= cutoff))


def rate(docs: DataFrame, labels: DataFrame, buckets: int | None = None) -> DataFrame:
    """One row per input row: row_ (all input columns), the base features, score, base_failed, kept.

    Features and verdict depend on the text alone, so rows meet theirs by the text's digest.
    """
    scratch = Scratch(docs.sparkSession, "rated")
    names = (*_COUNTS, "base_failed", "score", "kept")
    per = verdicts(docs, labels, buckets).groupBy("text_key").agg(F.count("*").alias("n"), *[F.max(c).alias(c) for c in names])
    per = scratch.cut(per, "texts")
    rows = packed(docs).withColumn("key_", text_key(F.col("row_.text")))
    return rows.join(small(per, 96), F.col("key_") == F.col("text_key")).select("row_", *names)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns.

    Only the rejected texts' digests are joined. One that a great share of all rows hold (at
    most ``HOT`` such, 1/HOT of the rows each or more) is always broadcast, so that it is no hot key.
    """
    scratch = Scratch(docs.sparkSession, "kept")
    v = verdicts(docs, labels)
    bad = scratch.cut(v.where("NOT kept").groupBy("text_key").agg(F.count("*").alias("n")), "rejected")
    rows = packed(docs).withColumn("key_", text_key(F.col("row_.text")))
    same = F.col("key_") == F.col("text_key")
    total = v.count()
    hot = F.broadcast(bad.where(F.col("n") * HOT >= total).select("text_key"))
    rest = scratch.cut(bad.where(F.col("n") * HOT < total).select("text_key"), "rare")
    return unpacked(rows.join(hot, same, "left_anti").join(small(rest, 64), same, "left_anti").select("row_"))


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Contract query: rules over every document of ``documents``."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return verdicts(docs, labels).select("doc_id", *_COUNTS, "base_failed", "kept", "score")
