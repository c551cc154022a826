"""Clustering-quality metrics over (clusters, authorship bridge, docs).

Each metric returns a DataFrame: the per-entity / per-cluster detail frame when
``detail=True``, otherwise a one-row frame with the mean (``metric``) and the
number of entities it averages. The mean is always an aggregate of the detail
frame, so the two can never disagree.

Plan shape (why it scales):
* the bridge is joined to the clusters once on a normalised document key;
  hot documents are split by adaptive skew-join handling;
* per-(entity, topic) counts use partial (map-side) aggregation, so a hot
  author holding a third of the rows is combined inside each map task;
* "max share" is ``max(n_ak) / sum(n_ak)`` in a second aggregation - no
  self-join of a table with its own aggregate and no window over hot keys;
* author overlap keeps an author's top-k topics as bit masks, counts equal masks
  and sums the counted masks per topic; no pairs are emitted per author.
"""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubstrata.columns import DEFAULT_COLS, PubCols, require_columns
from pubstrata.functions.keys import key_type
from pubstrata.functions.stats import safe_div, with_global_stats
from pubstrata.session import cut_lineage

AuthOrder = Literal["first", "last"] | None


def _count() -> Column:
    return F.count(F.lit(1))


def cluster_rows(clusters: DataFrame, cols: PubCols = DEFAULT_COLS, only_core: bool = False) -> DataFrame:
    require_columns(clusters, [cols.doc, cols.topic, cols.is_core], "clusters")
    c = clusters
    if only_core:
        c = c.where(F.col(cols.is_core) == F.lit(True))
    return c


def drop_noise(clusters: DataFrame, cols: PubCols = DEFAULT_COLS) -> DataFrame:
    return clusters.where(F.col(cols.topic) != -1)


def bridge_topics(
    clusters: DataFrame,
    bridge: DataFrame,
    entity: str,
    cols: PubCols = DEFAULT_COLS,
    only_core: bool = False,
    auth_order: AuthOrder = None,
) -> DataFrame:
    """Bridge rows joined to their document's topic: (doc_key, entity, topic).

    One output row per bridge row (rows, not documents). ``auth_order``
    keeps first authors (``auth_seqn = 0``) or last authors (the largest
    ``auth_seqn`` of the document over the whole bridge).
    """
    if auth_order not in (None, "first", "last"):
        raise ValueError("auth_order must be None, 'first' or 'last'")
    require_columns(bridge, [cols.bridge_doc, entity] + ([cols.seqn] if auth_order else []), "bridge")
    kt = key_type((clusters, cols.doc), (bridge, cols.bridge_doc))
    dc = cluster_rows(clusters, cols, only_core).select(
        F.col(cols.doc).cast(kt).alias("doc_key"), F.col(cols.topic).alias("topic")
    )
    b = bridge.select(
        F.col(cols.bridge_doc).cast(kt).alias("doc_key"),
        F.col(entity).alias("entity"),
        *([F.col(cols.seqn).alias("seqn")] if auth_order else []),
    )
    if auth_order == "first":
        b = b.where(F.col("seqn") == 0)
    elif auth_order == "last":
        last = bridge.groupBy(F.col(cols.bridge_doc).cast(kt).alias("doc_key")).agg(
            F.max(cols.seqn).alias("max_seqn")
        )
        b = b.join(last, "doc_key").where(F.col("seqn") == F.col("max_seqn")).drop("max_seqn")
    if auth_order:
        b = b.drop("seqn")
    return b.join(dc, "doc_key")


def doc_topics(
    clusters: DataFrame,
    docs: DataFrame,
    field: str,
    cols: PubCols = DEFAULT_COLS,
    only_core: bool = False,
    drop_null: bool = True,
    value_type: str | None = None,
) -> DataFrame:
    """Clustered documents with one docs column: (topic, val)."""
    require_columns(docs, [cols.eid, field], "docs")
    kt = key_type((clusters, cols.doc), (docs, cols.eid))
    dc = cluster_rows(clusters, cols, only_core).select(
        F.col(cols.doc).cast(kt).alias("doc_key"), F.col(cols.topic).alias("topic")
    )
    v = F.col(field) if value_type is None else F.col(field).cast(value_type)
    d = docs.select(F.col(cols.eid).cast(kt).alias("doc_key"), v.alias("val"))
    if drop_null:
        d = d.where(F.col("val").isNotNull())
    return dc.join(d, "doc_key").select("topic", "val")


def _mean_of(detail: DataFrame, n_name: str) -> DataFrame:
    return detail.agg(F.avg("metric").alias("metric"), _count().alias(n_name))


# --- M1 -------------------------------------------------------------------------------------

def simple_metrics(clusters: DataFrame, cols: PubCols = DEFAULT_COLS) -> DataFrame:
    """Counts and shares over the raw labels (noise kept)."""
    require_columns(clusters, [cols.topic, cols.is_core], "clusters")
    t, core = F.col(cols.topic), F.col(cols.is_core)
    agg = clusters.agg(
        _count().alias("n_total"),
        F.count(F.when(core, 1)).alias("n_core"),
        F.count(F.when(t != -1, 1)).alias("n_non_noise"),
        F.count_distinct(F.when(t != -1, t)).alias("n_clusters"),
    )
    share = lambda c: F.when(F.col("n_total") > 0, F.col(c) / F.col("n_total")).otherwise(F.lit(0.0))
    return agg.select(
        "n_total",
        "n_core",
        "n_non_noise",
        share("n_core").alias("core_share"),
        share("n_non_noise").alias("non_noise_share"),
        "n_clusters",
    )


# --- M2 / M3 --------------------------------------------------------------------------------

def entity_concentration(
    clusters: DataFrame,
    bridge: DataFrame,
    entity: str,
    min_pubs: int = 3,
    cols: PubCols = DEFAULT_COLS,
    only_core: bool = False,
    auth_order: AuthOrder = None,
    detail: bool = False,
    entity_alias: str | None = None,
) -> DataFrame:
    """mean over entities of max_k n(e,k)/n(e), entities with n(e) >= min_pubs.

    Counts are bridge rows; NULL entities are left out.
    """
    rows = bridge_topics(clusters, bridge, entity, cols, only_core, auth_order)
    return concentration_from_rows(rows, min_pubs, detail, entity_alias or entity)


def concentration_from_rows(rows: DataFrame, min_pubs: int, detail: bool = False,
                            entity_alias: str = "entity") -> DataFrame:
    """Concentration over pre-joined (entity, topic) bridge rows."""
    rows = rows.where(F.col("entity").isNotNull())
    n_ak = rows.groupBy("entity", "topic").agg(_count().alias("n_ak"))
    acc = (
        n_ak.groupBy("entity")
        .agg(F.sum("n_ak").alias("n_a"), F.max("n_ak").alias("top"))
        .where(F.col("n_a") >= min_pubs)
        .select(
            F.col("entity").alias(entity_alias),
            (F.col("top") / F.col("n_a")).alias("metric"),
            F.col("n_a"),
        )
    )
    return acc if detail else _mean_of(acc, "n_entities")


def auth_cluster_concentration(clusters, bridge, min_auth_pubs=3, cols=DEFAULT_COLS, only_core=False,
                               auth_order: AuthOrder = None, detail=False) -> DataFrame:
    return entity_concentration(clusters, bridge, cols.auth, min_auth_pubs, cols, only_core, auth_order, detail)


def aff_cluster_concentration(clusters, bridge, min_aff_pubs=3, cols=DEFAULT_COLS, only_core=False,
                              detail=False) -> DataFrame:
    return entity_concentration(clusters, bridge, cols.aff, min_aff_pubs, cols, only_core, None, detail)


# --- M4 / M5 --------------------------------------------------------------------------------

def _clusters_per_author(clusters, bridge, min_auth_pubs, cols, only_core) -> DataFrame:
    return _per_author_from_rows(bridge_topics(clusters, bridge, cols.auth, cols, only_core), min_auth_pubs)


def _per_author_from_rows(rows: DataFrame, min_auth_pubs: int) -> DataFrame:
    rows = rows.where(F.col("entity").isNotNull())
    return (
        rows.groupBy("entity")
        .agg(F.count_distinct("doc_key").alias("n_docs"), F.count_distinct("topic").alias("n_clusters"))
        .where(F.col("n_docs") >= min_auth_pubs)
    )


def k_cluster_auth_rate(clusters, bridge, K: int, min_auth_pubs: int = 3, cols=DEFAULT_COLS,
                        only_core=False) -> DataFrame:
    """Share of authors (>= min distinct documents) whose documents fall in <= K topics."""
    return car_from_rows(bridge_topics(clusters, bridge, cols.auth, cols, only_core), K, min_auth_pubs)


def car_from_rows(rows: DataFrame, K: int, min_auth_pubs: int) -> DataFrame:
    per = _per_author_from_rows(rows, min_auth_pubs)
    return per.agg(
        F.avg(F.when(F.col("n_clusters") <= K, 1.0).otherwise(0.0)).alias("metric"),
        _count().alias("n_entities"),
    )


def k_cluster_distribution(clusters, bridge, min_auth_pubs: int = 3, cols=DEFAULT_COLS,
                           only_core=False) -> DataFrame:
    """(n_clusters, n_authors, metric = share of authors) over qualifying authors."""
    per = _clusters_per_author(clusters, bridge, min_auth_pubs, cols, only_core)
    dist = per.groupBy("n_clusters").agg(_count().alias("n_authors"))
    dist = with_global_stats(dist, {"__tot": F.sum("n_authors")})
    return dist.select("n_clusters", "n_authors", (F.col("n_authors") / F.col("__tot")).alias("metric"))


# --- M6 -------------------------------------------------------------------------------------

#: topics per mask column; 62 keeps every mask a non-negative long
MASK_BITS = 62


def _shared_authors(author_topics: DataFrame, k: int) -> DataFrame:
    """(i, j, c): number of entities with both topic indexes, i <= j, from (entity, tix) rows (repeats allowed).

    An entity's topics are a few masks (``bit_or``), equal masks are counted once, and row i of
    the co-occurrence matrix is the sum of the masks that hold i: at most k rows per distinct mask.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    words = [f"m{w}" for w in range(-(-k // MASK_BITS))]
    bit = F.expr(f"shiftleft(1L, tix % {MASK_BITS})")
    masks = author_topics.groupBy("entity").agg(*[
        F.coalesce(F.bit_or(F.when(F.floor(F.col("tix") / MASK_BITS) == w, bit)), F.lit(0).cast("long")).alias(m) for w, m in enumerate(words)])
    counted = masks.groupBy(*words).agg(F.count(F.lit(1)).alias("n"))

    def held(i: int):
        return F.col(words[i // MASK_BITS]).bitwiseAND(F.lit(1 << (i % MASK_BITS)).cast("long")) != 0

    flags = F.array(*[held(i).cast("double") for i in range(k)])
    rows = counted.select("n", flags.alias("x")).select("n", "x", F.posexplode("x").alias("i", "on")).where("on > 0")
    total = rows.groupBy("i").agg(vector_to_array(Summarizer.sum(array_to_vector("x"), F.col("n").cast("double"))).alias("c"))
    return total.select("i", F.posexplode("c").alias("j", "c")).where("c > 0 AND i <= j").select("i", "j", F.col("c").cast("long").alias("c"))


def author_overlap(clusters, bridge, cols=DEFAULT_COLS, only_core=False, top_k: int = 50,
                   detail: bool = False) -> DataFrame:
    """Jaccard of author sets for every pair of the top_k topics (by documents with authors).

    Detail: (topic_i, topic_j, ai, aj, inter, metric) with topic_i < topic_j.
    Ties in the top_k cut are broken by topic id.
    """
    return overlap_from_rows(bridge_topics(clusters, bridge, cols.auth, cols, only_core), top_k, detail)


def overlap_from_rows(rows: DataFrame, top_k: int = 50, detail: bool = False) -> DataFrame:
    rows = rows.where(F.col("entity").isNotNull())
    rank_w = Window.orderBy(F.desc("docs"), F.asc("topic"))
    # at most top_k rows: the ordered limit keeps only top_k per task before one merge
    top = (
        rows.groupBy("topic")
        .agg(F.count_distinct("doc_key").alias("docs"))
        .orderBy(F.desc("docs"), F.asc("topic"))
        .limit(top_k)
        .withColumn("tix", (F.row_number().over(rank_w) - 1).cast("int"))
        .withColumn("n_top", F.count(F.lit(1)).over(Window.partitionBy()))
        .select("topic", "tix", "n_top")
    )
    # at most top_k rows are broadcast
    gram = _shared_authors(rows.join(F.broadcast(top.select("topic", "tix")), "topic").select("entity", "tix"), top_k)
    sizes = gram.where(F.col("i") == F.col("j")).select(F.col("i").alias("tix"), F.col("c").alias("a"))
    inter = gram.where(F.col("i") < F.col("j")).select("i", "j", F.col("c").alias("inter"))
    pairs = top.where(F.col("tix") < F.col("n_top") - 1).select(
        F.col("tix").alias("i"), F.explode(F.sequence(F.col("tix") + 1, F.col("n_top") - 1)).alias("j")
    )
    ti = top.select(F.col("tix").alias("i"), F.col("topic").alias("t_i"))
    tj = top.select(F.col("tix").alias("j"), F.col("topic").alias("t_j"))
    si = sizes.select(F.col("tix").alias("i"), F.col("a").alias("a_i"))
    sj = sizes.select(F.col("tix").alias("j"), F.col("a").alias("a_j"))
    p = (
        pairs.join(ti, "i").join(tj, "j").join(si, "i").join(sj, "j")
        .join(inter, ["i", "j"], "left")
        .withColumn("inter", F.coalesce(F.col("inter"), F.lit(0)).cast("bigint"))
    )
    lo = F.col("t_i") < F.col("t_j")
    out = p.select(
        F.when(lo, F.col("t_i")).otherwise(F.col("t_j")).alias("topic_i"),
        F.when(lo, F.col("t_j")).otherwise(F.col("t_i")).alias("topic_j"),
        F.when(lo, F.col("a_i")).otherwise(F.col("a_j")).alias("ai"),
        F.when(lo, F.col("a_j")).otherwise(F.col("a_i")).alias("aj"),
        F.col("inter"),
        safe_div(F.col("inter"), F.col("a_i") + F.col("a_j") - F.col("inter")).alias("metric"),
    )
    return out if detail else _mean_of(out, "n_pairs")


# --- M7 -------------------------------------------------------------------------------------

def cluster_purity(clusters, docs, field: str = "source", min_cluster_docs: int | None = 3,
                   cols=DEFAULT_COLS, only_core=False, drop_null_field=True, detail=False) -> DataFrame:
    """How uniform the topics are in ``field`` (docs.source or docs.doctype): the mean share of a topic's commonest value.

    Topics are kept when they have more than ``min_cluster_docs`` documents
    (``None``: no size filter - the per-cluster view of the original).
    Detail: (topic, metric, n_c, top_value, top_count); ties -> smaller value.
    """
    if field not in (cols.source, cols.doctype, "source", "doctype"):
        raise ValueError("field must be 'source' or 'doctype'")
    dc = cluster_rows(clusters, cols, only_core)
    if min_cluster_docs is not None:
        big = dc.groupBy(cols.topic).agg(F.count(cols.doc).alias("n")).where(F.col("n") > min_cluster_docs)
        dc = dc.join(big.select(cols.topic), cols.topic, "left_semi")
    cl = doc_topics(dc, docs, getattr(cols, field, field), cols, False, drop_null_field)
    return purity_from_rows(cl, detail)


def purity_from_rows(cl: DataFrame, detail: bool = False) -> DataFrame:
    """Per topic the most frequent value's share of the rows; ``cl`` holds (topic, val) rows of the topics that count."""
    n_cs = cl.groupBy("topic", "val").agg(_count().alias("n_cs"))
    per = n_cs.groupBy("topic").agg(
        F.sum("n_cs").alias("n_c"),
        F.max("n_cs").alias("top_count"),
        F.min_by("val", F.struct((-F.col("n_cs")).alias("a"), F.col("val").alias("b"))).alias("top_value"),
    )
    out = per.select(
        "topic", (F.col("top_count") / F.col("n_c")).alias("metric"), "n_c", "top_value", "top_count"
    )
    return out if detail else _mean_of(out, "n_topics")


# --- M8 - M10 -------------------------------------------------------------------------------

def year_iqr(clusters, docs, cols=DEFAULT_COLS, only_core=False, drop_null_year=True, detail=False) -> DataFrame:
    """mean over topics of q75 - q25 of publication year (interpolated quantiles)."""
    return iqr_from_rows(doc_topics(clusters, docs, cols.year, cols, only_core, drop_null_year, "double"), detail)


def iqr_from_rows(cy: DataFrame, detail: bool = False) -> DataFrame:
    cy = cy.select("topic", F.col("val").cast("double").alias("val"))
    per = cy.groupBy("topic").agg(
        _count().alias("n_c"),
        F.percentile("val", F.lit(0.25)).alias("q25"),
        F.percentile("val", F.lit(0.75)).alias("q75"),
    )
    out = per.select("topic", (F.col("q75") - F.col("q25")).alias("metric"), "q25", "q75", "n_c")
    return out if detail else _mean_of(out, "n_topics")


def _year_counts(clusters, docs, cols, only_core, drop_null_year) -> DataFrame:
    return year_counts_from_rows(doc_topics(clusters, docs, cols.year, cols, only_core, drop_null_year))


def year_counts_from_rows(cy: DataFrame) -> DataFrame:
    return cy.groupBy("topic", F.col("val").cast("bigint").alias("y")).agg(_count().alias("n_cy"))


def entropy_norm(clusters, docs, cols=DEFAULT_COLS, only_core=False, drop_null_year=True, detail=False) -> DataFrame:
    """mean over topics of H(years)/log(K_c), 0 when K_c <= 1 (the log base cancels).

    H = ln(n_c) - sum(n ln n)/n_c, one aggregation over the (topic, year) counts.
    """
    return entropy_from_counts(_year_counts(clusters, docs, cols, only_core, drop_null_year), detail)


def entropy_from_counts(n_cy: DataFrame, detail: bool = False) -> DataFrame:
    per = n_cy.groupBy("topic").agg(
        F.sum("n_cy").alias("n_c"),
        _count().alias("K_c"),
        F.sum(F.col("n_cy") * F.log(F.col("n_cy").cast("double"))).alias("snl"),
    )
    h = F.log(F.col("n_c").cast("double")) - F.col("snl") / F.col("n_c")
    out = per.select(
        "topic",
        F.when(F.col("K_c") <= 1, F.lit(0.0)).otherwise(h / F.log(F.col("K_c").cast("double"))).alias("metric"),
        "K_c",
        "n_c",
    )
    return out if detail else _mean_of(out, "n_topics")


def year_peak_share(clusters, docs, cols=DEFAULT_COLS, only_core=False, drop_null_year=True,
                    detail=False) -> DataFrame:
    """mean over topics of the largest yearly share; detail adds the peak year (ties -> earlier)."""
    return peak_from_counts(_year_counts(clusters, docs, cols, only_core, drop_null_year), detail)


def peak_from_counts(n_cy: DataFrame, detail: bool = False) -> DataFrame:
    per = n_cy.groupBy("topic").agg(
        F.sum("n_cy").alias("n_c"),
        F.max("n_cy").alias("peak_count"),
        F.min_by("y", F.struct((-F.col("n_cy")).alias("a"), F.col("y").alias("b"))).alias("peak_year"),
    )
    out = per.select(
        "topic", (F.col("peak_count") / F.col("n_c")).alias("metric"), "n_c", "peak_year", "peak_count"
    )
    return out if detail else _mean_of(out, "n_topics")


# --- M11 - M13 ------------------------------------------------------------------------------

def count_authors_with_pubs(bridge, min_pubs: int, auth_seqn: AuthOrder = None, cols=DEFAULT_COLS) -> DataFrame:
    """Number of authors with more than ``min_pubs`` bridge rows (NULL is one author)."""
    b = bridge
    if auth_seqn == "first":
        b = b.where(F.col(cols.seqn) == 0)
    elif auth_seqn == "last":
        last = bridge.groupBy(cols.bridge_doc).agg(F.max(cols.seqn).alias("__max"))
        b = b.join(last, cols.bridge_doc).where(F.col(cols.seqn) == F.col("__max"))
    elif auth_seqn is not None:
        raise ValueError("auth_seqn must be None, 'first' or 'last'")
    g = b.groupBy(cols.auth).agg(F.count(cols.bridge_doc).alias("n")).where(F.col("n") > min_pubs)
    return g.agg(_count().alias("n_authors"))


def count_affiliations_with_pubs(bridge, min_pubs: int, cols=DEFAULT_COLS) -> DataFrame:
    g = bridge.groupBy(cols.aff).agg(F.count(cols.bridge_doc).alias("n")).where(F.col("n") > min_pubs)
    return g.agg(_count().alias("n_affiliations"))


def count_clusters_with_pubs(clusters, min_cluster_docs: int, cols=DEFAULT_COLS) -> DataFrame:
    """Per core flag, the number of topics with more than ``min_cluster_docs`` distinct documents."""
    per = (
        clusters.groupBy(cols.is_core, cols.topic)
        .agg(F.count_distinct(cols.doc).alias("id_count"))
        .where(F.col("id_count") > min_cluster_docs)
    )
    return per.groupBy(cols.is_core).agg(_count().alias("topic_count"))


# --- M14 ------------------------------------------------------------------------------------

def interpretable_metrics(clusters, bridge, docs, cols=DEFAULT_COLS) -> DataFrame:
    """The fixed metric suite as a long table (metric, value, report).

    ``report`` is the text of the original report: 4 decimals (AJ: 8), "-1" when
    a metric has no qualifying rows, "n_eval/n_unique" for the ratio rows.

    Fused plan: one (author, topic) aggregation with first/last-author counts
    and distinct documents feeds AACC, AACC_first, AACC_last, CAR_1 and CAR_2;
    one per-author pass over the whole bridge feeds every ratio; one
    (topic, year, count) table feeds YearIQR (frequency-weighted percentile),
    AH and YPS. Each branch ends in a single row, so the union is seven small
    results instead of one pass per metric. Assumes one topic per document id,
    as a cluster table has.
    """
    cl = drop_noise(clusters, cols)
    kt = key_type((clusters, cols.doc), (bridge, cols.bridge_doc))
    b = bridge.select(
        F.col(cols.bridge_doc).alias("doc_id"), F.col(cols.bridge_doc).cast(kt).alias("doc_key"),
        F.col(cols.auth).alias("auth"), F.col(cols.aff).alias("aff"), F.col(cols.seqn).alias("seqn"),
    )
    last = b.groupBy("doc_key").agg(F.max("seqn").alias("__mx"))
    bf = b.join(last, "doc_key", "left").select(
        "doc_id", "doc_key", "auth", "aff", (F.col("seqn") == 0).alias("f"), (F.col("seqn") == F.col("__mx")).alias("l"),
    )
    dcl = cl.select(F.col(cols.doc).cast(kt).alias("doc_key"), F.col(cols.topic).alias("topic"))
    # read five times below: one narrow table instead of as many joins
    bf = cut_lineage(bf.join(dcl, "doc_key", "left").select("doc_id", "doc_key", "auth", "aff", "f", "l", "topic"), "suite")
    bc = bf.where(F.col("topic").isNotNull())

    def long(df: DataFrame, items: list[tuple[str, str, int | None]]) -> DataFrame:
        """One-row frame -> rows (metric, value, report); items: (name, column, digits or None=ratio)."""
        structs = []
        for name, col, digits in items:
            v = F.col(col).cast("double")
            if digits is None:  # ratio rows: col holds "a/b" parts in col+"_a", col+"_b"
                a, bb = F.col(col + "_a"), F.col(col + "_b")
                v = safe_div(a, bb)
                rep = F.concat_ws("/", a.cast("string"), bb.cast("string"))
            else:
                rep = F.when(v.isNull(), F.lit("-1")).otherwise(F.format_string(f"%.{digits}f", v))
            structs.append(F.struct(F.lit(name).alias("metric"), v.alias("value"), rep.alias("report")))
        return df.select(F.explode(F.array(*structs)).alias("r")).select("r.metric", "r.value", "r.report")

    # ratios: authors / affiliations with more than n bridge rows (whole bridge, NULL is one entity)
    ca = bf.groupBy("auth").agg(F.count("doc_id").alias("n"), F.count(F.when(F.col("f"), F.col("doc_id"))).alias("nf"),
                                F.count(F.when(F.col("l"), F.col("doc_id"))).alias("nl"))
    cnt = lambda c: F.count(F.when(c, 1))
    ra = ca.agg(cnt(F.col("n") > 0).alias("all"), cnt(F.col("n") > 2).alias("n2"), cnt(F.col("nf") > 2).alias("f2"),
                cnt(F.col("nl") > 2).alias("l2"), cnt(F.col("n") > 3).alias("n3"))
    rf = bf.groupBy("aff").agg(F.count("doc_id").alias("n")).agg(
        cnt(F.col("n") > 0).alias("all"), cnt(F.col("n") > 2).alias("n2"))
    ratios = ra.select(
        *[x for nm, c in (("auth_ratio", "n2"), ("auth_first_ratio", "f2"), ("auth_last_ratio", "l2"),
                          ("CAR_1_ratio", "n2"), ("CAR_2_ratio", "n3"))
          for x in (F.col(c).alias(nm + "_a"), F.col("all").alias(nm + "_b"))]
    ).withColumn("__one", F.lit(1)).join(
        rf.select(F.col("n2").alias("aff_ratio_a"), F.col("all").alias("aff_ratio_b")).withColumn("__one", F.lit(1)),
        "__one",
    )
    # author concentration (all / first / last) and K-cluster rates from one (author, topic) table
    at = bc.where(F.col("auth").isNotNull()).groupBy("auth", "topic").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("f"), 1)).alias("nf"),
        F.count(F.when(F.col("l"), 1)).alias("nl"), F.count_distinct("doc_key").alias("nd"),
    )
    pa = at.groupBy("auth").agg(
        F.sum("n").alias("na"), F.max("n").alias("ta"), F.sum("nf").alias("naf"), F.max("nf").alias("taf"),
        F.sum("nl").alias("nal"), F.max("nl").alias("tal"), F.sum("nd").alias("nd"), F.count(F.lit(1)).alias("nt"),
    )
    share = lambda t, n: F.avg(F.when(F.col(n) >= 2, F.col(t) / F.col(n)))
    rate = lambda k, m: F.avg(F.when(F.col("nd") >= m, F.when(F.col("nt") <= k, 1.0).otherwise(0.0)))
    auth = pa.agg(share("ta", "na").alias("AACC"), share("taf", "naf").alias("AACC_first"),
                  share("tal", "nal").alias("AACC_last"), rate(1, 2).alias("CAR_1"), rate(2, 3).alias("CAR_2"))
    aff = concentration_from_rows(bc.select("doc_key", F.col("aff").alias("entity"), "topic"), 2)
    aj = overlap_from_rows(bc.select("doc_key", F.col("auth").alias("entity"), "topic"), 50)
    # purity over topics with more than 3 documents
    kd = key_type((clusters, cols.doc), (docs, cols.eid))
    dd = docs.select(F.col(cols.eid).cast(kd).alias("doc_key"), F.col(cols.source).alias("source"),
                     F.col(cols.doctype).alias("doctype"), F.col(cols.year).alias("year"))
    dc = cl.select(F.col(cols.doc).cast(kd).alias("doc_key"), F.col(cols.topic).alias("topic")).join(dd, "doc_key")
    big = cl.groupBy(F.col(cols.topic).alias("topic")).agg(F.count(cols.doc).alias("n")).where(F.col("n") > 3)

    def purity(field: str) -> DataFrame:
        d = dc.join(big.select("topic"), "topic", "left_semi").where(F.col(field).isNotNull())
        return purity_from_rows(d.select("topic", F.col(field).alias("val")))

    # year spread: one (topic, year, count) table
    yc = dc.where(F.col("year").isNotNull()).groupBy("topic", F.col("year").cast("bigint").alias("y")).agg(
        F.count(F.lit(1)).alias("c"))
    py = yc.groupBy("topic").agg(
        F.sum("c").alias("n_c"), F.count(F.lit(1)).alias("K_c"), F.max("c").alias("pk"),
        F.sum(F.col("c") * F.log(F.col("c").cast("double"))).alias("snl"),
        F.percentile(F.col("y").cast("double"), F.lit(0.25), F.col("c")).alias("q25"),
        F.percentile(F.col("y").cast("double"), F.lit(0.75), F.col("c")).alias("q75"),
    )
    h = F.log(F.col("n_c").cast("double")) - F.col("snl") / F.col("n_c")
    years = py.agg(
        F.avg(F.col("q75") - F.col("q25")).alias("YearIQR"),
        F.avg(F.when(F.col("K_c") <= 1, F.lit(0.0)).otherwise(h / F.log(F.col("K_c").cast("double")))).alias("AH"),
        F.avg(F.col("pk") / F.col("n_c")).alias("YPS"),
    )
    parts = [
        long(auth, [("AACC", "AACC", 4), ("AACC_first", "AACC_first", 4), ("AACC_last", "AACC_last", 4),
                    ("CAR_1", "CAR_1", 4), ("CAR_2", "CAR_2", 4)]),
        long(ratios, [(n, n, None) for n in ("auth_ratio", "auth_first_ratio", "auth_last_ratio", "aff_ratio",
                                              "CAR_1_ratio", "CAR_2_ratio")]),
        long(aff, [("AAffCC", "metric", 4)]),
        long(aj, [("AJ", "metric", 8)]),
        long(purity("source"), [("CP_source", "metric", 4)]),
        long(purity("doctype"), [("CP_doctype", "metric", 4)]),
        long(years, [("YearIQR", "YearIQR", 4), ("AH", "AH", 4), ("YPS", "YPS", 4)]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
