"""Registered queries: one per operator of the blueprint, each (spark, sf_dir) -> DataFrame.

Every query reads the driver tables of ``sf_dir`` in full (through the
publication views) and rounds its floating columns for comparison.
``ORACLE`` holds the matching DuckDB SQL where the operator is relational.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pubstrata.deploy import ship_package
from pubstrata.functions.stats import best_first, finalize
from pubstrata.operators import quality as Q
from pubstrata.operators.membership import best_memberships
from pubstrata.plans import oracle as O
from pubstrata.session import cut_lineage
from pubstrata.sources import fixtures as FX

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark, sf_dir, _fn=fn):
            ship_package(spark)
            return finalize(_fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _pubs(spark, sf_dir):
    return FX.publications(spark, sf_dir)


def _cl(p):
    return Q.drop_noise(p.clusters)


# ---- clustering quality (M1-M14) ----------------------------------------------------------

@register("simple_metrics", O.simple_metrics_sql())
def _simple(spark, d):
    return Q.simple_metrics(_pubs(spark, d).clusters)


@register("aacc", O.concentration_sql("auth_id", 2))
def _aacc(spark, d):
    p = _pubs(spark, d)
    return Q.auth_cluster_concentration(_cl(p), p.bridge, 2)


@register("aacc_first", O.concentration_sql("auth_id", 2, "first"))
def _aacc_first(spark, d):
    p = _pubs(spark, d)
    return Q.auth_cluster_concentration(_cl(p), p.bridge, 2, auth_order="first")


@register("aacc_last", O.concentration_sql("auth_id", 2, "last"))
def _aacc_last(spark, d):
    p = _pubs(spark, d)
    return Q.auth_cluster_concentration(_cl(p), p.bridge, 2, auth_order="last")


@register("aacc_per_author", O.concentration_sql("auth_id", 2, detail=True))
def _aacc_per_author(spark, d):
    p = _pubs(spark, d)
    return Q.auth_cluster_concentration(_cl(p), p.bridge, 2, detail=True).orderBy("auth_id")


@register("aaffcc", O.concentration_sql("aff_id", 2))
def _aaffcc(spark, d):
    p = _pubs(spark, d)
    return Q.aff_cluster_concentration(_cl(p), p.bridge, 2)


@register("aaffcc_per_aff", O.concentration_sql("aff_id", 2, detail=True))
def _aaffcc_per_aff(spark, d):
    p = _pubs(spark, d)
    return Q.aff_cluster_concentration(_cl(p), p.bridge, 2, detail=True).orderBy("aff_id")


@register("car_1", O.car_sql(1, 2))
def _car_1(spark, d):
    p = _pubs(spark, d)
    return Q.k_cluster_auth_rate(_cl(p), p.bridge, K=1, min_auth_pubs=2)


@register("car_2", O.car_sql(2, 3))
def _car_2(spark, d):
    p = _pubs(spark, d)
    return Q.k_cluster_auth_rate(_cl(p), p.bridge, K=2, min_auth_pubs=3)


@register("car_distribution", O.car_distribution_sql(3))
def _car_dist(spark, d):
    p = _pubs(spark, d)
    return Q.k_cluster_distribution(_cl(p), p.bridge, 3).orderBy("n_clusters")


@register("author_overlap", O.overlap_sql(50))
def _aj(spark, d):
    p = _pubs(spark, d)
    return Q.author_overlap(_cl(p), p.bridge, top_k=50)


@register("author_overlap_pairs", O.overlap_sql(50, detail=True))
def _aj_pairs(spark, d):
    p = _pubs(spark, d)
    return best_first(Q.author_overlap(_cl(p), p.bridge, top_k=50, detail=True), "metric", "topic_i", "topic_j")


@register("cp_source", O.purity_sql("source", 3))
def _cp_source(spark, d):
    p = _pubs(spark, d)
    return Q.cluster_purity(_cl(p), p.docs, "source", 3)


@register("cp_doctype", O.purity_sql("doctype", 3))
def _cp_doctype(spark, d):
    p = _pubs(spark, d)
    return Q.cluster_purity(_cl(p), p.docs, "doctype", 3)


@register("purity_per_cluster", O.purity_sql("source", None, detail=True))
def _purity_detail(spark, d):
    p = _pubs(spark, d)
    return Q.cluster_purity(_cl(p), p.docs, "source", None, detail=True).orderBy("topic")


@register("year_iqr", O.year_iqr_sql())
def _yiqr(spark, d):
    p = _pubs(spark, d)
    return Q.year_iqr(_cl(p), p.docs)


@register("year_iqr_per_cluster", O.year_iqr_sql(detail=True))
def _yiqr_detail(spark, d):
    p = _pubs(spark, d)
    return Q.year_iqr(_cl(p), p.docs, detail=True).orderBy("topic")


@register("entropy_norm", O.entropy_sql())
def _ent(spark, d):
    p = _pubs(spark, d)
    return Q.entropy_norm(_cl(p), p.docs)


@register("entropy_per_cluster", O.entropy_sql(detail=True))
def _ent_detail(spark, d):
    p = _pubs(spark, d)
    return Q.entropy_norm(_cl(p), p.docs, detail=True).orderBy("topic")


@register("year_peak_share", O.peak_sql())
def _yps(spark, d):
    p = _pubs(spark, d)
    return Q.year_peak_share(_cl(p), p.docs)


@register("peak_per_cluster", O.peak_sql(detail=True))
def _yps_detail(spark, d):
    p = _pubs(spark, d)
    return Q.year_peak_share(_cl(p), p.docs, detail=True).orderBy("topic")


@register("count_authors", O.count_authors_sql(2))
def _count_authors(spark, d):
    return Q.count_authors_with_pubs(_pubs(spark, d).bridge, 2)


@register("count_authors_first", O.count_authors_sql(2, "first"))
def _count_authors_first(spark, d):
    return Q.count_authors_with_pubs(_pubs(spark, d).bridge, 2, "first")


@register("count_authors_last", O.count_authors_sql(2, "last"))
def _count_authors_last(spark, d):
    return Q.count_authors_with_pubs(_pubs(spark, d).bridge, 2, "last")


@register("count_affiliations", O.count_affiliations_sql(2))
def _count_affs(spark, d):
    return Q.count_affiliations_with_pubs(_pubs(spark, d).bridge, 2)


@register("count_clusters", O.count_clusters_sql(3))
def _count_clusters(spark, d):
    return Q.count_clusters_with_pubs(_pubs(spark, d).clusters, 3)


@register("interpretable_metrics", O.interpretable_sql())
def _interpretable(spark, d):
    p = _pubs(spark, d)
    return Q.interpretable_metrics(p.clusters, p.bridge, p.docs)


# ---- topic metrics (T1-T9) ----------------------------------------------------------------

from pubstrata.operators import topics as T  # noqa: E402


@register("impact_score", O.impact_sql())
def _impact(spark, d):
    p = _pubs(spark, d)
    return T.impact_score(_cl(p), p.docs)


@register("top_k_pubs", O.topk_sql(10))
def _topk(spark, d):
    p = _pubs(spark, d)
    return T.top_k_pubs(_cl(p), p.docs, 10)


@register("cs_mean", O.cs_mean_sql())
def _cs_mean(spark, d):
    p = _pubs(spark, d)
    return T.cs_mean(_cl(p), p.docs)


@register("ztrend_cs_sum", O.ztrend_cs_sql())
def _ztrend_cs(spark, d):
    p = _pubs(spark, d)
    return T.ztrend_cs_sum(_cl(p), p.docs)


@register("ztrend_auth_diversity", O.ztrend_auth_sql())
def _ztrend_auth(spark, d):
    p = _pubs(spark, d)
    return T.ztrend_diversity(_cl(p), p.docs, T.auth_entity_rows(p.bridge))


@register("ztrend_country_diversity", O.ztrend_country_sql())
def _ztrend_country(spark, d):
    p = _pubs(spark, d)
    return T.ztrend_diversity(_cl(p), p.docs, T.country_entity_rows(p.bridge, p.affiliations))


def _impact_index(spark, d):
    p = _pubs(spark, d)
    return T.impact_suite(p.clusters, p.docs)


def _impulse_index(spark, d):
    p = _pubs(spark, d)
    return T.impulse_suite(p.clusters, p.docs, p.bridge, p.affiliations)


register("impact_index", O.impact_index_sql())(lambda s, d: best_first(_impact_index(s, d), "metric", "topic"))
register("impact_index_mean", O.impact_index_sql(mean=True))(lambda s, d: T.index_mean(_impact_index(s, d)))
register("impulse_index", O.impulse_index_sql())(lambda s, d: best_first(_impulse_index(s, d), "metric", "topic"))
register("impulse_index_mean", O.impulse_index_sql(mean=True))(lambda s, d: T.index_mean(_impulse_index(s, d)))


@register("topic_metrics", O.topic_metrics_sql())
def _topic_metrics(spark, d):
    p = _pubs(spark, d)
    return T.topic_metrics(p.clusters, p.docs, p.bridge, p.affiliations)


# ---- text, embeddings, neighbours, periphery (S1-S3, E1-E6, C1, C7a-b, C8-C9) -------------

from pubstrata.operators import embed as E  # noqa: E402
from pubstrata.operators import neighbors as N  # noqa: E402
from pubstrata.operators import periphery as P  # noqa: E402
from pubstrata.sources import tables as S  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

VEC_DIM = 64          # driver vectors (1024 in the original model)
KNN_K = 15            # n_neighbors for the 500-vector fixture
MIN_SAMPLES = 5
MIN_CLUSTER_SIZE = 10


@register("scan_texts", O.scan_texts_sql())
def _scan_texts(spark, d):
    return S.scan_texts(FX.text_docs_view(spark, d))


@register("embed_text", O.embed_text_sql())
def _embed_text(spark, d):
    return E.embed_text(FX.text_docs_view(spark, d))


@register("load_embeddings", O.load_embeddings_sql())
def _load_embeddings(spark, d):
    emb = S.load_embeddings(spark, f"{d.rstrip('/')}/embeddings.parquet", id_col="vec_id", dim=VEC_DIM)
    return E.to_long(emb, "eid")


@register("quantize_half", O.quantize_half_sql())
def _quantize(spark, d):
    v = FX.vectors_view(spark, d).withColumnRenamed("id", "eid")
    return E.to_long(E.quantize_half(v), "eid")


@register("mean_pool", O.mean_pool_sql())
def _mean_pool(spark, d):
    return E.to_long(E.mean_pool(FX.vectors_view(spark, d), "label"), "label")


@register("l2_normalize", O.l2_normalize_sql())
def _l2(spark, d):
    return E.to_long(E.normalize(E.mean_pool(FX.vectors_view(spark, d), "label")), "label")


@register("embed_documents")
def _embed_docs(spark, d):
    return E.embed_documents(E.embed_text(FX.text_docs_view(spark, d)), dim=VEC_DIM)


@register("knn_cosine", O.knn_sql("cosine", KNN_K))
def _knn_cos(spark, d):
    return N.knn(FX.vectors_view(spark, d), KNN_K, "cosine")


@register("knn_euclid", O.knn_sql("euclidean", KNN_K))
def _knn_euc(spark, d):
    return N.knn(FX.vectors_view(spark, d), KNN_K, "euclidean")


@register("core_distance", O.core_distance_sql(MIN_SAMPLES))
def _core(spark, d):
    return N.core_distances(N.knn(FX.vectors_view(spark, d), MIN_SAMPLES, "euclidean"), MIN_SAMPLES)


@register("mutual_reachability", O.mutual_reachability_sql(KNN_K, MIN_SAMPLES))
def _mr(spark, d):
    kn = cut_lineage(N.knn(FX.vectors_view(spark, d), KNN_K, "euclidean"), "knn")  # read three times
    return N.mutual_reachability(kn, N.core_distances(kn, MIN_SAMPLES))


def _membership(spark, d):
    return P.membership_distance(FX.vectors_view(spark, d), FX.vector_clusters_view(spark, d))


register("membership", O.membership_sql())(_membership)


def _best_two(spark, d):
    return cut_lineage(best_memberships(FX.vectors_view(spark, d), FX.vector_clusters_view(spark, d)), "best")


def _calibrate(spark, d, best=None, frac=1.0):
    return P.calibrate_periphery(_best_two(spark, d) if best is None else best, FX.vector_clusters_view(spark, d),
                                 core_sample_frac=frac, core_quantile=0.05)


register("calibrate_periphery", O.calibrate_sql(0.05))(_calibrate)


@register("attach_periphery", O.attach_sql(0.05))
def _attach(spark, d):
    best = _best_two(spark, d)  # calibration and attachment share it
    return P.attach_periphery(FX.vector_clusters_view(spark, d), best, _calibrate(spark, d, best))


# ---- annotation (A1-A6) -------------------------------------------------------------------

from pubstrata.operators import annotate as A  # noqa: E402


def _best(spark, d):
    p = _pubs(spark, d)
    return A.best_pubs(_cl(p), p.docs, 10)


register("best_pubs", O.best_pubs_sql(10))(_best)
register("annotation_prompts")(lambda s, d: A.annotation_prompts(_best(s, d)))
register("annotation_requests")(lambda s, d: A.request_lines(A.annotation_requests(A.annotation_prompts(_best(s, d)))))


def _parsed(spark, d):
    lines = FX.answer_lines(spark, d)
    return lines, A.parse_responses(lines)


register("parse_responses", O.parse_responses_sql())(
    lambda s, d: _parsed(s, d)[1].withColumn("topic_id", F.col("topic_id").cast("string")))
register("parse_stats", O.parse_stats_sql())(lambda s, d: A.parse_stats(*_parsed(s, d)))
register("annotations", O.annotations_sql())(lambda s, d: A.annotations(_parsed(s, d)[1]))


# ---- density clustering (C7a-g) -----------------------------------------------------------

from pubstrata.operators import density as DN  # noqa: E402


def _hdb(spark, d):
    return DN.hdbscan(FX.vectors_view(spark, d), min_cluster_size=MIN_CLUSTER_SIZE, min_samples=MIN_SAMPLES, details=True)


register("mst")(lambda s, d: _hdb(s, d)[1])
register("linkage_levels")(lambda s, d: _hdb(s, d)[2].merges)
register("condensed_tree")(lambda s, d: _hdb(s, d)[2].lineages)
register("select_clusters")(lambda s, d: _hdb(s, d)[3])


@register("hdbscan")
def _hdbscan(spark, d):
    return DN.hdbscan(FX.vectors_view(spark, d), min_cluster_size=MIN_CLUSTER_SIZE, min_samples=MIN_SAMPLES)


# ---- dimension reduction (C2-C6) ----------------------------------------------------------

from pubstrata.operators import reduce as RD  # noqa: E402

UMAP_K = 15


def _weights(spark, d):
    kn = cut_lineage(N.knn(FX.vectors_view(spark, d), UMAP_K - 1, "cosine"), "knn")  # read three times
    return RD.fuzzy_weights(kn, UMAP_K)


def _graph(spark, d):
    return cut_lineage(RD.fuzzy_union(cut_lineage(_weights(spark, d), "weights")), "graph")


register("reduce_pca")(lambda s, d: RD.reduce_pca(FX.vectors_view(s, d), 16))
register("fuzzy_weights")(_weights)
register("fuzzy_union")(_graph)
register("spectral_embed")(
    lambda s, d: RD.spectral_init(_graph(s, d), FX.vectors_view(s, d).select("id"), 16)
)


@register("layout")
def _layout(spark, d):
    g = _graph(spark, d)
    init = RD.spectral_init(g, FX.vectors_view(spark, d).select("id"), 16)
    return RD.layout(g, init)


register("reduce_umap")(
    lambda s, d: RD.reduce_umap(FX.vectors_view(s, d), n_neighbors=UMAP_K, n_components=16)
)


# ---- sources / sinks, runs and stages, streaming (S2, S6-S10, E6, R1-R6, X1) ---------------

import hashlib  # noqa: E402
import uuid  # noqa: E402

from pubstrata.plans import stages as ST  # noqa: E402
from pubstrata.plans.config import ConfigItem  # noqa: E402
from pubstrata.session import shared_dir  # noqa: E402
from pubstrata.streaming.embed_stream import run_embed_stream  # noqa: E402


def _scratch(spark, d, *parts):
    tag = hashlib.sha1(d.encode()).hexdigest()[:10]
    return shared_dir(spark, "registry", tag, *parts)


def _fresh(spark, d, name):
    return _scratch(spark, d, f"{name}-{uuid.uuid4().hex[:8]}")


@register("scan_csv", O.scan_texts_sql())
def _scan_csv(spark, d):
    path = _fresh(spark, d, "texts-csv")
    S.scan_texts(FX.text_docs_view(spark, d)).write.option("header", "true").option("escape", '"').csv(path)
    return S.scan_csv(spark, path)


@register("embed_sink")
def _embed_sink(spark, d):
    path = _fresh(spark, d, "embeddings")
    E.write_embeddings(E.quantize_half(E.embed_documents(E.embed_text(FX.text_docs_view(spark, d)), dim=VEC_DIM)),
                       path)
    return S.load_embeddings(spark, path, dim=VEC_DIM)


@register("embed_job")
def _embed_job(spark, d):
    path = _fresh(spark, d, "embed-job")
    E.embed_job(FX.text_docs_view(spark, d), path, dim=VEC_DIM)
    return spark.read.parquet(path)


@register("stream_embed")
def _stream_embed(spark, d):
    base = _fresh(spark, d, "stream")
    texts = S.scan_texts(FX.text_docs_view(spark, d))
    # documents arrive in two drops; the stream embeds each file once
    texts.where(F.col("eid") % 2 == 0).write.parquet(f"{base}/in/drop=0")
    texts.where(F.col("eid") % 2 == 1).write.parquet(f"{base}/in/drop=1")
    run_embed_stream(spark, f"{base}/in/*", f"{base}/out", f"{base}/ckpt", dim=VEC_DIM)
    return spark.read.parquet(f"{base}/out")


def _save_impact(spark, d):
    path = _fresh(spark, d, "tables")
    S.save_table(_impact_index(spark, d), "topic_metrics.impact_index", path=path)
    return spark.table("topic_metrics.impact_index")


register("save_table", O.impact_index_sql())(_save_impact)

RUN_CONFIG = {
    "id": "run-1",
    "config": {
        "umap": {"n_neighbors": UMAP_K, "min_dist": 0.1},
        "hdbscan": {"min_cluster_size": MIN_CLUSTER_SIZE, "min_samples": MIN_SAMPLES, "cluster_selection_method": "eom"},
        "periphery": {"core_sample_frac": 0.2, "core_sample_min": 0, "core_sample_max": 999999999,
                      "core_quantile": 0.05, "mv_batch_size": 2048, "batch_size": 50000},
    },
}


def _run(spark, d):
    p = _pubs(spark, d)
    return ST.cluster_run(spark, FX.vectors_view(spark, d), ConfigItem.from_dict(RUN_CONFIG), _scratch(spark, d, "runs"),
                          docs=p.docs, bridge=p.bridge, resume=True)


register("cluster_run")(lambda s, d: _run(s, d).clusters)
register("metrics_report")(lambda s, d: _run(s, d).metrics)
register("stage_tables")(lambda s, d: _run(s, d).stage_table(s))


@register("stage_reuse")
def _stage_reuse(spark, d):
    _run(spark, d)
    return _run(spark, d).stage_table(spark)  # second run: every stage read back


@register("list_runs")
def _list_runs(spark, d):
    _run(spark, d)
    return ST.list_runs(spark, _scratch(spark, d, "runs"))


@register("interpret_run")
def _interpret_run(spark, d):
    r = _run(spark, d)
    p = _pubs(spark, d)
    answers = _fresh(spark, d, "answers")
    FX.answer_lines(spark, d).select("value").write.text(answers)
    return ST.interpret_run(spark, _scratch(spark, d, "runs"), r.run_id, r.clusters, p.docs, p.bridge, p.affiliations, answers=answers)


@register("membership_full")
def _membership_full(spark, d):
    labels, mst, h, sel = _hdb(spark, d)
    dist = P.membership_distance(FX.vectors_view(spark, d), labels, table=False)
    return DN.membership_vectors(h, sel, dist)
