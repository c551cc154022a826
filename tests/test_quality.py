"""Clustering-quality metrics on the hand-worked trap fixture (traps Q1-Q5, Q15-Q17, Q19)."""

import math

import pytest

from pubstrata.operators import quality as Q


def one(df, col="metric"):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0][col]


def test_simple_metrics_keep_noise(trap):
    r = Q.simple_metrics(trap.clusters).collect()[0]
    assert (r.n_total, r.n_core, r.n_non_noise, r.n_clusters) == (6, 4, 5, 2)
    assert r.core_share == pytest.approx(4 / 6)
    assert r.non_noise_share == pytest.approx(5 / 6)


def test_simple_metrics_empty(spark):
    empty = spark.createDataFrame([], "id long, topic int, is_core boolean")
    r = Q.simple_metrics(empty).collect()[0]
    assert r.n_total == 0 and r.core_share == 0.0 and r.non_noise_share == 0.0


def test_author_concentration_counts_rows(trap):
    assert one(Q.auth_cluster_concentration(trap.cl, trap.bridge, 2)) == pytest.approx(0.875)
    per = {r.auth_id: (r.metric, r.n_a) for r in Q.auth_cluster_concentration(trap.cl, trap.bridge, 2, detail=True).collect()}
    assert per == {"a": (0.75, 4), "c": (1.0, 2)}


def test_author_position(trap):
    assert one(Q.auth_cluster_concentration(trap.cl, trap.bridge, 2, auth_order="first")) == pytest.approx(0.75)
    assert one(Q.auth_cluster_concentration(trap.cl, trap.bridge, 2, auth_order="last")) == pytest.approx(1.0)
    with pytest.raises(ValueError):
        Q.auth_cluster_concentration(trap.cl, trap.bridge, 2, auth_order="middle")


def test_affiliation_concentration(trap):
    assert one(Q.aff_cluster_concentration(trap.cl, trap.bridge, 2)) == pytest.approx((4 / 5 + 2 / 3) / 2)


def test_k_cluster_rate_distinct_docs(trap):
    assert one(Q.k_cluster_auth_rate(trap.cl, trap.bridge, K=1, min_auth_pubs=2)) == pytest.approx(0.5)
    dist = {r.n_clusters: (r.n_authors, r.metric) for r in Q.k_cluster_distribution(trap.cl, trap.bridge, 2).collect()}
    assert dist == {1: (1, 0.5), 2: (1, 0.5)}


def test_author_overlap_single_pair(trap):
    pairs = Q.author_overlap(trap.cl, trap.bridge, detail=True).collect()
    assert len(pairs) == 1
    p = pairs[0]
    assert (p.topic_i, p.topic_j, p.ai, p.aj, p.inter) == (0, 1, 2, 2, 1)
    assert p.metric == pytest.approx(1 / 3)
    assert one(Q.author_overlap(trap.cl, trap.bridge)) == pytest.approx(1 / 3)


def test_author_overlap_no_pairs_is_null(trap):
    only0 = trap.cl.where("topic = 0")
    assert one(Q.author_overlap(only0, trap.bridge)) is None


def test_purity_thresholds(trap):
    assert one(Q.cluster_purity(trap.cl, trap.docs, "source", 1)) == pytest.approx((2 / 3 + 1.0) / 2)
    assert one(Q.cluster_purity(trap.cl, trap.docs, "source", 3)) is None  # Q1/Q19: nothing qualifies
    per = {r.topic: (r.top_value, r.top_count, r.n_c) for r in
           Q.cluster_purity(trap.cl, trap.docs, "source", None, detail=True).collect()}
    assert per == {0: ("S1", 2, 3), 1: ("S2", 1, 1)}


def test_year_spread_metrics(trap):
    assert one(Q.year_iqr(trap.cl, trap.docs)) == pytest.approx(0.5)
    assert one(Q.entropy_norm(trap.cl, trap.docs)) == pytest.approx((0.918296 + 1.0) / 2, abs=1e-6)
    assert one(Q.year_peak_share(trap.cl, trap.docs)) == pytest.approx((2 / 3 + 1 / 2) / 2)
    peaks = {r.topic: r.peak_year for r in Q.year_peak_share(trap.cl, trap.docs, detail=True).collect()}
    assert peaks == {0: 2000, 1: 2001}  # tie in topic 1 -> earlier year


def test_counts_null_author_is_one_group(trap):
    assert one(Q.count_authors_with_pubs(trap.bridge, 0), "n_authors") == 5
    assert one(Q.count_authors_with_pubs(trap.bridge, 2), "n_authors") == 1
    assert one(Q.count_affiliations_with_pubs(trap.bridge, 3), "n_affiliations") == 2


def test_count_clusters(trap):
    got = {r.is_core: r.topic_count for r in Q.count_clusters_with_pubs(trap.clusters, 1).collect()}
    assert got == {True: 2}


def test_interpretable_suite_reports(trap):
    rows = {r.metric: r for r in Q.interpretable_metrics(trap.clusters, trap.bridge, trap.docs).collect()}
    assert rows["AACC"].report == "0.8750"
    assert rows["CP_source"].report == "-1"  # min 3 documents: no topic qualifies
    assert rows["auth_ratio"].report == "1/5"
    assert math.isclose(rows["AJ"].value, 1 / 3)
    assert rows["AJ"].report == "0.33333333"
