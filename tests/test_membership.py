"""Best memberships against the full table, the lineage tree against walks, and far noise that stays noise."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pubstrata.operators import density as D
from pubstrata.operators import membership as M
from pubstrata.operators import periphery as P
from pubstrata.operators import shares as SH


def frame(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>")


def blobs(seed=1, far=()):
    rng = np.random.default_rng(seed)
    x = [rng.normal(c, 0.3, (30, 3)) for c in (0.0, 4.0, 8.0)] + [rng.uniform(-2, 10, (20, 3))]
    return np.vstack([*x, *[np.array([f], dtype=float) for f in far]])


def test_lowest_common_ancestors_by_lifting():
    rng = np.random.default_rng(0)
    for chain in (False, True):
        parent = [-1] + [(i - 1 if chain else int(rng.integers(0, i))) for i in range(1, 90)]
        lins = np.arange(90) * 7 + 3
        up = np.array([-1 if p < 0 else lins[p] for p in parent])
        tree = M.Tree.build(lins, up, np.zeros(90), {}, {})

        def path(i):
            out = []
            while i >= 0:
                out.append(i)
                i = parent[i]
            return out

        a, b = rng.integers(0, 90, 200), rng.integers(0, 90, 200)
        want = [next(x for x in path(i) if x in set(path(j))) for i, j in zip(a, b)]
        assert tree.lca(a, b).tolist() == want
        assert tree.depth.tolist() == [len(path(i)) - 1 for i in range(90)]
    two = M.Tree.build(np.array([1, 2, 3, 4]), np.array([-1, -1, 1, 2]), np.zeros(4), {}, {})
    assert two.lca(np.array([2, 0, 2]), np.array([3, 2, 0])).tolist() == [-1, 0, 0]


@pytest.mark.parametrize("block_rows", [4096, 7])
def test_best_two_equal_the_full_table(spark, block_rows):
    df = frame(spark, blobs())
    labels, _, h, sel = D.hdbscan(df, min_cluster_size=8, min_samples=4, details=True)
    labels = labels.cache()
    dist = P.membership_distance(df, labels)
    for full, extra in ((dist, {}), (D.membership_vectors(h, sel, dist), {"hierarchy": h, "selection": sel})):
        want = {r.id: r for r in P.top2(full).collect()}
        got = {r.id: r for r in M.best_memberships(df, labels, block_rows=block_rows, **extra).collect()}
        assert set(got) == set(want) and len(got) == 110
        for i in got:
            assert got[i].p1 == pytest.approx(want[i].p1, abs=1e-9) and got[i].p2 == pytest.approx(want[i].p2, abs=1e-9)
            assert got[i].c1 == want[i].c1 or want[i].p1 - want[i].p2 < 1e-9


def test_copies_of_an_exemplar_and_big_topics(spark):
    rng = np.random.default_rng(8)
    x = np.vstack([np.tile(rng.normal(size=3), (40, 1)), rng.normal(5, 0.1, (25, 3)), rng.normal(-5, 0.1, (3, 3))])
    df = frame(spark, x)
    lab = spark.createDataFrame([(i, 0 if i < 40 else 1 if i < 65 else -1, i < 65, 1.0 if i < 65 else 0.0) for i in range(68)],
                                "id long, topic int, is_core boolean, probability double")
    want = {r.id: r for r in P.top2(P.membership_distance(df, lab)).collect()}
    for block_rows in (10, 4096):  # 10: topic 1 has more exemplars than a tile, topic 0 a single distinct one
        got = {r.id: r for r in M.best_memberships(df, lab, block_rows=block_rows).collect()}
        assert set(got) == set(want)
        assert all(got[i].p1 == pytest.approx(want[i].p1) and got[i].c1 == want[i].c1 for i in got)


def test_beyond_the_broadcast_bound_the_joins_give_the_same(spark, monkeypatch):
    df = frame(spark, blobs(2))
    labels, _, h, sel = D.hdbscan(df, min_cluster_size=8, min_samples=4, details=True)
    small = {r.id: r for r in M.best_memberships(df, labels, None, h, sel).collect()}
    monkeypatch.setattr(M, "TREE_BYTES", 0)
    assert M.lineage_tree(h, sel, D.cluster_numbering(sel, h.lineages)) is None
    joins = {r.id: r for r in M.best_memberships(df, labels, None, h, sel).collect()}
    assert set(small) == set(joins)
    assert all(small[i].p1 == pytest.approx(joins[i].p1, abs=1e-9) for i in small)


def test_a_far_noise_point_stays_noise(spark):
    """Its nearest cluster is much nearer than any other, so the distance share alone attaches it; in the full membership it is in no cluster."""
    x = blobs(3, far=[(-60.0, -60.0, -60.0)])
    far = len(x) - 1
    df = frame(spark, x)
    labels, _, h, sel = D.hdbscan(df, min_cluster_size=8, min_samples=4, details=True)
    labels = labels.cache()
    assert labels.where(F.col("id") == far).first().topic == -1
    full = M.best_memberships(df, labels, None, h, sel)
    th = P.calibrate_periphery(full, labels, core_sample_frac=1.0)
    out = {r.id: r.topic for r in P.attach_periphery(labels, full, th).collect()}
    assert out[far] == -1
    p1 = {r.id: r.p1 for r in full.collect()}
    core = [r.id for r in labels.where("topic <> -1").collect()]
    assert p1[far] < min(p1[i] for i in core)


def test_no_cluster_no_memberships(spark):
    df = frame(spark, np.random.default_rng(0).uniform(size=(12, 3)))
    lab = spark.createDataFrame([(i, -1, False, 0.0) for i in range(12)], "id long, topic int, is_core boolean, probability double")
    assert M.best_memberships(df, lab).collect() == []


def table(df):
    """{(id, topic): its p values, sorted} of a membership table."""
    out = {}
    for r in df.collect():
        out.setdefault((r.id, r.topic), []).append(r.p)
    return {k: sorted(v) for k, v in out.items()}


def same_table(got, want):
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-6, abs=1e-9, nan_ok=True), k


@pytest.mark.parametrize("block_rows", [4096, 1])
def test_distance_shares_against_brute_force(spark, block_rows):
    """1: eight tiles, and a topic with more exemplars than a tile; an id with two vectors has the lesser distance."""
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(c, 0.5, (k, 3)) for c, k in ((0.0, 30), (4.0, 6), (8.0, 5), (12.0, 9))])
    topic = np.repeat([0, 1, 2, 3], [30, 6, 5, 9])
    ids = np.append(np.arange(50), 7)
    x = np.vstack([x, [4.0, 4.0, 4.1]])
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "id long, embedding array<double>")
    lab = spark.createDataFrame([(i, int(topic[i]) if i != 7 else -1, i != 7, 1.0) for i in range(50)], "id long, topic int, is_core boolean, probability double")
    got = table(P.membership_distance(df, lab, block_rows=block_rows))
    core = [i for i in range(50) if i != 7]
    assert len(got) == 200
    for i in (7, 12, 45):
        d = [min(np.linalg.norm(x[a] - x[b]) for a in np.flatnonzero(ids == i) for b in core if topic[b] == t) for t in range(4)]
        w = 1.0 / np.maximum(d, 1e-7)  # the distance of an exemplar to itself is rounding
        for t in range(4):
            assert got[i, t] == [pytest.approx(w[t] / w.sum(), abs=1e-5)]


@pytest.mark.parametrize("block_rows", [4096, 1])
def test_weighed_in_the_tasks_as_by_the_joins(spark, block_rows):
    df = frame(spark, blobs(5))
    labels, _, h, sel = D.hdbscan(df, min_cluster_size=8, min_samples=4, details=True)
    labels = labels.cache()
    want = table(D.membership_vectors(h, sel, P.membership_distance(df, labels)))
    assert len(want) == 110 * labels.where("topic <> -1").select("topic").distinct().count()
    same_table(table(D.membership_vectors(h, sel, P.membership_distance(df, labels, block_rows=block_rows, table=False))), want)
    # ids with several falls and vectors, falls in a tree of their own, a topic without exemplars (its deepest points have no vector)
    deepest = [r.id for r in labels.where("topic = 0 and probability = 1").collect()]
    x, y, z = [i for i in range(30) if i not in deepest][:3]
    lin = h.falls.where("id = 40").first().lin
    far = 1 << 40
    falls = h.falls.where(F.col("id") != z).unionByName(spark.createDataFrame(
        [(x, lin, 0.2), (x, lin, 0.2), (y, far, 0.5), (z, far, 0.5), (500, lin, 0.3)], "id long, lin long, lam double"))
    odd = D.Hierarchy(None, falls, h.lineages.unionByName(spark.createDataFrame([(far, None, 8, 0.0, 0.7, 0.0, 0.0)], h.lineages.schema)))
    more = df.where(~F.col("id").isin(deepest)).unionByName(spark.createDataFrame([(x, [4.0, 4.0, 4.0]), (x, [8.0, 8.0, 8.0])], df.schema))
    few = labels.where("topic <> 0")
    want = table(D.membership_vectors(odd, sel, P.membership_distance(more, few)))
    assert len(want[x, 1]) == 3 and (y, 1) in want and (z, 1) not in want and (x, 0) not in want
    same_table(table(D.membership_vectors(odd, sel, P.membership_distance(more, few, block_rows=block_rows, table=False))), want)


@pytest.mark.parametrize("block_rows", [4096, 1])
def test_copies_of_infinite_lambda_as_by_the_joins(spark, block_rows):
    df = frame(spark, np.vstack([blobs(6), np.tile([20.0, 20.0, 20.0], (12, 1))]))
    labels, _, h, sel = D.hdbscan(df, min_cluster_size=8, min_samples=4, details=True)
    labels = labels.cache()
    assert h.falls.where("lam = double('inf')").count() > 0
    want = table(D.membership_vectors(h, sel, P.membership_distance(df, labels)))
    same_table(table(D.membership_vectors(h, sel, P.membership_distance(df, labels, block_rows=block_rows, table=False))), want)


def test_rows_of_points_and_topics_are_not_shuffled(spark):
    df = frame(spark, blobs(7))
    lab = spark.createDataFrame([(i, i // 30, True, 1.0) for i in range(90)], "id long, topic int, is_core boolean, probability double")
    h = D.Hierarchy(None, spark.createDataFrame([(i, i // 30 + 1 if i < 90 else 0, 1.0) for i in range(110)], "id long, lin long, lam double"),
                    spark.createDataFrame([(0, None, 0.1), (1, 0, 1.0), (2, 0, 1.0), (3, 0, 1.0)], "lin long, parent long, lam_form double"))
    sel = spark.createDataFrame([(0, False, None), (1, True, 1), (2, True, 2), (3, True, 3)], "lin long, selected boolean, sel long")
    for out in (P.membership_distance(df, lab, block_rows=1), D.membership_vectors(h, sel, P.membership_distance(df, lab, block_rows=1, table=False))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert 0 <= plan.find("MapInPandas") < plan.find("Exchange")
        assert out.count() == 330


def test_copies_grow_to_a_bound():
    for most in (SH.BLOCKS, SH.TILES):
        assert SH.part_count(100_000, 512, most) == SH.part_count(1_000_000, 512, most) == most
    assert SH.part_count(0, 512, 24) == 1 and SH.part_count(10 * SH.TASK_ROWS, 512, 8) == 10
