"""Dimension reduction: PCA shape, fuzzy weights (sum = log2 k), fuzzy union, spectral basis, layout."""

import inspect
import math
from types import SimpleNamespace

import numpy as np
import pytest

from pubstrata.operators import neighbors as N
from pubstrata.operators import reduce as R
from pubstrata.plans import registry as Q


@pytest.fixture(scope="module")
def vecs(spark):
    rng = np.random.default_rng(11)
    X = np.vstack([rng.normal(c, 0.1, (40, 8)) for c in (0.0, 2.0, 4.0)])
    return spark.createDataFrame([(i, X[i].tolist()) for i in range(len(X))], "id long, embedding array<double>"), X


def test_pca(vecs):
    df, X = vecs
    out = np.vstack([r.embedding for r in R.reduce_pca(df, 3).orderBy("id").collect()])
    assert out.shape == (120, 3)
    # same variance explained as NumPy's SVD on centred data
    ev = np.linalg.svd(X - X.mean(0), compute_uv=False)[:3] ** 2
    assert np.var(out, axis=0, ddof=1).sum() * (len(X) - 1) == pytest.approx(ev.sum(), rel=1e-6)


def test_fuzzy_weights_and_union(vecs):
    df, _ = vecs
    k = 10
    fw = R.fuzzy_weights(N.knn(df, k - 1, "euclidean"), k).toPandas()
    s = fw.groupby("id").w.sum()
    assert np.allclose(s, math.log2(k), atol=1e-4)
    assert np.allclose(fw.groupby("id").w.max(), 1.0)  # nearest neighbour has weight 1
    u = R.fuzzy_union(R.fuzzy_weights(N.knn(df, k - 1, "euclidean"), k)).toPandas()
    m = {(r.i, r.j): r.w for r in u.itertuples()}
    assert all(abs(m[(j, i)] - w) < 1e-12 for (i, j), w in m.items())
    d = {(r.id, r.neighbor): r.w for r in fw.itertuples()}
    for (i, j), w in list(m.items())[:200]:
        a, b = d.get((i, j), 0.0), d.get((j, i), 0.0)
        assert w == pytest.approx(a + b - a * b)


def test_sigma_floor_does_not_depend_on_partitions(spark):
    # points 0-9 have only copies for neighbours (rho 0): their floor is the mean distance of the whole graph
    rows = [(i, (i + r) % 10, r, 0.0) for i in range(10) for r in (1, 2)] + [(i, i + 1, r, float(r)) for i in range(10, 20) for r in (1, 2)]
    kn = spark.createDataFrame(rows, "id long, neighbor long, rank int, distance double")
    got = [{r.id: r.sigma for r in R.fuzzy_weights(kn.repartition(p), 3).collect()} for p in (1, 13)]
    assert got[0] == got[1] and got[0][0] == pytest.approx(R.MIN_K_DIST_SCALE * 0.75)


def test_layout_pushes_both_ends(spark):
    # attraction vanishes at distance 0, so every move of these pairs comes from negative samples
    g = spark.createDataFrame([(i, i ^ 1, 1.0) for i in range(20)], "i long, j long, w double")
    init = spark.createDataFrame([(i, [float(i // 2), 0.0]) for i in range(20)], "id long, y array<double>")
    y = {r.id: r.y for r in R.layout(g, init, n_epochs=1).collect()}
    assert all(y[i] != [float(i // 2), 0.0] for i in range(20))
    assert any(y[2 * i] != y[2 * i + 1] for i in range(10))


def test_find_ab():
    a, b = R.find_ab(0.1, 1.0)
    assert a == pytest.approx(1.577, abs=0.01) and b == pytest.approx(0.895, abs=0.01)


def test_spectral_and_layout_separate_groups(vecs, spark):
    df, _ = vecs
    g = R.fuzzy_union(R.fuzzy_weights(N.knn(df, 9, "euclidean"), 10))
    init = R.spectral_init(g, df.select("id"), 2, iters=8)
    y = R.layout(g, init, n_epochs=10)
    pts = {r.id: np.array(r.y) for r in y.collect()}
    assert all(np.isfinite(v).all() and v.shape == (2,) for v in pts.values())
    grp = {i: i // 40 for i in pts}
    cent = {c: np.mean([pts[i] for i in pts if grp[i] == c], 0) for c in range(3)}
    # every point is closer to its own group's centre than to the others'
    ok = [min(range(3), key=lambda c: np.linalg.norm(pts[i] - cent[c])) == grp[i] for i in pts]
    assert np.mean(ok) > 0.95


def test_reduce_umap_end_to_end(spark):
    # cosine geometry: groups point in different directions
    rng = np.random.default_rng(12)
    X = np.vstack([3.0 * np.eye(8)[c] + rng.normal(0, 0.1, (40, 8)) for c in range(3)])
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(len(X))], "id long, embedding array<double>")
    out = R.reduce_umap(df, n_neighbors=10, n_components=2, n_epochs=8, spectral_iters=8)
    pts = {r.id: np.array(r.embedding) for r in out.collect()}
    assert len(pts) == 120 and all(v.shape == (2,) and np.isfinite(v).all() for v in pts.values())
    grp = {i: i // 40 for i in pts}
    cent = {c: np.mean([pts[i] for i in pts if grp[i] == c], 0) for c in range(3)}
    ok = [min(range(3), key=lambda c: np.linalg.norm(pts[i] - cent[c])) == grp[i] for i in pts]
    assert np.mean(ok) > 0.9


def test_registered_queries_run_the_operators_own_rounds(spark, monkeypatch):
    """spectral_embed, layout, reduce_umap and the stored run take the 30 iterations and 200 epochs of the operators."""
    seen = {}

    def note(owner, name):
        signature = inspect.signature(getattr(owner, name))

        def called(*args, **kw):
            bound = signature.bind(*args, **kw)
            bound.apply_defaults()
            seen.setdefault(name, []).append(bound.arguments)
            return spark.range(1)

        monkeypatch.setattr(owner, name, called)

    for owner, name in ((R, "spectral_init"), (R, "layout"), (R, "reduce_umap"), (Q.ST, "cluster_run")):
        note(owner, name)
    monkeypatch.setattr(Q, "_graph", lambda s, d: None)
    monkeypatch.setattr(Q, "_pubs", lambda s, d: SimpleNamespace(docs=None, bridge=None))
    monkeypatch.setattr(Q.FX, "vectors_view", lambda s, d: spark.range(1))
    for name in ("spectral_embed", "layout", "reduce_umap"):
        Q.QUERIES[name](spark, "")
    Q._run(spark, "")
    assert [a["iters"] for a in seen["spectral_init"]] == [30, 30]
    assert [a["n_epochs"] for a in seen["layout"]] == [200]
    assert [(a["spectral_iters"], a["n_epochs"]) for a in seen["reduce_umap"]] == [(30, 200)]
    assert [(a["spectral_iters"], a["layout_epochs"]) for a in seen["cluster_run"]] == [(30, 200)]
