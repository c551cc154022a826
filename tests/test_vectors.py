"""Vector operators: half rounding, pooling, normalisation, exact kNN against brute force."""

import numpy as np
import pytest

from pubstrata.operators import embed as E
from pubstrata.operators import neighbors as N


def test_half_rounding_matches_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([
        [0.1, 0.2, -0.3, 1.0, 65504.0, 65519.0, 65520.0, 1e-5, 3e-8, -6.1e-5, 0.0],
        rng.normal(0, 1, 300), rng.normal(0, 1e-4, 100), rng.normal(0, 1e3, 100),
    ]).astype(np.float32)
    df = spark.createDataFrame([(1, vals.tolist())], "eid long, embedding array<float>")
    got = np.array(E.quantize_half(df).collect()[0].embedding, dtype=np.float32)
    want = vals.astype(np.float16).astype(np.float32)
    assert np.array_equal(got, want)
    assert got[0] == np.float32(0.0999755859375) and got[1] == np.float32(0.199951171875)


def test_mean_pool_masked_and_normalize(spark):
    rows = [("d1", [1.0, 0.0], 1), ("d1", [3.0, 4.0], 1), ("d1", [100.0, 100.0], 0), ("d2", [2.0, 2.0], 0)]
    df = spark.createDataFrame(rows, "doc string, embedding array<double>, mask int")
    got = {r.doc: r.embedding for r in E.mean_pool(df, "doc", mask_col="mask").collect()}
    assert got["d1"] == pytest.approx([2.0, 2.0])
    assert got["d2"] == [0.0, 0.0]  # all masked: clamp gives the zero vector
    n = {r.doc: r.embedding for r in E.normalize(E.mean_pool(df, "doc", mask_col="mask")).collect()}
    assert n["d1"] == pytest.approx([2 ** -0.5, 2 ** -0.5])
    assert n["d2"] == [0.0, 0.0]


def test_text_build_and_hashing_encoder(spark):
    docs = spark.createDataFrame([(1, "Title", "one two  three"), (2, None, None)], "eid long, title string, abstract string")
    t = {r.eid: (r.text, r.n_words) for r in E.embed_text(docs).collect()}
    assert t[1] == ("query: Title\none two  three", 5)
    assert t[2] == ("query: \n", 1)
    emb = {r.eid: np.array(r.embedding) for r in E.embed_documents(E.embed_text(docs), dim=32).collect()}
    assert emb[1].shape == (32,) and abs(np.linalg.norm(emb[1]) - 1) < 1e-6
    again = {r.eid: np.array(r.embedding) for r in E.embed_documents(E.embed_text(docs), dim=32).collect()}
    assert np.array_equal(emb[1], again[1])  # deterministic


def _brute(x, ids, k, metric):
    if metric == "cosine":
        xn = x / np.linalg.norm(x, axis=1)[:, None]
        d = 1 - xn @ xn.T
    else:
        d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    out = {}
    for i in range(len(ids)):
        order = sorted(range(len(ids)), key=lambda j: (d[i, j], ids[j]))[:k]
        out[ids[i]] = [(ids[j], d[i, j]) for j in order]
    return out


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_knn_equals_brute_force(spark, metric):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    ids = list(range(1000, 1300))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "id long, embedding array<double>")
    got = {}
    for r in N.knn(df, 7, metric, block_rows=50).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbor, r.distance))
    want = _brute(x, ids, 7, metric)
    assert set(got) == set(ids)
    for i in ids:
        g = sorted(got[i])
        assert [n for _, n, _ in g] == [n for n, _ in want[i]]
        assert [d for _, _, d in g] == pytest.approx([d for _, d in want[i]], abs=1e-9)


def test_core_and_mutual_reachability(spark):
    # points on a line: 0, 1, 2, 10, 11, 12
    pts = [(i, [float(p)]) for i, p in enumerate([0, 1, 2, 10, 11, 12])]
    df = spark.createDataFrame(pts, "id long, embedding array<double>")
    kn = N.knn(df, 3, "euclidean")
    core = {r.id: r.core_distance for r in N.core_distances(kn, 3).collect()}  # self counts: 2nd other point
    assert core == {0: 2.0, 1: 1.0, 2: 2.0, 3: 2.0, 4: 1.0, 5: 2.0}
    mr = {(r.id, r.neighbor): r.mr for r in N.mutual_reachability(kn, N.core_distances(kn, 3)).collect()}
    assert mr[(0, 1)] == 2.0 and mr[(1, 2)] == 2.0 and mr[(2, 3)] == 8.0


def test_best_first_puts_nan_and_null_last(spark):
    from pubstrata.functions.stats import best_first
    from pubstrata.operators import topics as T

    df = spark.createDataFrame([(1, None), (2, float("nan")), (3, -1.0), (4, 2.0), (0, 2.0), (5, float("inf")), (6, float("nan"))],
                               "topic int, metric double")
    assert [r.topic for r in best_first(df, "metric", "topic").collect()] == [5, 0, 4, 3, 2, 6, 1]
    z = spark.createDataFrame([(7, 1.0), (3, 4.0), (5, -2.0)], "topic int, metric double")
    out = T.impulse_index(z, z, z, sort_desc=True).collect()
    assert [r.topic for r in out] == [3, 7, 5] and out[0].metric == pytest.approx(4.0)
    assert T.impulse_index(z, z, z).columns == ["topic", "metric"]
