"""What a task holds and what a job moves stays bounded (tables of the tests' own)."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pubstrata.operators import embed as E
from pubstrata.operators import neighbors as N
from pubstrata.operators import periphery as P
from pubstrata.operators import spectral as S


def peak_mb(fn) -> float:
    tracemalloc.start()
    try:
        fn()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_knn_copies_a_vector_a_fixed_number_of_times(spark, monkeypatch):
    seen = lambda *a: lambda key, pdf: pd.DataFrame({"id": [len(pdf)], "neighbor": [0], "distance": [0.0]})
    monkeypatch.setattr(N, "_block_fn", seen)
    df = spark.range(400).select("id", F.array(F.col("id").cast("float")).alias("embedding"))
    copies = sum(r.id for r in N.knn(df, 3, block_rows=4).collect())
    assert copies <= 400 * 16  # before: once per 4 rows


@pytest.mark.parametrize("metric", N.METRICS)
def test_knn_by_tiles_inside_a_task(spark, metric):
    x = np.random.default_rng(1).normal(size=(180, 4)).astype(np.float32)
    x[100:120] = x[7]  # copies
    df = spark.createDataFrame([(i * 3, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<float>")
    d = N._distances(x.astype(np.float64), x.astype(np.float64), metric)
    np.fill_diagonal(d, np.inf)
    got = {}
    for r in N.knn(df, 5, metric, block_rows=4).collect():
        got.setdefault(r.id, {})[r["rank"]] = (r.neighbor, r.distance)
    assert len(got) == 180
    for i, near in got.items():
        assert sorted(near) == [1, 2, 3, 4, 5]
        want = np.sort(d[i // 3])[:5]
        assert np.allclose([near[k][1] for k in range(1, 6)], want, atol=1e-6)
        assert np.allclose([d[i // 3, near[k][0] // 3] for k in range(1, 6)], want, atol=1e-6)


def test_ties_in_later_tiles_do_not_displace_smaller_ids():
    pdf = pd.DataFrame({"id": np.arange(50)[::-1], "v": [np.zeros(2)] * 50, "bi": 0, "bj": 0, "side": 0})
    got = N._block_fn(3, "euclidean", False, 8)(pdf)
    assert len(got) == 150
    assert {i: sorted(g) for i, g in got.groupby("id")["neighbor"]} == {i: [x for x in range(4) if x != i][:3] for i in range(50)}


@pytest.mark.parametrize("metric", N.METRICS)
@pytest.mark.parametrize("scale,shift", [(1.0, 0.0), (1e-3, 1e3), (1.0, 1e9), (1e-30, 0.0), (1e30, 0.0), (1e160, 0.0)])
def test_few_pairs_are_measured_in_double_precision(metric, scale, shift, monkeypatch):
    x = np.random.default_rng(11).normal(size=(600, 4)) * scale + shift
    x[40:60], x[70], x[80, 1] = x[3], np.nan, np.inf
    measured, exact = [], N._exact
    monkeypatch.setattr(N, "_exact", lambda a, b, m: measured.append(len(a)) or exact(a, b, m))
    pdf = pd.DataFrame({"id": np.arange(600)[::-1] * 7, "v": list(x), "bi": 0, "bj": 0, "side": 0})
    got = N._block_fn(5, metric, False, 64)(pdf)
    assert np.isfinite(got["distance"]).all() and not set(got["id"]) & {7 * (599 - 70), 7 * (599 - 80)}
    if (scale, shift) == (1.0, 0.0):
        assert sum(measured) < 600 * 600 / 8  # before: every pair
    with np.errstate(all="ignore"):
        y = x / np.linalg.norm(x, axis=1)[:, None] if metric == "cosine" else x
        d = 1.0 - np.einsum("ik,jk->ij", y, y) if metric == "cosine" else N._distances(x, x, metric)
    np.fill_diagonal(d, np.inf)
    d[~np.isfinite(d)] = np.inf
    near = {i: np.sort(g.to_numpy()) for i, g in got.groupby("id")["distance"]}
    for r in range(600):
        want = np.sort(d[r])[:5]
        want = want[np.isfinite(want)]
        assert np.allclose(near.get(7 * (599 - r), []), want, rtol=1e-9, atol=1e-12 if metric == "cosine" else 1e-7 * (scale + shift))


def test_queries_on_neighbours_search_them_once(spark, tmp_path):
    from pubstrata.plans import registry

    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist(), i % 2) for i in range(60)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    for name in ("mutual_reachability", "fuzzy_weights", "fuzzy_union"):
        plan = registry.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().toString()
        assert "FlatMapGroupsInPandas" not in plan, name


def test_scan_of_a_large_block_is_sliced(monkeypatch):
    from pubstrata.operators import density as D

    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"id": np.arange(2 * n), "v": list(rng.normal(size=(2 * n, 4))), "core": 0.1, "comp": np.arange(2 * n) % 7,
                        "side": np.arange(2 * n) // n})
    whole = []
    assert peak_mb(lambda: whole.append(D._scan_fn()(pdf))) < 8 * n * n / 1e6 * 3
    monkeypatch.setattr(D, "TILE_CELLS", n * n)
    assert whole[0].reset_index(drop=True).equals(D._scan_fn()(pdf).reset_index(drop=True))


def test_distances_to_exemplars_are_sliced():
    rng = np.random.default_rng(4)
    x, e = rng.normal(size=(4096, 4)), rng.normal(size=(9000, 4))
    out = []
    assert peak_mb(lambda: out.append(P.nearest_exemplars(x, e, np.array([0, 10, 5000])))) < 60  # the whole matrix: 295 MB
    d = np.sqrt(((x[:50, None, :] - e[None]) ** 2).sum(2))
    assert np.allclose(out[0][:50], np.minimum.reduceat(d, [0, 10, 5000], axis=1))


def test_encoder_holds_the_words_of_a_run():
    texts = [f"word{i} " * 300 for i in range(2000)] + [None, ""]
    enc = E.HashingEncoder(16)
    out = []
    assert peak_mb(lambda: out.append(enc.encode(texts))) < 20  # before: all 600,000 words at once
    assert np.array_equal(out[0][[0, 1999, 2001]], np.vstack([enc.encode([texts[i]]) for i in (0, 1999, 2001)]))


def test_a_product_moves_rows_not_edges():
    n, parts, cols = 80, 4, 6
    ids = np.arange(n) * 5
    home = np.arange(n) % parts
    i, j = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n), indexing="ij"))
    i, j = i[i != j], j[i != j]  # every two points are linked
    m = np.random.default_rng(5).random(len(i))
    fixed, moved = {}, []
    for q in range(parts):
        edges = pd.DataFrame({"part": q, "i": ids[i], "j": ids[j], "pj": home[j], "m": m})[home[i] == q]
        own = pd.DataFrame({"part": q, "dest": -1, "id": ids, "d": 1.0, "n": 1})[home == q]
        wanted = pd.concat([own.assign(dest=x) for x in range(parts) if x != q])
        fixed[q] = S._fixed_arrays(parts)(edges, pd.concat([wanted, own]))
    y = np.random.default_rng(6).normal(size=(n, cols))
    for q in range(parts):
        rows = pd.DataFrame({"id": ids[home == q], "cur": list(y[home == q])})
        moved.append(S._pack(fixed[q], rows))
    state = pd.concat(moved)
    assert len(state) <= parts * parts
    assert state["cur"].map(len).sum() <= parts * n * cols * 8  # before: a row of columns per edge, n times as much
    a = np.zeros((n, n))
    a[i, j] = m
    want = 2.0 * (a @ y + 0.5 * y) - 3.0 * y
    for q in range(parts):
        got = S._step(2.0, -3.0, 0.0, True)(fixed[q], state[state["part"] == q])
        assert np.allclose(np.vstack(got["ay"]), want[home == q]) and (got["id"] == ids[home == q]).all()


def test_quality_counts_come_from_few_tasks(spark, monkeypatch):
    from pubstrata.llm import quality_rules as Q

    plans = {}
    cut = Q.Scratch.cut

    def spy(self, df, name):
        plans[name] = df._jdf.queryExecution().toString()
        return cut(self, df, name)

    monkeypatch.setattr(Q.Scratch, "cut", spy)
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words of text "), F.col("id")).alias("text")).repartition(30)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert Q.verdicts(docs, labels).count() == 60
    assert "Coalesce 12" in plans["counts"]


def test_filter_by_factors_is_the_chebyshev_polynomial():
    x = np.linspace(-1.0, 1.0, 501)
    for degree in (5, 12, 24):
        z = S.filter_zeros(degree)
        steps = np.cumprod([2.0 * (x - t) for t in z], axis=0)
        assert np.allclose(steps[-1], 2.0 * np.cos(degree * np.arccos(x)), atol=1e-11)
        assert np.abs(steps).max() < 4 * degree  # no product on the way grows out of hand


def test_the_state_of_a_product_is_one_block_of_columns():
    assert S._STATE.count("binary") == 1  # before: the columns before the last, too
    fixed = pd.Series({"part": 0, "send": np.array([1], np.int32).tobytes(), "send_n": np.array([0, 1]).tobytes()})
    moved = S._messages(fixed, np.arange(6.0).reshape(3, 2))
    assert moved["cur"].map(len).tolist() == [3 * 2 * 8, 2 * 8]


def test_a_vertex_has_a_bounded_number_of_ghosts():
    from pubstrata.operators import layout as L

    assert [L.part_count(n, 2048) for n in (0, 1, 2048, 2049, 10_256)] == [1, 1, 1, 2, 6]
    assert L.part_count(102_564, 2048) == L.part_count(615_384, 2048) == L.PARTS <= 16  # before: 51 and 301
    assert L.part_count(4_000_000, 2048) == 62


def test_epochs_in_runs_of_edges_equal_those_at_once(monkeypatch):
    from pubstrata.operators import layout as L

    rng = np.random.default_rng(8)
    y, src, dst, p = rng.normal(size=(300, 5)), np.sort(rng.integers(0, 200, 4000)), rng.integers(0, 300, 4000), rng.random(4000)
    args = (y, 200, src, dst, p, np.arange(300), range(0, 4), 20, 1.5, 0.9, 1.0, 5, (7, 0))
    out = {}
    for size in (1 << 20, 64):
        monkeypatch.setattr(L, "EDGES", size)
        out[size] = L.run_epochs(*args)
    assert np.array_equal(out[1 << 20], out[64])
    big = rng.integers(0, 200, 200_000)
    big.sort()
    monkeypatch.setattr(L, "EDGES", 1 << 12)
    many = (y, 200, big, rng.integers(0, 300, len(big)), np.ones(len(big)), np.arange(300), range(0, 1), 20, 1.5, 0.9, 1.0, 1, (7, 0))
    assert peak_mb(lambda: L.run_epochs(*many)) < 15  # the edges' moves at once: 8 MB an array


def test_copies_of_a_vector_hardly_grow_from_ten_to_a_hundred_thousand():
    blocks = [N.block_count(n, 2048, 4) for n in (10_256, 102_564, 615_384)]
    assert blocks == [6, 8, 8]  # before: 6, 16, 16
    assert N.block_count(5_000_000, 2048, 4) == 39


def test_distances_make_few_matrices(spark, monkeypatch):
    x = np.random.default_rng(9).normal(size=(800, 4))
    for metric in N.METRICS:
        assert peak_mb(lambda: N._distances(x, x, metric)) < 2.5 * 8 * 800 * 800 / 1e6  # before: three at once for euclidean
    tiles = []
    monkeypatch.setattr(N, "_block_fn", lambda k, m, s, tile: tiles.append(tile) or (lambda pdf: pd.DataFrame({"id": [0], "neighbor": [0], "distance": [0.0]})))
    N.knn(spark.range(9).select("id", F.array(F.col("id").cast("float")).alias("embedding")), 2)
    assert tiles == [1024]  # before: 2048, out of the cache
