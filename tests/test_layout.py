"""Spectral initialisation against numpy's eigenvectors; ghost-vertex layout against the one-partition loop."""

import numpy as np
import pytest

from pubstrata.operators import layout as L
from pubstrata.operators import neighbors as N
from pubstrata.operators import reduce as R
from pubstrata.operators import spectral as S
from pubstrata.session import cut_lineage


@pytest.fixture(scope="module")
def ring(spark):
    """Points of 20 loose groups on a sphere, their fuzzy graph and its matrix."""
    rng = np.random.default_rng(21)
    centre = rng.normal(size=(20, 12))
    x = np.vstack([c + 0.6 * rng.normal(size=(18, 12)) for c in centre])
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>")
    g = cut_lineage(R.fuzzy_union(R.fuzzy_weights(N.knn(df, 9, "cosine"), 10)))
    w = np.zeros((len(x), len(x)))
    for r in g.collect():
        w[r.i, r.j] = r.w
    return df, g, x, w


def test_tall_skinny_qr_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(S, "FAN", 3)
    rng = np.random.default_rng(2)
    y, ay, d = rng.normal(size=(70, 4)), rng.normal(size=(70, 4)), rng.normal(size=70)
    df = spark.createDataFrame([(float(d[i]), y[i].tolist(), ay[i].tolist()) for i in range(70)], "d double, y array<double>, ay array<double>")
    r, g, h = S.tall_skinny_qr(df.repartition(17), 4)
    full = np.column_stack([d, y])
    assert np.allclose(r.T @ r, full.T @ full) and np.allclose(np.tril(r, -1), 0)
    assert np.allclose(g, y.T @ ay) and np.allclose(h, ay.T @ ay)


def test_spectral_subspace_in_few_rounds(spark, ring):
    df, g, _, w = ring
    deg = w.sum(1)
    a = 0.5 * (np.eye(len(w)) + w / np.sqrt(deg[:, None] * deg[None, :]))
    trivial = np.sqrt(deg) / np.linalg.norm(np.sqrt(deg))
    values, vectors = np.linalg.eigh(a - np.outer(trivial, trivial))  # the trivial vector out, also where 1 is repeated
    rounds = []
    got = R.spectral_init(g, df.select("id"), 6, stats=rounds).orderBy("id").collect()
    y = np.array([r.y for r in got])
    assert len(rounds) <= 10 and rounds[-1] <= 1e-6
    assert np.abs(y).max() == pytest.approx(10.0)
    q, want = np.linalg.qr(y)[0], vectors[:, ::-1][:, :6]
    assert values[-6] - values[-7] > 1e-3  # the subspace is well defined
    assert np.linalg.norm(want - q @ (q.T @ want), 2) < 1e-3
    assert np.abs(trivial @ q).max() < 1e-8


def test_groups_of_columns_in_single_precision_reach_the_same_subspace(spark, ring, monkeypatch):
    df, g, _, _ = ring
    seen, step = [], S._step
    monkeypatch.setattr(S, "_step", lambda *a: seen.append((a[3], np.dtype(a[4]).itemsize)) or step(*a))
    ids, rounds = df.select("id"), {}
    basis = {}
    for rows in (1 << 15, 100):  # one group of columns in double precision; four, in single precision first
        monkeypatch.setattr(S, "GROUP_ROWS", rows)
        seen.clear()
        got = R.spectral_init(g, ids, 6, stats=rounds.setdefault(rows, [])).orderBy("id").collect()
        basis[rows] = np.linalg.qr(np.array([r.y for r in got]))[0]
        assert {size for last, size in seen if not last} >= ({8} if rows > 400 else {4})
    assert rounds[100][-1] <= 1e-6 and len(rounds[100]) <= len(rounds[1 << 15]) + 2
    a, b = basis.values()
    assert np.linalg.norm(a - b @ (b.T @ a), 2) < 1e-4


def test_points_without_edges_and_tiny_graphs(spark):
    g = spark.createDataFrame([(0, 1, 1.0), (1, 0, 1.0)], "i long, j long, w double")
    ids = spark.createDataFrame([(i,) for i in range(4)], "id long")
    y = {r.id: r.y for r in R.spectral_init(g, ids, 2).collect()}
    assert set(y) == {0, 1, 2, 3} and all(np.isfinite(v).all() and len(v) == 2 for v in y.values())
    out = R.layout(g, spark.createDataFrame([(i, y[i]) for i in y], "id long, y array<double>"), n_epochs=3)
    got = {r.id: r.y for r in out.collect()}
    assert set(got) == set(y) and got[2] == y[2]
    assert R.layout(g, spark.createDataFrame([], "id long, y array<double>"), n_epochs=3).collect() == []


def trustworthiness(x, y, k=10):
    n = len(x)
    dx = 1 - x @ x.T
    np.fill_diagonal(dx, np.inf)
    rank = np.argsort(np.argsort(dx, 1), 1)
    dy = ((y[:, None] - y[None]) ** 2).sum(-1)
    np.fill_diagonal(dy, np.inf)
    near = np.argsort(dy, 1)[:, :k]
    late = sum(max(0, rank[i, j] - k + 1) for i in range(n) for j in near[i])
    return 1 - 2 * late / (n * k * (2 * n - 3 * k - 1))


def positions(df):
    got = {r.id: r.y for r in df.collect()}
    return np.array([got[i] for i in sorted(got)])


def test_partitions_with_ghosts_keep_neighbours(spark, ring):
    df, g, x, _ = ring
    init = cut_lineage(R.spectral_init(g, df.select("id"), 4, iters=2))
    one = positions(R.layout(g, init, 60))
    many = positions(R.layout(g, init, 60, part_rows=90))
    again = positions(R.layout(g.repartition(3), init.repartition(5), 60))
    assert one.shape == many.shape == (len(x), 4) and np.array_equal(one, again)
    t_one, t_many = trustworthiness(x, one), trustworthiness(x, many)
    assert t_one > 0.85 and t_many > t_one - 0.03


def test_one_partition_equals_the_plain_loop(spark):
    rng = np.random.default_rng(4)
    y = rng.normal(size=(30, 3))
    pairs = sorted({(min(i, j), max(i, j)) for i, j in rng.integers(0, 30, (80, 2)) if i != j})
    w = {e: float(rng.uniform(0.1, 1)) for e in pairs}
    g = spark.createDataFrame([(int(i), int(j), v) for (a, b), v in w.items() for i, j in ((a, b), (b, a))], "i long, j long, w double")
    got = positions(R.layout(g, spark.createDataFrame([(i, y[i].tolist()) for i in range(30)], "id long, y array<double>"), 4))
    a, b = L.find_ab()
    directed = sorted([(i, j, v) for (i, j), v in w.items()] + [(j, i, v) for (i, j), v in w.items()])
    top = max(w.values())
    for ep in range(4):
        r = np.random.default_rng([42, 0, ep])
        move = np.zeros_like(y)
        for i, j, v in directed:
            d = y[i] - y[j]
            d2 = d @ d
            move[i] += -4 * a * b * d2 ** (b - 1) / (a * d2**b + 1) * v / top * d
        for _ in range(5):
            k = r.integers(30, size=len(directed))
            for (i, _, v), o in zip(directed, k):
                if o != i:
                    d = y[i] - y[o]
                    d2 = d @ d
                    move[i] += 2 * b / ((0.001 + d2) * (a * d2**b + 1)) * v / top * d
        y = y + np.clip(move, -4, 4) * (1 - ep / 4)
    assert np.allclose(got, y, atol=1e-9)


def test_hubs_are_mirrored_in_every_partition(spark):
    """A star: the hub has an edge to every point; no partition holds all of them, and each point is there once."""
    n = 200
    g = spark.createDataFrame([e for i in range(1, n) for e in ((0, i, 1.0), (i, 0, 1.0))], "i long, j long, w double")
    rng = np.random.default_rng(3)
    start = rng.uniform(-10, 10, (n, 2))
    init = spark.createDataFrame([(i, start[i].tolist()) for i in range(n)], "id long, y array<double>")
    y = positions(R.layout(g, init, 40, part_rows=40, hub=50))
    assert y.shape == (n, 2) and np.isfinite(y).all()
    # the hub ends amid its points, nearer to their centre than most of them
    far = np.linalg.norm(y - y[1:].mean(0), axis=1)
    assert far[0] < np.median(far[1:])


def test_morton_keeps_near_points_together(spark):
    from pyspark.sql import functions as F

    grid = [(x, y) for x in range(16) for y in range(16)]
    df = spark.createDataFrame([(i, [x / 8 - 1 + 1 / 16, y / 8 - 1 + 1 / 16]) for i, (x, y) in enumerate(grid)], "id long, y array<double>")
    z = [r.id for r in df.select("id", L.morton(F.col("y"), 1.0, 2, 4).alias("z")).orderBy("z").collect()]
    for q in range(4):  # each quarter of the order is a quadrant
        cells = {(grid[i][0] // 8, grid[i][1] // 8) for i in z[64 * q:64 * q + 64]}
        assert len(cells) == 1
