"""Whitening against numpy's symmetric eigensolver, and its parts on hard matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pubstrata.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, white string"


def matrices():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    yield "random", q @ np.diag(rng.uniform(0, 9, 40)) @ q.T
    yield "cluster", q @ np.diag([7.0] * 5 + [7.0 - 1e-9] * 3 + list(np.linspace(0, 1, 32))) @ q.T
    yield "identity", np.eye(12)
    yield "zero tail", q @ np.diag([3.0, 2.0] + [0.0] * 38) @ q.T
    yield "diagonal", np.diag(np.arange(20.0))
    yield "tiny", 1e-200 * (q @ np.diag(np.arange(40.0)) @ q.T)
    yield "graded", np.diag(10.0 ** -np.arange(0, 30, 2.0)) + 1e-3 * np.outer(*[10.0 ** -np.arange(0, 30, 2.0)] * 2)
    yield "glued", np.kron(np.eye(3), np.diag(np.arange(7.0)) + np.diag(np.ones(6), 1) + np.diag(np.ones(6), -1))
    for n in (1, 2, 3):
        yield f"n={n}", q[:n, :n] + q[:n, :n].T + 5 * np.eye(n)


@pytest.mark.parametrize("name, a", list(matrices()))
def test_leading_components(name, a):
    a = (a + a.T) / 2
    values, vectors = W.leading_components(a, 8)
    want = np.linalg.eigvalsh(a)[::-1][:8]
    scale = np.abs(np.linalg.eigvalsh(a)).max()
    k = len(values)
    assert np.abs(values - want[:k]).max() <= 4e-14 * scale
    assert np.abs(vectors @ vectors.T - np.eye(k)).max() < 1e-13
    assert np.abs(a @ vectors.T - vectors.T * values).max() <= 4e-14 * scale


def test_sturm_counts_count_eigenvalues():
    rng = np.random.default_rng(1)
    d, e = rng.normal(size=30), rng.normal(size=29)
    e[[4, 11]] = 0
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-4, 4, 33)
    assert W.sturm_counts(d, e * e, at, 1e-300).tolist() == [int((values < x).sum()) for x in at]


def brute(rows, k=8):
    """(n, S, x by row, eigenvalues, vectors) of the rows that take part."""
    x = np.array([[int(np.floor(1024.0 * float(np.float32(c)))) + 100000 for c in v] for v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s).astype(float) / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    order = np.argsort(e)[::-1][:k]
    return n, s, x, c, e[order], q[:, order].T, np.trace(v)


def check(got, ids, vectors, k):
    n, s, x, c, e, q, trace = brute(vectors)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    assert set(by_id) == set(ids)
    for i, v in enumerate(ids):
        copies = ids.count(v)
        assert sorted(by_id[v]) == list(range(1, k + 1)) and all(len(by_id[v][j]) == copies for j in by_id[v])
        if copies == 1:
            deviation = sum(int(y) ** 2 for y in n * x[i] - s)
            assert all(by_id[v][j][0]["deviation"] == deviation and by_id[v][j][0]["n"] == n for j in by_id[v])
    for j in range(k):
        mine = np.array([by_id[v][j + 1][0]["whitened"] for v in ids])
        want = c @ q[j] / np.sqrt(e[j])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-7
        assert by_id[ids[0]][j + 1][0]["explained"] == pytest.approx(e[j] / trace, rel=1e-9)
    assert 0 <= got[0]["identity_error"] < 1e-9 and len({r["identity_error"] for r in got}) == 1


def contract(spark, rows, tmp_path, name):
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / name / "embeddings.parquet"))
    return [r.asDict() for r in W.op12_whitening(spark, str(tmp_path / name)).collect()]


def test_contract_query_equals_numpy(spark, sf):
    src = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = [r.asDict() for r in W.op12_whitening(spark, sf).collect()]
    check(got, [r.vec_id for r in src], [r.embedding for r in src], 8)


def test_odd_rows(spark, tmp_path):
    rng = np.random.default_rng(3)
    good = [(2**60 + 1 + i, [float(v) for v in np.float32(rng.normal(size=5))]) for i in range(40)]
    good += [good[0], good[0], (None, [1.0, 2.0, 3.0, 4.0, 5.0])]
    bad = [(1, None), (2, [1.0, None, 0.0, 0.0, 0.0]), (3, [float("nan")] * 5), (4, [float("inf")] + [0.0] * 4), (5, [])]
    got = contract(spark, [(i, v, 0, 9, "x") for i, v in good + bad], tmp_path, "odd")
    check(got, [i for i, _ in good], [v for _, v in good], 5)


def test_each_dimension_is_a_fit_list(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(v) for v in np.float32(rng.normal(size=2 + i % 3))]) for i in range(60)]
    monkeypatch.setattr(W, "BROADCAST_BYTES", 1)  # a batch per dimension
    got = contract(spark, [(i, v, 0, 9, "x") for i, v in rows], tmp_path, "dims")
    for d in (2, 3, 4):
        mine = [(i, v) for i, v in rows if len(v) == d]
        check([r for r in got if r["vec_id"] in {i for i, _ in mine}], [i for i, _ in mine], [v for _, v in mine], d)


def test_no_direction_no_rows(spark, tmp_path):
    assert contract(spark, [], tmp_path, "empty") == []
    assert contract(spark, [(i, [0.5, 0.25], 0, 0, "x") for i in range(4)], tmp_path, "equal") == []
    line = contract(spark, [(i, [float(i), 2.0 * i], 0, 0, "x") for i in range(5)], tmp_path, "line")
    assert {r["component"] for r in line} == {1} and line[0]["explained"] == pytest.approx(1.0)


def test_deviation_beyond_64_bits_stops_there(spark, tmp_path):
    got = contract(spark, [(0, [3e30, 0.0], 0, 0, "x"), (1, [-3e30, 1.0], 0, 0, "x"), (2, [0.0, 5.0], 0, 0, "x")], tmp_path, "big")
    assert {r["deviation"] for r in got if r["vec_id"] < 2} == {2**63 - 1}


def test_model_is_the_same_for_all_rows(spark, sf):
    white, model = W.whiten(spark.read.parquet(f"{sf}/embeddings.parquet"))
    m = model.orderBy("component").collect()
    q = np.array([r.vector for r in m])
    assert np.abs(q @ q.T - np.eye(8)).max() < 1e-13
    assert white.agg(F.count("*")).first()[0] == m[0].n
