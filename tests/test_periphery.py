"""Periphery calibration and attachment (traps Q12-Q14) and the hash rank."""

import pytest
from pyspark.errors import PythonException
from py4j.protocol import Py4JJavaError

from pubstrata.operators import periphery as P


@pytest.fixture()
def fixture(spark):
    clusters = spark.createDataFrame(
        [(1, 0, True, 0.9), (2, 0, True, 0.8), (3, 1, True, 0.7), (4, 1, True, 0.6),
         (5, -1, False, 0.0), (6, -1, False, 0.0), (7, -1, False, 0.0)],
        "id long, topic int, is_core boolean, probability double")
    mem = [(1, .9, .1), (2, .8, .2), (3, .7, .2), (4, .6, .4), (5, .7, .2), (6, .62, .55), (7, .5, .1)]
    membership = spark.createDataFrame(
        [(i, t, p) for i, a, b in mem for t, p in ((0, a), (1, b))], "id long, topic int, p double")
    return clusters, membership


def test_calibration(fixture):
    clusters, membership = fixture
    r = P.calibrate_periphery(membership, clusters, core_sample_frac=1.0, core_quantile=0.05).collect()[0]
    assert r.tau == pytest.approx(0.615, abs=1e-3)
    assert r.delta == pytest.approx(0.245, abs=1e-3)
    assert (r.n_core, r.n_sample) == (4, 4)


def test_attach(fixture):
    clusters, membership = fixture
    th = P.calibrate_periphery(membership, clusters, core_sample_frac=1.0, core_quantile=0.05)
    out = {r.id: r for r in P.attach_periphery(clusters, membership, th).collect()}
    assert out[5].topic == 0 and out[5].is_core is False
    assert out[5].probability == pytest.approx(0.7001953125)  # half-rounded p1
    assert out[6].topic == -1 and out[7].topic == -1
    assert all(out[i].topic == t for i, t in [(1, 0), (2, 0), (3, 1), (4, 1)])


def test_single_topic_second_best_is_zero(spark):
    m = spark.createDataFrame([(1, 0, 0.8)], "id long, topic int, p double")
    r = P.top2(m).collect()[0]
    assert (r.c1, r.p1, r.p2) == (0, 0.8, 0.0)


def test_no_core_fails(spark):
    clusters = spark.createDataFrame([(1, -1, False, 0.0)], "id long, topic int, is_core boolean, probability double")
    m = spark.createDataFrame([(1, 0, 0.8)], "id long, topic int, p double")
    with pytest.raises(Exception, match="no core"):
        P.calibrate_periphery(m, clusters).collect()


def test_sample_size_and_hash_rank(spark):
    df = spark.range(10000).withColumnRenamed("id", "id")
    ranks = sorted(r.hrank for r in P.hash_rank(df, "id", seed=5).collect())
    assert ranks == list(range(1, 10001))
    clusters = spark.range(100).selectExpr("id", "0 AS topic", "true AS is_core", "0.5 AS probability")
    m = spark.range(100).selectExpr("id", "0 AS topic", "0.5 AS p")
    r = P.calibrate_periphery(m, clusters, core_sample_frac=0.2, core_sample_min=30).collect()[0]
    assert r.n_sample == 30
    r = P.calibrate_periphery(m, clusters, core_sample_frac=0.5, core_sample_max=10).collect()[0]
    assert r.n_sample == 10
