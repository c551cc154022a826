"""Stage configuration, stage tables (reuse / partial recompute), run catalogue, streaming = batch."""

import uuid

import numpy as np
import pytest

from pubstrata.operators import embed as E
from pubstrata.plans import stages as ST
from pubstrata.plans.config import ConfigError, ConfigItem
from pubstrata.session import shared_dir
from pubstrata.streaming.embed_stream import run_embed_stream

CFG = {
    "id": "t",
    "config": {
        "umap": {"n_neighbors": 10, "min_dist": 0.1},
        "hdbscan": {"min_cluster_size": 15, "min_samples": 5, "cluster_selection_method": "eom"},
        "periphery": {"core_sample_frac": 1.0, "core_sample_min": 0, "core_sample_max": 999999999,
                      "core_quantile": 0.05, "mv_batch_size": 2048, "batch_size": 50000},
    },
}


def test_config_strict():
    item = ConfigItem.from_dict(CFG)
    assert item.config.hdbscan.min_cluster_size == 15
    bad = {**CFG, "config": {**CFG["config"], "umap": {"n_neighbors": 5, "spread": 1.0}}}
    with pytest.raises(ConfigError):
        ConfigItem.from_dict(bad)
    bad = {**CFG, "config": {**CFG["config"], "periphery": {"core_sample_min": 5, "core_sample_max": 1}}}
    with pytest.raises(ConfigError):
        ConfigItem.from_dict(bad)
    bad = {**CFG, "config": {**CFG["config"], "periphery": {"mv_batch_size": 10, "batch_size": 5}}}
    with pytest.raises(ConfigError):
        ConfigItem.from_dict(bad)
    assert ConfigItem.from_dict({"id": "d", "config": {"umap": {}, "hdbscan": {}, "periphery": {}}}).config.umap.n_neighbors == 50


def test_stage_reuse_and_partial_recompute(spark):
    rng = np.random.default_rng(5)
    X = np.vstack([rng.normal(c, 0.05, (40, 20)) for c in (0.0, 1.0, 2.0)] + [rng.uniform(-1, 3, (10, 20))])
    vec = spark.createDataFrame([(i, X[i].tolist()) for i in range(len(X))], "id long, embedding array<double>")
    root = shared_dir(spark, "test-runs", uuid.uuid4().hex)
    item = ConfigItem.from_dict(CFG)
    r1 = ST.cluster_run(spark, vec, item, root, reduction="pca")
    assert [s.reused for s in r1.stages] == [False, False, False]
    out = r1.clusters.collect()
    assert len(out) == len(X) and len({r.id for r in out}) == len(X)
    assert {r.topic for r in out} - {-1} == {0, 1, 2}
    r2 = ST.cluster_run(spark, vec, item, root, reduction="pca")
    assert [s.reused for s in r2.stages] == [True, True, True]
    changed = dict(CFG, config=dict(CFG["config"], hdbscan=dict(CFG["config"]["hdbscan"], min_cluster_size=20)))
    r3 = ST.cluster_run(spark, vec, ConfigItem.from_dict(changed), root, reduction="pca")
    assert [s.reused for s in r3.stages] == [True, False, False]
    m = {r.metric: r.value for r in r1.metrics.collect()}
    assert m["n_total"] == len(X)
    ids = [r.id for r in ST.list_runs(spark, root).collect()]
    assert len(ids) == 3 and "t" in ids  # a taken id gets a fresh suffix
    assert ST.generate_new_id(spark, root, "t") != "t"
    assert ST.cluster_run(spark, vec, item, root, reduction="pca", resume=True).run_id == "t"
    assert ST.is_unique_id(spark, root, "other")
    # other rows under the same root and parameters: nothing is reused
    r4 = ST.cluster_run(spark, vec.where("id < 120"), item, root, reduction="pca")
    assert [s.reused for s in r4.stages] == [False, False, False]
    assert {r.id for r in r4.clusters.collect()} == set(range(120))
    assert ST.input_identity(vec) == ST.input_identity(vec.repartition(7))


def test_stream_equals_batch(spark):
    base = shared_dir(spark, "test-stream", uuid.uuid4().hex)
    docs = spark.createDataFrame([(i, f"title {i}", f"abstract words {i} and {i * 7}") for i in range(50)],
                                 "eid long, title string, abstract string")
    docs.where("eid < 25").write.parquet(f"{base}/in/a")
    docs.where("eid >= 25").write.parquet(f"{base}/in/b")
    run_embed_stream(spark, f"{base}/in/*", f"{base}/out", f"{base}/ckpt", dim=16)
    run_embed_stream(spark, f"{base}/in/*", f"{base}/out", f"{base}/ckpt", dim=16)  # restart: nothing twice
    got = {r.eid: r.embedding for r in spark.read.parquet(f"{base}/out").collect()}
    batch = {r.eid: r.embedding for r in E.quantize_half(E.embed_documents(E.embed_text(docs), dim=16)).collect()}
    assert got.keys() == batch.keys() and spark.read.parquet(f"{base}/out").count() == 50
    assert all(np.array_equal(got[k], batch[k]) for k in got)
