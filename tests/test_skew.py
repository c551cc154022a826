"""Hot keys: one author holds a third of all bridge rows and one document a large share.

Results must equal a direct pandas evaluation of the definitions (no rows dropped or capped).
"""

import numpy as np
import pandas as pd
import pytest

from pubstrata.operators import quality as Q


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(9)
    n_docs = 3000
    clusters = pd.DataFrame({"id": np.arange(n_docs), "topic": rng.integers(-1, 8, n_docs),
                             "is_core": rng.random(n_docs) < 0.8})
    rows = []
    for d in range(n_docs):
        for s in range(rng.integers(1, 5)):
            rows.append((d, int(rng.integers(0, 2000)), int(rng.integers(0, 50)), s))
    bridge = pd.DataFrame(rows, columns=["doc_id", "auth_id", "aff_id", "auth_seqn"])
    hot = bridge.sample(frac=0.5, random_state=1).index  # the hot author: a third of all rows after append
    bridge.loc[hot, "auth_id"] = 7
    extra = pd.DataFrame({"doc_id": 11, "auth_id": rng.integers(0, 2000, 2000), "aff_id": 3,
                          "auth_seqn": np.arange(4, 2004)})  # one hot document
    bridge = pd.concat([bridge, extra], ignore_index=True)
    c = spark.createDataFrame(clusters.astype({"id": "int64", "topic": "int32"}))
    b = spark.createDataFrame(bridge.astype("int64").astype({"auth_seqn": "int32"}))
    return clusters, bridge, c, b


def _acc_ref(clusters, bridge, entity, min_pubs, order=None):
    cl = clusters[clusters.topic != -1]
    b = bridge
    if order == "first":
        b = b[b.auth_seqn == 0]
    elif order == "last":
        b = b[b.auth_seqn == bridge.groupby("doc_id").auth_seqn.transform("max").loc[b.index]]
    j = b.merge(cl, left_on="doc_id", right_on="id")
    n = j.groupby([entity, "topic"]).size()
    per = n.groupby(level=0).agg(["sum", "max"])
    per = per[per["sum"] >= min_pubs]
    return (per["max"] / per["sum"]).mean(), len(per)


def test_hot_author_share(skewed):
    clusters, bridge, c, b = skewed
    assert (bridge.auth_id == 7).mean() > 0.3
    cl = c.where("topic <> -1")
    for order in (None, "first", "last"):
        r = Q.auth_cluster_concentration(cl, b, 2, auth_order=order).collect()[0]
        want, n = _acc_ref(clusters, bridge, "auth_id", 2, order)
        assert r.metric == pytest.approx(want) and r.n_entities == n
    r = Q.aff_cluster_concentration(cl, b, 2).collect()[0]
    want, n = _acc_ref(clusters, bridge, "aff_id", 2)
    assert r.metric == pytest.approx(want) and r.n_entities == n


def test_hot_keys_in_suite(skewed):
    clusters, bridge, c, b = skewed
    docs = c.selectExpr("CAST(id AS STRING) AS eid", "CAST(NULL AS STRING) AS source",
                        "CAST(NULL AS STRING) AS doctype", "2000 + CAST(id % 5 AS INT) AS year")
    rows = {r.metric: r for r in Q.interpretable_metrics(c, b, docs).collect()}
    want, _ = _acc_ref(clusters, bridge, "auth_id", 2)
    assert rows["AACC"].value == pytest.approx(want)
    want_last, _ = _acc_ref(clusters, bridge, "auth_id", 2, "last")
    assert rows["AACC_last"].value == pytest.approx(want_last)
    n_all = bridge.groupby("auth_id", dropna=False).doc_id.count()
    assert rows["auth_ratio"].report == f"{(n_all > 2).sum()}/{(n_all > 0).sum()}"
    cl = clusters[clusters.topic != -1]
    j = bridge.merge(cl, left_on="doc_id", right_on="id")
    per = j.groupby("auth_id").agg(nd=("doc_id", "nunique"), nt=("topic", "nunique"))
    q = per[per.nd >= 2]
    assert rows["CAR_1"].value == pytest.approx((q.nt <= 1).mean())
