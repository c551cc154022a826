import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pubstrata.session import local_session

    s = local_session("*", 8, app="pubstrata-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def trap(spark):
    """The hand-worked trap fixture (FIXTURES.md section 5)."""
    from types import SimpleNamespace

    clusters = spark.createDataFrame(
        [(1, 0, True, 0.9), (2, 0, True, 0.8), (3, 0, False, 0.0), (4, 1, True, 0.7), (5, 1, True, 0.6),
         (6, -1, False, 0.0)],
        "id long, topic int, is_core boolean, probability double",
    )
    bridge = spark.createDataFrame(
        [(1, "a", "X", 0), (1, "a", "Y", 0), (1, "b", "X", 1), (2, "a", "X", 0), (4, "a", "X", 0),
         (4, "c", "Y", 1), (5, "c", "Y", 0), (3, None, "X", 0), (6, "d", "Y", 0)],
        "doc_id long, auth_id string, aff_id string, auth_seqn int",
    )
    docs = spark.createDataFrame(
        [("1", "t1", "a1", "S1", "J", 2000, 10, 1.0), ("2", "t2", "a2", "S1", "J", 2000, 0, None),
         ("3", "t3", "a3", "S2", "J", 2001, 5, 2.0), ("4", "t4", "a4", "S2", "J", 2001, 5, 1.0),
         ("5", "t5", "a5", None, "J", 2002, 2, 3.0), ("6", "t6", "a6", "S3", "J", 2002, 6, 1.0)],
        "eid string, title string, abstract string, source string, doctype string, year int, cited long, sjr double",
    )
    affiliations = spark.createDataFrame([("X", "FR"), ("Y", " ")], "id string, Country string")
    return SimpleNamespace(clusters=clusters, bridge=bridge, docs=docs, affiliations=affiliations,
                           cl=clusters.where("topic <> -1"))
