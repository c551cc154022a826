"""Session helpers.

Library code never creates a session; it takes the caller's. These helpers are
for tests, the benchmark and the command-line jobs. ``shared_dir`` resolves the
shared folder named by ``spark.checkpoint.dir`` - stage tables and lineage cuts
go there, never to a machine-local temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SCALE_CONF = {
    # adaptive execution: runtime broadcast decisions on measured sizes,
    # partition coalescing and skew-join splitting for hot keys
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "pubstrata") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and stage tables.

    Read from the session (``spark.checkpoint.dir``), else the context's
    checkpoint folder. Only when neither is set (tests, local runs) a folder is
    created and registered with ``setCheckpointDir``; the session config is
    never modified (core configs cannot be changed at run time).
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or getattr(sc, "_pubstrata_ckpt", None)
    if not d:
        existing = sc.getCheckpointDir()
        if not existing and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = existing if existing else tempfile.mkdtemp(
            prefix="pubstrata-ckpt-", dir=os.environ.get("PUBSTRATA_SCRATCH", "/tmp"))
    sc._pubstrata_ckpt = d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def shared_dir(spark: SparkSession, *parts: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def cut_lineage(df, tag: str = "cut"):
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Used by the iterative jobs every round: the plan is computed once, the
    result survives executor loss (it is on shared storage, not in executor
    memory), and later rounds start from a short lineage.
    """
    path = shared_dir(df.sparkSession, "tables", f"{tag}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.parquet(path)
    back._cut_path = path
    return back


def free(*frames) -> None:
    """Delete the tables of ``cut_lineage`` that no later step reads (None: nothing)."""
    for df in frames:
        if df is not None:
            drop_folder(df.sparkSession, df._cut_path)


@contextmanager
def bucketed(df, *keys: str, tag: str = "bucketed"):
    """``df`` written once as a table bucketed by ``keys``, with as many buckets as shuffle partitions.

    Joins and groupings by the keys read it without a shuffle. The files lie in the shared folder; the
    catalog entry is dropped and the files are deleted at the end of the block.
    """
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    name, path = f"{tag}_{uuid.uuid4().hex}", shared_dir(spark, "tables", f"{tag}-{uuid.uuid4().hex}")
    df.repartition(n, *keys).write.bucketBy(n, *keys).option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_folder(spark, path)


def drop_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
