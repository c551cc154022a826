"""Runs and stage tables: the cluster job and the interpret job with reuse and resume.

Every stage writes one table under ``<root>/stages/<stage>-<key>``, where the
key hashes the input rows, the stage's parameters and those of the stages before it. A stage
whose table is complete (``_SUCCESS`` marker) is read instead of recomputed,
so a changed clustering parameter reruns clustering and periphery but reuses
the reduction, and a failed run resumes from its last finished stage. The
periphery stage always starts from the stored (pristine) cluster labels.
``<root>`` must be shared storage (by default under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubstrata.operators import density as DN
from pubstrata.operators import periphery as P
from pubstrata.operators import quality as Q
from pubstrata.operators import reduce as RD
from pubstrata.operators.membership import best_memberships
from pubstrata.plans.config import ConfigItem, stage_key
from pubstrata.session import cut_lineage


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def complete(spark: SparkSession, path: str) -> bool:
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


# --- run catalogue (R5) --------------------------------------------------------------------

def list_runs(spark: SparkSession, root: str) -> DataFrame:
    """(id, config): one row per stored run, ordered by id."""
    if not exists(spark, f"{root}/runs"):
        return spark.createDataFrame([], "id string, config string")
    df = spark.read.text(f"{root}/runs/*/config.json", wholetext=True)
    return df.select(F.get_json_object("value", "$.id").alias("id"), F.col("value").alias("config")) \
        .dropDuplicates(["id"]).orderBy("id")


def is_unique_id(spark: SparkSession, root: str, run_id: str) -> bool:
    return not exists(spark, f"{root}/runs/{run_id}/config.json")


def generate_new_id(spark: SparkSession, root: str, run_id: str) -> str:
    new = run_id
    while not is_unique_id(spark, root, new):
        new = f"{run_id}_{uuid.uuid4().hex[:12]}"
    return new


# --- stages (R1, R3, R4) -------------------------------------------------------------------

@dataclass
class StageInfo:
    stage: str
    key: str
    path: str
    reused: bool


@dataclass
class RunResult:
    run_id: str
    stages: list[StageInfo] = field(default_factory=list)
    clusters: DataFrame | None = None
    metrics: DataFrame | None = None

    def stage_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(s.stage, s.key, s.reused) for s in self.stages],
                                     "stage string, key string, reused boolean")


def _stage(spark: SparkSession, root: str, name: str, key: str, build, info: list[StageInfo]) -> DataFrame:
    path = f"{root}/stages/{name}-{key}"
    reused = complete(spark, path)
    if not reused:
        build().write.mode("overwrite").parquet(path)
    info.append(StageInfo(name, key, path, reused))
    return spark.read.parquet(path)


def input_identity(df: DataFrame) -> list[str]:
    """Row count and two order-free sums of row hashes: other rows give another identity."""
    row = F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    got = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.xxhash64(F.lit(s), row).cast("decimal(38,0)")).alias(f"h{s}")
                                                 for s in (0, 1)]).first()
    return [str(v) for v in got]


def cluster_run(spark: SparkSession, vectors: DataFrame, item: ConfigItem, root: str, docs: DataFrame | None = None,
                bridge: DataFrame | None = None, reduction: str = "umap", layout_epochs: int = 200,
                spectral_iters: int = 30, seed: int = 42, resume: bool = False) -> RunResult:
    """reduce -> cluster -> attach periphery -> metrics, each stage stored and reusable.

    ``vectors``: (id, embedding). With ``docs`` and ``bridge`` the metric report
    includes the interpretable suite; it always includes the simple metrics.
    A run id that is already taken gets a fresh suffix unless ``resume`` is set
    (continue that run); stages are shared by parameter key either way.
    """
    if reduction not in ("umap", "pca"):
        raise ValueError("reduction must be 'umap' or 'pca'")
    cfg = item.config
    run_id = item.id if resume else generate_new_id(spark, root, item.id)
    if is_unique_id(spark, root, run_id):
        write_text(spark, f"{root}/runs/{run_id}/config.json", json.dumps({**item.to_dict(), "id": run_id}))
    info: list[StageInfo] = []
    extra = {"reduction": reduction, "epochs": layout_epochs, "spectral_iters": spectral_iters, "seed": seed,
             "input": input_identity(vectors)}

    def build_reduced():
        if reduction == "pca":
            return RD.reduce_pca(vectors, cfg.umap.n_components)
        return RD.reduce_umap(vectors, n_neighbors=cfg.umap.n_neighbors, n_components=cfg.umap.n_components,
                              min_dist=cfg.umap.min_dist, n_epochs=layout_epochs, spectral_iters=spectral_iters,
                              seed=seed)

    reduced = _stage(spark, root, "reduced", stage_key(cfg, "reduced", extra), build_reduced, info)

    key = stage_key(cfg, "clusters", extra)
    # the hierarchy lies beside the labels; the labels come last, so their marker stands for all four tables
    side = {name: f"{root}/stages/clusters-{key}-{name}" for name in ("falls", "lineages", "selection")}

    def build_clusters():
        h = cfg.hdbscan
        labels, _, tree, selection = DN.hdbscan(reduced, min_cluster_size=h.min_cluster_size, min_samples=h.min_samples,
                                                method=h.cluster_selection_method, details=True)
        for name, df in (("falls", tree.falls), ("lineages", tree.lineages), ("selection", selection)):
            df.write.mode("overwrite").parquet(side[name])
        return labels

    clusters = _stage(spark, root, "clusters", key, build_clusters, info)

    def build_periphery():
        pc = cfg.periphery
        sample = P.core_sample(clusters, pc.core_sample_frac, pc.core_sample_min, pc.core_sample_max, seed)
        pts = sample.unionByName(clusters.where(F.col("topic") == -1).select("id"))
        tree = DN.Hierarchy(None, spark.read.parquet(side["falls"]), spark.read.parquet(side["lineages"]))
        # the full soft membership, once for calibration and attachment
        mem = cut_lineage(best_memberships(reduced, clusters, pts, tree, spark.read.parquet(side["selection"])), "membership")
        th = P.calibrate_periphery(mem, clusters, pc.core_sample_frac, pc.core_sample_min, pc.core_sample_max,
                                   pc.core_quantile, seed)
        return P.attach_periphery(clusters, mem, th)

    final = _stage(spark, root, "periphery", stage_key(cfg, "periphery", extra), build_periphery, info)
    metrics = metrics_report(final, docs, bridge)
    metrics.write.mode("overwrite").json(f"{root}/runs/{run_id}/metrics")
    return RunResult(run_id, info, final, spark.read.schema(metrics.schema).json(f"{root}/runs/{run_id}/metrics"))


def metrics_report(clusters: DataFrame, docs: DataFrame | None = None, bridge: DataFrame | None = None) -> DataFrame:
    """(metric, value, report): simple metrics plus, given docs and bridge, the interpretable suite."""
    sm = Q.simple_metrics(clusters)
    rows = None
    for c in sm.columns:
        v = F.col(c).cast("double")
        fmt = F.format_string("%.4f", v) if c.endswith("share") else F.col(c).cast("string")
        part = sm.select(F.lit(c).alias("metric"), v.alias("value"), fmt.alias("report"))
        rows = part if rows is None else rows.unionByName(part)
    if docs is not None and bridge is not None:
        rows = rows.unionByName(Q.interpretable_metrics(clusters, bridge, docs))
    return rows


def interpret_run(spark: SparkSession, root: str, run_id: str, clusters: DataFrame, docs: DataFrame,
                  bridge: DataFrame, affiliations: DataFrame, model: str | None = None, answers: str | None = None) -> DataFrame:
    """The interpret job of a stored run: annotation requests (JSON lines), the two index tables, and the annotations.

    ``answers``: a folder of answer lines (one JSON object per line); they are parsed, and the annotation table, the failed
    lines and the parse statistics are written. Returns (topic, impact_index, impulse_index, name, description), best impact
    first, topics without an index or answer with nulls.
    """
    from pubstrata.operators import annotate as A
    from pubstrata.operators import topics as T

    here = f"{root}/runs/{run_id}"
    best = A.best_pubs(Q.drop_noise(clusters), docs)
    req = A.annotation_requests(A.annotation_prompts(best), **({"model": model} if model else {}))
    A.request_lines(req).write.mode("overwrite").text(f"{here}/requests")
    T.impact_suite(clusters, docs).write.mode("overwrite").parquet(f"{here}/impact_index")
    T.impulse_suite(clusters, docs, bridge, affiliations).write.mode("overwrite").parquet(f"{here}/impulse_index")
    names = spark.createDataFrame([], "topic int, name string, description string")
    if answers is not None:
        lines = A.read_lines(spark, answers)
        parsed = cut_lineage(A.parse_responses(lines), "answers")
        A.annotations(parsed).write.mode("overwrite").parquet(f"{here}/annotations")
        parsed.where("outcome = 'failed'").select("custom_id", "line_no", "error", "details").write.mode("overwrite").parquet(f"{here}/failed_answers")
        A.parse_stats(lines, parsed).write.mode("overwrite").parquet(f"{here}/parse_stats")
        names = spark.read.parquet(f"{here}/annotations")
    index = spark.read.parquet(f"{here}/impact_index").withColumnRenamed("metric", "impact_index").join(
        spark.read.parquet(f"{here}/impulse_index").withColumnRenamed("metric", "impulse_index"), "topic", "full")
    return index.join(names, "topic", "full").orderBy(F.col("impact_index").desc_nulls_last(), "topic")
