"""Publication views derived from the driver's TPC-H-style tables.

The driver ships generic tables; these functions re-read them as the
publication model (docs, authorship bridge, affiliations, clusters). Every row
of the source tables is kept; the modulo rules below only inject NULLs, blank
countries and noise labels so the metrics meet the edge cases they must handle.
The same definitions appear as SQL in ``pubstrata.plans.oracle.VIEWS_SQL``.

Fixed values (view definitions shared with the SQL oracle):
  docs.source NULL when o_orderkey % 53 = 0; docs.year NULL when % 89 = 0;
  docs.cited NULL when % 97 = 0; docs.sjr NULL when % 11 = 0;
  bridge.auth_id NULL when l_orderkey % 101 = 0,
    else l_partkey*13 + l_orderkey % 13 for l_linenumber <= 4, else l_partkey*13;
  affiliations.Country ' ' when s_suppkey % 17 = 0;
  clusters.topic = o_orderkey % 13 - 1; is_core = o_orderkey % 4 <> 0;
  probability = (o_orderkey % 1000) / 1000.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def docs_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("eid"),
        F.concat(F.lit("T"), k.cast("string")).alias("title"),
        F.col("o_orderpriority").alias("abstract"),
        F.when(k % 53 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("source"),
        F.col("o_orderstatus").alias("doctype"),
        F.when(k % 89 == 0, F.lit(None).cast("int")).otherwise(F.year("o_orderdate")).alias("year"),
        F.when(k % 97 == 0, F.lit(None).cast("bigint"))
        .otherwise(F.floor(F.col("o_totalprice") / 1000).cast("bigint"))
        .alias("cited"),
        F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice") / 10000.0).alias("sjr"),
    )


def bridge_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    ok, pk = F.col("l_orderkey"), F.col("l_partkey")
    auth = (
        F.when(ok % 101 == 0, F.lit(None).cast("bigint"))
        .when(F.col("l_linenumber") <= 4, pk * 13 + ok % 13)
        .otherwise(pk * 13)
    )
    return li.select(
        ok.alias("doc_id"),
        auth.alias("auth_id"),
        F.col("l_suppkey").alias("aff_id"),
        (F.col("l_linenumber") - 1).alias("auth_seqn"),
    )


def affiliations_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier")
    n = _read(spark, sf_dir, "nation")
    # nation has 25 rows by definition of the schema: a proven broadcast bound
    j = s.join(F.broadcast(n), s["s_nationkey"] == n["n_nationkey"])
    return j.select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_suppkey") % 17 == 0, F.lit(" ")).otherwise(F.col("n_name")).alias("Country"),
    )


def clusters_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        (k % 13 - 1).cast("int").alias("topic"),
        (k % 4 != 0).alias("is_core"),
        ((k % 1000).cast("double") / 1000.0).alias("probability"),
    )


@dataclass
class Publications:
    docs: DataFrame
    bridge: DataFrame
    affiliations: DataFrame
    clusters: DataFrame


def publications(spark: SparkSession, sf_dir: str) -> Publications:
    return Publications(
        docs=docs_view(spark, sf_dir),
        bridge=bridge_view(spark, sf_dir),
        affiliations=affiliations_view(spark, sf_dir),
        clusters=clusters_view(spark, sf_dir),
    )


def text_docs_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publications for the text operators: title = first line, abstract = whole text."""
    d = _read(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("eid"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("abstract"),
        F.col("source"),
    )


def answer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, value): a line per document, of every kind an answer file may hold.

    By doc_id % 8: 0, 1 an answer; 2 its topic id as text; 3 no description; 4 HTTP 429; 5 not JSON; 6 no choices; 7 blank.
    Lines are numbered by doc_id + 1; the custom id and topic are doc_id % 50, the name is the text's first 40 characters.
    """
    d = _read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))
    kind, topic = F.col("doc_id") % 8, F.col("doc_id") % 50
    name, custom = F.substring("text", 1, 40), topic.cast("string").alias("custom_id")

    def line(response) -> Column:
        return F.to_json(F.struct(custom, response.alias("response")))

    def answer(content) -> Column:
        return line(F.struct(F.lit(200).alias("status_code"), F.struct(
            F.array(F.struct(F.struct(F.to_json(content).alias("content")).alias("message"))).alias("choices")).alias("body")))

    full = [name.alias("name"), F.col("lang").alias("description")]
    value = (
        F.when(kind < 2, answer(F.struct(topic.alias("topic_id"), *full)))
        .when(kind == 2, answer(F.struct(topic.cast("string").alias("topic_id"), *full)))
        .when(kind == 3, answer(F.struct(topic.alias("topic_id"), full[0])))
        .when(kind == 4, line(F.struct(F.lit(429).alias("status_code"), F.struct(F.struct(F.lit("rate").alias("message")).alias("error")).alias("body"))))
        .when(kind == 5, F.concat(F.lit("garbled "), F.col("doc_id").cast("string")))
        .when(kind == 6, line(F.struct(F.lit(200).alias("status_code"), F.struct(F.array().cast("array<string>").alias("choices")).alias("body"))))
        .otherwise(F.lit(" "))
    )
    return d.select((F.col("doc_id") + 1).alias("line_no"), value.alias("value"))


def vectors_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedding table (id, embedding, label) from the driver's ``embeddings``."""
    e = _read(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding"), F.col("label"))


def vector_clusters_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster table over the vectors: topic = label, every 7th id is noise (fixed rule)."""
    e = _read(spark, sf_dir, "embeddings")
    noise = F.col("vec_id") % 7 == 0
    return e.select(
        F.col("vec_id").alias("id"),
        F.when(noise, F.lit(-1)).otherwise(F.col("label")).cast("int").alias("topic"),
        (~noise).alias("is_core"),
        F.when(noise, F.lit(0.0)).otherwise(1.0 - (F.col("vec_id") % 10).cast("double") / 20.0).alias("probability"),
    )
