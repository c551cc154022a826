"""Scans and sinks (S1-S3, S5-S10).

Readers select only the columns an operator needs so the Parquet scan prunes
columns and receives pushed-down filters.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pubstrata.columns import require_columns
from pubstrata.functions.vectors import dim_ok


def read_source(spark: SparkSession, source: str, fmt: str = "parquet", columns: list[str] | None = None,
                **options) -> DataFrame:
    """Read a table from a path (``fmt`` = parquet/orc/csv/json), a catalog table (``fmt='table'``) or a
    live database (``fmt='jdbc'``, with url/dbtable/user/... options; partitionColumn/lowerBound/
    upperBound/numPartitions split the read). Only ``columns`` are selected, so scans are pruned.
    """
    if fmt == "table":
        df = spark.table(source)
    elif fmt == "jdbc":
        df = spark.read.format("jdbc").options(dbtable=source, **options).load()
    else:
        df = spark.read.format(fmt).options(**options).load(source)
    return df.select(*columns) if columns else df


def scan_texts(table: DataFrame, id_col: str = "eid", title: str = "title", abstract: str = "abstract",
               stop: int | None = None) -> DataFrame:
    """(eid, title, abstract) with the id cast to a 64-bit key; ``stop`` is the optional row cap."""
    require_columns(table, [id_col, title, abstract], "text table")
    df = table.select(F.col(id_col).cast("bigint").alias("eid"), F.col(title).alias("title"),
                      F.col(abstract).alias("abstract"))
    return df.limit(int(stop)) if stop is not None else df


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(value): the records of the CSV files at ``path``, their headers left out, in no order; a record may span lines.

    A file is read in byte ranges like any text. Whether a line begins inside a quoted field is the parity of the quotes
    before it in its file, so each range counts its quotes on its own and a prefix scan over the ranges (a row each) tells
    every range how it begins. Records of one line leave from there; only the lines of longer ones are shuffled together, by the
    line that begins them, which the same scan finds in earlier ranges. Quotes must be doubled inside quoted fields and
    occur in no other field (RFC 4180). Blank lines between records are skipped; a quote that is never closed makes
    the rest of its file one record.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))  # grows with the place inside a range
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    before = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    lines = raw.withColumn("odd", odd).withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    ranges = lines.groupBy("file", "block").agg(
        (F.sum("odd") % 2).alias("odds"), F.min("at").alias("first"),
        *[F.max(F.when(F.col("inside") == i, F.col("at"))).alias(f"start{i}") for i in (0, 1)])
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("enters", F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2)
    ranges = ranges.withColumn("start", F.when(F.col("enters") == 0, F.col("start0")).otherwise(F.col("start1")))
    # the record that an earlier range leaves open: that range and the line there
    opened = F.when(F.col("start").isNotNull(), F.struct("block", F.col("start").alias("at")))
    ranges = ranges.withColumn("carried", F.last(opened, ignorenulls=True).over(earlier))
    ranges = ranges.withColumn("is_head", F.row_number().over(Window.partitionBy("file").orderBy("block")) == 1)
    placed = lines.join(ranges.select("file", "block", "enters", "carried", "first", "is_head"), ["file", "block"])
    begins = (F.col("inside") + F.col("enters")) % 2 == 0
    ends = (F.col("inside") + F.col("odd") + F.col("enters")) % 2 == 0
    upto = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.last(F.when(begins, F.struct("block", "at")), ignorenulls=True).over(upto)
    placed = placed.select("file", "block", "at", "value", (begins & ends).alias("whole"), F.coalesce(own, "carried").alias("record"),
                           (F.col("is_head") & (F.col("first") == F.col("at"))).alias("head"))
    single = placed.where(F.col("whole") & ~F.col("head")).select("value")
    line = F.struct("block", "at", "value", "head")
    longer = placed.where(~F.col("whole")).groupBy("file", "record").agg(F.array_sort(F.collect_list(line)).alias("parts"))
    longer = longer.where(~F.exists("parts", lambda x: x["head"])).select(F.array_join(F.transform("parts", lambda x: x["value"]), "\n").alias("value"))
    both = single.unionByName(longer).select(F.regexp_replace("value", "\\r\\z", "").alias("value"))
    return both.where(F.trim("value") != "")


def scan_csv(spark: SparkSession, path: str, stop: int | None = None) -> DataFrame:
    """CSV with a header and columns eid, title, abstract (quoted multi-line fields allowed, large files read in ranges)."""
    options = {"escape": '"', "multiLine": "true"}
    df = csv_records(spark, path).select(F.from_csv("value", "eid long, title string, abstract string", options).alias("r")).select("r.*")
    return scan_texts(df, stop=stop)


def load_embeddings(spark: SparkSession, path: str, id_col: str = "eid", emb_col: str = "embedding",
                    dim: int = 1024) -> DataFrame:
    """(eid, embedding array<float>); fails at run time on a vector whose length is not ``dim``."""
    df = spark.read.parquet(path).select(F.col(id_col).cast("bigint").alias("eid"),
                                         F.col(emb_col).cast("array<float>").alias("embedding"))
    ok = F.when(dim_ok("embedding", dim), F.col("embedding")).otherwise(
        F.raise_error(F.concat(F.lit(f"Found embeddings with dim != {dim}: eid="), F.col("eid").cast("string")))
    )
    return df.select("eid", ok.alias("embedding"))


def save_table(df: DataFrame, name: str, database: str | None = None, path: str | None = None) -> None:
    """Create-or-replace a catalog table (``database.table``), creating the database if needed.

    The rows are written to a folder of their own below ``path`` (by default below the database's location) and only
    then does the catalog point there, in one step where the schema stays: a reader sees the old rows or the new ones, and a
    failed write changes nothing. A table that is replaced keeps its last folder for readers that began before; older ones go.
    """
    spark = df.sparkSession
    if database is None and "." in name:
        database, name = name.split(".", 1)

    def q(x):
        return "`" + x.replace("`", "``") + "`"

    def text(x):
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"

    if database:
        # keep the database folder on the same shared storage as the table
        loc = " LOCATION " + text(path.rstrip("/").rsplit("/", 1)[0] + "/_databases/" + database) if path else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {q(database)}{loc}")
    full = f"{q(database)}.{q(name)}" if database else q(name)
    base = (path or spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri + "/" + name).rstrip("/")
    version = f"{base}/version-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(version)
    new = spark.read.parquet(version).schema
    if spark.catalog.tableExists(full) and spark.table(full).schema == new:
        spark.sql(f"ALTER TABLE {full} SET LOCATION {text(version)}")
        spark.catalog.refreshTable(full)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.catalog.createTable(full, path=version, source="parquet", schema=new)
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = sorted((s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("version-")), key=lambda p: p.getName())
    for old in versions[:-2]:
        fs.delete(old, True)
