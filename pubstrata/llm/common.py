"""Helpers shared by the corpus operators.

Scratch tables go to the folder that ``spark.checkpoint.dir`` names (see
``pubstrata.session``); nothing here touches a machine-local folder on a cluster.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from pubstrata.deploy import ship_package
from pubstrata.session import shared_dir

#: white space that separates words: space and U+0009 to U+000D, nothing else
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)

#: a side of a join is broadcast only if its counted rows, at their given width, stay within this
BROADCAST_BYTES = 32 << 20


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the words of ``text`` (null or blank text: empty array)."""
    solid = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(solid == "", F.array().cast("array<string>")).otherwise(F.split(solid, WORD_GAP))


class Scratch:
    """Tables of one operator run in the shared folder.

    ``cut`` writes a frame as Parquet and reads it back, which ends its lineage
    in storage that survives lost executors; ``free`` deletes a table that no
    later step reads.
    """

    def __init__(self, spark, tag: str):
        self.spark = spark
        self.root = shared_dir(spark, "llm", f"{tag}-{uuid.uuid4().hex}")
        self._n = 0

    def path(self, tag: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{tag}"

    def cut(self, df: DataFrame, tag: str = "t", by: tuple[str, ...] = ()) -> DataFrame:
        """``by``: columns that split the table into folders, so that a reader of one value skips the rest."""
        path = self.path(tag)
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch_path = path
        return back

    def bucketed(self, df: DataFrame, key: str, tag: str) -> DataFrame:
        """``df`` as a table bucketed by ``key`` into as many buckets as shuffle partitions; joins by the key do not shuffle it again."""
        n = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        name = f"{tag}_{uuid.uuid4().hex}"
        df.repartition(n, key).write.option("compression", "zstd").bucketBy(n, key).option("path", self.path(tag)).saveAsTable(name)
        return self.spark.table(name)

    def free(self, *frames: DataFrame) -> None:
        sc = self.spark.sparkContext
        for f in frames:
            path = sc._jvm.org.apache.hadoop.fs.Path(f._scratch_path)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its counted size is within ``BROADCAST_BYTES``; else as it is.

    Beyond the bound the join shuffles both sides and adaptive execution splits
    hot keys. ``df`` should be a table already written, so that counting is cheap.
    """
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n * row_bytes <= BROADCAST_BYTES else df


def rows_of(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns of any name cannot clash."""
    return docs.select(*[col(n).alias(n) for n in names])


def packed(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` in one struct column ``row_``; ``unpacked`` undoes it."""
    return docs.select(F.struct(*[col(c).alias(c) for c in docs.columns]).alias("row_"))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select("row_.*")


def exact(frame: pa.RecordBatch | pa.Table, ids: tuple[str, ...]) -> pd.DataFrame:
    """The rows in pandas; the columns ``ids`` as nullable integers, which hold 64-bit values beside nulls exactly."""
    return pd.DataFrame({n: frame.column(i).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get) if n in ids else frame.column(i).to_pandas()
                         for i, n in enumerate(frame.schema.names)})


def map_frames(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], ddl: str, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``mapInPandas`` that keeps 64-bit ids beside nulls exact (pandas alone would make them floats)."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in fn(exact(b, ids) for b in batches):
            yield pa.RecordBatch.from_pandas(out, schema=schema, preserve_index=False)

    return df.mapInArrow(run, ddl)


def group_frames(grouped, fn: Callable[[pd.DataFrame], pd.DataFrame], ddl: str, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``applyInPandas`` of a grouping that keeps 64-bit ids beside nulls exact."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))
    return grouped.applyInArrow(lambda t: pa.Table.from_pandas(fn(exact(t, ids)), schema=schema, preserve_index=False), ddl)


def nullable_ids(values: list) -> pd.Series:
    """Integers and Nones as a nullable integer column."""
    return pd.Series(pd.array(values, dtype="Int64"))


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def components(links: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over ``links`` (a, b); a node that is its own root has no row.

    Alternating large-star and small-star passes; each pass is one group-by with
    map-side minima and one equi-join, so a hub with very many links is never
    gathered. Adaptive execution splits a hub's partition in the joins. Every
    pass ends in a table in the shared folder.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = scratch.cut(edges, "edges")
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    last = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node goes to the smallest of its neighbourhood
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.cut(large.where("a <> b").distinct(), "large")
        # small star: every smaller neighbour, and the node, go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        flat = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        flat = scratch.cut(flat.where("a <> b").distinct(), "small")
        stat = flat.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        scratch.free(edges, large)
        edges = flat
        if last == (stat.n, stat.h):
            break
        last = (stat.n, stat.h)
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))


__all__ = ["WORD", "WORD_GAP", "ASCII_LOWER", "Scratch", "ascii_lower", "col", "components", "exact", "group_frames", "map_frames",
           "nullable_ids", "packed", "quoted", "read_table", "rows_of", "ship_package", "small", "unpacked", "words"]
