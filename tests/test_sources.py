"""Scans and sinks (S1-S3, S6, S8) and the required-column check (S5)."""

import uuid

import pytest

from pubstrata.columns import require_columns
from pubstrata.operators import embed as E
from pubstrata.session import shared_dir
from pubstrata.sources import tables as S


def test_scan_texts_cap_and_cast(spark):
    df = spark.createDataFrame([("7", "t", "a"), ("8", "u", "b")], "id string, ti string, ab string")
    out = S.scan_texts(df, "id", "ti", "ab")
    assert out.schema.simpleString() == "struct<eid:bigint,title:string,abstract:string>"
    assert S.scan_texts(df, "id", "ti", "ab", stop=1).count() == 1


def test_scan_csv_multiline(spark):
    path = shared_dir(spark, "test-csv", uuid.uuid4().hex)
    df = spark.createDataFrame([(1, "a, b", 'line one\nline "two"')], "eid long, title string, abstract string")
    df.write.option("header", "true").option("escape", '"').csv(path)
    got = S.scan_csv(spark, path).collect()
    assert [(r.eid, r.title, r.abstract) for r in got] == [(1, "a, b", 'line one\nline "two"')]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_one_csv_file_in_many_ranges(spark, newline):
    """Ranges of 64 bytes cut records, quoted line breaks and headers of several lines: rows as the csv module reads them."""
    import csv
    import os
    import random

    rnd = random.Random(5)
    path = shared_dir(spark, "test-csv", uuid.uuid4().hex).replace("file:", "")
    os.makedirs(path)
    want = []
    for f in range(3):
        rows = []
        for i in range(80):
            text = "".join(rnd.choice(["a", "b ", ",", '"', '""', "\n", "\n\n", "é", "longer words "]) for _ in range(rnd.randrange(0, 30 if i % 9 else 200)))
            rows.append((f * 1000 + i, f"t{i}" if i % 4 else 'say "x",\ny', "x" + text))
        with open(f"{path}/part{f}.csv", "w", newline="", encoding="utf-8") as out:
            w = csv.writer(out, lineterminator=newline)
            w.writerow(["eid", "title", "abstract" if f else 'abstract\n"long"'])
            for k, r in enumerate(rows):
                w.writerow(r)
                if k % 10 == 0:
                    out.write(newline)
        want += rows
    open(f"{path}/empty.csv", "w").close()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 100
        got = [tuple(r) for r in S.scan_csv(spark, path).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert sorted(got) == sorted(want)
    assert sorted(tuple(r) for r in S.scan_csv(spark, path).collect()) == sorted(want)


def test_csv_of_blank_and_short_records(spark):
    import os

    path = shared_dir(spark, "test-csv", uuid.uuid4().hex).replace("file:", "")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as out:
        out.write('eid,title,abstract\n1,,""\n\nx,t,a\n3,only\n4,t,"open\nto the end\n')
    by_spark = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').schema("eid long, title string, abstract string").csv(path)
    assert sorted(map(str, S.scan_csv(spark, path).where("eid IS NULL OR eid < 4").collect())) == sorted(map(str, by_spark.where("eid IS NULL OR eid < 4").collect()))
    with open(f"{path}/a.csv", "w") as out:
        out.write("eid,title,abstract\n")
    assert S.scan_csv(spark, path).isEmpty()


def test_embedding_sink_roundtrip_and_dim_check(spark):
    path = shared_dir(spark, "test-emb", uuid.uuid4().hex)
    df = spark.createDataFrame([(1, [0.1, 0.2, 0.3]), (2, [1.0, 0.0, 0.0])], "eid long, embedding array<double>")
    E.write_embeddings(E.quantize_half(df), path)
    back = {r.eid: r.embedding for r in S.load_embeddings(spark, path, dim=3).collect()}
    assert back[1][0] == pytest.approx(0.0999755859375)
    import pyarrow.parquet as pq
    import glob
    mds = [pq.ParquetFile(f).metadata for f in glob.glob(path.replace("file:", "") + "/*.parquet")]
    mds = [m for m in mds if m.num_row_groups > 0]
    assert mds and all(m.row_group(0).column(1).compression == "ZSTD" for m in mds)
    with pytest.raises(Exception, match="dim != 4"):
        S.load_embeddings(spark, path, dim=4).collect()


def test_save_table_and_required_columns(spark):
    path = shared_dir(spark, "test-table", uuid.uuid4().hex)
    df = spark.createDataFrame([(0, 1.5)], "topic int, metric double")
    S.save_table(df, "test_schema.some_table", path=path)
    S.save_table(df.union(df), "test_schema.some_table", path=path)  # replaced, not appended
    assert spark.table("test_schema.some_table").count() == 2
    with pytest.raises(ValueError, match="missing required columns"):
        require_columns(df, ["topic", "is_core"], "clusters")


def test_read_source_formats(spark):
    path = shared_dir(spark, "test-src", uuid.uuid4().hex)
    df = spark.createDataFrame([(1, "a", 2.0)], "id long, name string, x double")
    df.write.parquet(path)
    assert S.read_source(spark, path, columns=["id", "x"]).columns == ["id", "x"]
    df.createOrReplaceTempView("src_view")
    assert S.read_source(spark, "src_view", fmt="table").count() == 1


def test_replaced_table_is_never_missing(spark):
    """While the new rows are written the name gives the old ones; a failed write changes nothing; a new schema replaces the old."""
    from pyspark.sql import functions as F

    path, name = shared_dir(spark, "test-tables", uuid.uuid4().hex, "t"), f"test_db.t{uuid.uuid4().hex}"
    S.save_table(spark.range(3), name, path=path)
    assert spark.table(name).count() == 3
    seen = []
    during = spark.range(5).select(F.when(F.lit(True), F.col("id")).alias("id"))
    old = spark.table(name)
    S.save_table(during, name, path=path)
    seen.append(old.count())  # a reader that began before
    assert seen == [3] and spark.table(name).count() == 5
    with pytest.raises(Exception):
        S.save_table(spark.range(2).select(F.raise_error(F.lit("no")).cast("long").alias("id")), name, path=path)
    assert spark.table(name).count() == 5
    S.save_table(spark.range(2).withColumn("x", F.lit("a")), name, path=path)
    assert spark.table(name).columns == ["id", "x"] and spark.table(name).count() == 2


def test_nearest_neighbours_of_very_many_copies(spark):
    """A third of all vectors are copies: k rows each leave a block, ties go to the smaller id."""
    import numpy as np

    from pubstrata.operators import neighbors as N

    rng = np.random.default_rng(1)
    x = np.vstack([np.tile([1.0, 0.0], (60, 1)), rng.normal(size=(120, 2))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>")
    got = {}
    for r in N.knn(df, 3, "euclidean", block_rows=20).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbor))
    for i in range(60):
        assert [n for _, n in sorted(got[i])] == [j for j in range(4) if j != i][:3]
    d = np.zeros((5, 50))
    rows, cols = N._nearest(d, np.arange(50)[::-1], 3)
    assert len(rows) == 15 and set(cols) == {47, 48, 49}
