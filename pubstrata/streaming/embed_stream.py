"""Incremental embedding of newly arriving documents (Structured Streaming).

File source of (eid, title, abstract) Parquet files -> the same text build,
encoder and half rounding as the batch job -> Parquet sink, with a
checkpoint so every file is embedded exactly once across restarts. The job is
stateless, so no watermark is needed. ``trigger(availableNow=True)`` processes
what has arrived and stops (scheduled incremental runs); without it the query
keeps running and picks up new files as they land.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from pubstrata.operators.embed import embed_documents, embed_text, quantize_half

TEXT_SCHEMA = "eid long, title string, abstract string"


def start_embed_stream(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str, encoder_factory=None,
                       dim: int = 1024, available_now: bool = True, max_files_per_trigger: int | None = None
                       ) -> StreamingQuery:
    reader = spark.readStream.schema(TEXT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    src = reader.parquet(source_dir)
    emb = quantize_half(embed_documents(embed_text(src), encoder_factory, dim))
    w = (
        emb.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .option("compression", "zstd")
        .option("parquet.enable.dictionary", "false")
        .outputMode("append")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def run_embed_stream(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str, encoder_factory=None,
                     dim: int = 1024) -> None:
    """Embed everything that has arrived, then stop."""
    q = start_embed_stream(spark, source_dir, out_dir, checkpoint_dir, encoder_factory, dim, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
