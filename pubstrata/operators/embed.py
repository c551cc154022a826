"""Text -> vector operators (the embedding job as one narrow Spark job).

    scan -> text build (JVM) -> mapInPandas(encoder per Python worker) -> half rounding (JVM) -> Parquet

``embed_documents`` takes any ``encoder_factory`` (a zero-argument callable
returning an object with ``encode(list[str]) -> ndarray[n, dim]``); the model is
built once per Python worker and reused across tasks. The built-in
``HashingEncoder`` is a deterministic stand-in (signed feature hashing of
lower-cased word tokens, mean-pooled and L2-normalised) because no neural
weights are available offline. Whole texts are encoded: no token cap.
"""

from __future__ import annotations

import re
import uuid
from collections import OrderedDict
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubstrata.functions.vectors import half_round, l2_normalize

# The text layout of the original job.
QUERY_PREFIX = "query: "
TITLE_ABSTRACT_SEPARATOR = "\n"

#: characters that the built-in encoder takes into words at a time
RUN_CHARS = 1 << 18

_WORD = re.compile(r"\w+", re.UNICODE)
_WS_RUN = r"[^ \t\n\r]+"


def build_text(title: str = "title", abstract: str = "abstract", prefix: str = QUERY_PREFIX) -> Column:
    """prefix + title + newline + abstract; a missing part is an empty string."""
    return F.concat(
        F.lit(prefix),
        F.coalesce(F.col(title).cast("string"), F.lit("")),
        F.lit(TITLE_ABSTRACT_SEPARATOR),
        F.coalesce(F.col(abstract).cast("string"), F.lit("")),
    )


def embed_text(docs: DataFrame, id_col: str = "eid", title: str = "title", abstract: str = "abstract",
               prefix: str = QUERY_PREFIX) -> DataFrame:
    """(eid, text, n_words): the model input for every document, whole."""
    t = build_text(title, abstract, prefix)
    return docs.select(
        F.col(id_col).alias("eid"), t.alias("text")
    ).withColumn("n_words", F.regexp_count(F.col("text"), F.lit(_WS_RUN)).cast("bigint"))


class HashingEncoder:
    """Signed feature hashing of word tokens, mean-pooled, L2-normalised (float32)."""

    def __init__(self, dim: int = 1024):
        self.dim = int(dim)

    def encode(self, texts: list[str]) -> np.ndarray:
        """Row by row results, so a batch goes in runs of about ``RUN_CHARS`` characters: the words of one run are held at a time."""
        out, first, chars = np.empty((len(texts), self.dim), dtype=np.float32), 0, 0
        for i, t in enumerate(texts):
            chars += len(t or "")
            if chars >= RUN_CHARS or i + 1 == len(texts):
                out[first:i + 1] = self._encode_run(texts[first:i + 1])
                first, chars = i + 1, 0
        return out

    def _encode_run(self, texts: list[str]) -> np.ndarray:
        n, d = len(texts), self.dim
        toks: list[str] = []
        rows: list[int] = []
        for i, t in enumerate(texts):
            w = _WORD.findall((t or "").lower())
            toks.extend(w)
            rows.extend([i] * len(w))
        out = np.zeros((n, d), dtype=np.float64)
        if toks:
            h = pd.util.hash_array(np.asarray(toks, dtype=object))
            idx = (h % np.uint64(d)).astype(np.int64)
            sign = np.where((h >> np.uint64(63)) == 1, -1.0, 1.0)
            r = np.asarray(rows, dtype=np.int64)
            np.add.at(out, (r, idx), sign)
            counts = np.bincount(r, minlength=n).astype(np.float64)
            out /= np.maximum(counts, 1e-9)[:, None]  # masked mean pooling
        norms = np.maximum(np.linalg.norm(out, axis=1), 1e-12)
        return (out / norms[:, None]).astype(np.float32)


_ENCODERS: "OrderedDict[str, object]" = OrderedDict()
_MAX_ENCODERS = 4


def _encoder(token: str, factory: Callable[[], object]):
    """The encoder of one embedding job, built once per Python worker and reused across its tasks."""
    if token not in _ENCODERS:
        _ENCODERS[token] = factory()
        while len(_ENCODERS) > _MAX_ENCODERS:  # keep memory bounded across jobs
            _ENCODERS.popitem(last=False)
    _ENCODERS.move_to_end(token)
    return _ENCODERS[token]


def embed_documents(texts: DataFrame, encoder_factory: Callable[[], object] | None = None, dim: int = 1024,
                    id_col: str = "eid", text_col: str = "text") -> DataFrame:
    """(eid, embedding array<float>) via mapInPandas; no shuffle."""
    factory = encoder_factory or (lambda: HashingEncoder(dim))
    token = uuid.uuid4().hex  # identifies this job's encoder in the worker cache

    def run(batches):
        enc = _encoder(token, factory)
        for pdf in batches:
            if pdf.empty:
                continue
            m = enc.encode(pdf[text_col].tolist())
            if m.ndim != 2 or m.shape[0] != len(pdf):
                raise ValueError(f"encoder returned shape {m.shape} for {len(pdf)} texts")
            yield pd.DataFrame({"eid": pdf[id_col].astype("int64").to_numpy(), "embedding": list(m)})

    return texts.select(F.col(id_col).cast("bigint").alias(id_col), text_col).mapInPandas(
        run, "eid long, embedding array<float>"
    )


def quantize_half(df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """Round every vector element to binary16 precision (stored as float32)."""
    return df.withColumn(vec_col, half_round(vec_col))


def mean_pool(rows: DataFrame, group_col: str, vec_col: str = "embedding", mask_col: str | None = None,
              out_col: str = "embedding") -> DataFrame:
    """Masked mean of the vectors of each group: sum(mask * v) / max(sum(mask), 1e-9).

    Uses MLlib's ``Summarizer`` (a JVM aggregate with map-side partial buffers),
    so vectors are never exploded into per-element rows and a hot group is
    combined inside each map task. A group whose mask sums to 0 gets the zero
    vector, as the clamp in the original pooling gives.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    m = F.col(mask_col).cast("double") if mask_col else F.lit(1.0)
    src = rows.select(group_col, array_to_vector(F.col(vec_col)).alias("__v"), m.alias("__m"),
                      F.size(vec_col).alias("__d"))
    # Summarizer skips zero-weight rows and rejects groups with nothing added,
    # so fully masked groups come from a second (cheap) aggregate
    pooled = src.where(F.col("__m") > 0).groupBy(group_col).agg(
        vector_to_array(Summarizer.mean(F.col("__v"), F.col("__m"))).alias("__mean")
    )
    groups = src.groupBy(group_col).agg(F.max("__d").alias("__d"))
    out = groups.join(pooled, group_col, "left")
    return out.select(
        group_col, F.coalesce(F.col("__mean"), F.array_repeat(F.lit(0.0), F.col("__d"))).alias(out_col)
    )


def normalize(df: DataFrame, vec_col: str = "embedding") -> DataFrame:
    return df.withColumn(vec_col, l2_normalize(vec_col))


def to_long(df: DataFrame, id_col: str, vec_col: str = "embedding") -> DataFrame:
    """(id, dim, value) rows of a vector column; dim is 0-based."""
    return df.select(
        F.col(id_col), F.posexplode(vec_col).alias("dim", "value")
    ).select(id_col, F.col("dim").cast("int").alias("dim"), F.col("value").cast("double").alias("value"))


def write_embeddings(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Embedding sink: (eid bigint, embedding array<float>), zstd, no dictionary encoding."""
    (
        df.select(F.col("eid").cast("bigint"), F.col("embedding").cast("array<float>"))
        .write.mode(mode)
        .option("compression", "zstd")
        .option("parquet.enable.dictionary", "false")
        .parquet(path)
    )


def embed_job(docs: DataFrame, out_path: str, encoder_factory=None, dim: int = 1024, id_col: str = "eid",
              title: str = "title", abstract: str = "abstract") -> None:
    """scan -> text -> encode -> half rounding -> Parquet, as one narrow job."""
    texts = embed_text(docs, id_col, title, abstract)
    emb = quantize_half(embed_documents(texts, encoder_factory, dim))
    write_embeddings(emb, out_path)
