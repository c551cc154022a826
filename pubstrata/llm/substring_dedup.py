"""Exact substring deduplication with difference-cover anchors.

A word is removed if a window of ``WINDOW`` words that covers it occurs anywhere else.
Positions whose remainder modulo ``PERIOD`` lies in the difference cover ``COVER`` are
anchors: for any two positions i and j some shift below PERIOD brings both into the
cover. Two equal windows therefore hold an equal run of WINDOW - PERIOD + 1 words that
begins at an anchor in both, and only anchors (5 of 21 positions) are hashed and
compared. A repeated anchor is extended to every window that can hold it; those windows
are compared by 128-bit hashes, and that decides.

A comparison shuffles each (hash, document, position) once: a window over the hash counts its rows. Hashes that one
batch of texts holds ``HOT`` times or more are known to repeat there, so their positions go through under keys of their own and the
hash itself as a single row; a passage that a third of all documents share is a few rows per batch in its group. Texts are
bucketed once by a row key; hits and windows are brought to them, never the texts to those. Texts that occur
several times are represented once (all their windows occur elsewhere). Per document only its own positions are collected.

Defined results: null or wordless text has no words and keeps the empty string; texts
of fewer than WINDOW words keep all words; of a repeated text of WINDOW words or more
nothing is kept, rows repeated as a whole included; null ids are rows like others;
only doc_id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubstrata.llm.common import WORD, Scratch, map_frames, read_table, rows_of, ship_package
from pubstrata.llm.shingles import scramble, window_hashes, word_hashes

WINDOW = 35
#: a perfect difference set: every remainder of 21 is a difference of two of its members
PERIOD, COVER = 21, (0, 1, 6, 8, 18)
ANCHOR = WINDOW - PERIOD + 1
HOT = 8
_IN_COVER = np.isin(np.arange(PERIOD), COVER)


def anchor_positions(n_words: int) -> np.ndarray:
    """Cover positions at which a whole anchor run fits, in texts that have a window at all."""
    if n_words < WINDOW:
        return np.empty(0, dtype=np.int32)
    at = np.arange(n_words - ANCHOR + 1, dtype=np.int32)
    return at[_IN_COVER[at % PERIOD]]


def window_starts(anchors: np.ndarray, n_words: int) -> np.ndarray:
    """Starts of all windows that hold one of the anchors within their first PERIOD positions."""
    if n_words < WINDOW:
        return np.empty(0, dtype=np.int32)
    mark = np.zeros(n_words + 1, dtype=np.int32)
    np.add.at(mark, np.maximum(anchors - (PERIOD - 1), 0), 1)
    np.add.at(mark, anchors + 1, -1)
    return np.flatnonzero(np.cumsum(mark[:-1])[:n_words - WINDOW + 1] > 0).astype(np.int32)


def _combined(keys: list[np.ndarray], u: np.ndarray, at: np.ndarray) -> pd.DataFrame:
    """Rows (keys, u, at, n) of one batch: n counts as so many occurrences. Hot hashes: their positions with keys of their own
    and n = 2, and one row without position for the others to see."""
    _, back, count = np.unique(np.rec.fromarrays(keys), return_inverse=True, return_counts=True)
    hot = (count >= HOT)[back]
    n = np.where(hot, 2, 1)
    if hot.any():
        first = np.unique(back[hot], return_index=True)[1]
        extra = [k[hot][first] for k in keys]
        own = scramble(u[hot].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + at[hot].astype(np.uint64))
        keys = [k.copy() for k in keys]
        for i, k in enumerate(keys):
            k[hot] = scramble(own + np.uint64(i)).view(np.int64)
        keys = [np.concatenate([k, e]) for k, e in zip(keys, extra)]
        u, at, n = (np.concatenate([x, np.full(len(first), f, x.dtype)]) for x, f in ((u, 0), (at, -1), (n, 2)))
    out = {f"h{i}": k for i, k in enumerate(keys)}
    return pd.DataFrame(out | {"u": u, "at": at, "n": n.astype(np.int32)})


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        h, u, at = [], [], []
        for key, text in zip(pdf["u"].to_numpy(), pdf["text"]):
            words = word_hashes(text or "")
            p = anchor_positions(len(words))
            if len(p):
                h.append(window_hashes(words, ANCHOR)[p])
                u.append(np.full(len(p), key))
                at.append(p)
        if h:
            yield _combined([np.concatenate(h).view(np.int64)], np.concatenate(u), np.concatenate(at))


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        h, g, u, at = [], [], [], []
        for key, text, anchors in zip(pdf["u"].to_numpy(), pdf["text"], pdf["ats"]):
            words = word_hashes(text or "")
            s = window_starts(np.asarray(anchors, dtype=np.int32), len(words))
            if len(s):
                h.append(window_hashes(words, WINDOW)[s])
                g.append(window_hashes(scramble(words + np.uint64(WINDOW)), WINDOW)[s])
                u.append(np.full(len(s), key))
                at.append(s)
        if h:
            yield _combined([np.concatenate(h).view(np.int64), np.concatenate(g).view(np.int64)], np.concatenate(u), np.concatenate(at))


def _remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        total, removed, kept = [], [], []
        for text, again, starts in zip(pdf["text"], pdf["again"], pdf["starts"]):
            words = WORD.findall(text or "")
            n = len(words)
            if n >= WINDOW and again:
                gone = n
                words = []
            elif starts is not None and len(starts):
                mark = np.zeros(n + 1, dtype=np.int32)
                np.add.at(mark, starts, 1)
                np.add.at(mark, np.asarray(starts) + WINDOW, -1)
                cover = np.cumsum(mark[:-1]) > 0
                gone = int(cover.sum())
                words = [w for w, c in zip(words, cover.tolist()) if not c]
            else:
                gone = 0
            total.append(n)
            removed.append(gone)
            kept.append(" ".join(words))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": total, "n_removed": removed, "kept_text": kept})


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_text (kept words joined by one space)."""
    spark = docs.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "substr")
    d = rows_of(docs, "doc_id", "text").withColumn("tk", F.md5(F.coalesce("text", F.lit(""))))
    # u names a row; rows that repeat id and text share it, and are found to repeat each other
    d = scratch.bucketed(d.withColumn("u", F.xxhash64("doc_id", "tk")), "u", "texts")
    narrow = d.select("u", "tk")
    copies = narrow.groupBy("tk").agg(F.count("*").alias("c"), F.min("u").alias("first")).where("c > 1").select("tk", "first")
    # narrow rows only: a text that a third of all rows hold is one row of copies, its rows are split by adaptive execution
    flags = narrow.join(copies, "tk").select(F.col("u").alias("f_u"), (F.col("u") == F.col("first")).alias("lead")).distinct()
    flags = scratch.cut(flags, "copies")
    lead = d.join(flags, F.col("u") == F.col("f_u"), "left").where("f_u IS NULL OR lead").select("u", "text")
    lead = lead.groupBy("u").agg(F.min("text").alias("text"))

    def repeated(rows: DataFrame, *keys: str) -> DataFrame:
        """(u, positions) of rows whose hash counts more than once."""
        total = F.sum("n").over(Window.partitionBy(*keys))
        often = rows.withColumn("total", total).where("total > 1 AND at >= 0")
        return often.groupBy("u").agg(F.collect_list("at").alias("ats"))

    anchors = map_frames(lead, _anchors, "h0 long, u long, at int, n int", ids=())
    hits = scratch.cut(repeated(anchors, "h0").withColumnRenamed("u", "hit_u"), "hits")
    near = lead.join(hits, F.col("u") == F.col("hit_u")).select("u", "text", "ats")
    windows = map_frames(near, _windows, "h0 long, h1 long, u long, at int, n int", ids=())
    gone = scratch.cut(repeated(windows, "h0", "h1").select(F.col("u").alias("g_u"), F.col("ats").alias("starts")), "gone")
    last = d.join(flags, F.col("u") == F.col("f_u"), "left").join(gone, F.col("u") == F.col("g_u"), "left")
    return map_frames(last.select("doc_id", "text", F.col("f_u").isNotNull().alias("again"), "starts"), _remove,
                      "doc_id long, n_words long, n_removed long, kept_text string")


def op9_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: repeated passages of ``documents``."""
    out = dedup_substrings(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


_W = f"(i + {WINDOW - 1})"
ORACLE = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  s AS (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW}),
  k AS (SELECT rid, i, array_to_string(list_slice(w, i, {_W}), ' ') AS words FROM s),
  again AS (SELECT words FROM k GROUP BY words HAVING count(*) > 1),
  gone AS (SELECT DISTINCT rid, unnest(range(i, i + {WINDOW})) AS j FROM k JOIN again USING (words)),
  x AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
  kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS words FROM x ANTI JOIN gone USING (rid, j) GROUP BY rid)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
  FROM d LEFT JOIN kept USING (rid)"""
