"""Bounded-space online packing of tokenized documents into fixed-length sequences.

Each task keeps at most ``OPEN`` windows open. A document is its token ids and a
final 0; full windows are cut off it first, the rest is placed in the open window
with the least sufficient room (best fit). When none fits and all windows are open,
the fullest is emitted; if its gap is larger than ``SLACK`` the head of the piece
fills it first. What is still open when a task ends are the leftovers: they are few
(OPEN windows per task), and groups of ``MERGE`` tasks' leftovers are packed once
more, largest first, and drained so that one sequence per group is partly filled.

A task holds OPEN windows and one batch of documents; a merge group holds at most
OPEN * MERGE windows. The packed pieces are written to the shared folder before the
merge, so a lost executor repeats its tasks only, with the same result: placement
depends on nothing but the order of a partition's rows.

Ids come from the vocabulary of the given ``tokenizers`` file. Encoding runs in the
tiktoken engine built from that file (the same byte-level merges, about six times
faster here); the tests hold it against ``tokenizers`` itself. Very long texts are
encoded in stretches that end where a token must end.

Defined results: null text is the empty text, which is the single id 0; repeated rows
are packed separately; null ids are kept; only doc_id and text are read; an empty
table gives no pieces.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubstrata.llm.common import Scratch, group_frames, map_frames, nullable_ids, read_table, rows_of, ship_package

LENGTH, OPEN, SLACK, MERGE = 1024, 32, 4, 16
STRETCH = 1 << 20
#: how the byte-level tokenizer cuts text into words
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")


@functools.lru_cache(maxsize=2)
def engine(path: str):
    """The file's byte-level vocabulary as a tiktoken encoding."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
    return tiktoken.Encoding(path, pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(text: str | None, path: str) -> np.ndarray:
    """Ids of the text and the closing 0, little-endian unsigned 32-bit."""
    enc, text, parts, at = engine(path), text or "", [], 0
    while at < len(text):
        # a single space between two other characters always begins a token
        m = _INNER_SPACE.search(text, at + STRETCH) if len(text) - at > STRETCH else None
        end = m.start() if m else len(text)
        parts.append(enc.encode_to_numpy(text[at:end], allowed_special="all"))
        at = end
    return np.concatenate([*parts, [0]]).astype("<u4")


class Piece:
    """Consecutive ids of one document."""

    __slots__ = ("doc_id", "start", "ids", "total")

    def __init__(self, doc_id, start, ids, total):
        self.doc_id, self.start, self.ids, self.total = doc_id, start, ids, total

    def split(self, n: int) -> tuple["Piece", "Piece"]:
        return (Piece(self.doc_id, self.start, self.ids[:n], self.total),
                Piece(self.doc_id, self.start + n, self.ids[n:], self.total))


class Packer:
    """At most ``open_windows`` partly filled windows."""

    def __init__(self, length: int = LENGTH, open_windows: int = OPEN, slack: int = SLACK):
        self.length, self.limit, self.slack = length, open_windows, slack
        self.windows: list[list[Piece]] = []
        self.room: list[int] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Places a piece; yields the windows that are emitted meanwhile."""
        while len(piece.ids) >= self.length:
            head, piece = piece.split(self.length)
            yield [head]
        while len(piece.ids):
            n = len(piece.ids)
            fit = min((r, k) for k, r in enumerate(self.room) if r >= n) if any(r >= n for r in self.room) else None
            if fit:
                k = fit[1]
                self.windows[k].append(piece)
                self.room[k] -= n
                if self.room[k] == 0:
                    yield self._close(k)
                return
            if len(self.windows) < self.limit:
                self.windows.append([piece])
                self.room.append(self.length - n)
                return
            k = self.room.index(min(self.room))
            if self.room[k] > self.slack:
                head, piece = piece.split(self.room[k])
                self.windows[k].append(head)
            yield self._close(k)

    def _close(self, k: int) -> list[Piece]:
        self.windows[k], self.windows[-1] = self.windows[-1], self.windows[k]
        self.room[k], self.room[-1] = self.room[-1], self.room[k]
        self.room.pop()
        return self.windows.pop()

    def drain(self) -> Iterator[list[Piece]]:
        """Empties the emptiest windows into the fullest; only the last one may stay partly filled."""
        order = sorted(range(len(self.room)), key=lambda k: self.room[k])
        todo = [p for k in order for p in self.windows[k]]
        self.windows, self.room, window, used = [], [], [], 0
        for p in todo:
            while len(p.ids):
                head, p = p.split(min(len(p.ids), self.length - used))
                window.append(head)
                used += len(head.ids)
                if used == self.length:
                    yield window
                    window, used = [], 0
        if window:
            yield window


COLUMNS = "sequence_id long, offset long, doc_id long, start long, doc_tokens long, ids binary, closed boolean"
_NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def _rows(sequence: int, window: list[Piece], closed: bool) -> list[tuple]:
    out, at = [], 0
    for p in window:
        out.append((sequence, at, p.doc_id, p.start, p.total, p.ids.tobytes(), closed))
        at += len(p.ids)
    return out


def _frame(rows: list[tuple]) -> pd.DataFrame:
    columns = dict(zip(_NAMES, zip(*rows))) if rows else {n: [] for n in _NAMES}
    return pd.DataFrame(columns | {"doc_id": nullable_ids(list(columns["doc_id"]))})


def pack_partition(path: str, length: int, open_windows: int, slack: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer, number = Packer(length, open_windows, slack), TaskContext.get().partitionId() << 32
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                ids = token_ids(text, path)
                doc = None if pd.isna(doc_id) else int(doc_id)
                for window in packer.add(Piece(doc, 0, ids, len(ids))):
                    rows += _rows(number, window, True)
                    number += 1
                if len(rows) >= 4096:
                    yield _frame(rows)
                    rows = []
            yield _frame(rows)
        rows = []
        for window in packer.windows:
            rows += _rows(number, window, False)
            number += 1
        yield _frame(rows)
    return run


def merge_group(length: int, open_windows: int, slack: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["sequence_id", "offset"])
        pieces = [Piece(None if pd.isna(r.doc_id) else int(r.doc_id), int(r.start), np.frombuffer(r.ids, dtype="<u4"), int(r.doc_tokens))
                  for r in pdf.itertuples()]
        pieces.sort(key=lambda p: -len(p.ids))
        packer, number, rows = Packer(length, open_windows, slack), ((1 << 30) + int(pdf["group_"].iloc[0])) << 32, []
        for p in pieces:
            for window in packer.add(p):
                rows += _rows(number, window, True)
                number += 1
        for window in packer.drain():
            rows += _rows(number, window, True)
            number += 1
        return _frame(rows)
    return run


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, open_windows: int = OPEN,
         slack: int = SLACK, merge: int = MERGE) -> DataFrame:
    """One row per piece: sequence_id, offset, doc_id, start, doc_tokens, ids (binary, little-endian unsigned 32-bit)."""
    ship_package(docs.sparkSession)
    path, scratch = path or default_vocabulary(), Scratch(docs.sparkSession, "pack")
    first = map_frames(rows_of(docs, "doc_id", "text"), pack_partition(path, length, open_windows, slack), COLUMNS)
    first = scratch.cut(first, "pieces", by=("closed",))
    left = first.where("NOT closed").withColumn("group_", F.floor(F.shiftright("sequence_id", 32) / merge))
    merged = group_frames(left.groupBy("group_"), merge_group(length, open_windows, slack), COLUMNS)
    return first.where("closed").unionByName(merged).drop("closed")


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


def op5_pack(spark, sf_dir: str) -> DataFrame:
    """Contract query: ``documents`` packed into sequences of at most 1024 tokens."""
    return digest(pack(read_table(spark, sf_dir, "documents")))
