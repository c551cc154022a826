"""WARC archives of web pages: writing, reading back, and the merged capture index.

``write_archives`` renders one WARC/1.1 record per page and lets Spark's text writer
put the files into the shared folder: a record ends with two line breaks, which are the
writer's line separator, so the files are valid archives and commit like any table. A file holds at most
``RECORDS`` records and, counted with the largest page, ``FILE_BYTES`` bytes. ``read_archives`` reads whole files and follows
Content-Length, so payloads may hold any text; every response's digest is checked.

Records with equal payloads (SHA-1 and length) are one response, the row with the
smallest page_id, and revisits of it. Smallest ids are map-side minima over narrow
rows; only digests that occur twice are joined back.

``merge_index``: every archive is a capture run sorted by URL key, timestamp and
page_id; runs are range-partitioned by that order, and a task merges its k runs with a
loser tree. A URL with very many captures spreads over ranges by timestamp. Partitions
in order are the global history.

Defined results: null html is the empty payload; null or odd URLs are written without
target or with the offending characters replaced, and sort first; a null page_id never
is a response unless all equal payloads have none; rows that repeat the smallest
page_id of a payload are responses all; extra columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubstrata.llm.common import Scratch, col, map_frames, nullable_ids, read_table, rows_of, ship_package, small

RECORDS, FILE_BYTES = 2000, 512 << 20
#: a revisit of a payload that another record holds
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: payloads shorter than this are never revisits
MIN_REVISIT = 0
EPOCH = 1_700_000_000
CRLF = "\r\n"
HTTP_HEAD = CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "", ""])


def base32_sha1(text: Column) -> Column:
    """Upper-case base32 of the SHA-1: ten hex digits are eight base-32 digits."""
    h = F.sha1(text)
    digits = [F.lpad(F.conv(F.substring(h, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """One column ``value``: the pages' WARC records without their final line breaks."""
    p = rows_of(pages, "page_id", "url", "html").withColumn("html", F.coalesce("html", F.lit("")))
    p = p.withColumn("digest", base32_sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html").cast("long"))
    same = p.groupBy(F.col("digest").alias("d"), F.col("size").alias("z")).agg(
        F.min("page_id").alias("first"), F.min_by("url", "page_id").alias("first_url"), F.count("*").alias("n"))
    same = scratch.cut(same.where((F.col("n") > 1) & (F.col("z") >= MIN_REVISIT)).drop("n"), "same")
    p = p.join(small(same, 256), (F.col("digest") == F.col("d")) & (F.col("size") == F.col("z")), "left")
    revisit = F.col("d").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    def when(page: str) -> Column:
        at = F.to_utc_timestamp(F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(page, F.lit(0)), F.lit(10**9))), F.current_timezone())
        return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def target(url: str) -> Column:
        return F.regexp_replace(url, r"[\x00-\x20\x7F]", "_")

    block = F.when(revisit, F.lit(HTTP_HEAD)).otherwise(F.concat(F.lit(HTTP_HEAD), "html"))

    def line(name: str, value: Column) -> Column:
        # a null value leaves the line out
        return F.coalesce(F.concat(F.lit(name + ": "), value.cast("string"), F.lit(CRLF)), F.lit(""))

    head = F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))),
        line("WARC-Date", when("page_id")), line("WARC-Target-URI", target("url")), line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("WARC-Refers-To-Target-URI", F.when(revisit, target("first_url"))), line("WARC-Refers-To-Date", F.when(revisit, when("first"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")), line("X-Page-Id", F.col("page_id")),
        line("X-Payload-Length", F.col("size")), line("X-Refers-To-Page", F.when(revisit, F.col("first"))),
        line("Content-Type", F.lit("application/http;msgtype=response")), line("Content-Length", F.octet_length(block)), F.lit(CRLF))
    return p.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, scratch: Scratch) -> str:
    """Folder of the archives (one or more files)."""
    path = scratch.path("warc")
    largest = pages.agg(F.max(F.octet_length(col("html")))).first()[0] or 0
    most = max(1, min(RECORDS, FILE_BYTES // (largest + 4096)))
    records(pages, scratch).write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", most).text(path)
    return path


def url_key(url: str | None) -> str:
    """Host labels reversed, then the path: com,example)/path."""
    rest = (url or "").split("://", 1)[-1]
    host, slash, path = rest.partition("/")
    return ",".join(reversed(host.lower().split("."))) + ")" + slash + path if rest else ""


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], int, bytes, int]]:
    """(header, offset, block, length) of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        begin, size = end + 4, int(head["Content-Length"])
        if data[begin + size:begin + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} has no end where its length says")
        yield head, at, data[begin:begin + size], begin + size + 4 - at
        at = begin + size + 4


CAPTURE = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, url_key string, "
           "timestamp string, run string, offset long, length long")
_NAMES = [c.split()[0] for c in CAPTURE.split(", ")]
IDS = ("page_id", "refers_to")


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def _captures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for name, data in zip(pdf["path"], pdf["content"]):
            rows = []
            for head, at, block, length in parse_archive(data):
                size, digest = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
                if head["WARC-Type"] == "response":
                    payload = block.split(b"\r\n\r\n", 1)[1]
                    size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if found != digest:
                        raise ValueError(f"{name} at {at}: payload digest {found}, header {digest}")
                url = head.get("WARC-Target-URI")
                rows.append((_number(head.get("X-Page-Id")), size, digest, head["WARC-Type"], _number(head.get("X-Refers-To-Page")), url,
                             url_key(url), head["WARC-Date"], name.rsplit("/", 1)[-1], at, length))
            columns = dict(zip(_NAMES, zip(*rows))) if rows else {n: [] for n in _NAMES}
            yield pd.DataFrame(columns | {n: nullable_ids(list(columns[n])) for n in IDS})


def read_archives(spark, path: str) -> DataFrame:
    """One row per record of the archives in the folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return map_frames(files.select("path", "content"), _captures, CAPTURE, ids=())


class LoserTree:
    """K-way merge of sorted runs: inner nodes keep the loser of their match, the winner goes up.

    Taking a row replays one path of log2(k) matches.
    """

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.k = [iter(r) for r in runs], len(runs)
        self.head = [next(r, None) for r in self.runs]
        self.tree = [-1] * max(1, self.k)
        for i in range(self.k):
            self._replay(i)

    def _less(self, a: int, b: int) -> bool:
        if self.head[a] is None or self.head[b] is None:
            return self.head[a] is not None
        return (self.head[a], a) < (self.head[b], b)

    def _replay(self, i: int) -> None:
        winner, node = i, (i + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if other == -1:  # first match here: wait for the opponent
                self.tree[node] = winner
                return
            if self._less(other, winner):
                self.tree[node], winner = winner, other
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.head[self.tree[0]] is not None:
            i = self.tree[0]
            row, self.head[i] = self.head[i], next(self.runs[i], None)
            self._replay(i)
            yield row


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = [p for p in batches if len(p)]
    if not parts:
        return
    pdf = pd.concat(parts, ignore_index=True)
    page = pdf["page_id"]
    runs: dict[str, list[tuple]] = {}
    for i, (run, *key) in enumerate(zip(pdf["run"], pdf["url_key"], pdf["timestamp"], page.notna(), page.fillna(0), pdf["offset"])):
        runs.setdefault(run, []).append((*key, i))
    order = [row[-1] for row in LoserTree(list(runs.values()))]
    yield pdf.iloc[order]


def merge_index(captures: DataFrame) -> DataFrame:
    """The captures in global order of URL key, timestamp and page_id."""
    n = max(1, int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = ("url_key", "timestamp", "page_id")
    runs = captures.repartitionByRange(n, *order).sortWithinPartitions("run", *order, "offset")
    return map_frames(runs, _merge, CAPTURE, ids=IDS)


def archive(pages: DataFrame) -> DataFrame:
    """Writes the pages, reads the archives back and returns the merged capture index."""
    spark = pages.sparkSession
    ship_package(spark)
    scratch = Scratch(spark, "warc")
    captures = scratch.cut(read_archives(spark, write_archives(pages, scratch)), "captures")
    return merge_index(captures)


def op8_warc(spark, sf_dir: str) -> DataFrame:
    """Contract query: the archive records of ``pages``."""
    out = archive(read_table(spark, sf_dir, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "timestamp")
