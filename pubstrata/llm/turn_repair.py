"""Repair of conversation structure: a rank-convergence parallel Viterbi search for the cheapest edits.

A conversation's rows, in order, are to be edited so that the role initials read ``(s?(ua)+)?``. Four states tell what may
follow: nothing written yet, after s, after u, after a. Edits of a row: keep (0), rerole to the role that may follow (2),
delete (3, the only edit of blank and duplicate rows); an empty turn may be inserted anywhere (2); a truncated row that is
not deleted adds 1.

**Narrow rows.** The search needs a row's place (turn, fingerprint of role and text), role class and fault only. Equal rows
are counted with map-side sums before they are shuffled: of m equal rows the first is judged and the others
are duplicates. Duplicates at different turns come from a minimum per conversation and fingerprint.

**Chunks.** The narrow rows are range-partitioned by conversation, turn and fingerprint into partitions of about
``ROWS`` rows; a conversation's rows in one partition are a chunk. The backward cost vector (cheapest rest from each
state) of a chunk is computed at once from a speculative vector at its end, with marks every ``MARK`` rows. Then
fix-up passes: a chunk whose end vector differs from the next chunk's start vector by more than a constant runs again
from that vector, and stops at the first mark where the new vector differs from the old one by a constant only; the
passes end when no chunk has to run. Only conversations that lie in several partitions have to, and of
those a partition holds two chunks at most. The constants, added up, are the cost. A chunk's map from start state to
end state chains the chunks, and with its start state and its end vector every chunk traces its own part of the audit:
at each step the edit with the ASCII-least initial whose cost and remaining cost equal the stitched cost.

**Texts** are shuffled once, by conversation and in order, together with the chunks' audits, each sorted in before its first row; a
task streams them and applies the edits. (The digest of a conversation's repaired text is sequential; nothing of it is held but the
hash state and one chunk's audit.)

Rows of one turn are ordered by the fingerprint of role and text, null turns first. Defined results: null text and role are one
space, in the damage key too; a role's initial is its first character, whatever follows (an initial other than s, u, a cannot
be kept); null conv_id is a conversation of its own; repeated rows are rows like others; a conversation that loses every row gives zeros; an
empty table gives an empty result; only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubstrata.llm.chat_format import Batches, runs, stream
from pubstrata.llm.common import Scratch, read_table, rows_of, ship_package, small

#: narrow rows per range partition; rows between two marks of a chunk
ROWS, MARK = 250_000, 1024
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: states: 0 nothing written, 1 after s, 2 after u, 3 after a; what u or a leads to
NEXT = (2, 2, 3, 2)
#: cheapest ends: after s a whole pair is missing, after u an answer
LAST = (0, 2 * INSERT, INSERT, 0)

#: row symbols: role class (0 s, 1 u, 2 a, 3 other) + 4 * fault (0 none, 1 truncated, 2 blank, 3 duplicate)
BLANK, DUPLICATE = 2, 3


def _steps() -> list[list[list[tuple[str, int, int]]]]:
    """[symbol][state]: (initial, cost, next state) of the edits that use up the row, in ASCII order."""
    out = []
    for symbol in range(16):
        role, fault = symbol % 4, symbol // 4
        per_state = []
        for state in range(4):
            edits = [("D", DELETE, state)]
            if fault < BLANK:
                extra = TRUNCATED if fault == 1 else 0
                to = {0: 1 if state == 0 else None, 1: 2 if state != 2 else None, 2: 3 if state == 2 else None}.get(role)
                if to is not None:
                    edits.append(("K", KEEP + extra, to))
                edits.append(("R", REROLE + extra, NEXT[state]))
            per_state.append(edits)
        out.append(per_state)
    return out


STEPS = _steps()


def _closed(v: list[int]) -> tuple[int, ...]:
    """Costs with insertions allowed first."""
    u = min(v[2], INSERT + v[3])
    a = min(v[3], INSERT + v[2])
    return min(v[0], INSERT + u), min(v[1], INSERT + u), u, a


@lru_cache(maxsize=1 << 16)
def _back(symbol: int, v: tuple[int, ...]) -> tuple[int, ...]:
    return _closed([min(c + v[to] for _, c, to in STEPS[symbol][s]) for s in range(4)])


def back(symbol: int, count: int, v: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row, and ``count`` - 1 equal ones behind it, from the costs after them."""
    m = min(v)
    w = _back(symbol, (v[0] - m, v[1] - m, v[2] - m, v[3] - m))  # few vectors differ in more than a constant
    m += DELETE * (count - 1)
    return w[0] + m, w[1] + m, w[2] + m, w[3] + m


def level(v: tuple[int, ...]) -> tuple[int, ...]:
    """``v`` without its constant: equal for vectors that differ by a constant."""
    m = min(v)
    return tuple(x - m for x in v)


def sweep(symbols: bytes, counts: list[int] | None, end: tuple[int, ...], marks: list[list[int]] | None = None,
          start: tuple[int, ...] | None = None) -> tuple[tuple[int, ...], list[list[int]]]:
    """(cost vector at the chunk's start, marks). ``marks`` and ``start`` of an earlier sweep end this one where the vectors meet."""
    v, at, new = tuple(end), len(symbols), []
    while at > 0:
        low = max(0, (at - 1) // MARK * MARK)
        for i in range(at - 1, low - 1, -1):
            v = back(symbols[i], counts[i] if counts else 1, v)
        at = low
        new.append(list(v))
        if marks is not None and level(v) == level(tuple(marks[len(new) - 1])):
            shift = v[0] - marks[len(new) - 1][0]
            new += [[x + shift for x in m] for m in marks[len(new):]]
            return tuple(x + shift for x in start), new
    return v, new


def vectors(symbols: bytes, counts: list[int] | None, end: tuple[int, ...], marks: list[list[int]]) -> Iterator[tuple]:
    """(vector before, vector after) each row, from the first row on; one block of ``MARK`` rows is held at a time."""
    blocks = math.ceil(len(symbols) / MARK)
    for b in range(blocks):
        stop = min(len(symbols), (b + 1) * MARK)
        # marks run from the chunk's last block to its first
        block = [tuple(end) if b == blocks - 1 else tuple(marks[blocks - 2 - b])]
        for i in range(stop - 1, b * MARK - 1, -1):
            block.append(back(symbols[i], counts[i] if counts else 1, block[-1]))
        block.reverse()
        yield from zip(block, block[1:])


def trace(symbols: bytes, counts: list[int] | None, state: int, end: tuple[int, ...], marks: list[list[int]], last: bool) -> tuple[str, int]:
    """(audit, state behind the chunk): the ASCII-least of the cheapest edits; ``last``: insertions may end the conversation."""
    out = []
    for i, (before, after) in enumerate(vectors(symbols, counts, end, marks)):
        copies = (counts[i] if counts else 1) - 1
        while True:
            rest = before[state] - DELETE * copies
            fits = [(name, to) for name, cost, to in STEPS[symbols[i]][state] if cost + after[to] == rest]
            if fits and fits[0][0] == "D" or INSERT + before[NEXT[state]] != before[state]:
                break
            out.append("I")  # ASCII order: D, I, K, R
            state = NEXT[state]
        name, state = fits[0]
        out.append(name + "D" * copies)
    if last:
        while end[state]:
            out.append("I")
            state = NEXT[state]
    return "".join(out), state


# ---- rows ---------------------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: the damaged rows; a dropped row stays as a mark without text (gone)."""
    c = rows_of(conversations, "conv_id", "turn", "role", "text")
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    c = c.withColumn("kind", F.crc32(key.cast("binary")) % 20).withColumn("role", F.coalesce("role", blank)).withColumn("text", F.coalesce("text", blank))
    c = c.select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                 F.when(F.col("kind") <= 1, F.lit("")).when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                 (F.col("kind") == 0).alias("gone"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))
    return c.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")


def fingerprint(role: Column, text: Column) -> Column:
    """128 bits of role and text, by which rows are compared (and equal turns ordered)."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def _narrow(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, turn, fp, symbol, n: equal rows counted, marks of dropped rows with symbol -1."""
    solid = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(solid == "", BLANK).when(~F.substring(solid, -1, 1).isin(".", "!", "?"), 1).otherwise(0)
    keys = [F.col("conv_id"), F.when(~F.col("gone"), F.col("turn")).alias("turn"),
            F.when(~F.col("gone"), fingerprint(F.col("role"), F.col("text"))).alias("fp"),
            F.when(F.col("gone"), -1).otherwise(role + 4 * fault).cast("int").alias("symbol")]
    # grouping by narrow keys: one row per equal rows and map task is shuffled
    counted = rows.select(*keys).groupBy("conv_id", "turn", "fp", "symbol").agg(F.count("*").alias("n"))
    counted = scratch.cut(counted, "narrow")
    place = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    live = counted.where(f"symbol >= 0 AND symbol < {4 * BLANK}")
    again = live.groupBy("conv_id", "fp").agg(F.min(place).alias("first"), F.count("*").alias("turns")).where("turns > 1")
    again = scratch.cut(again.select(F.col("conv_id").alias("a_conv"), F.col("fp").alias("a_fp"), "first"), "again")
    joined = counted.join(small(again, 64), F.col("conv_id").eqNullSafe(F.col("a_conv")) & (F.col("fp") == F.col("a_fp")), "left")
    later = F.col("first").isNotNull() & ~place.eqNullSafe(F.col("first")) & (F.col("symbol") >= 0) & (F.col("symbol") < 4 * BLANK)
    return joined.select("conv_id", "turn", "fp", F.when(later, F.col("symbol") % 4 + 4 * DUPLICATE).otherwise(F.col("symbol")).alias("symbol"), "n")


_VECTOR = pa.list_(pa.int64())
CHUNK = pa.schema([("conv_id", pa.int64()), ("pid", pa.int32()), ("first_turn", pa.int64()), ("first_fp", pa.string()),
                   ("symbols", pa.binary()), ("counts", _VECTOR), ("stats", _VECTOR), ("low", pa.int64()), ("high", pa.int64()),
                   ("end", _VECTOR), ("start", _VECTOR), ("marks", pa.list_(_VECTOR))])
CHUNK_DDL = ("conv_id long, pid int, first_turn long, first_fp string, symbols binary, counts array<long>, stats array<long>, low long, high long, "
             "end array<long>, start array<long>, marks array<array<long>>")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's rows of this partition as one chunk, swept from the speculative vector."""
    from pyspark import TaskContext

    pid, out = TaskContext.get().partitionId(), Batches(CHUNK)
    for (conv,), rows in runs(stream(batches, "conv_id", "turn", "fp", "symbol", "n"), 1):
        symbols, counts, first, turns, before = bytearray(), [], None, [0, None, None], None
        n = blank = duplicate = truncated = illegal = 0
        for _, turn, fp, symbol, m in rows:
            if symbol < 0:
                continue
            first = first or (turn, fp)
            symbols.append(symbol)
            counts.append(m)
            role, fault = symbol % 4, symbol // 4
            n += m
            blank += m if fault == BLANK else 0
            duplicate += (m if fault == DUPLICATE else 0 if fault == BLANK else m - 1)
            truncated += fault == 1
            illegal += (before is not None and (before, role) not in LEGAL) + (m - 1)
            before = role
            if turn is not None and turn != turns[2]:
                turns = [turns[0] + 1, turn if turns[1] is None else turns[1], turn]
        counts_ = counts if any(c > 1 for c in counts) else None
        start, marks = sweep(bytes(symbols), counts_, LAST)
        stats = [n, blank, duplicate, truncated, illegal, turns[0], symbols[0] % 4 if symbols else -1, symbols[-1] % 4 if symbols else -1]
        yield from out.add((conv, pid, *(first or (None, None)), bytes(symbols), counts_, stats, turns[1], turns[2], list(LAST), list(start), marks),
                           len(symbols))
    yield from out.flush()


#: neighbours that may stand together: su, ua, au
LEGAL = {(0, 1), (1, 2), (2, 1)}


def _rerun(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, out = CHUNK.names, Batches(CHUNK)
    for *row, new_end in stream(batches, *names, "new_end"):
        r = dict(zip(names, row))
        if new_end is not None:
            start, marks = sweep(r["symbols"], r["counts"], tuple(new_end), r["marks"], tuple(r["start"]))
            r |= {"end": new_end, "start": list(start), "marks": marks}
        yield from out.add(tuple(r[n] for n in names), len(r["symbols"]))
    yield from out.flush()


_MAPPED = ("conv_id", "pid", "symbols", "counts", "end", "start", "marks")


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """State behind the chunk for each state before it."""
    schema = pa.schema([("conv_id", pa.int64()), ("pid", pa.int32()), ("start", _VECTOR), ("to", _VECTOR)])
    out = Batches(schema)
    for conv, pid, symbols, counts, end, start, marks in stream(batches, *_MAPPED):
        to = [trace(symbols, counts, s, tuple(end), marks, False)[1] for s in range(4)]
        yield from out.add((conv, pid, start, to))
    yield from out.flush()


AUDIT = pa.schema([("conv_id", pa.int64()), ("pid", pa.int32()), ("turn", pa.int64()), ("fp", pa.string()), ("audit", pa.string()), ("cost", pa.int64()),
                   ("stats", _VECTOR), ("low", pa.int64()), ("high", pa.int64())])
AUDIT_DDL = "conv_id long, pid int, turn long, fp string, audit string, cost long, stats array<long>, low long, high long"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("conv_id", "pid", "first_turn", "first_fp", "symbols", "counts", "end", "marks", "state", "last", "cost", "stats", "low", "high")
    out = Batches(AUDIT)
    for conv, pid, turn, fp, symbols, counts, end, marks, state, last, cost, *rest in stream(batches, *names):
        audit, _ = trace(symbols, counts, state, tuple(end), marks, last)
        yield from out.add((conv, pid, turn, fp, audit, cost, *rest), len(audit))
    yield from out.flush()


def _level(v: Column) -> Column:
    return F.transform(v, lambda x: x - F.array_min(v))


def _in_order() -> Window:
    """A conversation's chunks: at most one per partition."""
    return Window.partitionBy("conv_id").orderBy("pid")


def settled(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """Fix-up passes over ``keys``, the chunks of conversations that lie in several partitions; a pass mends one
    chunk of a chain at least, so there are no more passes than partitions."""
    while True:
        after = F.lead("start").over(_in_order())
        link = keys.select("conv_id", "pid", "end", F.coalesce(after, F.array(*[F.lit(x).cast("long") for x in LAST])).alias("want"))
        link = link.where(_level(F.col("want")) != _level(F.col("end")))
        link = scratch.cut(link.select(F.col("conv_id").alias("l_conv"), F.col("pid").alias("l_pid"), _level(F.col("want")).alias("new_end")), "links")
        if link.isEmpty():
            return keys
        # at most two chunks a partition, a few numbers each: as small as the partition count
        joined = keys.join(small(link, 64), F.col("conv_id").eqNullSafe(F.col("l_conv")) & (F.col("pid") == F.col("l_pid")), "left")
        passed = scratch.cut(joined.select(*CHUNK.names, "new_end").mapInArrow(_rerun, CHUNK_DDL), "chunks")
        scratch.free(keys, link)
        keys = passed


def search(rows: DataFrame, scratch: Scratch, rows_per_chunk: int = ROWS) -> DataFrame:
    """(conv_id, pid, turn, fp, audit, cost, stats, low, high): the audit of every chunk; turn and fp are its first row's."""
    spark = rows.sparkSession
    narrow = scratch.cut(_narrow(rows, scratch), "symbols")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(narrow.count() / rows_per_chunk))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("fp").asc_nulls_first()]
    ranged = narrow.repartitionByRange(n, *order).sortWithinPartitions(*order)
    chunks = scratch.cut(ranged.mapInArrow(_chunks, CHUNK_DDL), "chunks")
    # conversations in several partitions; at most one ends and one begins in each partition
    shared = chunks.groupBy("conv_id").agg(F.count("*").alias("parts")).where("parts > 1").select(F.col("conv_id").alias("s_conv"))
    shared = F.broadcast(scratch.cut(shared, "shared"))
    same = F.col("conv_id").eqNullSafe(F.col("s_conv"))
    alone = chunks.join(shared, same, "left_anti")
    keys = scratch.cut(chunks.join(shared, same, "left_semi"), "shared_chunks")
    first = alone.select(*CHUNK.names, F.lit(0).alias("state"), F.lit(True).alias("last"), F.element_at("start", 1).alias("cost"))
    if not keys.isEmpty():
        keys = settled(keys, scratch)
        maps = scratch.cut(keys.select(*_MAPPED).mapInArrow(
            _maps, "conv_id long, pid int, start array<long>, to array<long>"), "maps")
        # the chunks before this one, chained: at most as many as there are partitions
        before = _in_order().rowsBetween(Window.unboundedPreceding, -1)
        state = F.aggregate(F.collect_list("to").over(before), F.lit(0).cast("long"), lambda s, m: F.element_at(m, (s + 1).cast("int")))
        chain = maps.select(F.col("conv_id").alias("m_conv"), F.col("pid").alias("m_pid"),
                            F.coalesce(state, F.lit(0).cast("long")).cast("int").alias("state"), F.lead("pid").over(_in_order()).isNull().alias("last"),
                            F.row_number().over(_in_order()).alias("no"))
        chain = scratch.cut(chain, "chain")
        both = keys.join(small(chain, 32), F.col("conv_id").eqNullSafe(F.col("m_conv")) & (F.col("pid") == F.col("m_pid")))
        # a chunk's end vector has its constant taken off, which is the least entry of the next one's start vector
        cost = F.when(F.col("no") == 1, F.element_at("start", 1)).otherwise(F.array_min("start"))
        first = first.unionByName(both.select(*CHUNK.names, "state", "last", cost.alias("cost")))
    return scratch.cut(first.mapInArrow(_audits, AUDIT_DDL), "audits")


RESULT = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
                    ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
RESULT_DDL = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
_EDIT = re.compile("I*[KDR]")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams each conversation's audits and rows, in order."""
    out = Batches(RESULT)
    names = ("conv_id", "role", "text", "audit", "cost", "stats", "low", "high")
    for (conv,), rows in runs(stream(batches, *names), 1):
        digest, system = hashlib.sha256(), False
        audits, total, edits, tail = [], 0, iter(()), ""
        blank = duplicate = truncated = illegal = distinct = written = 0
        low = high = last_role = None

        def put(role: str, text: str) -> None:
            nonlocal written
            digest.update((("\n" if written else "") + f"{role}:{text}").encode())
            written += 1

        def turn_role() -> str:
            return ("user", "assistant")[(written - system) % 2]

        for _, role, text, audit, cost, stats, lo, hi in rows:
            if audit is not None:
                for _ in tail:
                    put(turn_role(), "")
                edits, tail = iter(_EDIT.findall(audit)), audit[len(audit.rstrip("I")):]
                audits.append(audit)
                total += cost
                n, b, d, t, i, turns, head, last = stats
                blank, duplicate, truncated = blank + b, duplicate + d, truncated + t
                if n:
                    illegal += i + (last_role is not None and (last_role, head) not in LEGAL)
                    last_role = last
                distinct += turns - (turns > 0 and lo == high)
                if turns:
                    low, high = lo if low is None else low, hi
                continue
            edit = next(edits)
            for _ in edit[:-1]:
                put(turn_role(), "")
            if edit[-1] == "K":
                system = system or (written == 0 and role[:1] == "s")
                put(role, text)
            elif edit[-1] == "R":
                put(turn_role(), text)
        for _ in tail:
            put(turn_role(), "")
        gaps = high - low + 1 - distinct if distinct else 0
        audit = "".join(audits)
        yield from out.add((conv, gaps, blank, duplicate, truncated, illegal, total, audit, digest.hexdigest()), len(audit))
    yield from out.flush()


def repair(conversations: DataFrame, rows_per_chunk: int = ROWS) -> DataFrame:
    """One row per conv_id of ``conversations`` (conv_id, turn, role, text), damaged by ``damage`` and repaired."""
    return repair_rows(damage(conversations), rows_per_chunk)


def repair_rows(rows: DataFrame, rows_per_chunk: int = ROWS) -> DataFrame:
    """``repair`` for rows (conv_id, turn, role, text, gone) as they are; a row that is gone only keeps its conversation."""
    ship_package(rows.sparkSession)
    scratch = Scratch(rows.sparkSession, "repair")
    rows = rows.withColumn("conv_id", F.col("conv_id").cast("long")).withColumn("turn", F.col("turn").cast("long"))
    audits = search(rows, scratch, rows_per_chunk)
    none = [F.lit(None).cast(t).alias(c) for c, t in (("audit", "string"), ("cost", "long"), ("stats", "array<long>"), ("low", "long"), ("high", "long"))]
    # a chunk's audit stands before its first row; chunks without rows of their own stand first
    texts = rows.where("NOT gone").select("conv_id", "turn", fingerprint(F.col("role"), F.col("text")).alias("fp"), F.lit(1).alias("kind"),
                                          F.lit(0).alias("pid"), "role", "text", *none)
    heads = audits.select("conv_id", "turn", "fp", F.lit(0).alias("kind"), "pid", F.lit(None).cast("string").alias("role"),
                          F.lit(None).cast("string").alias("text"), "audit", "cost", "stats", "low", "high")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("fp").asc_nulls_first(), F.col("kind"), F.col("pid")]
    stream_ = texts.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order)
    return stream_.mapInArrow(_apply, RESULT_DDL)


def op13_turn_repair(spark, sf_dir: str) -> DataFrame:
    """Contract query: all ``conversations``, damaged and repaired."""
    return repair(read_table(spark, sf_dir, "conversations"))


def _least(*states: str) -> str:
    return f"list_min(list_filter([{', '.join(states)}], lambda z: z IS NOT NULL))"


def _edit(state: str, cost: str, initial: str, line: str | None = None) -> str:
    text = f"{state}.t" if line is None else f"{state}.t || chr(10) || {line}"
    return (f"CASE WHEN {state} IS NOT NULL THEN {{'k': printf('%012d', CAST(substr({state}.k, 1, 12) AS BIGINT) + {cost}) || substr({state}.k, 13) || "
            f"'{initial}', 't': {text}}} END")


def _when(test: str, value: str) -> str:
    return f"CASE WHEN {test} THEN {value} END"


def _oracle() -> str:
    """The edits by dynamic programming over a conversation's rows from first to last: per state the least (cost, audit)."""
    kept, late = "r.role || ':' || r.text", "r.late"
    can, k = "NOT r.must", {x: f"(NOT r.must AND r.i = '{x}')" for x in "sua"}
    rer = {w: f"'{w}:' || r.text" for w in ("user", "assistant")}
    into = {
        0: [_edit("p.s0", "3", "D")],
        1: [_edit("p.s1", "3", "D"), _when(k["s"], _edit("p.s0", late, "K", kept))],
        2: [_edit("p.s2", "3", "D"), *[_when(k["u"], _edit(f"p.s{x}", late, "K", kept)) for x in (0, 1, 3)],
            *[_when(can, _edit(f"p.s{x}", f"2 + {late}", "R", rer["user"])) for x in (0, 1, 3)]],
        3: [_edit("p.s3", "3", "D"), _when(k["a"], _edit("p.s2", late, "K", kept)), _when(can, _edit("p.s2", f"2 + {late}", "R", rer["assistant"]))]}
    raw = ", ".join(f"{_least(*into[s])} AS n{s}" for s in range(4))

    def insert(name: str, role: str) -> str:
        return _edit(name, "2", "I", f"'{role}:'")

    u = _least("n2", *[insert(f"n{x}", "user") for x in (0, 1, 3)])
    state = "STRUCT(k VARCHAR, t VARCHAR)"
    begin = f"CAST({{'k': '000000000000', 't': ''}} AS {state})"
    begin_u = f"CAST({{'k': '000000000002I', 't': chr(10) || 'user:'}} AS {state})"
    begin_a = f"CAST({{'k': '000000000004II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS {state})"
    return f"""WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([CAST(i AS BIGINT)], range(8)),
      lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS x(i))),
    c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
    h AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(k, ''), lambda y: CAST(ascii(y) AS BIGINT))),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind FROM c, tab),
    d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
      CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
      FROM h, range(2) AS copy(no) WHERE kind <> 0 AND (no = 0 OR kind = 3)),
    f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(CAST(length(role) AS VARCHAR) || ':' || role || text)) AS rn,
      NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, substr(role, 1, 1) AS i FROM d),
    g AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 AS dup, lag(i) OVER (PARTITION BY conv_id ORDER BY rn) AS pi FROM f),
    r AS (SELECT *, blank OR dup AS must, CASE WHEN NOT blank AND NOT dup AND NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\\z') THEN 1 ELSE 0 END AS late FROM g),
    s AS (SELECT conv_id, CAST(0 AS BIGINT) AS pos, {begin} AS s0, CAST(NULL AS {state}) AS s1, {begin_u} AS s2, {begin_a} AS s3
      FROM (SELECT DISTINCT conv_id FROM conversations)
      UNION ALL SELECT conv_id, pos, n0, n1, c2, {_least("n3", insert("c2", "assistant"))} FROM (SELECT *, {u} AS c2 FROM (
        SELECT p.conv_id, p.pos + 1 AS pos, {raw} FROM s p JOIN r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.rn = p.pos + 1))),
    e AS (SELECT conv_id, arg_max({_least("s0", "s3")}, pos) AS best FROM s GROUP BY conv_id),
    m AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
      count(*) FILTER (WHERE dup) AS duplicate, CAST(sum(late) AS BIGINT) AS truncated,
      count(*) FILTER (WHERE pi IS NOT NULL AND pi || i NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
      coalesce(illegal, 0) AS illegal, CAST(substr(best.k, 1, 12) AS BIGINT) AS cost, substr(best.k, 13) AS audit, sha256(substr(best.t, 2)) AS repaired_sha256
    FROM e LEFT JOIN m ON e.conv_id IS NOT DISTINCT FROM m.conv_id"""


ORACLE = _oracle()
