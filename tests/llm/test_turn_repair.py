"""Turn repair against exhaustive search and plain dynamic programming, chunk by chunk and as a query."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from pubstrata.llm import turn_repair as T
from pubstrata.llm.common import Scratch

SCHEMA = "conv_id long, turn long, role string, text string"
WANTED = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """(must delete, truncated, blank, duplicate) per (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        blank, dup = not solid, (role, text) in seen
        seen.add((role, text))
        out.append((blank or dup, not blank and not dup and solid[-1] not in ".!?", blank, not blank and dup))
    return out


def best(rows):
    """(cost, audit, repaired) by dynamic programming from first to last row over (initials so far as a state)."""
    def insert(states):
        for _ in range(3):
            for s, (c, a, t) in list(states.items()):
                to, role = T.NEXT[s], "assistant" if s == 2 else "user"
                new = (c + 2, a + "I", t + [f"{role}:"])
                if to not in states or new < states[to]:
                    states[to] = new
        return states

    states = insert({0: (0, "", [])})
    for (role, text), (must, late, _, _) in zip(rows, faults(rows)):
        new = {}
        for s, (c, a, t) in states.items():
            options = [(s, (c + 3, a + "D", t))]
            if not must:
                want = "assistant" if s == 2 else "user"
                options.append((T.NEXT[s], (c + 2 + late, a + "R", t + [f"{want}:{text}"])))
                to = {"s": 1 if s == 0 else None, "u": 2 if s != 2 else None, "a": 3 if s == 2 else None}.get(role[:1])
                if to is not None:
                    options.append((to, (c + late, a + "K", t + [f"{role}:{text}"])))
            for to, value in options:
                if to not in new or value < new[to]:
                    new[to] = value
        states = insert(new)
    return min(states[s] for s in (0, 3) if s in states)


def exhaustive(rows, most):
    """Every audit of at most ``most`` edits that gives wanted initials, the cheapest, ASCII-least one."""
    found = None
    fault = faults(rows)
    for n in range(len(rows), most + 1):
        for audit in itertools.product("DIKR", repeat=n):
            if sum(e != "I" for e in audit) != len(rows):
                continue
            for roles in itertools.product("ua", repeat=sum(e in "IR" for e in audit)):
                left, at, initials, cost, ok = iter(roles), 0, "", 0, True
                for e in audit:
                    if e == "I":
                        initials, cost = initials + next(left), cost + 2
                        continue
                    must, late, _, _ = fault[at]
                    if e == "D":
                        cost += 3
                    elif must:
                        ok = False
                    else:
                        initials += rows[at][0][:1] if e == "K" else next(left)
                        cost += late + (2 if e == "R" else 0)
                    at += 1
                if ok and WANTED.fullmatch(initials):
                    found = min(found or (cost, "".join(audit)), (cost, "".join(audit)))
    return found


def test_dynamic_programming_equals_exhaustive_search():
    rng = random.Random(2)
    for _ in range(25):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", "b", "", "c!"])) for _ in range(rng.randint(0, 4))]
        assert best(rows)[:2] == exhaustive(rows, len(rows) + 2)


def symbols_of(rows):
    out = []
    for (role, _), (must, late, blank, _) in zip(rows, faults(rows)):
        out.append({"s": 0, "u": 1, "a": 2}.get(role[:1], 3) + 4 * (T.BLANK if blank else T.DUPLICATE if must else int(late)))
    return bytes(out)


@pytest.mark.parametrize("mark", [1, 3, 1024])
def test_chunks_fixed_up_in_passes_equal_one_sweep(monkeypatch, mark):
    monkeypatch.setattr(T, "MARK", mark)
    rng = random.Random(mark)
    reruns = 0
    for n in (0, 1, 7, 40, 200):
        for _ in range(10):
            rows = [(rng.choice(["system", "user", "assistant", "user", "assistant", "?"]), rng.choice(["a.", "b", "", f"c{rng.random()}!"])) for _ in range(n)]
            s = symbols_of(rows)
            cuts = sorted(rng.randint(0, n) for _ in range(rng.randint(0, 5)))
            parts = [s[a:b] for a, b in zip([0, *cuts], [*cuts, n])]
            ends, swept = [T.LAST] * len(parts), [T.sweep(p, None, T.LAST) for p in parts]
            while True:
                want = [T.level(swept[i + 1][0]) for i in range(len(parts) - 1)] + [T.LAST]
                again = [i for i in range(len(parts)) if want[i] != ends[i]]
                if not again:
                    break
                for i in again:
                    reruns += 1
                    old = swept[i]
                    swept[i] = T.sweep(parts[i], None, want[i], old[1], old[0])
                    assert swept[i] == T.sweep(parts[i], None, want[i])  # stopping early changes nothing
                    ends[i] = want[i]
            cost = swept[0][0][0] + sum(min(v) for v, _ in swept[1:])
            state, audit = 0, ""
            for i, p in enumerate(parts):
                piece, state = T.trace(p, None, state, ends[i], swept[i][1], i == len(parts) - 1)
                audit += piece
            assert (cost, audit) == best(rows)[:2]
    assert reruns


def test_counted_copies_equal_rows_one_by_one():
    rng = random.Random(9)
    for _ in range(30):
        rows = [(rng.choice(["user", "assistant", "system"]), rng.choice(["", f"{i}.", f"{i}"])) for i in range(8)]
        counts = [rng.choice([1, 1, 3]) for _ in rows]
        flat = [r for r, m in zip(rows, counts) for _ in range(m)]
        # rows of equal text are neighbours here, as in a chunk; blank rows may repeat anywhere
        start, marks = T.sweep(symbols_of(rows), counts, T.LAST)
        audit, _ = T.trace(symbols_of(rows), counts, 0, T.LAST, marks, True)
        assert (start[0], audit) == best(flat)[:2]


def brute(rows, damaged=True):
    out, groups = [], {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kept = groups.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for conv, kept in groups.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        pairs = [(r, t) for _, r, t in kept]
        fault = faults(pairs)
        cost, audit, repaired = best(pairs)
        turns = {t for t, _, _ in kept if t is not None}
        i = [r[:1] for r, _ in pairs]
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, sum(f[2] for f in fault), sum(f[3] for f in fault),
                    sum(f[1] for f in fault), sum(a + b not in ("su", "ua", "au") for a, b in zip(i, i[1:])), cost, audit,
                    hashlib.sha256("\n".join(repaired).encode()).hexdigest()))
    return sorted(out, key=str)


def odd_rows():
    rng = random.Random(11)
    rows = [(5, None, None, None), (5, None, "user", "x."), (5, 1, "assistant", "x."), (5, 1, "assistant", "x."), (5, 1, "assistant", "x."),
            (None, 3, "system", "s."), (None, 4, "user", "a\nb"), (None, 4, "user", "a\nb"), (6, 2, "tool", "t!"), (6, 9, "", "t!"), (7, 0, "user", " \n\t"),
            (2**60 + 1, 1, "user", "q? "), (2**60 + 1, 2, "assistant", "w " * 70000 + "."), (8, 1, "system", "only."), (-1, 0, "assistant", "é\u0085")]
    for t in range(300):  # one conversation with a third of all rows and more
        rows.append((9, t // 3 if t % 7 else None, rng.choice(["system", "user", "assistant", "assistant", "user"]), rng.choice(["a.", "b", "", f"{t}?", f"{t}", "same!"])))
    for c in range(100, 140):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, ("user", "assistant")[t % 2], f"{c} {t}" + rng.choice([".", "", "!"])))
    return rows


def test_query_equals_brute_force_with_any_chunks(spark):
    rows = odd_rows()
    c = spark.createDataFrame([(*r, 1, "k", True) for r in rows], SCHEMA + ", pid int, fp string, gone boolean").repartition(5)
    want = brute(rows)
    for per_chunk in (T.ROWS, 9):  # 9 rows a partition: the long conversation lies in dozens of them
        got = T.repair(c.select("conv_id", "turn", "role", "text", "pid", "fp"), per_chunk).collect()
        assert sorted((tuple(r) for r in got), key=str) == want


def test_undamaged_rows_and_long_deleted_runs(spark):
    """Chunks of blank rows pass any vector on; several passes are needed."""
    rows = [(1, 0, "system", "s."), *[(1, t, "user", "") for t in range(1, 90)], (1, 90, "assistant", "a."), (1, 91, "user", "b."),
            *[(1, t, "assistant", " ") for t in range(92, 130)], (2, 0, "user", "hi."), (2, 1, "assistant", "yo.")]
    c = spark.createDataFrame([(*r, False) for r in rows], SCHEMA + ", gone boolean")
    got = T.repair_rows(c, 7).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, damaged=False)


def test_empty_table_and_contract_query(spark, sf, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert T.op13_turn_repair(spark, str(tmp_path)).collect() == []
    got = sorted((tuple(r) for r in T.op13_turn_repair(spark, sf).collect()), key=str)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    rows = con.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    assert got == brute(rows) == sorted((tuple(r) for r in con.sql(T.ORACLE).fetchall()), key=str)


def test_oracle_on_odd_rows(spark):
    rows = odd_rows()
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert sorted((tuple(r) for r in con.sql(T.ORACLE).fetchall()), key=str) == brute(rows)


def test_narrow_rows_count_copies(spark):
    rows = [(1, 1, "user", "x.")] * 50 + [(1, 2, "user", "x.")] * 3
    c = spark.createDataFrame([(*r, False) for r in rows], SCHEMA + ", gone boolean")
    got = {(r.turn, r.symbol): r.n for r in T._narrow(c, Scratch(spark, "t")).collect()}
    assert got == {(1, 1): 50, (2, 1 + 4 * T.DUPLICATE): 3}
    assert T.repair_rows(c).select(F.sum("duplicate")).first()[0] == 52
