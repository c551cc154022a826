"""Secret scan over a trigram inverted index (DataFrame functions only).

Each rule's regular expression is turned into a Boolean trigram query: an AND of
ORs of ANDs of trigrams that every match must contain (``trigram_query``). The
index holds one posting (trigram, doc_id) per document and trigram of the rules'
vocabulary. Intersecting postings gives each rule's candidate documents, and only
those are verified with the regular expression. A rule without a mandatory trigram
(``hex``) has no query and scans every document.

Postings are grouped by document, never by trigram, so a trigram that occurs
everywhere is no hot key. Candidates are superset keys by ``doc_id``, therefore
repeated or null ids cost only extra verification, never a wrong span.

Defined results: null text counts as empty; an empty or secret-free text has no
spans; every input row gives one output row, repeated and null ids included; only
``doc_id`` and ``text`` are read, so extra columns of any name don't matter.
"""

from __future__ import annotations

import functools
import re._constants as RC
import re._parser as RP
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubstrata.llm.common import Scratch, col, packed, read_table, rows_of, small


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    min_chars: int = 1      # of group ``group``; shorter matches are dropped
    group: int = 0


#: the contract's three kinds, in its order
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
)
#: further kinds of this operator
EXTRA = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36}[A-Za-z0-9]*"),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10}[A-Za-z0-9-]*"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16}[A-Za-z0-9]*"),
    Rule("url_login", r"://[A-Za-z0-9._~-]+:[A-Za-z0-9._~!$%-]+@"),
)
RULES = BASE + EXTRA
MAX_STRINGS = 64


# ---- regular expression -> Boolean trigram query ---------------------------------------------

def _strings(node, ignore_case_only_ascii=True) -> set[str] | None:
    """All strings (lower case) a parsed item can match, or None if too many or unbounded."""
    op, arg = node
    if op is RC.LITERAL:
        return {chr(arg).lower()}
    if op is RC.AT:
        return {""}
    if op is RC.IN:
        out = set()
        for kind, x in arg:
            if kind is RC.LITERAL:
                out.add(chr(x).lower())
            elif kind is RC.RANGE and x[1] - x[0] < MAX_STRINGS:
                out |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is RC.SUBPATTERN:
        return _sequence_strings(arg[3])
    if op is RC.BRANCH:
        parts = [_sequence_strings(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is RC.MAX_REPEAT and arg[1] != RC.MAXREPEAT and arg[1] <= 4:
        one, out = _sequence_strings(arg[2]), set()
        if one is None:
            return None
        for n in range(arg[0], arg[1] + 1):
            grown = {""}
            for _ in range(n):
                grown = {a + b for a in grown for b in one}
                if len(grown) > MAX_STRINGS:
                    return None
            out |= grown
        return out
    return None


def _sequence_strings(seq) -> set[str] | None:
    out = {""}
    for node in seq:
        s = _strings(node)
        if s is None:
            return None
        out = {a + b for a in out for b in s}
        if len(out) > MAX_STRINGS:
            return None
    return out


def _runs(seq) -> list[set[str]]:
    """Sets of strings of which every match contains one each."""
    runs, now = [], {""}
    for node in seq:
        s = _strings(node)
        if s is not None and len(now) * len(s) <= MAX_STRINGS:
            now = {a + b for a in now for b in s}
            continue
        runs.append(now)
        now = s if s is not None else {""}
        if s is None and node[0] is RC.SUBPATTERN:
            runs += _runs(node[1][3])
        elif s is None and node[0] is RC.MAX_REPEAT and node[1][0] >= 1:
            runs += _runs(node[1][2])
    return [*runs, now]


def trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


@functools.cache
def trigram_query(pattern: str) -> tuple[tuple[frozenset[str], ...], ...]:
    """AND over OR over sets of trigrams that must all occur (in lower case); () if nothing is mandatory."""
    query = []
    for run in _runs(RP.parse(pattern)):
        need = {trigrams(s) for s in run}
        if frozenset() not in need:
            query.append(tuple(sorted((n for n in need if not any(m < n for m in need)), key=sorted)))
    return tuple(query)


def vocabulary(rules=RULES) -> list[str]:
    return sorted({t for r in rules for clause in trigram_query(r.pattern) for need in clause for t in need})


# ---- index and candidates --------------------------------------------------------------------

def postings(docs: DataFrame, vocab: list[str]) -> DataFrame:
    """(gram, doc_id): one row per document and vocabulary trigram in its text, case folded."""
    low = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("low"))
    hits = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(vocab)]))
    return low.select("doc_id", F.explode(hits).alias("gram"))


def candidates(index: DataFrame, rules, vocab: list[str]) -> DataFrame:
    """(doc_id, rules): numbers of the rules whose trigram query the document's postings satisfy."""
    number = {t: i for i, t in enumerate(vocab)}
    have = F.col("grams")

    def clause(alternatives) -> Column:
        tests = []
        for need in alternatives:
            ids = F.array(*[F.lit(number[t]) for t in sorted(need)])
            tests.append(F.size(F.array_intersect(have, ids)) == len(need))
        return functools.reduce(lambda a, b: a | b, tests)

    met = []
    for i, r in enumerate(rules):
        query = trigram_query(r.pattern)
        if query:
            met.append(F.when(functools.reduce(lambda a, b: a & b, [clause(c) for c in query]), F.lit(i)))
    lists = index.groupBy("doc_id").agg(F.collect_set("gram").alias("grams"))
    out = lists.select("doc_id", F.array_compact(F.array(*met)).alias("rules"))
    return out.where(F.size("rules") > 0)


# ---- verification ----------------------------------------------------------------------------

SPAN = "array<struct<start:int,rank:int,end:int>>"
BLOCK = 128     # elements that a running value appends one by one; blocks are joined once


def _blocks(xs: Column) -> Column:
    """An array cut into arrays of ``BLOCK`` elements."""
    last = F.floor((F.size(xs) - 1) / BLOCK).cast("int")
    return F.when(F.size(xs) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(xs, i * BLOCK + 1, BLOCK))).otherwise(F.array())


def running(xs: Column, plus) -> Column:
    """What ``plus`` (associative, from 0 on) makes of the integers before each element.

    Appending copies the array, so it is done within blocks and over the blocks only: the work grows little faster than the array.
    """
    def scan_(ys):
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(ys, start, lambda acc, y: F.struct(plus(acc.at, y).alias("at"), F.concat(acc.out, F.array(acc.at)).alias("out")))

    def joined(parts):
        before = scan_(F.transform(parts, lambda p: p.at)).out
        return F.flatten(F.zip_with(parts, before, lambda p, o: F.transform(p.out, lambda y: plus(o, y))))

    # one-element arrays, so that the integers and the blocks are computed once
    parts = F.transform(F.array(xs), lambda x: F.transform(_blocks(x), scan_))
    return F.transform(parts, joined)[0]


def rule_spans(text: Column, rank: int, rule: Rule) -> Column:
    """Leftmost non-overlapping matches as (start, rank, end) in code points, end exclusive.

    The text between matches (``split``) and the matches themselves alternate, so
    running sums of their lengths are the offsets.
    """
    p = F.lit(rule.pattern)
    hit, gap = F.regexp_extract_all(text, p, F.lit(0)), F.split(text, rule.pattern, -1)
    part = F.regexp_extract_all(text, p, F.lit(rule.group)) if rule.group else hit
    steps = F.zip_with(F.zip_with(gap, hit, lambda g, h: F.struct(F.length(g).alias("g"), F.coalesce(F.length(h), F.lit(0)).alias("h"))), part,
                       lambda s, x: F.struct(s.g.alias("g"), s.h.alias("h"), F.length(x).alias("x")))

    def placed(steps):
        at = running(F.transform(steps, lambda s: s.g + s.h), lambda a, b: a + b)
        spans = F.zip_with(steps, at, lambda s, o: F.struct((o + s.g).alias("start"), F.lit(rank).alias("rank"), (o + s.g + s.h).alias("end"), s.x.alias("x")))
        kept = F.filter(spans, lambda s: s.x >= rule.min_chars)
        return F.transform(kept, lambda s: F.struct(s.start.alias("start"), s["rank"].alias("rank"), s.end.alias("end")))

    return F.transform(F.array(steps), placed)[0].cast(SPAN)


def scan(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: row_ (all input columns), spans (start, rank, end; sorted by start, then rule order)."""
    scratch = Scratch(docs.sparkSession, "secrets")
    vocab = vocabulary(rules)
    keyed = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    index = scratch.cut(postings(keyed, vocab), "postings")
    found = scratch.cut(candidates(index, rules, vocab), "candidates")
    scratch.free(index)
    found = small(found.select(F.col("doc_id").alias("cand_id"), "rules"), 24 + 4 * len(rules))
    base = packed(docs).select("row_", F.col("row_").getField(id_col).alias("key_"),
                               F.coalesce(F.col("row_").getField(text_col), F.lit("")).alias("text_"))
    joined = base.join(found, F.col("key_").eqNullSafe(F.col("cand_id")), "left")
    spans, none = [], F.array().cast(SPAN)
    for i, r in enumerate(rules):
        # a run of the class decides first: cheap, and most texts have no match
        may = F.array_contains("rules", F.lit(i)) if trigram_query(r.pattern) else F.rlike("text_", F.lit(_gate(r)))
        spans.append(F.when(may, rule_spans(F.col("text_"), i, r)).otherwise(none))
    return joined.select("row_", F.array_sort(F.concat(*spans)).alias("spans"))


def _gate(rule: Rule) -> str:
    """For a class repeated: the same with its least length; else the pattern itself."""
    return rule.pattern[:-1] + "{%d}" % rule.min_chars if rule.pattern.endswith("]+") and not rule.group else rule.pattern


def span_text(spans: Column, rules=RULES) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ",")


def redact(docs: DataFrame, rules=RULES) -> DataFrame:
    """The documents with every secret replaced by ``[kind]``; ``n_chars`` follows, other columns stay.

    Overlapping spans become one replacement, named after the first.
    """
    found = scan(docs, rules)
    kinds = F.array(*[F.lit(f"[{r.kind}]") for r in rules])
    text = F.col("row_.text")
    ends = F.transform("spans", lambda s: s.end)

    def pieces(part):
        """A block's text up to its last span, every span replaced; the text is entered once per block, not once per span."""
        base, stop = part[0]["at"], F.element_at(part, -1)["start"]
        return F.transform(F.array(F.substring(text, base + 1, stop - base)), lambda t: F.array_join(F.transform(
            part, lambda s: F.concat(F.substring(t, s["at"] - base + 1, s["start"] - s["at"]), F.element_at(kinds, s["rank"] + 1))), ""))[0]

    # at: the end of the spans before
    spans = F.zip_with("spans", running(ends, F.greatest), lambda s, o: F.struct(s.start.alias("start"), s["rank"].alias("rank"), o.alias("at")))
    first = F.filter(spans, lambda s: s.start >= s["at"])
    rest = F.substring(text, F.array_max(ends) + 1, F.length(text))
    clean = F.concat(F.transform(F.array(first), lambda x: F.array_join(F.transform(_blocks(x), pieces), ""))[0], rest)
    new = F.when(F.size("spans") > 0, clean).otherwise(text)
    out = found.select("row_", new.alias("new_"), (F.size("spans") > 0).alias("hit_"))
    cols = []
    for c in docs.columns:
        old = F.col("row_").getField(c)
        if c == "text":
            old = F.col("new_")
        elif c == "n_chars":
            old = F.when(F.col("hit_"), F.length("new_").cast("long")).otherwise(old)
        cols.append(old.alias(c))
    return out.select(*cols)


def op1_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Contract query: secrets of every document of ``documents``."""
    found = scan(rows_of(read_table(spark, sf_dir, "documents"), "doc_id", "text"))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["rank"] < len(BASE))

    def count(i):
        return F.size(F.filter(spans, lambda s: s["rank"] == i)).cast("long")

    return found.select(
        F.col("row_.doc_id").alias("doc_id"),
        *[count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )


# ---- oracle ------------------------------------------------------------------------------------

def _oracle() -> str:
    ctes = []
    for i, r in enumerate(RULES):
        pat = r.pattern.replace("'", "''")
        ctes.append(f"""r{i} AS (SELECT rid, list_filter(list_transform(range(1, len(m) + 1), lambda k: {{
            'start': coalesce(list_sum(list_transform(g[1:k], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0),
            'rank': {i}, 'len': length(m[k]), 'part': length(p[k])}}), lambda z: z.part >= {r.min_chars}) AS s
          FROM (SELECT rid, regexp_extract_all(t, '{pat}', 0) AS m, regexp_extract_all(t, '{pat}', {r.group}) AS p,
                       string_split_regex(t, '{pat}') AS g FROM d))""")
    kinds = "[" + ", ".join(f"'{r.kind}'" for r in RULES) + "]"
    joined = " ".join(f"JOIN r{i} USING (rid)" for i in range(len(RULES)))
    allspans = "list_concat(" * (len(RULES) - 1) + "r0.s" + "".join(f", r{i}.s)" for i in range(1, len(RULES)))
    text = "coalesce(list_aggregate(list_transform({}, lambda z: {}[z.rank + 1] || ':' || z.start || ':' || (z.start + z.len)), 'string_agg', ','), '')"
    base = "list_filter(s, lambda z: z.rank < 3)"
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
    {", ".join(ctes)},
    a AS (SELECT d.doc_id, list_sort({allspans}) AS s FROM d {joined})
    SELECT doc_id, CAST(len(list_filter(s, lambda z: z.rank = 0)) AS BIGINT) AS n_assign,
      CAST(len(list_filter(s, lambda z: z.rank = 1)) AS BIGINT) AS n_access, CAST(len(list_filter(s, lambda z: z.rank = 2)) AS BIGINT) AS n_hex,
      sha256({text.format(base, kinds)}) AS base_sha256, {text.format('s', kinds)} AS spans FROM a"""


ORACLE = _oracle()
