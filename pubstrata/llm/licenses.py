"""License scan by template-markup matching.

A template is license wording with markup: ``<<beginOptional>>...<<endOptional>>``
may be left out as a whole, ``<<var;N>>`` stands for up to N words of any kind. Each
template is compiled into an automaton over words (``compile_template``); a text has
the template's label where the automaton accepts, that is where all mandatory wording
stands word for word. Base phrases are plain automata of their own, whose every place
counts.

The score is 1 where a template accepts, else the largest share of a template's
mandatory words matched in order from its beginning, but at least 0.5 where a base
phrase stands.

Automata are a handful of words each and go to the tasks with the function; documents
are not shuffled. Defined results: null text is empty; an empty text has no words, no
places, empty labels and score 0; each input row gives one row, repeats and null ids
included; only doc_id and text are read; very long texts are one pass over their words.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from pubstrata.llm.common import ASCII_LOWER, map_frames, read_table, rows_of, ship_package

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: fixed by the contract: phrase and label
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

TEMPLATES = (
    ("apache", "licensed under the apache license <<beginOptional>>version<<endOptional>> 2.0"),
    ("apache-header", "licensed under the apache license <<beginOptional>>version<<endOptional>> 2.0 <<beginOptional>>the license<<endOptional>>"
     " you may not use this file except in compliance with the license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software <<beginOptional>>and associated"
     " documentation files<<endOptional>> <<var;4>> to deal in <<var;2>> software without restriction"),
    ("mit-notice", "<<beginOptional>>licensed<<endOptional>> <<beginOptional>>released<<endOptional>> under the mit license"),
    ("isc", "permission to use copy modify and <<beginOptional>>or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl-notice", "<<beginOptional>>licensed<<endOptional>> <<beginOptional>>released<<endOptional>> under <<beginOptional>>the terms of<<endOptional>>"
     " the gnu <<var;1>> general public license <<beginOptional>>version <<var;1>><<endOptional>>"),
    ("cc-by-notice", "licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>> <<beginOptional>>creative commons<<endOptional>> cc by"
     " <<var;2>>"),
    ("creative-commons", "creative commons attribution <<var;3>> <<beginOptional>>international<<endOptional>> license"),
    ("copyright", "copyright <<beginOptional>>c<<endOptional>> <<var;6>> all rights reserved"),
)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(ASCII_LOWER))


class Automaton:
    """Nondeterministic automaton over words; states are numbers, ``depth`` counts the mandatory words before a state."""

    def __init__(self):
        self.step: list[dict[str, list[int]]] = []
        self.any: list[list[int]] = []
        self.free: list[list[int]] = []
        self.depth: list[int] = []

    def state(self, depth: int) -> int:
        self.step.append(defaultdict(list))
        self.any.append([])
        self.free.append([])
        self.depth.append(depth)
        return len(self.step) - 1

    def closure(self, states) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    def finish(self, end: int) -> "Automaton":
        self.end, self.total = end, max(1, self.depth[end])
        self.begin = self.closure([0])
        self.first = {w for s in self.begin for w in self.step[s]}
        return self

    def run(self, words: list[str], at: int) -> tuple[int | None, int]:
        """(end of the longest accepted run, most mandatory words matched) from word ``at``."""
        states, accepted, best = self.begin, None, 0
        for i in range(at, len(words)):
            into = [t for s in states for t in self.step[s].get(words[i], ())] + [t for s in states for t in self.any[s]]
            if not into:
                break
            states = self.closure(into)
            best = max(best, max(self.depth[s] for s in states))
            if self.end in states:
                accepted = i + 1
        return accepted, best


def compile_template(text: str) -> Automaton:
    auto = Automaton()
    now, optional = auto.state(0), []
    for part in re.split(r"(<<.*?>>)", text):
        if part == "<<beginOptional>>":
            optional.append(now)
        elif part == "<<endOptional>>":
            begin = optional.pop()
            join = auto.state(auto.depth[begin])
            auto.free[begin].append(join)
            auto.free[now].append(join)
            now = join
        elif m := re.fullmatch(r"<<var;(\d+)>>", part):
            chain = [now]
            for _ in range(int(m[1])):
                chain.append(auto.state(auto.depth[now]))
                auto.any[chain[-2]].append(chain[-1])
            end = auto.state(auto.depth[now])
            for s in chain:
                auto.free[s].append(end)
            now = end
        else:
            for w in words_of(part):
                to = auto.state(auto.depth[now] + (not optional))
                auto.step[now][w].append(to)
                now = to
    if optional:
        raise ValueError("an optional region is not closed")
    return auto.finish(now)


@functools.cache
def automata(templates) -> list[tuple[str, Automaton]]:
    return [(label, compile_template(text)) for label, text in templates]


def match(words: list[str], templates=TEMPLATES) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], float]:
    """(base places, template places, score); places are (label, first word, end)."""
    base, own = automata(tuple((label, phrase) for phrase, label in BASE)), automata(templates)
    starts = defaultdict(list)
    for kind, group in ((0, base), (1, own)):
        for label, auto in group:
            for w in auto.first:
                starts[w].append((kind, label, auto))
    found, score = ([], []), 0.0
    for i, w in enumerate(words):
        if w in starts:
            for kind, label, auto in starts[w]:
                end, best = auto.run(words, i)
                if end is not None:
                    found[kind].append((label, i, end))
                if kind:
                    score = max(score, 1.0 if end is not None else best / auto.total)
    return found[0], found[1], max(score, 0.5) if found[0] else min(score, 1.0)


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "places array<struct<label:string,start:long,end:long>>")


def _scan(templates):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                words = words_of(text)
                base, own, score = match(words, templates)
                at = [s for _, s, _ in base]
                names = {x for x, _, _ in base}
                rows.append((len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(names)),
                             ",".join(sorted(names | {x for x, _, _ in own})), score,
                             [{"label": x, "start": s, "end": e} for x, s, e in sorted(base + own, key=lambda p: (p[1], p[2], p[0]))]))
            out = pd.DataFrame(rows, columns=[c.strip().split()[0] for c in SCHEMA.split(", ")][1:])
            yield out.assign(doc_id=pdf["doc_id"]).astype({"first_word": "Int64", "last_word": "Int64"})
    return run


def scan_licenses(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per input row with its license places, labels and score."""
    ship_package(docs.sparkSession)
    return map_frames(rows_of(docs, "doc_id", "text"), _scan(tuple(templates)), SCHEMA)


def op10_licenses(spark, sf_dir: str) -> DataFrame:
    """Contract query: license wording in ``documents``."""
    return scan_licenses(read_table(spark, sf_dir, "documents")).drop("places")
