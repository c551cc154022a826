"""A sandboxed template language for chat formats, compiled to Python closures.

Syntax (a small subset of the usual double-brace templates)::

    text {{ expression }} {# comment #}
    {% if e %} .. {% elif e %} .. {% else %} .. {% endif %}
    {% for m in messages %} .. {% endfor %}
    {% set name = e %}    {% generation %} .. {% endgeneration %}

A ``-`` inside a delimiter (``{%-``, ``-}}``) strips the white space beside it. Expressions have strings, integers,
true, false, none, names, ``a.b``, ``a['b']``, comparisons, ``in``, ``and or not``, ``+``, ``~`` (text concatenation),
``a if c else b``, ``is defined`` and filters. Nothing can be called but the filters in ``FILTERS``; a ``.`` reads keys
of mappings only, never Python attributes; loops run over the given messages only, so every template ends.

``parse`` gives a syntax tree of tuples, ``fold`` evaluates its constant parts and joins neighbouring texts, ``compile_template``
turns the tree into closures. A compiled statement is a generator of pieces (text, under a generation marker); a loop over the
messages reads them one at a time and yields ``BREAK`` after each, so that a conversation of any length is rendered
without being held. A template may loop over the messages once, and not inside another loop.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

#: yielded after each message
BREAK = ("", None)

_CONTROL = re.compile(r"<(\\*)\|")
_CONTROL_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """Control strings begin with ``<|``; a backslash between the two, one more where there are some, breaks them up."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _CONTROL_ESCAPED.sub(r"<\1|", text)


def escape_line(text: str) -> str:
    """``escape`` for a value that a line break ends."""
    return escape(text.replace("%", "%25").replace("\n", "%0A"))


def unescape_line(text: str) -> str:
    return unescape(text).replace("%0A", "\n").replace("%25", "%")


def _text(v) -> str:
    return "" if v is None else v if isinstance(v, str) else ("false", "true")[v] if isinstance(v, bool) else str(v)


FILTERS: dict[str, Callable] = {
    "escape": lambda v: escape(_text(v)), "escape_line": lambda v: escape_line(_text(v)), "trim": lambda v: _text(v).strip(),
    "lower": lambda v: _text(v).lower(), "upper": lambda v: _text(v).upper(), "length": lambda v: len(_text(v)), "string": _text}


class TemplateError(ValueError):
    pass


# ---- lexer -------------------------------------------------------------------------------------

_BLOCK = re.compile(r"\{\{-?(.*?)-?\}\}|\{%-?(.*?)-?%\}|\{#-?.*?-?#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|<=|>=|[<>+~|.()\[\]=]))""")
_ESCAPED = {"n": "\n", "t": "\t", "r": "\r"}


def blocks(source: str) -> list[tuple[str, str]]:
    """("text" | "out" | "tag", content) in order."""
    out, at, strip = [], 0, False
    for m in _BLOCK.finditer(source):
        text = source[at:m.start()]
        text = text.lstrip() if strip else text
        out.append(("text", text.rstrip() if m[0][2] == "-" else text))
        if m[1] is not None or m[2] is not None:
            out.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at, strip = m.end(), m[0][-3] == "-"
    rest = source[at:]
    out.append(("text", rest.lstrip() if strip else rest))
    return [b for b in out if b != ("text", "")]


class Tokens:
    def __init__(self, code: str):
        self.items, at = [], 0
        while code[at:].strip():
            m = _TOKEN.match(code, at)
            if not m:
                raise TemplateError(f"cannot read {code[at:]!r}")
            self.items.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self, *values: str) -> bool:
        return self.at < len(self.items) and self.items[self.at][0] != "str" and self.items[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.items[self.at - 1][1]
        return None

    def need(self, *values: str) -> str:
        got = self.take(*values)
        if got is None:
            raise TemplateError(f"expected {' or '.join(values)}")
        return got

    def name(self) -> str:
        if self.at >= len(self.items) or self.items[self.at][0] != "name":
            raise TemplateError("expected a name")
        self.at += 1
        got = self.items[self.at - 1][1]
        if got.startswith("_"):
            raise TemplateError(f"names begin with a letter: {got}")
        return got

    def end(self) -> None:
        if self.at < len(self.items):
            raise TemplateError(f"unexpected {self.items[self.at][1]!r}")


# ---- parser: expressions ("const", v), ("name", n), ("get", e, key), ("bin", op, a, b), ... -----

def _expression(t: Tokens) -> tuple:
    value = _or(t)
    if t.take("if"):
        test = _or(t)
        t.need("else")
        return ("cond", test, value, _expression(t))
    return value


def _or(t: Tokens) -> tuple:
    left = _and(t)
    while t.take("or"):
        left = ("or", left, _and(t))
    return left


def _and(t: Tokens) -> tuple:
    left = _not(t)
    while t.take("and"):
        left = ("and", left, _not(t))
    return left


def _not(t: Tokens) -> tuple:
    return ("not", _not(t)) if t.take("not") else _compare(t)


def _compare(t: Tokens) -> tuple:
    left = _sum(t)
    while True:
        if t.take("is"):
            negated = t.take("not")
            t.need("defined")
            left = ("defined", left)
            left = ("not", left) if negated else left
        elif op := t.take("==", "!=", "<", ">", "<=", ">=", "in"):
            left = ("bin", op, left, _sum(t))
        else:
            return left


def _sum(t: Tokens) -> tuple:
    left = _postfix(t)
    while op := t.take("+", "~"):
        left = ("bin", op, left, _postfix(t))
    return left


def _postfix(t: Tokens) -> tuple:
    e = _atom(t)
    while op := t.take(".", "[", "|"):
        if op == ".":
            e = ("get", e, ("const", t.name()))
        elif op == "[":
            e = ("get", e, _expression(t))
            t.need("]")
        else:
            name = t.name()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name}")
            e = ("filter", name, e)
    return e


def _atom(t: Tokens) -> tuple:
    if t.take("("):
        e = _expression(t)
        t.need(")")
        return e
    if t.at >= len(t.items):
        raise TemplateError("expected a value")
    kind, value = t.items[t.at]
    if kind == "op":
        raise TemplateError(f"unexpected {value!r}")
    if kind == "name":
        word = t.name()
        return ("const", {"true": True, "false": False, "none": None}[word]) if word in ("true", "false", "none") else ("name", word)
    t.at += 1
    if kind == "int":
        return ("const", int(value))
    return ("const", re.sub(r"\\(.)", lambda m: _ESCAPED.get(m[1], m[1]), value[1:-1], flags=re.S))


# ---- parser: statements ("text", s), ("out", e), ("if", [(e, body)], else), ("for", name, e, body), ... --

def parse(source: str) -> list[tuple]:
    items = blocks(source)
    body, at, _ = _body(items, 0, ())
    if at < len(items):
        raise TemplateError(f"unexpected {items[at][1]!r}")
    return body


def _whole(code: str) -> tuple:
    t = Tokens(code)
    e = _expression(t)
    t.end()
    return e


def _body(items, at: int, ends: tuple[str, ...]) -> tuple[list[tuple], int, str]:
    """Statements up to a tag whose word is in ``ends``."""
    out: list[tuple] = []
    while at < len(items):
        kind, code = items[at]
        at += 1
        if kind == "text":
            out.append(("text", code))
            continue
        if kind == "out":
            out.append(("out", _whole(code)))
            continue
        word, _, rest = code.partition(" ")
        if word in ends:
            return out, at, code
        if word == "if":
            arms, other, test = [], [], _whole(rest)
            while True:
                inner, at, tag = _body(items, at, ("elif", "else", "endif"))
                if test is None:
                    other = inner
                else:
                    arms.append((test, inner))
                if tag == "endif":
                    break
                if test is None:
                    raise TemplateError("a branch after else")
                test = _whole(tag.partition(" ")[2]) if tag.startswith("elif") else None
            out.append(("if", arms, other))
        elif word == "for":
            t = Tokens(rest)
            name = t.name()
            t.need("in")
            over = _expression(t)
            t.end()
            inner, at, _ = _body(items, at, ("endfor",))
            out.append(("for", name, over, inner))
        elif word == "set":
            t = Tokens(rest)
            name = t.name()
            t.need("=")
            out.append(("set", name, _expression(t)))
            t.end()
        elif word == "generation":
            inner, at, _ = _body(items, at, ("endgeneration",))
            out.append(("generation", inner))
        else:
            raise TemplateError(f"no tag {word}")
    if ends:
        raise TemplateError(f"{' or '.join(ends)} is missing")
    return out, at, ""


# ---- constant folding --------------------------------------------------------------------------

def fold_expression(e: tuple) -> tuple:
    """``e`` with every part that holds no name replaced by its value."""
    if e[0] in ("const", "name"):
        return e
    parts = tuple(fold_expression(p) if isinstance(p, tuple) else p for p in e)
    kids = [p for p in parts if isinstance(p, tuple)]
    if e[0] == "cond" and parts[1][0] == "const":
        return parts[2] if parts[1][1] else parts[3]
    if e[0] in ("and", "or") and parts[1][0] == "const":
        return parts[2] if bool(parts[1][1]) == (e[0] == "and") else parts[1]
    if e[0] != "defined" and all(k[0] == "const" for k in kids):
        return ("const", _expr(parts)({}))
    return parts


def fold(body: list[tuple]) -> list[tuple]:
    """The statements with folded expressions, decided branches taken and neighbouring texts joined."""
    out: list[tuple] = []

    def add(statements: Iterable[tuple]) -> None:
        for s in statements:
            if s[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + s[1])
            elif s != ("text", ""):
                out.append(s)

    for s in body:
        if s[0] == "out":
            e = fold_expression(s[1])
            add([("text", _text(e[1])) if e[0] == "const" else ("out", e)])
        elif s[0] == "if":
            arms, other, decided = [], fold(s[2]), False
            for test, inner in s[1]:
                test = fold_expression(test)
                if test[0] != "const":
                    arms.append((test, fold(inner)))
                elif test[1]:
                    other, decided = fold(inner), True
                if decided:
                    break
            add([("if", arms, other)] if arms else other)
        elif s[0] == "for":
            add([("for", s[1], fold_expression(s[2]), fold(s[3]))])
        elif s[0] == "set":
            add([("set", s[1], fold_expression(s[2]))])
        elif s[0] == "generation":
            inner = fold(s[1])
            add([("generation", inner)] if inner else [])
        else:
            add([s])
    return out


# ---- closures ----------------------------------------------------------------------------------

def _get(value, key):
    return value.get(key) if isinstance(value, dict) else None


_BINARY: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b, "in": lambda a, b: _text(a) in _text(b), "~": lambda a, b: _text(a) + _text(b),
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b)}


def _expr(e: tuple) -> Callable:
    kind = e[0]
    if kind == "const":
        value = e[1]
        return lambda scope: value
    if kind == "name":
        name = e[1]
        return lambda scope: scope.get(name)
    if kind == "get":
        base, key = _expr(e[1]), _expr(e[2])
        return lambda scope: _get(base(scope), key(scope))
    if kind == "filter":
        run, inner = FILTERS[e[1]], _expr(e[2])
        return lambda scope: run(inner(scope))
    if kind == "defined":
        inner = _expr(e[1])
        return lambda scope: inner(scope) is not None
    if kind == "not":
        inner = _expr(e[1])
        return lambda scope: not inner(scope)
    if kind == "cond":
        test, yes, no = (_expr(x) for x in e[1:])
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if kind in ("and", "or"):
        a, b = _expr(e[1]), _expr(e[2])
        return (lambda scope: a(scope) and b(scope)) if kind == "and" else (lambda scope: a(scope) or b(scope))
    run, a, b = _BINARY[e[1]], _expr(e[2]), _expr(e[3])
    return lambda scope: run(a(scope), b(scope))


def _statement(s: tuple, marked: bool) -> Callable[[dict], Iterator[tuple]]:
    kind = s[0]
    if kind == "text":
        piece = (s[1], marked)

        def text(scope):
            yield piece
        return text
    if kind == "out":
        value = _expr(s[1])

        def out(scope):
            yield _text(value(scope)), marked
        return out
    if kind == "set":
        name, value = s[1], _expr(s[2])

        def put(scope):
            scope[name] = value(scope)
            return
            yield
        return put
    if kind == "generation":
        return _sequence(s[1], True)
    if kind == "if":
        arms, other = [(_expr(t), _sequence(b, marked)) for t, b in s[1]], _sequence(s[2], marked)

        def choose(scope):
            for test, inner in arms:
                if test(scope):
                    yield from inner(scope)
                    return
            yield from other(scope)
        return choose
    name, body = s[1], _sequence(s[3], marked)
    if s[2] != ("name", "messages"):
        raise TemplateError("loops run over messages")

    def loop(scope):
        rows, index = iter(scope["messages"]), 0
        now = next(rows, None)
        while now is not None:
            after = next(rows, None)
            inner = scope | {name: now, "loop": {"first": index == 0, "last": after is None, "index": index + 1, "index0": index}}
            yield from body(inner)
            yield BREAK
            now, index = after, index + 1
    return loop


def _sequence(body: list[tuple], marked: bool) -> Callable[[dict], Iterator[tuple]]:
    steps = [_statement(s, marked) for s in body]

    def run(scope):
        for step in steps:
            yield from step(scope)
    return run


def _loops(body: list[tuple], inside: bool) -> int:
    n = 0
    for s in body:
        if s[0] == "for":
            if inside:
                raise TemplateError("a loop over the messages inside another")
            n += 1 + _loops(s[3], True)
        elif s[0] == "if":
            n += max([_loops(b, inside) for _, b in s[1]] + [_loops(s[2], inside)])
        elif s[0] == "generation":
            n += _loops(s[1], inside)
    return n


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[tuple]]:
    """A function of the messages (mappings with role and text) that yields pieces (text, marked) and ``BREAK``s."""
    tree = fold(parse(source))
    if _loops(tree, False) > 1:
        raise TemplateError("a template reads the messages once")
    run = _sequence(tree, False)
    return lambda messages, **names: run({**names, "messages": messages})
