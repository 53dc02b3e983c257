"""Operator 11: chat formatting with a compiled template.

A template is parsed into a syntax tree, constants are folded, and each node becomes a
Python closure; a statement's closure yields pieces of text, each marked as generated or
not.  The language is a small sandbox:

- ``{{ expression }}``; ``{% if %}``, ``{% elif %}``, ``{% else %}``, ``{% endif %}``;
  ``{% for x in xs %}``, ``{% endfor %}`` (with ``loop.index``, ``loop.index0``,
  ``loop.first``, ``loop.last``); ``{% set x = expression %}``; ``{% generation %}``,
  ``{% endgeneration %}``; ``{# comment #}``; a ``-`` inside a tag strips white space.
- Expressions: strings, integers, ``true``, ``false``, ``none``, names, ``a.key``,
  ``a['key']``, ``+ - * ~``, comparisons, ``in``, ``not``, ``and``, ``or``,
  ``x if c else y``, ``is defined`` and the filters of ``FILTERS``.

Nothing can be called but filters, keys are looked up in dictionaries alone, and loops run
over what the caller passes, so a template can neither reach Python's objects nor run on
forever.  An error of syntax or of an unknown name, key or filter is a ``TemplateError``.

``format`` renders each conversation from its sorted rows as a stream: a loop takes one
turn at a time and ``loop.last`` one ahead, so memory holds a turn and a part, however
long a conversation is.  The result has one row per conversation, or several parts where
it has more than ``PART`` characters, with the spans (code points) that a model should
learn to generate.  ``digests`` reads the conversations back from it.

Control strings begin with ``<|``.  ``escape`` puts a backslash into each ``<|`` of a text
(and one more where there are some), so that none is left and ``unescape`` gives the text
back; ``header`` does so for a role, which must also stay on one line.

Cases: null texts and roles are empty; a null conversation id is a conversation; turns are
sorted by turn (null first), then role, then text, so ties and repeated rows have one
order; any role is kept, only ``assistant`` is generated; an empty table gives an empty
table; very long texts are one piece of a part; further columns take no part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a part, beyond which a conversation goes on in a further one.
PART = 1 << 20

START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = """
{#- every turn between control strings; only the assistant's texts are learned -#}
{%- for message in messages -%}
<|im_start|>{{ message.role | header }}
{% if message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}
{%- else %}{{ message.text | escape }}{% endif %}<|im_end|>
{% endfor -%}
"""


class TemplateError(ValueError):
    """A template that cannot be compiled, or that asks for what is not there."""


_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No control string is left in the result."""
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def header(role: str) -> str:
    """``escape`` of a role, on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unheader(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


FILTERS: dict[str, Callable] = {
    "escape": lambda v: escape(_text(v)),
    "header": lambda v: header(_text(v)),
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "trim": lambda v: _text(v).strip(),
    "length": lambda v: len(v),
    "default": lambda v, other="": other if v is None or v is _MISSING else v,
    "replace": lambda v, old, new: _text(v).replace(old, new),
}


def _text(v) -> str:
    if v is _MISSING:
        raise TemplateError("a value is not defined")
    return "" if v is None else str(v).lower() if isinstance(v, bool) else str(v)


_MISSING = object()


# --- syntax tree ---------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: object
    key: object


@dataclass(frozen=True)
class Op:
    """An operator, filter or test: ``kind`` names its function, ``of`` its operands."""

    kind: str
    of: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Out:
    of: object


@dataclass(frozen=True)
class If:
    cases: tuple  # (condition, body); the last condition may be Const(True)


@dataclass(frozen=True)
class For:
    name: str
    of: object
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    of: object


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- parsing -------------------------------------------------------------------------

_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?)(.*?)(-?)#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+*~<>().,|\[\]=]))""")
_ENDS = {"\\n": "\n", "\\t": "\t"}


class _Expression:
    """Recursive descent over the tokens of one tag."""

    LEVELS = (("or",), ("and",), ("==", "!=", "<", "<=", ">", ">=", "in"), ("~",), ("+", "-"), ("*",))

    def __init__(self, source: str):
        self.source, self.tokens, at = source, [], 0
        while source[at:].strip():
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"cannot read {source[at:].strip()!r}")
            kind = next(k for k in range(1, 5) if m[k] is not None)
            self.tokens.append((("string", "number", "name", "sign")[kind - 1], m[kind]))
            at = m.end()
        self.at = 0

    def peek(self) -> str | None:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else (None, None)
        return None if kind == "string" else value

    def take(self, want: str | None = None) -> tuple[str, str]:
        if self.at >= len(self.tokens) or (want is not None and self.peek() != want):
            raise TemplateError(f"expected {want or 'more'} in {self.source.strip()!r}")
        self.at += 1
        return self.tokens[self.at - 1]

    def name(self) -> str:
        kind, value = self.take()
        if kind != "name" or value.startswith("_"):
            raise TemplateError(f"{value!r} is no name that a template may use")
        return value

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {self.source.strip()!r}")

    def whole(self):
        value = self.expression()
        if self.peek() == "if":
            self.take()
            cond = self.expression()
            self.take("else")
            value = Op("if", (cond, value, self.whole()))
        return value

    def expression(self, level: int = 0):
        if level == len(self.LEVELS):
            return self.unary()
        if level == 2 and self.peek() == "not":
            self.take()
            return Op("not", (self.expression(2),))
        left = self.expression(level + 1)
        while self.peek() in self.LEVELS[level] or (level == 2 and self.peek() == "not"):
            sign = self.take()[1]
            if sign == "not":
                self.take("in")
                left = Op("not", (Op("in", (left, self.expression(level + 1))),))
            else:
                left = Op(sign, (left, self.expression(level + 1)))
        return left

    def unary(self):
        if self.peek() == "-":
            self.take()
            return Op("-", (Const(0), self.unary()))
        value = self.atom()
        while True:
            sign = self.peek()
            if sign == ".":
                self.take()
                value = Key(value, Const(self.name()))
            elif sign == "[":
                self.take()
                value = Key(value, self.whole())
                self.take("]")
            elif sign == "|":
                self.take()
                value = self.filtered(value)
            elif sign == "is":
                self.take()
                negative = self.peek() == "not" and self.take()
                self.take("defined")
                value = Op("defined", (value,))
                value = Op("not", (value,)) if negative else value
            else:
                return value

    def filtered(self, value):
        name, args = self.name(), []
        if name not in FILTERS:
            raise TemplateError(f"there is no filter {name!r}")
        if self.peek() == "(":
            self.take()
            while self.peek() != ")":
                args.append(self.whole())
                if self.peek() == ",":
                    self.take()
            self.take(")")
        return Op(f"|{name}", (value, *args))

    def atom(self):
        kind, value = self.take()
        if kind == "string":
            return Const(re.sub(r"\\.", lambda m: _ENDS.get(m[0], m[0][1]), value[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(value))
        if value == "(":
            inner = self.whole()
            self.take(")")
            return inner
        if kind == "name":
            fixed = {"true": True, "false": False, "none": None}
            self.at -= 1
            return Const(fixed[self.take()[1]]) if value in fixed else Name(self.name())
        raise TemplateError(f"unexpected {value!r} in {self.source.strip()!r}")


def parse(template: str) -> tuple:
    """The template's statements."""
    parts: list[tuple[str, str]] = []
    at, strip = 0, False
    for m in _TAG.finditer(template):
        kind = 0 if m[2] is not None else 1 if m[5] is not None else 2
        left, inner, right = m[3 * kind + 1], m[3 * kind + 2], m[3 * kind + 3]
        text = template[at : m.start()]
        text = text.lstrip() if strip else text
        parts.append(("text", text.rstrip() if left else text))
        parts.append((("out", "tag", "comment")[kind], inner))
        at, strip = m.end(), bool(right)
    rest = template[at:]
    parts.append(("text", rest.lstrip() if strip else rest))
    for kind, text in parts:
        if kind == "text" and (opened := re.search(r"\{[{%#]", text)):
            raise TemplateError(f"a tag is not closed: {text[opened.start() :][:40]!r}")
    return _body(parts, 0, ())[0]


def _body(parts: list, at: int, ends: tuple[str, ...]) -> tuple[tuple, int]:
    """Statements up to a tag that ``ends`` names, and the place of that tag."""
    out: list = []
    while at < len(parts):
        kind, inner = parts[at]
        at += 1
        if kind == "text":
            out.append(Text(inner))
        elif kind == "out":
            e = _Expression(inner)
            out.append(Out(e.whole()))
            e.end()
        elif kind == "tag":
            e = _Expression(inner)
            word = e.take()[1]
            if word in ends:
                return tuple(out), at - 1
            if word == "set":
                name = e.name()
                e.take("=")
                out.append(Set(name, e.whole()))
            elif word == "for":
                name = e.name()
                e.take("in")
                over = e.whole()
                body, at = _body(parts, at, ("endfor",))
                out.append(For(name, over, body))
                at += 1
            elif word == "generation":
                body, at = _body(parts, at, ("endgeneration",))
                out.append(Generation(body))
                at += 1
            elif word == "if":
                cases, cond = [], e.whole()
                while True:
                    body, at = _body(parts, at, ("elif", "else", "endif"))
                    cases.append((cond, body))
                    e.end()
                    e = _Expression(parts[at][1])
                    at += 1
                    word = e.take()[1]
                    if word == "endif":
                        break
                    cond = e.whole() if word == "elif" else Const(True)
                out.append(If(tuple(cases)))
            else:
                raise TemplateError(f"unexpected tag {word!r}")
            e.end()
    if ends:
        raise TemplateError(f"missing {ends[-1]}")
    return tuple(out), at


# --- folding -------------------------------------------------------------------------

_FUNCTIONS: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "~": lambda a, b: _text(a) + _text(b),
    "+": lambda a, b: a + b,
    "-": lambda a, b: a - b,
    "not": lambda a: not a,
    "defined": lambda a: a is not _MISSING,
    **{f"|{name}": f for name, f in FILTERS.items()},
}


def _times(a, b):
    if not (isinstance(a, int) and isinstance(b, int)):  # no text of any length from a short one
        raise TemplateError("only numbers can be multiplied")
    return a * b


_FUNCTIONS["*"] = _times


def fold(node):
    """The same expression with its constant parts evaluated."""
    if isinstance(node, Key):
        return Key(fold(node.of), fold(node.key))
    if not isinstance(node, Op):
        return node
    of = tuple(map(fold, node.of))
    if node.kind == "if" and isinstance(of[0], Const):
        return of[1] if of[0].value else of[2]
    if node.kind in ("and", "or") and isinstance(of[0], Const):
        return of[1] if bool(of[0].value) == (node.kind == "and") else of[0]
    if node.kind in _FUNCTIONS and all(isinstance(x, Const) for x in of):
        return Const(_called(_FUNCTIONS[node.kind], [x.value for x in of]))
    return Op(node.kind, of)


def _called(f: Callable, values: list):
    try:
        return f(*values)
    except (TypeError, ValueError) as e:
        raise TemplateError(str(e)) from e


def fold_body(body: tuple) -> tuple:
    """Statements with constants folded, dead branches gone and neighbouring texts joined."""
    out: list = []

    def add(s) -> None:
        if isinstance(s, Text) and out and isinstance(out[-1], Text):
            s = Text(out.pop().text + s.text)
        if not (isinstance(s, Text) and not s.text):
            out.append(s)

    for s in body:
        if isinstance(s, Out):
            of = fold(s.of)
            add(Text(_text(of.value)) if isinstance(of, Const) else Out(of))
        elif isinstance(s, Set):
            add(Set(s.name, fold(s.of)))
        elif isinstance(s, For):
            add(For(s.name, fold(s.of), fold_body(s.body)))
        elif isinstance(s, Generation):
            inner = fold_body(s.body)
            if inner:
                add(Generation(inner))
        elif isinstance(s, If):
            cases = []
            for cond, inner in s.cases:
                cond = fold(cond)
                if isinstance(cond, Const) and not cond.value:
                    continue
                cases.append((cond, fold_body(inner)))
                if isinstance(cond, Const):
                    break
            if cases and isinstance(cases[0][0], Const):
                for x in cases[0][1]:
                    add(x)
            elif cases:
                add(If(tuple(cases)))
        else:
            add(s)
    return tuple(out)


# --- closures ------------------------------------------------------------------------


def _value(node) -> Callable[[dict], object]:
    """A closure that evaluates an expression in a scope."""
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name, _MISSING)
    if isinstance(node, Key):
        of, key = _value(node.of), _value(node.key)

        def look(scope):
            held, k = of(scope), key(scope)
            if not isinstance(held, dict):
                raise TemplateError(f"{k!r} is asked of what is no dictionary")
            return held.get(k, _MISSING)

        return look
    of = [_value(x) for x in node.of]
    if node.kind == "if":
        cond, yes, no = of
        return lambda scope: yes(scope) if cond(scope) else no(scope)
    if node.kind == "and":
        return lambda scope: of[0](scope) and of[1](scope)
    if node.kind == "or":
        return lambda scope: of[0](scope) or of[1](scope)
    f = _FUNCTIONS[node.kind]
    if len(of) == 1:
        a = of[0]
        return lambda scope: _called(f, [a(scope)])
    return lambda scope: _called(f, [x(scope) for x in of])


Piece = tuple[str, bool]


def _run(body: tuple, generated: bool) -> Callable[[dict], Iterator[Piece]]:
    """A closure that yields the pieces of a list of statements."""
    made = [_statement(s, generated) for s in body]

    def run(scope: dict) -> Iterator[Piece]:
        for f in made:
            yield from f(scope)

    return run


def _statement(s, generated: bool) -> Callable[[dict], Iterator[Piece]]:
    if isinstance(s, Text):
        fixed = ((s.text, generated),)
        return lambda scope: fixed
    if isinstance(s, Out):
        value = _value(s.of)
        return lambda scope: ((_text(value(scope)), generated),)
    if isinstance(s, Generation):
        return _run(s.body, True)
    if isinstance(s, Set):
        name, value = s.name, _value(s.of)

        def put(scope: dict) -> tuple:
            scope[name] = value(scope)
            return ()

        return put
    if isinstance(s, If):
        cases = [(_value(c), _run(b, generated)) for c, b in s.cases]

        def choose(scope: dict) -> Iterator[Piece]:
            return next((b(scope) for c, b in cases if _truth(c(scope))), ())

        return choose
    name, over, inner = s.name, _value(s.of), _run(s.body, generated)

    def loop(scope: dict) -> Iterator[Piece]:
        items = over(scope)
        if items is _MISSING or isinstance(items, (str, int)) or items is None:
            raise TemplateError(f"cannot loop over {s.of}")
        rest, index = iter(items), 0
        item = next(rest, _MISSING)
        while item is not _MISSING:
            ahead = next(rest, _MISSING)
            own = {**scope, name: item, "loop": {"index0": index, "index": index + 1, "first": index == 0, "last": ahead is _MISSING}}
            yield from inner(own)
            item, index = ahead, index + 1

    return loop


def _truth(v) -> bool:
    return v is not _MISSING and bool(v)


def compile_template(template: str) -> Callable[..., Iterator[Piece]]:
    """A function of the template's variables that yields (text, generated) pieces."""
    run = _run(fold_body(parse(template)), False)
    return lambda **variables: run(dict(variables))


# --- Spark ---------------------------------------------------------------------------

_PARTS = "conv_id bigint, part bigint, formatted string, spans array<struct<begin:bigint,end:bigint>>, last boolean"


def _parts_of(pieces: Iterator[Piece], most: int) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Text and generated spans of each part, cut between pieces; neighbouring spans join."""
    texts: list[str] = []
    spans: list[tuple[int, int]] = []
    n = 0
    for text, generated in pieces:
        if n and n + len(text) > most:
            yield "".join(texts), spans
            texts, spans, n = [], [], 0
        if generated and text:
            begin = spans.pop()[0] if spans and spans[-1][1] == n else n
            spans.append((begin, n + len(text)))
        texts.append(text)
        n += len(text)
    yield "".join(texts), spans


def format(conversations: DataFrame, template: str = TEMPLATE, part: int = PART) -> DataFrame:
    """``(conv_id, part, formatted, spans, last)``: each conversation rendered, in parts of
    about ``part`` characters that follow each other within a partition."""
    compile_template(template)  # errors of syntax show on the driver

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")])

        out: list[dict] = []
        size = 0
        for conv, turns in groupby(rows(), key=lambda r: r[0]):
            messages = ({"role": r[1], "text": r[2]} for r in turns)
            held = None
            for k, (text, spans) in enumerate(_parts_of(render(messages=messages), part)):
                if held:
                    out.append(held)
                held = {"conv_id": conv, "part": k, "formatted": text, "spans": [{"begin": a, "end": b} for a, b in spans], "last": False}
                size += len(text)
                if size > 4 * part and out:
                    yield pa.RecordBatch.from_pylist(out, schema=_parts_schema())
                    out, size = [], 0
            out.append(held | {"last": True})
            if len(out) >= 4096:
                yield pa.RecordBatch.from_pylist(out, schema=_parts_schema())
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_parts_schema())

    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("bigint"), "turn", empty("role"), empty("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").drop("turn").mapInArrow(run, _PARTS)


def _parts_schema() -> pa.Schema:
    span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
    return pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(span)), ("last", pa.bool_())])


class Reader:
    """Reads turns back from the parts of one conversation, holding one turn at a time."""

    def __init__(self) -> None:
        self.rest, self.n_turns, self.chars, self.loss_chars = "", 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, spans: list[dict]) -> None:
        self.chars += len(text)
        for s in spans:
            learned = unescape(text[s["begin"] : s["end"]])
            self.loss_chars += len(learned)
            self.loss.update(learned.encode())
        at, text = 0, self.rest + text
        while True:
            end = text.find(END + "\n", at)
            if end < 0:
                break
            role, found, body = text[at:end].partition("\n")
            if not found or not role.startswith(START):
                raise ValueError(f"no turn begins at {text[at : at + 40]!r}")
            self.n_turns += 1
            self.turns.update(f"{unheader(role[len(START) :])}\n{unescape(body)}\n".encode())
            at = end + len(END) + 1
        self.rest = text[at:]

    def end(self) -> dict:
        if self.rest:
            raise ValueError(f"a turn does not end: {self.rest[:40]!r}")
        return {
            "n_turns": self.n_turns,
            "turns_sha256": self.turns.hexdigest(),
            "loss_chars": self.loss_chars,
            "loss_sha256": self.loss.hexdigest(),
            "formatted_chars": self.chars,
        }


def digests(formatted: DataFrame, ordered: bool = False) -> DataFrame:
    """What the formatted conversations say, read back: turns, their digest, the learned
    text's characters and digest, and all characters.

    ``ordered``: the parts come straight from ``format``, so that those of a conversation
    follow each other; else they are sorted again."""
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    arrow = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                reader.add(row["formatted"], row["spans"])
                if row["last"]:
                    out.append({"conv_id": row["conv_id"], **reader.end()})
                    reader = Reader()
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    parts = formatted.select("conv_id", "part", "formatted", "spans", "last")
    if not ordered:
        parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return parts.mapInArrow(run, schema)
