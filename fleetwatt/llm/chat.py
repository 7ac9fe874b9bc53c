"""Chat formatting by a template compiler.

A template is text with ``{{ expression }}`` and ``{% for / if / set / generation %}``
tags.  It is parsed into a syntax tree, constants are folded (operators and filters on
constants, branches that are always or never taken, neighbouring texts), and each node
becomes a Python closure that appends to an output.  What is rendered inside
``{% generation %}`` is recorded as a span of the output: the loss mask.

The language is a sandbox: names are ``messages``, ``loop``, the constants given and what
``set`` defines; fields are looked up in mappings only, never as Python attributes; there
are no calls beside the filters of ``FILTERS``, and loops run over given sequences.

Control strings of the template inside texts are escaped: a backslash goes behind their
first character, and before every backslash.  No control string is left in an escaped
text and none can arise where it meets the template, so the output can be read back.

Spark brings the rows of a conversation together, sorted by turn; a task renders them as
they stream past and holds one conversation at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import column

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<|turn|>", "<|text|>", "<|end|>")
TEMPLATE = """{# each turn: its role, its text, an end; the texts of the assistant are learned #}
{%- set open = '<|' + 'turn' + '|>' -%}
{%- for m in messages -%}
{{ open + (m.role | escape) }}<|text|>
{%- if m.role == 'assistant' -%}
{% generation %}{{ m.content | escape }}{% endgeneration %}
{%- else -%}
{{ m.content | escape }}
{%- endif -%}
<|end|>
{%- endfor -%}
"""

ESCAPE = "\\"


class TemplateError(ValueError):
    """The template is not in the language, or asks for what the sandbox does not give."""


class Escaper:
    """Escapes control strings reversibly."""

    def __init__(self, controls: Sequence[str]):
        for a in controls:
            if len(a) < 2 or ESCAPE in a:
                raise TemplateError(f"a control string has two characters or more and no {ESCAPE}: {a!r}")
            for b in controls:
                if any(b.startswith(a[i:]) for i in range(1, len(a))):
                    raise TemplateError(f"the end of {a!r} may not begin {b!r}")
        starts = "|".join(re.escape(c) for c in sorted(controls, key=len, reverse=True))
        self.pattern = re.compile(rf"\\|(?=(?:{starts}))." if controls else r"\\", re.DOTALL)

    def escape(self, text: str) -> str:
        return self.pattern.sub(lambda m: ESCAPE + ESCAPE if m[0] == ESCAPE else m[0] + ESCAPE, text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if ESCAPE in text else text


# ---------------------------------------------------------------- syntax tree


@dataclass
class Const:
    value: object


@dataclass
class Name:
    name: str


@dataclass
class Field:
    of: object
    key: object


@dataclass
class Filter:
    of: object
    name: str


@dataclass
class Binary:
    op: str
    left: object
    right: object


@dataclass
class Not:
    of: object


@dataclass
class Choice:
    test: object
    yes: object
    no: object


@dataclass
class Print:
    of: object


@dataclass
class For:
    name: str
    over: object
    body: list


@dataclass
class If:
    test: object
    yes: list
    no: list


@dataclass
class Set:
    name: str
    value: object


@dataclass
class Generation:
    body: list


_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?)(.*?)(-?)#\}", re.DOTALL)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+<>|.()\[\]=,])|(\S))", re.DOTALL)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"and", "or", "not", "in", "if", "else", "for", "true", "false", "none"}


def _tokens(source: str) -> list[tuple[str, object]]:
    out: list[tuple[str, object]] = []
    for m in _TOKEN.finditer(source.rstrip()):
        text, number, word, sign, other = m.groups()
        if text is not None:
            out.append(("text", re.sub(r"\\(.)", lambda e: _ESCAPES.get(e[1], e[1]), text[1:-1], flags=re.DOTALL)))
        elif number is not None:
            out.append(("number", int(number)))
        elif word is not None:
            out.append(("word" if word in _WORDS else "name", word))
        elif sign is not None:
            out.append(("sign", sign))
        else:
            raise TemplateError(f"unexpected {other!r} in {source!r}")
    return out


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, tokens: list[tuple[str, object]]):
        self.tokens, self.at = tokens, 0

    def _next(self, *values: str) -> str | None:
        if self.at < len(self.tokens):
            kind, value = self.tokens[self.at]
            if kind in ("sign", "word") and value in values:
                self.at += 1
                return value
        return None

    def _take(self, kind: str):
        if self.at < len(self.tokens) and self.tokens[self.at][0] == kind:
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError(f"a {kind} is missing in {self.tokens}")

    def whole(self):
        node = self.choice()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return node

    def choice(self):
        node = self.either()
        if self._next("if"):
            test = self.either()
            if not self._next("else"):
                raise TemplateError("an if without else in an expression")
            return Choice(test, node, self.choice())
        return node

    def either(self):
        node = self.both()
        while self._next("or"):
            node = Binary("or", node, self.both())
        return node

    def both(self):
        node = self.negated()
        while self._next("and"):
            node = Binary("and", node, self.negated())
        return node

    def negated(self):
        return Not(self.negated()) if self._next("not") else self.compared()

    def compared(self):
        node = self.summed()
        while True:
            if op := self._next("==", "!=", "<", ">", "<=", ">=", "in"):
                node = Binary(op, node, self.summed())
            elif self.tokens[self.at : self.at + 2] == [("word", "not"), ("word", "in")]:
                self.at += 2
                node = Not(Binary("in", node, self.summed()))
            else:
                return node

    def summed(self):
        node = self.filtered()
        while op := self._next("+", "-"):
            node = Binary(op, node, self.filtered())
        return node

    def filtered(self):
        node = self.reached()
        while self._next("|"):
            node = Filter(node, self._take("name"))
        return node

    def reached(self):
        node = self.atom()
        while True:
            if self._next("."):
                node = Field(node, Const(self._take("name")))
            elif self._next("["):
                node = Field(node, self.choice())
                if not self._next("]"):
                    raise TemplateError("] is missing")
            else:
                return node

    def atom(self):
        if self._next("("):
            node = self.choice()
            if not self._next(")"):
                raise TemplateError(") is missing")
            return node
        if word := self._next("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[word])
        if self._next("-"):
            return Binary("-", Const(0), self.atom())
        if self.at < len(self.tokens) and self.tokens[self.at][0] in ("text", "number"):
            self.at += 1
            return Const(self.tokens[self.at - 1][1])
        return Name(self._take("name"))


def parse(source: str) -> list:
    """The syntax tree of a template."""
    body: list = []
    open_tags: list[tuple[str, list, object]] = []
    at, strip = 0, False
    for m in [*_TAG.finditer(source), None]:
        text = source[at : m.start()] if m else source[at:]
        dashes = m and (m[1] or m[4] or m[7])
        text = text.lstrip() if strip else text
        text = text.rstrip() if dashes else text
        if text:
            body.append(Print(Const(text)))
        if m is None:
            break
        at, strip = m.end(), bool(m[3] or m[6] or m[9])
        if m[2] is not None:
            body.append(Print(_Expression(_tokens(m[2])).whole()))
        elif m[5] is not None:
            tokens = _tokens(m[5])
            word = tokens[0][1] if tokens else ""
            rest = _Expression(tokens[1:])
            if word == "for":
                name = rest._take("name")
                if not rest._next("in"):
                    raise TemplateError("a for without in")
                node = For(name, rest.whole(), [])
                body.append(node)
                open_tags.append(("endfor", body, node))
                body = node.body
            elif word == "if":
                node = If(rest.whole(), [], [])
                body.append(node)
                open_tags.append(("endif", body, node))
                body = node.yes
            elif word in ("elif", "else") and open_tags and open_tags[-1][0] == "endif":
                above = open_tags[-1][2]
                if body is above.no:
                    raise TemplateError(f"{word} after else")
                if word == "elif":
                    node = If(rest.whole(), [], [])
                    above.no.append(node)
                    open_tags[-1] = ("endif", open_tags[-1][1], node)
                    body = node.yes
                else:
                    rest_empty(rest)
                    body = above.no
            elif word == "set":
                name = rest._take("name")
                if not rest._next("="):
                    raise TemplateError("a set without =")
                body.append(Set(name, rest.whole()))
            elif word == "generation":
                rest_empty(rest)
                if any(isinstance(x[2], Generation) for x in open_tags):
                    raise TemplateError("a generation within a generation")
                node = Generation([])
                body.append(node)
                open_tags.append(("endgeneration", body, node))
                body = node.body
            elif open_tags and word == open_tags[-1][0]:
                rest_empty(rest)
                body = open_tags.pop()[1]
            else:
                raise TemplateError(f"unexpected tag {m[0]!r}")
    if open_tags:
        raise TemplateError(f"{open_tags[-1][0]} is missing")
    return body


def rest_empty(rest: _Expression) -> None:
    if rest.tokens:
        raise TemplateError(f"unexpected {rest.tokens[0][1]!r}")


# ------------------------------------------------------------ constant folding

FILTERS: dict[str, Callable[[object], object]] = {
    "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(),
    "string": lambda x: _text(x),
    "length": lambda x: len(x),
    "first": lambda x: x[0] if x else None,
    "last": lambda x: x[-1] if x else None,
}


def _text(x: object) -> str:
    if x is None:
        return ""
    if isinstance(x, (str, int)):
        return str(x)
    raise TemplateError(f"{type(x).__name__} is not a text")


_OPS: dict[str, Callable[[object, object], object]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    ">": lambda a, b: a > b,
    "<=": lambda a, b: a <= b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b),
    "-": lambda a, b: a - b,
}


def folded(node, filters: Mapping[str, Callable] = FILTERS):
    """The same tree with everything computed that does not depend on the input."""
    again = lambda x: folded(x, filters)
    if isinstance(node, list):
        out: list = []
        for x in map(again, node):
            for y in x if isinstance(x, list) else [x]:
                if isinstance(y, Print) and isinstance(y.of, Const):
                    if out and isinstance(out[-1], Print) and isinstance(out[-1].of, Const):
                        out[-1] = Print(Const(_text(out[-1].of.value) + _text(y.of.value)))
                        continue
                    if _text(y.of.value) == "":
                        continue
                out.append(y)
        return out
    if isinstance(node, Binary):
        a, b = again(node.left), again(node.right)
        if node.op in ("and", "or"):
            if isinstance(a, Const):
                return b if bool(a.value) == (node.op == "and") else a
        elif isinstance(a, Const) and isinstance(b, Const):
            return Const(_OPS[node.op](a.value, b.value))
        elif node.op == "+" and isinstance(b, Const) and isinstance(b.value, str) and isinstance(a, Binary) and a.op == "+":
            if isinstance(a.right, Const) and isinstance(a.right.value, str):  # x + 'a' + 'b'
                return Binary("+", a.left, Const(a.right.value + b.value))
        return Binary(node.op, a, b)
    if isinstance(node, Not):
        of = again(node.of)
        return Const(not of.value) if isinstance(of, Const) else Not(of)
    if isinstance(node, Filter):
        if node.name not in filters:
            raise TemplateError(f"no filter {node.name!r}")
        of = again(node.of)
        return Const(filters[node.name](of.value)) if isinstance(of, Const) else Filter(of, node.name)
    if isinstance(node, Choice):
        test = again(node.test)
        if isinstance(test, Const):
            return again(node.yes if test.value else node.no)
        return Choice(test, again(node.yes), again(node.no))
    if isinstance(node, If):
        test = again(node.test)
        if isinstance(test, Const):
            return again(node.yes if test.value else node.no)
        return If(test, again(node.yes), again(node.no))
    if isinstance(node, For):
        return For(node.name, again(node.over), again(node.body))
    if isinstance(node, Generation):
        return Generation(again(node.body))
    if isinstance(node, Set):
        return Set(node.name, again(node.value))
    if isinstance(node, Print):
        return Print(again(node.of))
    if isinstance(node, Field):
        return Field(again(node.of), again(node.key))
    return node


# ------------------------------------------------------------------- closures


@dataclass
class Output:
    parts: list[str] = field(default_factory=list)
    size: int = 0
    #: (start, length) in code points of what was rendered as generation.
    spans: list[tuple[int, int]] = field(default_factory=list)

    def add(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)


Value = Callable[[dict], object]
Step = Callable[[dict, Output], None]


def _value(node, filters: Mapping[str, Callable]) -> Value:
    of = lambda x: _value(x, filters)
    if isinstance(node, Const):
        value = node.value
        return lambda env: value
    if isinstance(node, Name):
        name = node.name

        def named(env: dict):
            try:
                return env[name]
            except KeyError:
                raise TemplateError(f"no name {name!r}") from None

        return named
    if isinstance(node, Field):
        base, key = of(node.of), of(node.key)

        def reached(env: dict):
            x, k = base(env), key(env)
            if isinstance(x, Mapping):
                return x.get(k)
            if isinstance(x, (list, tuple)) and isinstance(k, int):
                return x[k] if -len(x) <= k < len(x) else None
            raise TemplateError(f"{type(x).__name__} has no field {k!r} here")

        return reached
    if isinstance(node, Filter):
        base, f = of(node.of), filters[node.name]
        return lambda env: f(base(env))
    if isinstance(node, Not):
        base = of(node.of)
        return lambda env: not base(env)
    if isinstance(node, Choice):
        test, yes, no = of(node.test), of(node.yes), of(node.no)
        return lambda env: yes(env) if test(env) else no(env)
    left, right = of(node.left), of(node.right)
    if node.op == "and":
        return lambda env: left(env) and right(env)
    if node.op == "or":
        return lambda env: left(env) or right(env)
    op = _OPS[node.op]
    return lambda env: op(left(env), right(env))


def _step(node, filters: Mapping[str, Callable]) -> Step:
    if isinstance(node, list):
        steps = [_step(x, filters) for x in node]

        def all_of(env: dict, out: Output) -> None:
            for s in steps:
                s(env, out)

        return all_of
    if isinstance(node, Print):
        if isinstance(node.of, Const):
            text = _text(node.of.value)
            return lambda env, out: out.add(text)
        value = _value(node.of, filters)
        return lambda env, out: out.add(_text(value(env)))
    if isinstance(node, If):
        test, yes, no = _value(node.test, filters), _step(node.yes, filters), _step(node.no, filters)
        return lambda env, out: yes(env, out) if test(env) else no(env, out)
    if isinstance(node, Set):
        name, value = node.name, _value(node.value, filters)

        def assign(env: dict, out: Output) -> None:
            env[name] = value(env)

        return assign
    if isinstance(node, Generation):
        body = _step(node.body, filters)

        def marked(env: dict, out: Output) -> None:
            begin = out.size
            body(env, out)
            out.spans.append((begin, out.size - begin))

        return marked
    over, body, name = _value(node.over, filters), _step(node.body, filters), node.name

    def loop(env: dict, out: Output) -> None:
        rows = over(env)
        if not isinstance(rows, (list, tuple)):
            raise TemplateError(f"a loop over {type(rows).__name__}")
        inner, last = dict(env), len(rows) - 1
        for i, row in enumerate(rows):
            inner[name] = row
            inner["loop"] = {"index0": i, "index": i + 1, "first": i == 0, "last": i == last, "length": last + 1}
            body(inner, out)

    return loop


class Template:
    """A compiled template; ``render`` gives the text and the spans of its generations."""

    def __init__(self, source: str, controls: Sequence[str] = CONTROLS, constants: Mapping[str, object] | None = None):
        self.filters = FILTERS | {"escape": lambda x, e=Escaper(controls): e.escape(_text(x))}
        self.tree = folded(parse(source), self.filters)
        self.constants = dict(constants or {})
        self._run = _step(self.tree, self.filters)

    def render(self, messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        self._run(self.constants | {"messages": messages}, out)
        return "".join(out.parts), out.spans


# ------------------------------------------------------------------------ Spark

_FORMATTED = "_conv long, _own int, formatted string, spans array<struct<start:long,length:long>>"


def format_chats(
    rows: DataFrame,
    template: str = TEMPLATE,
    controls: Sequence[str] = CONTROLS,
    constants: Mapping[str, object] | None = None,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    own_col: str | None = None,
    max_batch_chars: int = 4_000_000,
) -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``spans`` (``start``, ``length``, code points).

    The messages of a conversation are its rows by turn, null turns first; rows of one
    turn by role and text, so repeated turns stay and have one order.  A null role or text
    is empty.  Rows with a null id are one conversation, which comes back with a null id.
    Rows that differ in ``own_col`` (an integer column) are different conversations of
    one id.  An empty table gives an empty table; other columns are not read.

    The text of one conversation is one value of the result and is held in memory, as is
    an output batch of ``max_batch_chars``; nothing else is.
    """
    Template(template, controls, constants)  # an error shows in the driver
    narrow = rows.select(
        column(conv_col).cast("long").alias("_conv"),
        (F.lit(0) if own_col is None else F.coalesce(column(own_col).cast("int"), F.lit(0))).alias("_own"),
        column(turn_col).alias("_turn"),
        F.coalesce(column(role_col), F.lit("")).alias("_role"),
        F.coalesce(column(text_col), F.lit("")).alias("_text"),
    )
    together = narrow.repartition("_conv", "_own").sortWithinPartitions("_conv", "_own", "_turn", "_role", "_text")

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = Template(template, controls, constants)
        key, messages, done, chars = None, [], [], 0

        def close() -> None:
            text, spans = compiled.render(messages)
            done.append((*key, text, [{"start": a, "length": n} for a, n in spans]))

        def batch() -> pa.RecordBatch:
            conv, own, text, spans = zip(*done)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            return pa.RecordBatch.from_arrays(
                [pa.array(conv, pa.int64()), pa.array(own, pa.int32()), pa.array(text, pa.string()), pa.array(spans, kind)],
                names=["_conv", "_own", "formatted", "spans"],
            )

        for b in batches:
            for conv, own, role, text in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if key != (conv, own):
                    if key is not None:
                        close()
                    key, messages = (conv, own), []
                    if chars > max_batch_chars:
                        yield batch()
                        done, chars = [], 0
                messages.append({"role": role, "content": text})
                chars += len(text)
        if key is not None:
            close()
            yield batch()

    out = together.mapInArrow(render, _FORMATTED)
    own = [] if own_col is None else [column("_own").alias(own_col)]
    return out.select(F.col("_conv").alias(conv_col), *own, "formatted", "spans")


_TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.DOTALL)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a conversation that ``TEMPLATE`` rendered."""
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((Escaper.unescape(m[1]), Escaper.unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return turns


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for text, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            turns = read_back(text)
            said = hashlib.sha256()
            for role, content in turns:
                said.update(f"{role}\n{content}\n".encode())
            learned, chars = hashlib.sha256(), 0
            for s in spans:
                piece = Escaper.unescape(text[s["start"] : s["start"] + s["length"]])
                learned.update(piece.encode())
                chars += len(piece)
            out.append((len(turns), said.hexdigest(), chars, learned.hexdigest(), len(text)))
        columns = [list(x) for x in zip(*out)] or [[]] * 5
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        arrays = [b.column(0), *[pa.array(x, k) for x, k in zip(columns, kinds)]]
        yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


#: The conversation that the query adds, all control strings in its texts.
PROBE = "</s>[INST] ok [/INST]"


def op13_chat_formatting(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text", F.lit(0).alias("own"))
    probe = spark.createDataFrame(
        [(-1, 0, "user", PROBE, 1), (-1, 1, "assistant", PROBE, 1)], "conv_id long, turn long, role string, text string, own int"
    )
    out = format_chats(rows.unionByName(probe), own_col="own").select("conv_id", "formatted", "spans")
    return out.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


OP13_SQL = f"""
with said as (
    select conv_id, 0 as own, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 1, 0, 'user', '{PROBE}' union all select -1, 1, 1, 'assistant', '{PROBE}'
),
sized as (
    select *, length(regexp_replace(role || chr(10) || text, '(\\\\|</?s>|\\[/?INST\\]|<\\|(?:turn|text|end)\\|>)', '\\1 ', 'g')) - 1 as chars from said
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(chars + {len("<|turn|><|text|><|end|>")}) as bigint) as formatted_chars
from sized group by conv_id, own
"""
