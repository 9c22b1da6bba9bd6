"""Chat formatting by compiled templates.

A small template language (text, ``{{ expression }}``, ``{% if %}``, ``{% for %}``,
``{% generation %}``) is parsed into a syntax tree, constants are folded, and the tree
becomes nested Python closures.  It is a sandbox: expressions read names and dictionary
entries, compare, concatenate and call the filters of ``FILTERS``; nothing else can be
reached from a template.

``{% generation %}`` marks what the model is to learn: pieces rendered inside are
returned as spans of the output.

Conversations are streams: rows are dealt by conversation and sorted by turn, a loop over
``messages`` pulls one row at a time, and output leaves in parts of bounded size.  A
conversation of any length therefore needs the memory of one message.  The reader
(``read_back``) walks the parts in the same way.

Order within a conversation: turn, then role, then text (repeated turns stay).  Nulls:
a null text or role is empty; a null turn comes first; rows with a null conv_id are one
conversation.  ``escape`` puts a backslash before ``\\``, ``[`` and ``<``, so no control
string can stand in a text, and ``unescape`` takes it off again.  Empty texts are turns without
text; long ones are one message each.  An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

PART_CHARS = 1 << 20

#: Turns as [INST] ... [/INST], answers ended by </s>, other roles spelt out.
TEMPLATE = ("{{ '<s>' }}{% for m in messages %}"
            "{% if m.role == 'user' %}[INST]{{ m.text | escape }}[/INST]"
            "{% elif m.role == 'assistant' %}[ANS]{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
            "{% else %}[ROLE]{{ m.role | escape }}[SAYS]{{ m.text | escape }}[/ROLE]{% endif %}{% endfor %}")

_ESCAPED = re.compile(r"[\\\[<]")


def escape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


FILTERS: dict[str, Callable] = {
    "escape": lambda x: escape(str(x)),
    "trim": lambda x: str(x).strip(),
    "upper": lambda x: str(x).upper(),
    "lower": lambda x: str(x).lower(),
    "length": lambda x: len(x),
}


class TemplateError(ValueError):
    pass


# ---- parsing: text -> tree of tuples -------------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
_LEX = re.compile(r"\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z_]\w*)|(==|!=|[.|~()+]))")
_WORDS = {"true": True, "false": False, "none": None}


def _lex(source: str) -> list[tuple[str, object]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _LEX.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        number, string, name, sign = m.groups()
        if number is not None:
            out.append(("const", int(number)))
        elif string is not None:
            out.append(("const", re.sub(r"\\(.)", lambda k: {"n": "\n", "t": "\t"}.get(k[1], k[1]), string[1:-1], flags=re.S)))
        elif name is not None:
            out.append(("const", _WORDS[name]) if name in _WORDS else ("word", name) if name in ("and", "or", "not") else ("name", name))
        else:
            out.append(("sign", sign))
        at = m.end()
    return out


class _Expression:
    """Precedence: or, and, not, == !=, ~ +, filters, members."""

    def __init__(self, source: str):
        self.items, self.at = _lex(source), 0
        self.tree = self.either()
        if self.at != len(self.items):
            raise TemplateError(f"left over in {source!r}")

    def _take(self, *wanted) -> object | None:
        if self.at < len(self.items) and self.items[self.at] in wanted:
            self.at += 1
            return self.items[self.at - 1][1]
        return None

    def _kind(self, kind: str):
        if self.at < len(self.items) and self.items[self.at][0] == kind:
            self.at += 1
            return self.items[self.at - 1][1]
        raise TemplateError(f"a {kind} is missing")

    def _chain(self, below, *signs):
        left = below()
        while sign := self._take(*signs):
            left = (str(sign), left, below())
        return left

    def either(self):
        return self._chain(self.both, ("word", "or"))

    def both(self):
        return self._chain(self.negated, ("word", "and"))

    def negated(self):
        return ("not", self.negated()) if self._take(("word", "not")) else self.compared()

    def compared(self):
        return self._chain(self.joined, ("sign", "=="), ("sign", "!="))

    def joined(self):
        return self._chain(self.filtered, ("sign", "~"), ("sign", "+"))

    def filtered(self):
        tree = self.member()
        while self._take(("sign", "|")):
            name = self._kind("name")
            if name not in FILTERS:
                raise TemplateError(f"no filter {name}")
            tree = ("filter", name, tree)
        return tree

    def member(self):
        if self._take(("sign", "(")):
            tree = self.either()
            if not self._take(("sign", ")")):
                raise TemplateError(") is missing")
        elif self.at < len(self.items) and self.items[self.at][0] == "const":
            tree = ("const", self.items[self.at][1])
            self.at += 1
        else:
            tree = ("name", self._kind("name"))
        while self._take(("sign", ".")):
            tree = ("member", tree, self._kind("name"))
        return tree


def parse(source: str) -> list[tuple]:
    """Nodes: ("text", s), ("out", expr), ("if", [(expr, nodes)], else nodes),
    ("for", name, expr, nodes), ("generation", nodes)."""
    flat, at = [], 0
    for m in _TAG.finditer(source):
        if m.start() > at:
            flat.append(("text", source[at:m.start()]))
        if m[1] is not None:
            flat.append(("out", _Expression(m[1]).tree))
        elif m[2] is not None:
            flat.append(("tag", m[2].strip()))
        at = m.end()
    if at < len(source):
        flat.append(("text", source[at:]))
    items = iter(flat)

    def body(*ends: str) -> tuple[list[tuple], str]:
        nodes = []
        for node in items:
            if node[0] != "tag":
                nodes.append(node)
                continue
            word, _, rest = node[1].partition(" ")
            if word in ends:
                return nodes, node[1]
            if word == "if":
                cases, test = [], rest
                while True:
                    inner, end = body("elif", "else", "endif")
                    cases.append((_Expression(test).tree, inner))
                    word, _, test = end.partition(" ")
                    if word != "elif":
                        break
                nodes.append(("if", cases, body("endif")[0] if word == "else" else []))
            elif word == "for":
                m = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.+)", rest.strip(), re.S)
                if not m:
                    raise TemplateError(f"cannot read for {rest!r}")
                nodes.append(("for", m[1], _Expression(m[2]).tree, body("endfor")[0]))
            elif word == "generation":
                nodes.append(("generation", body("endgeneration")[0]))
            else:
                raise TemplateError(f"unknown tag {node[1]!r}")
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return nodes, ""

    return body()[0]


# ---- folding -------------------------------------------------------------------------

def _fold_expression(e: tuple) -> tuple:
    kind = e[0]
    if kind in ("const", "name"):
        return e
    if kind == "member":
        return ("member", _fold_expression(e[1]), e[2])
    if kind == "filter":
        inner = _fold_expression(e[2])
        return ("const", FILTERS[e[1]](inner[1])) if inner[0] == "const" else ("filter", e[1], inner)
    parts = [_fold_expression(x) for x in e[1:]]
    folded = (kind, *parts)
    if all(x[0] == "const" for x in parts):
        return ("const", _compile_expression(folded)({}))
    if kind in ("and", "or") and parts[0][0] == "const":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    return folded


def fold(nodes: list[tuple]) -> list[tuple]:
    """The same tree with constant expressions evaluated, constant output joined to the
    text around it and decided branches taken."""
    out: list[tuple] = []

    def add(node: tuple) -> None:
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in nodes:
        if node[0] == "out":
            e = _fold_expression(node[1])
            add(("text", _show(e[1])) if e[0] == "const" else ("out", e))
        elif node[0] == "if":
            cases, otherwise = [], fold(node[2])
            for test, inner in node[1]:
                t = _fold_expression(test)
                if t[0] != "const":
                    cases.append((t, fold(inner)))
                elif t[1]:
                    otherwise = fold(inner)
                    break
            for x in [("if", cases, otherwise)] if cases else otherwise:
                add(x)
        elif node[0] == "for":
            add(("for", node[1], _fold_expression(node[2]), fold(node[3])))
        elif node[0] == "generation":
            add(("generation", fold(node[1])))
        else:
            add(node)
    return out


# ---- closures ------------------------------------------------------------------------

def _show(value: object) -> str:
    return "" if value is None else str(value)


def _compile_expression(e: tuple) -> Callable[[dict], object]:
    kind = e[0]
    if kind == "const":
        value = e[1]
        return lambda scope: value
    if kind == "name":
        name = e[1]
        return lambda scope: scope.get(name)
    if kind == "member":
        inner, name = _compile_expression(e[1]), e[2]

        def member(scope):
            value = inner(scope)
            return value.get(name) if type(value) is dict else None
        return member
    if kind == "filter":
        inner, call = _compile_expression(e[2]), FILTERS[e[1]]
        return lambda scope: call(inner(scope))
    if kind == "not":
        inner = _compile_expression(e[1])
        return lambda scope: not inner(scope)
    a, b = _compile_expression(e[1]), _compile_expression(e[2])
    if kind == "and":
        return lambda scope: a(scope) and b(scope)
    if kind == "or":
        return lambda scope: a(scope) or b(scope)
    if kind == "==":
        return lambda scope: a(scope) == b(scope)
    if kind == "!=":
        return lambda scope: a(scope) != b(scope)
    return lambda scope: _show(a(scope)) + _show(b(scope))  # ~ and +


Piece = tuple[str, bool]


def _compile(nodes: list[tuple], learnt: bool = False) -> Callable[[dict], Iterator[Piece]]:
    steps = [_compile_node(n, learnt) for n in nodes]

    def run(scope: dict) -> Iterator[Piece]:
        for step in steps:
            yield from step(scope)
    return run


def _compile_node(node: tuple, learnt: bool) -> Callable[[dict], Iterator[Piece]]:
    kind = node[0]
    if kind == "text":
        piece = (node[1], learnt)
        return lambda scope: (piece,)
    if kind == "out":
        value = _compile_expression(node[1])
        return lambda scope: ((_show(value(scope)), learnt),)
    if kind == "generation":
        return _compile(node[1], True)
    if kind == "if":
        cases = [(_compile_expression(t), _compile(n, learnt)) for t, n in node[1]]
        otherwise = _compile(node[2], learnt)

        def choose(scope):
            for test, inner in cases:
                if test(scope):
                    return inner(scope)
            return otherwise(scope)
        return choose
    name, source, inner = node[1], _compile_expression(node[2]), _compile(node[3], learnt)

    def loop(scope):
        scope = dict(scope)
        for k, item in enumerate(source(scope) or ()):
            scope[name] = item
            scope["loop"] = {"index": k + 1, "index0": k, "first": k == 0}
            yield from inner(scope)
    return loop


def compile_template(source: str) -> Callable[[dict], Iterator[Piece]]:
    """A function of the scope that yields (text, whether it is learnt)."""
    return _compile(fold(parse(source)))


# ---- on Spark ------------------------------------------------------------------------

_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("last", pa.bool_()), ("text", pa.string()),
                    ("learnt", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in batch.schema.names))


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _batched(rows: Iterator[tuple], schema: pa.Schema, chars: Callable[[tuple], int]):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += chars(row) + 64
        if size >= PART_CHARS:
            yield _record(held, schema)
            held, size = [], 0
    if held:
        yield _record(held, schema)


def _render(template: str):
    def run(batches):
        render = compile_template(template)

        def parts():
            for conv, group in itertools.groupby(_rows(batches), key=lambda r: r[0]):
                messages = ({"role": r[2] or "", "text": r[3] or ""} for r in group)
                text, learnt, size, k = [], [], 0, 0
                for piece, marked in render({"messages": messages}):
                    if marked and piece:
                        learnt.append({"start": size, "end": size + len(piece)})
                    text.append(piece)
                    size += len(piece)
                    if size >= PART_CHARS:
                        yield conv, k, False, "".join(text), learnt
                        text, learnt, size, k = [], [], 0, k + 1
                yield conv, k, True, "".join(text), learnt
        yield from _batched(parts(), _PARTS, lambda r: len(r[3]))
    return run


def format_conversations(rows: DataFrame, template: str = TEMPLATE, conv_id: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, part, last, text, learnt): each conversation's output in parts of about
    a million characters, in order within its partition; learnt: the spans of the part
    (code points) that are under the loss mask."""
    compile_template(template)  # errors show here, not in a task
    dealt = rows.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_render(template), "conv_id long, part long, last boolean, text string, "
                                               "learnt array<struct<start:long,end:long>>")


_T = r"((?:[^\\\[<]++|\\.)*+)"     # possessive: what is not read back fails at once
_TURN = re.compile(rf"\[INST\]{_T}\[/INST\]|\[ANS\]{_T}</s>|\[ROLE\]{_T}\[SAYS\]{_T}\[/ROLE\]", re.S)

_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                      ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _read(batches):
    """Turns and loss text of TEMPLATE's output, one part at a time."""
    def digests():
        for conv, group in itertools.groupby(_rows(batches), key=lambda r: r[0]):
            turns, loss, n, loss_chars, chars, rest, begun = hashlib.sha256(), hashlib.sha256(), 0, 0, 0, "", False
            for _, _, _, text, learnt in group:
                chars += len(text)
                for s in learnt:
                    plain = unescape(text[s["start"]:s["end"]])
                    loss_chars += len(plain)
                    loss.update(plain.encode())
                rest += text
                at = 0
                if not begun and rest.startswith("<s>"):
                    begun, at = True, 3
                while m := _TURN.match(rest, at):
                    user, answer, other, said = m.groups()
                    role, body = ("user", user) if user is not None else ("assistant", answer) if answer is not None else (unescape(other), said)
                    turns.update(f"{role}\n{unescape(body)}\n".encode())
                    n += 1
                    at = m.end()
                rest = rest[at:]
            if rest:
                raise ValueError(f"conversation {conv}: output cannot be read back at {rest[:40]!r}")
            yield conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars
    yield from _batched(digests(), _DIGESTS, lambda r: 200)


def read_back(parts: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of
    formatted conversations, read from the output of TEMPLATE and its loss mask.
    ``parts``: straight from ``format_conversations`` (its order is needed)."""
    return parts.mapInArrow(_read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long")


#: DuckDB form of the digests over ``conversations`` and the extra conversation -7.
SQL = r"""
WITH msgs AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, 2 * length(text) - length(translate(text, '\[<', '')) AS text_size,
         2 * length(role) - length(translate(role, '\[<', '')) AS role_size FROM msgs)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(3 + sum(text_size + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 ELSE 19 + role_size END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
