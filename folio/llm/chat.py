"""Chat formatting by a small template compiler.

The template language has text, ``{{ expression }}``, ``{% if %} / {% elif %} / {% else %} / {% endif %}``, one
``{% for m in messages %} ... {% endfor %}`` and, inside it, ``{% generation %} ... {% endgeneration %}`` around
what a model has to produce.  Expressions know strings, numbers, ``true``, ``false``, the names of ``NAMES``, the
operators ``or and not == != in + `` and the filters of ``FILTERS``; nothing else can be named or called, so a
template can neither reach Python nor run on.  It is parsed to a syntax tree, constants are folded, and the tree
becomes Python closures.

Control strings inside roles and texts are escaped reversibly: in every one of them, a backslash is put after the
first character (one more if some are there already), so an escaped text holds no control string and other texts
stay as they are.

Rendering streams: rows are dealt out by conversation and sorted by turn, and a task holds one message and one
output piece (at most ``PIECE`` characters, or one message) at a time.  A conversation of any length thus needs
bounded memory, though its own messages, whose order the result depends on, are read one after the other.

Defined cases: null text and null role are ''; a null id is a conversation of its own; messages that tie in turn
are ordered by role and text, repeated rows stay; null turns come first; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<role>", "</role>")
TEMPLATE = ("{% for m in messages %}"
            "{% if m.role == 'user' %}{{ '<s>' + '[INST] ' }}{{ m.text }}{{ ' [/INST]' }}"
            "{% elif m.role == 'assistant' %} {% generation %}{{ m.text }}{% endgeneration %}</s>"
            "{% else %}<role>{{ m.role }}</role>{{ m.text }}</s>{% endif %}"
            "{% endfor %}")
NAMES = ("m.role", "m.text", "m.turn", "loop.index", "loop.first", "loop.last")
FILTERS: dict[str, Callable] = {"trim": lambda x: str(x).strip(), "upper": lambda x: str(x).upper(), "lower": lambda x: str(x).lower()}
PIECE = 1 << 20
_BY_HEAD = {h: "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == h) for h in sorted({c[0] for c in CONTROLS})}
_PLAIN = re.compile("|".join(rf"{re.escape(h)}(?=\\*(?:{rest}))" for h, rest in _BY_HEAD.items()))
_ESCAPED = re.compile("|".join(rf"(?<={re.escape(h)})\\(?=\\*(?:{rest}))" for h, rest in _BY_HEAD.items()))
_TURN = re.compile(r"<s>\[INST\] (?P<user>.*?) \[/INST\]|<role>(?P<role>.*?)</role>(?P<text>.*?)</s>| (?P<assistant>.*?)</s>", re.S)
_LEX = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*(?:\.\w+)?)|(==|!=|[+|()]))")


class TemplateError(ValueError):
    pass


def escape(text: str) -> str:
    return _PLAIN.sub(r"\g<0>\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


# -- parsing: nodes are tuples (kind, ...)

def _lex(code: str) -> list[tuple[str, object]]:
    out, at = [], 0
    while code[at:].strip():
        m = _LEX.match(code, at)
        if not m:
            raise TemplateError(f"cannot read {code[at:]!r}")
        at = m.end()
        if m[1]:
            out.append(("const", re.sub(r"\\(.)", lambda k: {"n": "\n", "t": "\t"}.get(k[1], k[1]), m[1][1:-1])))
        elif m[2]:
            out.append(("const", int(m[2])))
        elif m[3] in ("true", "false"):
            out.append(("const", m[3] == "true"))
        else:
            out.append(("word" if m[3] else "sign", m[3] or m[4]))
    return out


def _expression(code: str):
    tokens = _lex(code)

    def peek(*signs):
        return tokens and tokens[0][0] != "const" and tokens[0][1] in signs

    def binary(below, *signs):
        node = below()
        while peek(*signs):
            op = tokens.pop(0)[1]
            node = ("op", op, node, below())
        return node

    def unary():
        if peek("not"):
            tokens.pop(0)
            return ("op", "not", unary(), None)
        return binary(lambda: binary(filtered, "+"), "==", "!=", "in")

    def filtered():
        node = atom()
        while peek("|"):
            tokens.pop(0)
            name = tokens.pop(0)[1] if tokens else None
            if name not in FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            node = ("filter", name, node)
        return node

    def atom():
        if not tokens:
            raise TemplateError(f"unfinished expression {code!r}")
        kind, value = tokens.pop(0)
        if kind == "const":
            return ("const", value)
        if value == "(":
            node = either()
            if not peek(")"):
                raise TemplateError(f"missing ) in {code!r}")
            tokens.pop(0)
            return node
        if value not in NAMES:
            raise TemplateError(f"unknown name {value!r}")
        return ("name", value)

    def either():
        return binary(lambda: binary(unary, "and"), "or")

    node = either()
    if tokens:
        raise TemplateError(f"cannot read the end of {code!r}")
    return node


def parse(template: str) -> list:
    """Syntax tree: a list of ("text", s), ("out", e), ("if", [(e, body)], body), ("for", body), ("gen", body)."""
    parts = re.split(r"(\{%.*?%\}|\{\{.*?\}\})", template, flags=re.S)
    at = 0

    def body(ends: tuple[str, ...], inside: tuple[str, ...]):
        nonlocal at
        out = []
        while at < len(parts):
            p = parts[at]
            at += 1
            if p.startswith("{{"):
                out.append(("out", _expression(p[2:-2])))
            elif not p.startswith("{%"):
                if p:
                    out.append(("text", p))
            else:
                word, _, rest = p[2:-2].strip().partition(" ")
                if word in ends:
                    return out, word, rest
                if word == "if":
                    arms, last = [], []
                    test = rest
                    while word != "endif":
                        arm, word, rest = body(("elif", "else", "endif"), inside)
                        arms.append((_expression(test), arm))
                        test = rest
                        if word == "else":
                            last, word, _ = body(("endif",), inside)
                    out.append(("if", arms, last))
                elif word == "for" and rest.split() == ["m", "in", "messages"] and "for" not in inside:
                    out.append(("for", body(("endfor",), (*inside, "for"))[0]))
                elif word == "generation" and inside == ("for",):
                    out.append(("gen", body(("endgeneration",), (*inside, "gen"))[0]))
                else:
                    raise TemplateError(f"unexpected {p!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return out, "", ""

    return body((), ())[0]


def _fold_expression(e):
    if e[0] == "op":
        e = ("op", e[1], _fold_expression(e[2]), e[3] and _fold_expression(e[3]))
        if e[2][0] == "const" and (e[3] is None or e[3][0] == "const"):
            return ("const", _compile_expression(e)({}))
    elif e[0] == "filter":
        e = ("filter", e[1], _fold_expression(e[2]))
        if e[2][0] == "const":
            return ("const", FILTERS[e[1]](e[2][1]))
    return e


def fold(tree: list) -> list:
    """Constant outputs become text, arms whose test is known are chosen or dropped, and texts are joined."""
    out: list = []

    def add(node):
        if node[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + node[1])
        elif node != ("text", ""):
            out.append(node)

    for node in tree:
        if node[0] == "out":
            e = _fold_expression(node[1])
            add(("text", str(e[1])) if e[0] == "const" else ("out", e))
        elif node[0] == "if":
            arms, last = [], fold(node[2])
            for test, arm in node[1]:
                test = _fold_expression(test)
                if test[0] != "const":
                    arms.append((test, fold(arm)))
                elif test[1]:
                    last = fold(arm)
                    break
            for x in [("if", arms, last)] if arms else last:
                add(x)
        elif node[0] in ("for", "gen"):
            add((node[0], fold(node[1])))
        else:
            add(node)
    return out


_OPS = {"or": lambda a, b: lambda v: a(v) or b(v), "and": lambda a, b: lambda v: a(v) and b(v), "not": lambda a, b: lambda v: not a(v),
        "==": lambda a, b: lambda v: a(v) == b(v), "!=": lambda a, b: lambda v: a(v) != b(v),
        "in": lambda a, b: lambda v: str(a(v)) in str(b(v)), "+": lambda a, b: lambda v: str(a(v)) + str(b(v))}


def _compile_expression(e) -> Callable[[dict], object]:
    if e[0] == "const":
        return lambda v, x=e[1]: x
    if e[0] == "name":
        return lambda v, x=e[1]: v[x]
    if e[0] == "filter":
        return lambda v, f=FILTERS[e[1]], a=_compile_expression(e[2]): f(a(v))
    return _OPS[e[1]](_compile_expression(e[2]), e[3] and _compile_expression(e[3]))


def _compile(tree: list) -> Callable[[dict, Callable, Callable], None]:
    """A closure (values, write, mark): ``mark(True)`` and ``mark(False)`` bound what is generated."""
    steps = []
    for node in tree:
        if node[0] == "text":
            steps.append(lambda v, w, m, x=node[1]: w(x))
        elif node[0] == "out":  # only names can bring control strings from outside
            steps.append(lambda v, w, m, f=_compile_expression(node[1]): w(str(f(v))))
        elif node[0] == "if":
            arms = [(_compile_expression(t), _compile(b)) for t, b in node[1]]
            steps.append(lambda v, w, m, arms=arms, last=_compile(node[2]):
                         next((b for t, b in arms if t(v)), last)(v, w, m))
        elif node[0] == "gen":
            steps.append(lambda v, w, m, b=_compile(node[1]): (m(True), b(v, w, m), m(False)))
        else:
            raise TemplateError("a loop stands at the top level only")

    def run(v, w, m):
        for s in steps:
            s(v, w, m)
    return run


class Template:
    """``before``, ``message`` and ``after``: closures for what stands before, in and after the loop."""

    def __init__(self, source: str):
        tree = fold(parse(source))
        loops = [k for k, node in enumerate(tree) if node[0] == "for"]
        if len(loops) != 1:
            raise TemplateError("a template has one loop over messages")
        outside = tree[:loops[0]] + tree[loops[0] + 1:]
        if "m." in repr(outside) or "loop." in repr(outside):
            raise TemplateError("m and loop are known in the loop only")
        self.before, self.message, self.after = (_compile(x) for x in (tree[:loops[0]], tree[loops[0]][1], tree[loops[0] + 1:]))


def _render(source: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = Template(source)
        rows: dict[str, list] = {k: [] for k in ("conv", "piece", "last", "text", "starts", "ends")}
        text: list[str] = []
        size = piece = 0
        starts: list[int] = []
        ends: list[int] = []

        def write(s):
            nonlocal size
            text.append(s)
            size += len(s)

        def mark(begin):
            (starts if begin else ends).append(size)

        def flush(conv, last):
            nonlocal size, piece
            for k, v in zip(rows, (conv, piece, last, "".join(text), starts.copy(), ends.copy())):
                rows[k].append(v)
            text.clear(), starts.clear(), ends.clear()
            size, piece = 0, 0 if last else piece + 1

        def emit():
            out = pa.RecordBatch.from_arrays(
                [pa.array(rows["conv"], conv_type), pa.array(rows["piece"], pa.int64()), pa.array(rows["last"], pa.bool_()),
                 pa.array(rows["text"], pa.string()), pa.array(rows["starts"], pa.list_(pa.int64())), pa.array(rows["ends"], pa.list_(pa.int64()))],
                names=["conv", "piece", "last", "text", "starts", "ends"])
            for v in rows.values():
                v.clear()
            return out

        held, index, conv_type, waiting = None, 0, pa.int64(), 0

        def put(row, last):
            nonlocal index
            conv, turn, role, said = row
            index += 1
            if index == 1:
                template.before({}, write, mark)
            template.message({"m.role": escape(role or ""), "m.text": escape(said or ""), "m.turn": turn, "loop.index": index,
                              "loop.first": index == 1, "loop.last": last}, write, mark)
            if last:
                template.after({}, write, mark)
                index = 0
            if last or size >= PIECE:
                flush(conv, last)

        for b in batches:
            conv_type = b.column(0).type
            for row in zip(*(b.column(k).to_pylist() for k in range(4))):
                if held is not None:
                    put(held, held[0] != row[0])
                held = row
                if rows["text"]:
                    waiting += len(rows["text"][-1]) if len(rows["text"]) else 0
                    if len(rows["text"]) >= 1000 or waiting > 8 * PIECE:
                        yield emit()
                        waiting = 0
        if held is not None:
            put(held, True)
        if rows["text"]:
            yield emit()
    return run


def render(conversations: DataFrame, template: str = TEMPLATE, id_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Pieces of formatted text, in order within their partition: conv, piece, last, text, and the starts and ends
    (code points within the piece) of what is generated.  Most conversations are one piece."""
    Template(template)  # a wrong template fails here
    kind = conversations.schema[id_col].dataType.simpleString()
    rows = conversations.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"),
                                F.col(text_col).alias("text"))
    rows = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return rows.mapInArrow(_render(template), f"conv {kind}, piece long, last boolean, text string, starts array<long>, ends array<long>")


def read_back(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a text formatted with ``TEMPLATE``."""
    out, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        if m["user"] is not None:
            out.append(("user", unescape(m["user"])))
        elif m["assistant"] is not None:
            out.append(("assistant", unescape(m["assistant"])))
        else:
            out.append((unescape(m["role"]), unescape(m["text"])))
        at = m.end()
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state = None
    for b in batches:
        rows = []
        for conv, last, text, starts, ends in zip(*(b.column(k).to_pylist() for k in (0, 2, 3, 4, 5))):
            if state is None:
                state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in read_back(text):
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
            for s, e in zip(starts, ends):
                said = unescape(text[s:e])
                state[2] += len(said)
                state[3].update(said.encode())
            state[4] += len(text)
            if last:
                rows.append((conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))
                state = None
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], b.column(0).type), *map(pa.array, cols[1:])],
                                             names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(pieces: DataFrame) -> DataFrame:
    """A row per conversation, read back from the formatted pieces in the order ``render`` left them in."""
    kind = pieces.schema["conv"].dataType.simpleString()
    return pieces.mapInArrow(_digest, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")
