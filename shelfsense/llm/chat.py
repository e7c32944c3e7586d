"""Chat formatting: a template compiler, a template with reversible escapes, and the way back.

The template language is sandboxed: expressions read the given values by key and nothing else, so a
template can neither call Python nor reach its attributes.

    text   {{ expression }}   {% for name in expression %} … {% endfor %}
    {% if e %} … {% elif e %} … {% else %} … {% endif %}   {% set name = e %}
    {% generation %} … {% endgeneration %}: what is rendered inside is under the loss mask

Expressions have strings, integers, true, false, none, names, `a.b`, `a['b']`, `not`, `and`, `or`,
`==`, `!=`, `in`, `+` and `~` (both join strings), parentheses and the filters of `FILTERS`. In a loop `loop.index0`,
`loop.first` and `loop.last` are set. A `-` inside a tag's bracket strips white space on that side.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Strings that steer a model, as opposed to text.
TAIL = r"(/?s>|/?INST\])"
ESCAPE = re.compile(r"([<\[])(\\*)" + TAIL)
UNESCAPE = re.compile(r"([<\[])\\(\\*)" + TAIL)
TEMPLATE = (
    "{%- for m in messages -%}"
    "<s>[INST] {{ m.role | escape }} [/INST] "
    "{%- if m.role == 'assistant' -%}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{%- else -%}{{ m.text | escape }}{%- endif -%}"
    "</s>"
    "{%- endfor -%}"
)
TURN = re.compile(r"<s>\[INST\] (.*?) \[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    """Put one more backslash into every control string, so none is left and each can be restored."""
    return ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2\3", text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower, "length": len, "string": str,
}
TAG = re.compile(r"\{(\{|%)(-?)(.*?)(-?)(\}|%)\}", re.DOTALL)
TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[.\[\]()|~+]))")


class TemplateError(ValueError):
    """The template is not in the language."""


class Output:
    """Rendered text so far, and the spans under the loss mask in code points."""

    def __init__(self):
        self.parts: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


# Syntax tree: tuples of a kind and its parts. Expressions: ("const", v), ("name", n), ("key", e, k),
# ("filter", e, name), ("not", e), ("and" | "or" | "==" | "!=" | "in" | "+", a, b).
# Statements: ("text", s), ("print", e), ("for", name, e, body), ("if", [(e, body), …]), ("set", name, e),
# ("generation", body).


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, object]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            text, number, name, sign = found.groups()
            if text is not None:
                self.tokens.append(("const", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), text[1:-1])))
            elif number is not None:
                self.tokens.append(("const", int(number)))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
            at = found.end()
        self.at = 0

    def peek(self) -> tuple[str, object]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, value: str) -> bool:
        if self.peek()[0] != "const" and self.peek()[1] == value:
            self.at += 1
            return True
        return False

    def parse(self) -> tuple:
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return tree

    def either(self) -> tuple:
        tree = self.both()
        while self.take("or"):
            tree = ("or", tree, self.both())
        return tree

    def both(self) -> tuple:
        tree = self.negated()
        while self.take("and"):
            tree = ("and", tree, self.negated())
        return tree

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        tree = self.joined()
        for sign in ("==", "!=", "in"):
            if self.take(sign):
                return (sign, tree, self.joined())
        return tree

    def joined(self) -> tuple:
        tree = self.filtered()
        while self.take("+") or self.take("~"):
            tree = ("+", tree, self.filtered())
        return tree

    def filtered(self) -> tuple:
        tree = self.read()
        while self.take("|"):
            _, name = self.peek()
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            tree = ("filter", tree, name)
        return tree

    def read(self) -> tuple:
        kind, value = self.peek()
        self.at += 1
        if kind == "const":
            tree: tuple = ("const", value)
        elif kind == "name":
            constants = {"true": True, "false": False, "none": None}
            tree = ("const", constants[value]) if value in constants else ("name", value)
        elif value == "(":
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("a parenthesis is open")
        else:
            raise TemplateError(f"unexpected {value!r}")
        while True:
            if self.take("."):
                kind, value = self.peek()
                if kind != "name":
                    raise TemplateError("a name must follow the dot")
                self.at += 1
                tree = ("key", tree, ("const", value))
            elif self.take("["):
                tree = ("key", tree, self.either())
                if not self.take("]"):
                    raise TemplateError("a bracket is open")
            else:
                return tree


def parse(source: str) -> list[tuple]:
    """Syntax tree of a template."""
    pieces: list[tuple] = []
    at, strip = 0, False
    for found in TAG.finditer(source):
        opening, left, inner, right, closing = found.groups()
        if (opening == "{") != (closing == "}"):
            raise TemplateError(f"brackets differ in {found.group()!r}")
        text = source[at : found.start()]
        text = text.lstrip() if strip else text
        pieces.append(("text", text.rstrip() if left else text))
        pieces.append(("print" if opening == "{" else "tag", inner.strip()))
        at, strip = found.end(), bool(right)
    pieces.append(("text", source[at:].lstrip() if strip else source[at:]))
    body, rest = _block(pieces, 0, ())
    if rest != len(pieces):
        raise TemplateError(f"unexpected {pieces[rest][1]!r}")
    return body


def _block(pieces: list[tuple], at: int, ends: tuple[str, ...]) -> tuple[list[tuple], int]:
    """Statements from `at` to the first tag among `ends`, and where that tag is."""
    body: list[tuple] = []
    while at < len(pieces):
        kind, value = pieces[at]
        if kind == "text":
            body.append(("text", value))
        elif kind == "print":
            body.append(("print", _Expression(value).parse()))
        else:
            word, _, rest = value.partition(" ")
            if word in ends:
                return body, at
            if word == "for":
                found = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.DOTALL)
                if not found:
                    raise TemplateError(f"cannot read {value!r}")
                inside, at = _block(pieces, at + 1, ("endfor",))
                body.append(("for", found[1], _Expression(found[2]).parse(), inside))
            elif word == "if":
                branches = []
                while word != "endif":
                    test = ("const", True) if word == "else" else _Expression(rest).parse()
                    inside, at = _block(pieces, at + 1, ("endif",) if word == "else" else ("elif", "else", "endif"))
                    branches.append((test, inside))
                    if at >= len(pieces):
                        break
                    word, _, rest = pieces[at][1].partition(" ")
                body.append(("if", branches))
            elif word == "set":
                name, sign, expression = rest.partition("=")
                if not sign or not name.strip().isidentifier():
                    raise TemplateError(f"cannot read {value!r}")
                body.append(("set", name.strip(), _Expression(expression).parse()))
            elif word == "generation":
                inside, at = _block(pieces, at + 1, ("endgeneration",))
                body.append(("generation", inside))
            else:
                raise TemplateError(f"unexpected {value!r}")
            if at >= len(pieces):
                raise TemplateError(f"{word} has no end")
        at += 1
    return body, at


def _apply(kind: str, a: object, b: object) -> object:
    if kind == "==":
        return a == b
    if kind == "!=":
        return a != b
    if kind == "in":
        return isinstance(b, (list, dict)) and a in b or isinstance(a, str) and isinstance(b, str) and a in b
    return _shown(a) + _shown(b)


def _shown(value: object) -> str:
    return "" if value is None else str(value)


def fold(tree: tuple) -> tuple:
    """An expression with every constant part computed."""
    kind = tree[0]
    if kind in ("const", "name"):
        return tree
    if kind == "filter":
        inner = fold(tree[1])
        return ("const", FILTERS[tree[2]](_shown(inner[1]))) if inner[0] == "const" else ("filter", inner, tree[2])
    parts = [fold(part) for part in tree[1:]]
    if kind in ("and", "or") and parts[0][0] == "const":
        return parts[1] if bool(parts[0][1]) == (kind == "and") else parts[0]
    if kind == "not" and parts[0][0] == "const":
        return ("const", not parts[0][1])
    if kind in ("==", "!=", "in", "+") and all(part[0] == "const" for part in parts):
        return ("const", _apply(kind, parts[0][1], parts[1][1]))
    return (kind, *parts)


def fold_block(body: list[tuple]) -> list[tuple]:
    """Statements with constants folded: dead branches go, printed constants and neighbouring texts become one text."""
    out: list[tuple] = []

    def add(statement: tuple) -> None:
        if statement[0] == "text" and out and out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + statement[1])
        elif statement != ("text", ""):
            out.append(statement)

    for statement in body:
        kind = statement[0]
        if kind == "print":
            tree = fold(statement[1])
            add(("text", _shown(tree[1])) if tree[0] == "const" else ("print", tree))
        elif kind == "for":
            add(("for", statement[1], fold(statement[2]), fold_block(statement[3])))
        elif kind == "set":
            add(("set", statement[1], fold(statement[2])))
        elif kind == "generation":
            add(("generation", fold_block(statement[1])))
        elif kind == "if":
            branches = []
            for test, inside in statement[1]:
                test = fold(test)
                if test[0] == "const" and not test[1]:
                    continue
                branches.append((test, fold_block(inside)))
                if test[0] == "const":
                    break
            if branches and branches[0][0][0] == "const":
                for inner in branches[0][1]:
                    add(inner)
            elif branches:
                add(("if", branches))
        else:
            add(statement)
    return out


def _evaluator(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        return lambda values, constant=tree[1]: constant
    if kind == "name":
        return lambda values, name=tree[1]: values.get(name)
    if kind == "filter":
        inner, function = _evaluator(tree[1]), FILTERS[tree[2]]
        return lambda values: function(_shown(inner(values)))
    if kind == "not":
        inner = _evaluator(tree[1])
        return lambda values: not inner(values)
    a, b = _evaluator(tree[1]), _evaluator(tree[2])
    if kind == "key":

        def lookup(values: dict) -> object:
            holder, key = a(values), b(values)
            if isinstance(holder, dict):
                return holder.get(key)
            return holder[key] if isinstance(holder, list) and isinstance(key, int) and key < len(holder) else None

        return lookup
    if kind == "and":
        return lambda values: a(values) and b(values)
    if kind == "or":
        return lambda values: a(values) or b(values)
    return lambda values: _apply(kind, a(values), b(values))


def _renderer(body: list[tuple]) -> Callable[[dict, Output], None]:
    steps = [_statement(statement) for statement in body]

    def run(values: dict, out: Output) -> None:
        for step in steps:
            step(values, out)

    return run


def _statement(statement: tuple) -> Callable[[dict, Output], None]:
    kind = statement[0]
    if kind == "text":
        return lambda values, out, text=statement[1]: out.write(text)
    if kind == "print":
        shown = _evaluator(statement[1])
        return lambda values, out: out.write(_shown(shown(values)))
    if kind == "set":
        value = _evaluator(statement[2])
        return lambda values, out, name=statement[1]: values.__setitem__(name, value(values))
    if kind == "generation":
        inside = _renderer(statement[1])

        def generation(values: dict, out: Output) -> None:
            start = out.length
            inside(values, out)
            out.spans.append((start, out.length))

        return generation
    if kind == "for":
        items, name, inside = _evaluator(statement[2]), statement[1], _renderer(statement[3])

        def loop(values: dict, out: Output) -> None:
            sequence = items(values) or []
            for i, item in enumerate(sequence):
                state = {"index0": i, "first": i == 0, "last": i == len(sequence) - 1}
                inside(values | {name: item, "loop": state}, out)

        return loop
    branches = [(_evaluator(test), _renderer(inside)) for test, inside in statement[1]]

    def choose(values: dict, out: Output) -> None:
        for test, inside in branches:
            if test(values):
                return inside(values, out)

    return choose


def compile_template(source: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from values to the rendered text and its spans under the loss mask."""
    run = _renderer(fold_block(parse(source)))

    def render(values: dict) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        run(dict(values), out)
        return "".join(out.parts), out.spans

    return render


def format_conversations(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Every conversation rendered as one text: (conv_id, formatted, spans).

    `turns` has conv_id, turn, role, text. Turns are ordered by (turn, role, text), a null turn first;
    a null role or text is empty, and repeated rows are turns of their own. Rows with a null conv_id
    form one conversation. `spans` are [start, end) offsets in code points. A conversation becomes one
    row, so it must fit in a task; it is the only thing that does.
    """
    compile_template(template)  # fails here, not in a task
    order = F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
    conversations = turns.groupBy("conv_id").agg(order.alias("messages"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                done = [render({"messages": messages}) for messages in batch.column("messages").to_pylist()]
                spans = pa.array([[{"start": a, "end": b} for a, b in s] for _, s in done], SPANS)
                yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array([t for t, _ in done], pa.string()), spans], ["conv_id", "formatted", "spans"])

    kind = turns.schema["conv_id"].dataType.simpleString()
    return conversations.mapInArrow(run, f"conv_id {kind}, formatted string, spans array<struct<start: long, end: long>>")


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a text rendered by `TEMPLATE`."""
    return [(unescape(role), unescape(text)) for role, text in TURN.findall(formatted)]


def read_back(formatted: DataFrame) -> DataFrame:
    """What formatted conversations hold: turns by the markers, and the text under the loss mask.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars); the first digest is
    over role, newline, text, newline of each turn, the second over the unescaped masked text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("spans").to_pylist()):
                turns = read_turns(text)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(unescape(text[span["start"] : span["end"]]) for span in spans)
                rows.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(run, schema)
