"""A sandboxed template language, compiled to Python closures.

    {{ expression }}   {% for x in expression %} ... {% endfor %}   {% if e %} ... {% elif e %} ... {% else %} ... {% endif %}
    {% set name = expression %}   {% generation %} ... {% endgeneration %}   {# comment #}

A ``-`` inside a tag strips white space on that side. Expressions have strings, integers, true, false, none, names,
``a.b`` and ``a['b']`` on mappings, ``+ ~ == != < <= > >= in not and or``, and the filters of ``FILTERS``. There are no
calls and no attributes of Python objects, so a template reaches only what it is given. Constant parts are folded when
the template is compiled. Rendering yields (chunk, inside a generation block) pairs, so a long loop needs little memory.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass


class TemplateError(ValueError):
    """The template can't be parsed, or asks for what the sandbox does not give."""


def _length(x):
    return len(x)


FILTERS: dict[str, Callable] = {
    "trim": lambda x: str(x).strip(),
    "upper": lambda x: str(x).upper(),
    "lower": lambda x: str(x).lower(),
    "length": _length,
    "string": lambda x: text_of(x),
}


def text_of(x) -> str:
    if x is None:
        return ""
    if isinstance(x, bool):
        return "true" if x else "false"
    return str(x)


# ---- expressions


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: object
    key: object


@dataclass(frozen=True)
class Apply:
    filter: str
    of: object


@dataclass(frozen=True)
class Op:
    sign: str
    parts: tuple


# ---- statements


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Show:
    expr: object


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class If:
    cases: tuple  # of (condition or None, body)


@dataclass(frozen=True)
class Set:
    name: str
    expr: object


@dataclass(frozen=True)
class Generation:
    body: tuple


TOKEN = re.compile(r"\s*(?:(?P<str>'(?:\\.|[^'\\])*'|\"(?:\\.|[^\"\\])*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-+~<>.\[\]()|=]))", re.S)
TAG = re.compile(r"\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#-?.*?-?#\}", re.S)
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
WORDS = {"true": True, "false": False, "none": None}
RESERVED = {"and", "or", "not", "in", *WORDS}


class Expression:
    """Recursive descent over one expression's tokens."""

    def __init__(self, source: str):
        self.tokens, at, source = [], 0, source.rstrip()
        while at < len(source):
            m = TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            self.tokens.append((m.lastgroup, m[m.lastgroup]))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *values: str) -> str | None:
        kind, value = self.peek()
        if kind in ("sign", "name") and value in values:
            self.at += 1
            return value
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"expected {value!r}, found {self.peek()[1]!r}")

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "name" or value in RESERVED:
            raise TemplateError(f"expected a name, found {value!r}")
        self.at += 1
        return value

    def done(self) -> None:
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")

    def whole(self):
        out = self.either()
        self.done()
        return out

    def either(self):
        out = self.both()
        while self.take("or"):
            out = Op("or", (out, self.both()))
        return out

    def both(self):
        out = self.negated()
        while self.take("and"):
            out = Op("and", (out, self.negated()))
        return out

    def negated(self):
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        out = self.joined()
        while sign := self.take("==", "!=", "<", "<=", ">", ">=", "in", "not"):
            if sign == "not":
                self.need("in")
                out = Op("not", (Op("in", (out, self.joined())),))
            else:
                out = Op(sign, (out, self.joined()))
        return out

    def joined(self):
        out = self.postfix()
        while sign := self.take("+", "~", "-"):
            out = Op(sign, (out, self.postfix()))
        return out

    def postfix(self):
        out = self.atom()
        while True:
            if self.take("."):
                out = Item(out, Const(self.name()))
            elif self.take("["):
                out = Item(out, self.either())
                self.need("]")
            elif self.take("|"):
                if (name := self.name()) not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                out = Apply(name, out)
            else:
                return out

    def atom(self):
        kind, value = self.peek()
        if kind == "str":
            self.at += 1
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "int":
            self.at += 1
            return Const(int(value))
        if kind == "name" and value in WORDS:
            self.at += 1
            return Const(WORDS[value])
        if self.take("("):
            out = self.either()
            self.need(")")
            return out
        return Name(self.name())


# ---- statements: parsing


def pieces(source: str) -> list[tuple[str, str]]:
    """(kind, content) of text, shown expressions and statements; white space control is applied."""
    out, at, strip = [], 0, False
    for m in TAG.finditer(source):
        tag, before = m[0], source[at : m.start()]
        before = before.lstrip() if strip else before
        inner = tag[2:-2]
        if inner.startswith("-"):
            before, inner = before.rstrip(), inner[1:]
        strip = inner.endswith("-")
        inner = inner[:-1] if strip else inner
        out += [("text", before)] * bool(before)
        if tag[1] != "#":
            out.append(("show" if tag[1] == "{" else "do", inner.strip()))
        at = m.end()
    rest = source[at:].lstrip() if strip else source[at:]
    return out + [("text", rest)] * bool(rest)


def parse(source: str) -> tuple:
    parts = pieces(source)
    at = 0

    def word() -> str:
        return parts[at][1].split(None, 1)[0] if at < len(parts) and parts[at][0] == "do" and parts[at][1] else ""

    def block(*ends: str) -> tuple:
        nonlocal at
        out = []
        while at < len(parts):
            kind, content = parts[at]
            head, _, rest = content.partition(" ") if kind == "do" else ("", "", "")
            if kind == "do" and head in ends:
                return tuple(out)
            at += 1
            if kind == "text":
                out.append(Text(content))
            elif kind == "show":
                out.append(Show(Expression(content).whole()))
            elif head == "for":
                e = Expression(rest)
                name = e.name()
                e.need("in")
                over = e.whole()
                out.append(For(name, over, block("endfor")))
                end("endfor")
            elif head == "generation":
                out.append(Generation(block("endgeneration")))
                end("endgeneration")
            elif head == "set":
                e = Expression(rest)
                name = e.name()
                e.need("=")
                out.append(Set(name, e.whole()))
            elif head == "if":
                cases = [(Expression(rest).whole(), block("elif", "else", "endif"))]
                while word() in ("elif", "else"):
                    head, _, rest = parts[at][1].partition(" ")
                    at += 1
                    test = Expression(rest).whole() if head == "elif" else None
                    cases.append((test, block("elif", "else", "endif") if test is not None else block("endif")))
                end("endif")
                out.append(If(tuple(cases)))
            else:
                raise TemplateError(f"unexpected tag {content!r}")
        if ends:
            raise TemplateError(f"no {ends[-1]}")
        return tuple(out)

    def end(name: str) -> None:
        nonlocal at
        if word() != name:
            raise TemplateError(f"no {name}")
        at += 1

    return block()


# ---- folding


def fold(node):
    """The expression with constant parts replaced by their values."""
    if isinstance(node, Item):
        return Item(fold(node.of), fold(node.key))
    if isinstance(node, Apply):
        of = fold(node.of)
        return Const(FILTERS[node.filter](of.value)) if isinstance(of, Const) else Apply(node.filter, of)
    if isinstance(node, Op):
        parts = tuple(fold(p) for p in node.parts)
        if all(isinstance(p, Const) for p in parts):
            return Const(expression(Op(node.sign, parts))({}))
        if node.sign in ("and", "or") and isinstance(parts[0], Const):
            return parts[1] if bool(parts[0].value) == (node.sign == "and") else parts[0]
        return Op(node.sign, parts)
    return node


def fold_block(body: tuple) -> tuple:
    """Statements with constant output as text, neighbouring texts joined, and branches that can't be taken left out."""
    out: list = []

    def add(node) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].value + node.value)
        elif not (isinstance(node, Text) and not node.value):
            out.append(node)

    for node in body:
        if isinstance(node, Show):
            expr = fold(node.expr)
            add(Text(text_of(expr.value)) if isinstance(expr, Const) else Show(expr))
        elif isinstance(node, For):
            add(For(node.name, fold(node.over), fold_block(node.body)))
        elif isinstance(node, Set):
            add(Set(node.name, fold(node.expr)))
        elif isinstance(node, Generation):
            add(Generation(fold_block(node.body)))
        elif isinstance(node, If):
            cases = []
            for test, inner in node.cases:
                test = None if test is None else fold(test)
                if isinstance(test, Const):
                    if not test.value:
                        continue
                    test = None
                cases.append((test, fold_block(inner)))
                if test is None:
                    break
            if cases and cases[0][0] is None:
                for inner in cases[0][1]:
                    add(inner)
            elif cases:
                add(If(tuple(cases)))
        else:
            add(node)
    return tuple(out)


# ---- closures

BINARY: dict[str, Callable] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b,
    "~": lambda a, b: text_of(a) + text_of(b),
    "-": lambda a, b: a - b,
    "+": lambda a, b: text_of(a) + text_of(b) if isinstance(a, str) or isinstance(b, str) else a + b,
}


def expression(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name

        def look(scope):
            try:
                return scope[name]
            except KeyError:
                raise TemplateError(f"no name {name!r}") from None

        return look
    if isinstance(node, Item):
        of, key = expression(node.of), expression(node.key)

        def item(scope):
            found = of(scope)
            if not isinstance(found, Mapping):
                raise TemplateError("only mappings have items")
            return found.get(key(scope))

        return item
    if isinstance(node, Apply):
        f, of = FILTERS[node.filter], expression(node.of)
        return lambda scope: f(of(scope))
    parts = [expression(p) for p in node.parts]
    if node.sign == "not":
        return lambda scope: not parts[0](scope)
    left, right = parts
    if node.sign == "and":
        return lambda scope: left(scope) and right(scope)
    if node.sign == "or":
        return lambda scope: left(scope) or right(scope)
    f = BINARY[node.sign]
    return lambda scope: f(left(scope), right(scope))


Run = Callable[[dict, bool], Iterator[tuple[str, bool]]]


def statements(body: tuple) -> Run:
    runs = [statement(node) for node in body]

    def run(scope, marked):
        for r in runs:
            yield from r(scope, marked)

    return runs[0] if len(runs) == 1 else run


def statement(node) -> Run:
    if isinstance(node, Text):
        value = node.value

        def text(scope, marked):
            yield value, marked

        return text
    if isinstance(node, Show):
        show = expression(node.expr)

        def shown(scope, marked):
            yield text_of(show(scope)), marked

        return shown
    if isinstance(node, Set):
        name, value = node.name, expression(node.expr)

        def put(scope, marked):
            scope[name] = value(scope)
            return
            yield

        return put
    if isinstance(node, Generation):
        inner = statements(node.body)
        return lambda scope, marked: inner(scope, True)
    if isinstance(node, For):
        name, over, inner = node.name, expression(node.over), statements(node.body)

        def loop(scope, marked):
            for x in over(scope):
                yield from inner({**scope, name: x}, marked)

        return loop
    cases = [(None if test is None else expression(test), statements(inner)) for test, inner in node.cases]

    def branch(scope, marked):
        for test, inner in cases:
            if test is None or test(scope):
                yield from inner(scope, marked)
                return

    return branch


class Template:
    """A compiled template. ``stream(**names)`` yields (chunk, marked); ``render`` joins them and lists marked spans."""

    def __init__(self, source: str):
        self.source, self.tree = source, fold_block(parse(source))
        self._run = statements(self.tree)

    def stream(self, **names) -> Iterator[tuple[str, bool]]:
        return self._run(dict(names), False)

    def render(self, **names) -> tuple[str, list[tuple[int, int]]]:
        return joined(self.stream(**names))


def joined(chunks: Iterable[tuple[str, bool]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of chunks, and the spans [from, to) that were marked; each marked run that is not empty is a span."""
    out, spans, at, open_ = [], [], 0, False
    for chunk, marked in chunks:
        if chunk:
            if marked and open_:
                spans[-1] = (spans[-1][0], at + len(chunk))
            elif marked:
                spans.append((at, at + len(chunk)))
            out.append(chunk)
            at += len(chunk)
        open_ = marked and (open_ or bool(chunk))
    return "".join(out), spans
