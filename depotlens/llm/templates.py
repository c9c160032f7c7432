"""A small sandboxed template language, compiled to Python closures.

``{{ expression }}`` prints, ``{% if e %} .. {% elif e %} .. {% else %} .. {% endif %}`` chooses,
``{% for x in e %} .. {% endfor %}`` repeats, ``{% set x = e %}`` names, and ``{% generation %} ..
{% endgeneration %}`` marks what a model is to generate. Expressions: strings, integers, true, false, none,
names, ``a.b``, ``a['b']``, ``a[0]``, ``==``, ``!=``, ``~`` (join as text), ``not``, ``and``, ``or``, brackets
and ``| filter``. There are no calls, no attributes of Python objects (only keys of mappings and places of
lists), no imports and no way to a loop other than over a given list.

The source is parsed to a syntax tree, constant expressions are folded (so branches that cannot be taken go,
and neighbouring text is joined), and the tree becomes closures that append to one list of pieces.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

TAGS = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.S)
TOKENS = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[|~().\[\]]))")
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
NAMED = {"true": True, "false": False, "none": None}


class TemplateError(ValueError):
    """The template is not in the language, or asks for something that is not there."""


# -- syntax tree ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    base: object
    key: object


@dataclass(frozen=True)
class Apply:
    kind: str  # an operator, or | and a filter's name
    parts: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Print:
    value: object


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class If:
    test: object
    body: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    values: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


class _Expression:
    """Recursive descent over one expression's tokens."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.strip()
        while at < len(source):
            m = TOKENS.match(source, at)
            if not m or m.end() == at:
                raise TemplateError(f"unexpected {source[at:]!r}")
            kind = ("text", "number", "name", "sign")[m.lastindex - 1]
            self.tokens.append((kind, m.group(m.lastindex)))
            at = m.end()
        self.at = 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, value: str | None = None) -> tuple[str, str]:
        token = self.peek()
        if token[0] == "end" or (value is not None and token[1] != value):
            raise TemplateError(f"expected {value or 'more'}, found {token[1] or 'the end'!r}")
        self.at += 1
        return token

    def accept(self, *values: str) -> str | None:
        kind, value = self.peek()
        if kind in ("sign", "name") and value in values:
            self.at += 1
            return value
        return None

    def whole(self):
        found = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return found

    def either(self):
        left = self.both()
        while self.accept("or"):
            left = Apply("or", (left, self.both()))
        return left

    def both(self):
        left = self.negated()
        while self.accept("and"):
            left = Apply("and", (left, self.negated()))
        return left

    def negated(self):
        return Apply("not", (self.negated(),)) if self.accept("not") else self.compared()

    def compared(self):
        left = self.joined()
        while sign := self.accept("==", "!="):
            left = Apply(sign, (left, self.joined()))
        return left

    def joined(self):
        left = self.filtered()
        while self.accept("~"):
            left = Apply("~", (left, self.filtered()))
        return left

    def filtered(self):
        left = self.item()
        while self.accept("|"):
            kind, name = self.take()
            if kind != "name":
                raise TemplateError(f"{name!r} is no filter")
            left = Apply("|" + name, (left,))
        return left

    def item(self):
        left = self.single()
        while sign := self.accept(".", "["):
            if sign == ".":
                kind, name = self.take()
                if kind != "name":
                    raise TemplateError(f"{name!r} is no key")
                left = Item(left, Const(name))
            else:
                left = Item(left, self.either())
                self.take("]")
        return left

    def single(self):
        kind, value = self.take()
        if kind == "text":
            return Const(re.sub(r"\\(.)", lambda m: ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(value))
        if kind == "name":
            return Const(NAMED[value]) if value in NAMED else Name(value)
        if value == "(":
            inner = self.either()
            self.take(")")
            return inner
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of statements."""
    pieces, at = [], 0
    for m in TAGS.finditer(source):
        pieces.append(("text", source[at : m.start()]))
        pieces.append(("print", m[1]) if m[1] is not None else ("tag", (m[2] or "").strip()))
        at = m.end()
    pieces.append(("text", source[at:]))
    return _statements(pieces, [0], ())


def _statements(pieces: list, at: list[int], ends: tuple[str, ...]) -> tuple:
    """Statements up to one of the closing tags, which is left for the caller."""
    found: list = []
    while at[0] < len(pieces):
        kind, value = pieces[at[0]]
        if kind == "tag" and value.split(None, 1)[:1] and value.split(None, 1)[0] in ends:
            return tuple(found)
        at[0] += 1
        if kind == "text":
            if value:
                found.append(Text(value))
        elif kind == "print":
            found.append(Print(_Expression(value).whole()))
        elif value:
            found.append(_tag(value, pieces, at))
    if ends:
        raise TemplateError(f"no {' or '.join(ends)}")
    return tuple(found)


def _tag(value: str, pieces: list, at: list[int]):
    word, _, rest = value.partition(" ")
    if word == "set" and (m := re.fullmatch(r"\s*([A-Za-z_]\w*)\s*=(?!=)(.*)", rest, re.S)):
        return Set(m[1], _Expression(m[2]).whole())
    if word == "for" and (m := re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.S)):
        body = _statements(pieces, at, ("endfor",))
        at[0] += 1
        return For(m[1], _Expression(m[2]).whole(), body)
    if word == "generation" and not rest:
        body = _statements(pieces, at, ("endgeneration",))
        at[0] += 1
        return Generation(body)
    if word in ("if", "elif"):
        test = _Expression(rest).whole()
        body = _statements(pieces, at, ("elif", "else", "endif"))
        closing = pieces[at[0]][1]
        at[0] += 1
        if closing == "endif":
            return If(test, body, ())
        if closing == "else":
            other = _statements(pieces, at, ("endif",))
            at[0] += 1
            return If(test, body, other)
        return If(test, body, (_tag(closing, pieces, at),))
    raise TemplateError(f"unknown tag {value!r}")


# -- folding --------------------------------------------------------------------------------------


def text_of(value: object) -> str:
    return "" if value is None else str(value)


def _same(a: object, b: object) -> bool:
    return a == b


OPERATORS: dict[str, Callable] = {
    "==": _same,
    "!=": lambda a, b: a != b,
    "~": lambda a, b: text_of(a) + text_of(b),
    "not": lambda a: not a,
}


def fold_expression(e, filters: Mapping[str, Callable]):
    """The expression with every part that needs no input computed."""
    if isinstance(e, Item):
        return Item(fold_expression(e.base, filters), fold_expression(e.key, filters))
    if not isinstance(e, Apply):
        return e
    parts = tuple(fold_expression(p, filters) for p in e.parts)
    if e.kind[0] == "|" and e.kind[1:] not in filters:
        raise TemplateError(f"unknown filter {e.kind[1:]!r}")
    if e.kind in ("and", "or"):
        if isinstance(parts[0], Const):
            return parts[1] if bool(parts[0].value) == (e.kind == "and") else parts[0]
    elif all(isinstance(p, Const) for p in parts):
        act = filters[e.kind[1:]] if e.kind[0] == "|" else OPERATORS[e.kind]
        return Const(act(*(p.value for p in parts)))
    return Apply(e.kind, parts)


def fold(body: tuple, filters: Mapping[str, Callable]) -> tuple:
    """The statements with constants folded, dead branches removed and neighbouring text joined."""
    out: list = []
    for s in body:
        made: tuple = (s,)
        if isinstance(s, Print):
            value = fold_expression(s.value, filters)
            made = (Text(text_of(value.value)),) if isinstance(value, Const) else (Print(value),)
        elif isinstance(s, Set):
            made = (Set(s.name, fold_expression(s.value, filters)),)
        elif isinstance(s, If):
            test = fold_expression(s.test, filters)
            if isinstance(test, Const):
                made = fold(s.body if test.value else s.other, filters)
            else:
                made = (If(test, fold(s.body, filters), fold(s.other, filters)),)
        elif isinstance(s, For):
            made = (For(s.name, fold_expression(s.values, filters), fold(s.body, filters)),)
        elif isinstance(s, Generation):
            made = (Generation(fold(s.body, filters)),)
        for m in made:
            if isinstance(m, Text) and out and isinstance(out[-1], Text):
                m = Text(out.pop().text + m.text)
            if m != Text(""):
                out.append(m)
    return tuple(out)


# -- closures -------------------------------------------------------------------------------------


@dataclass
class Output:
    """Pieces written so far, their length in code points, and the generated spans."""

    pieces: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def _lookup(base: object, key: object) -> object:
    if isinstance(base, Mapping) and isinstance(key, str):
        return base.get(key)
    if isinstance(base, (list, tuple)) and isinstance(key, int) and not isinstance(key, bool):
        return base[key] if 0 <= key < len(base) else None
    raise TemplateError(f"{key!r} cannot be looked up")


def compile_expression(e, filters: Mapping[str, Callable]) -> Callable[[dict], object]:
    if isinstance(e, Const):
        return lambda names, value=e.value: value
    if isinstance(e, Name):
        return lambda names, name=e.name: names.get(name)
    if isinstance(e, Item):
        base, key = compile_expression(e.base, filters), compile_expression(e.key, filters)
        return lambda names: _lookup(base(names), key(names))
    parts = [compile_expression(p, filters) for p in e.parts]
    if e.kind in ("and", "or"):
        first, second = parts
        return (lambda n: first(n) and second(n)) if e.kind == "and" else (lambda n: first(n) or second(n))
    act = filters[e.kind[1:]] if e.kind[0] == "|" else OPERATORS[e.kind]
    if len(parts) == 1:
        return lambda names, one=parts[0]: act(one(names))
    return lambda names, a=parts[0], b=parts[1]: act(a(names), b(names))


def compile_body(body: tuple, filters: Mapping[str, Callable]) -> Callable[[dict, Output], None]:
    steps = [_compile_statement(s, filters) for s in body]

    def run(names: dict, out: Output) -> None:
        for step in steps:
            step(names, out)

    return run


def _compile_statement(s, filters: Mapping[str, Callable]) -> Callable[[dict, Output], None]:
    if isinstance(s, Text):
        return lambda names, out, text=s.text: out.write(text)
    if isinstance(s, Print):
        value = compile_expression(s.value, filters)
        return lambda names, out: out.write(text_of(value(names)))
    if isinstance(s, Set):
        value = compile_expression(s.value, filters)
        return lambda names, out, name=s.name: names.__setitem__(name, value(names))
    if isinstance(s, If):
        test, body, other = compile_expression(s.test, filters), compile_body(s.body, filters), compile_body(s.other, filters)
        return lambda names, out: (body if test(names) else other)(names, out)
    if isinstance(s, Generation):
        inner = compile_body(s.body, filters)

        def generate(names: dict, out: Output) -> None:
            begin = out.length
            inner(names, out)
            out.spans.append((begin, out.length))

        return generate
    values, body = compile_expression(s.values, filters), compile_body(s.body, filters)

    def repeat(names: dict, out: Output) -> None:
        items = values(names)
        if items is not None and not isinstance(items, (list, tuple)):
            raise TemplateError("only lists can be repeated over")
        for item in items or ():
            body({**names, s.name: item}, out)

    return repeat


def compile_template(source: str, filters: Mapping[str, Callable]) -> Callable[[Mapping], Output]:
    """A function from the template's input to its output."""
    body = compile_body(fold(parse(source), filters), filters)

    def render(names: Mapping) -> Output:
        out = Output()
        body(dict(names), out)
        return out

    return render
