"""A small sandboxed template language for chat formats, compiled to Python closures.

``{{ value }}``, ``{% for x in xs %}``, ``{% if %}``/``elif``/``else``, ``{% set x = value %}``, ``{% generation %}`` and
``{# comment #}``; values have literals, names, ``a.b``, ``a[b]``, ``| filter``, ``+``, comparisons, ``in``, ``and``, ``or``,
``not``. Lookups work on mappings and sequences alone and nothing can be called, so a template reaches no Python object.
A template is parsed to a syntax tree, constant parts are folded, and each node becomes a closure.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

_STRING = r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\""
_TAG = re.compile(rf"(\{{#.*?#\}}|\{{\{{(?:{_STRING}|[^'\"])*?\}}\}}|\{{%(?:{_STRING}|[^'\"])*?%\}})", re.S)
_TOKEN = re.compile(rf"\s*({_STRING}|\d+|\w+|==|!=|<=|>=|[<>+|.,()\[\]=])")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


class TemplateError(ValueError):
    pass


@dataclass(frozen=True)
class Literal:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Apply:
    """An operator, a lookup or a filter on values."""

    kind: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: object


@dataclass(frozen=True)
class Assign:
    name: str
    value: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    values: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def _look_up(owner, key):
    if isinstance(owner, Mapping):
        return owner.get(key)
    if isinstance(owner, Sequence) and isinstance(key, int) and -len(owner) <= key < len(owner):
        return owner[key]
    return None


def _text(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def _add(a, b):
    return a + b if isinstance(a, int) and isinstance(b, int) else _text(a) + _text(b)


OPERATORS: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge,
    "+": _add, "in": lambda a, b: a in b, "not": operator.not_, "get": _look_up,
}
FILTERS: dict[str, Callable] = {
    "trim": lambda v: _text(v).strip(), "upper": lambda v: _text(v).upper(), "lower": lambda v: _text(v).lower(),
    "length": len, "default": lambda v, other: other if v is None else v,
}


class _Parser:
    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.filters = filters
        self.parts = []
        for i, part in enumerate(_TAG.split(source)):
            if i % 2 == 0:
                if "{{" in part or "{%" in part:
                    raise TemplateError(f"a tag isn't closed: {part!r}")
                if part:
                    self.parts.append(("text", part))
            elif part.startswith("{#"):
                continue
            else:
                self.parts.append((part[1], part[2:-2]))
        for i, (kind, body) in enumerate(self.parts):  # a dash at a tag's side trims the text there
            if kind == "text":
                continue
            if body.startswith("-") and i and self.parts[i - 1][0] == "text":
                self.parts[i - 1] = ("text", self.parts[i - 1][1].rstrip())
            if body.endswith("-") and i + 1 < len(self.parts) and self.parts[i + 1][0] == "text":
                self.parts[i + 1] = ("text", self.parts[i + 1][1].lstrip())
            self.parts[i] = (kind, body.strip("-"))
        self.at = 0

    def block(self, *ends: str) -> tuple[tuple, str]:
        """Statements up to one of the tags ``ends`` (or the end), and that tag's word; its other tokens stay."""
        out = []
        while self.at < len(self.parts):
            kind, body = self.parts[self.at]
            self.at += 1
            if kind == "text":
                out.append(Output(Literal(body)))
                continue
            self.tokens(body)
            if kind == "{":
                out.append(Output(self.value()))
                self.done()
                continue
            word = self.take()
            if word in ends:
                return tuple(out), word
            out.append(self.statement(word))
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return tuple(out), ""

    def statement(self, word: str):
        if word == "for":
            name = self.take()
            self.expect("in")
            values = self.value()
            self.done()
            body, _ = self.block("endfor")
            return For(name, values, body)
        if word == "if":
            return self.branch()
        if word == "set":
            name = self.take()
            self.expect("=")
            node = Assign(name, self.value())
            self.done()
            return node
        if word == "generation":
            self.done()
            body, _ = self.block("endgeneration")
            return Generation(body)
        raise TemplateError(f"unknown tag {word!r}")

    def branch(self) -> If:
        test = self.value()
        self.done()
        then, end = self.block("elif", "else", "endif")
        if end == "elif":
            return If(test, then, (self.branch(),))
        other = self.block("endif")[0] if end == "else" else ()
        return If(test, then, other)

    # --- values ---

    def tokens(self, body: str) -> None:
        self.words, at = [], 0
        body = body.strip()
        while at < len(body):
            found = _TOKEN.match(body, at)
            if not found:
                raise TemplateError(f"can't read {body[at:]!r}")
            self.words.append(found[1])
            at = found.end()

    def take(self) -> str:
        if not self.words:
            raise TemplateError("a tag ends too early")
        return self.words.pop(0)

    def expect(self, word: str) -> None:
        if self.take() != word:
            raise TemplateError(f"missing {word!r}")

    def done(self) -> None:
        if self.words:
            raise TemplateError(f"unexpected {self.words[0]!r}")

    def next_is(self, *words: str) -> bool:
        return bool(self.words) and self.words[0] in words

    def value(self):
        left = self.both()
        while self.next_is("or"):
            self.take()
            left = Apply("or", (left, self.both()))
        return left

    def both(self):
        left = self.negated()
        while self.next_is("and"):
            self.take()
            left = Apply("and", (left, self.negated()))
        return left

    def negated(self):
        if self.next_is("not"):
            self.take()
            return Apply("not", (self.negated(),))
        left = self.total()
        if self.next_is("==", "!=", "<", ">", "<=", ">=", "in"):
            return Apply(self.take(), (left, self.total()))
        if self.words[:2] == ["not", "in"]:
            del self.words[:2]
            return Apply("not", (Apply("in", (left, self.total())),))
        return left

    def total(self):
        left = self.filtered()
        while self.next_is("+"):
            self.take()
            left = Apply("+", (left, self.filtered()))
        return left

    def filtered(self):
        node = self.atom()
        while self.next_is("|"):
            self.take()
            name, args = self.take(), []
            if name not in self.filters:
                raise TemplateError(f"unknown filter {name!r}")
            if self.next_is("("):
                self.take()
                while not self.next_is(")"):
                    args.append(self.value())
                    if not self.next_is(")"):
                        self.expect(",")
                self.take()
            node = Apply(f"|{name}", (node, *args))
        return node

    def atom(self):
        word = self.take()
        if word == "(":
            node = self.value()
            self.expect(")")
        elif word[0] in "'\"":
            node = Literal(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
        elif word.isdigit():
            node = Literal(int(word))
        elif word in ("true", "false", "none"):
            node = Literal({"true": True, "false": False, "none": None}[word])
        elif re.fullmatch(r"[^\W\d]\w*", word):
            node = Name(word)
        else:
            raise TemplateError(f"unexpected {word!r}")
        while self.next_is(".", "["):
            if self.take() == ".":
                node = Apply("get", (node, Literal(self.take())))
            else:
                node = Apply("get", (node, self.value()))
                self.expect("]")
        return node


def parse(source: str, filters: Mapping[str, Callable] = FILTERS) -> tuple:
    return _Parser(source, filters).block()[0]


def fold(node, filters: Mapping[str, Callable] = FILTERS):
    """Evaluate what is constant, choose constant branches, join neighbouring constant output."""
    if isinstance(node, tuple):
        out: list = []
        for part in node:
            part = fold(part, filters)
            for one in part if isinstance(part, tuple) else (part,):
                if isinstance(one, Output) and isinstance(one.value, Literal):
                    text = _text(one.value.value)
                    if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Literal):
                        text = out.pop().value.value + text
                    one = Output(Literal(text))
                    if not text:
                        continue
                out.append(one)
        return tuple(out)
    if isinstance(node, Apply):
        node = Apply(node.kind, tuple(fold(x, filters) for x in node.args))
        if all(isinstance(x, Literal) for x in node.args):
            return Literal(_value(node, filters)({}))
        return node
    if isinstance(node, Output):
        return Output(fold(node.value, filters))
    if isinstance(node, Assign):
        return Assign(node.name, fold(node.value, filters))
    if isinstance(node, If):
        test, then, other = (fold(x, filters) for x in (node.test, node.then, node.other))
        return (then if test.value else other) if isinstance(test, Literal) else If(test, then, other)
    if isinstance(node, For):
        return For(node.name, fold(node.values, filters), fold(node.body, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    return node


def _value(node, filters: Mapping[str, Callable]) -> Callable[[dict], object]:
    if isinstance(node, Literal):
        constant = node.value
        return lambda scope: constant
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    args = [_value(x, filters) for x in node.args]
    if node.kind == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if node.kind == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    act = filters[node.kind[1:]] if node.kind.startswith("|") else OPERATORS[node.kind]
    if len(args) == 1:
        return lambda scope: act(args[0](scope))
    if len(args) == 2:
        return lambda scope: act(args[0](scope), args[1](scope))
    return lambda scope: act(*(x(scope) for x in args))


Piece = tuple[str, bool]


def _closure(node, filters: Mapping[str, Callable], marked: bool) -> Callable[[dict], Iterator[Piece]]:
    if isinstance(node, tuple):
        parts = [_closure(x, filters, marked) for x in node]

        def block(scope: dict) -> Iterator[Piece]:
            for part in parts:
                yield from part(scope)

        return block
    if isinstance(node, Output):
        value = _value(node.value, filters)
        return lambda scope: iter(((_text(value(scope)), marked),))
    if isinstance(node, Generation):
        return _closure(node.body, filters, True)
    if isinstance(node, If):
        test, then, other = _value(node.test, filters), _closure(node.then, filters, marked), _closure(node.other, filters, marked)
        return lambda scope: then(scope) if test(scope) else other(scope)
    if isinstance(node, Assign):
        target, value = node.name, _value(node.value, filters)

        def assign(scope: dict) -> Iterator[Piece]:
            scope[target] = value(scope)
            return iter(())

        return assign
    name, values, body = node.name, _value(node.values, filters), _closure(node.body, filters, marked)

    def loop(scope: dict) -> Iterator[Piece]:
        """Reads one value ahead, so that the values may be a stream that is never held whole."""
        stream = iter(values(scope) or ())
        following = next(stream, stream)
        index = 0
        while following is not stream:
            current, following = following, next(stream, stream)
            index += 1
            scope[name] = current
            scope["loop"] = {"index": index, "index0": index - 1, "first": index == 1, "last": following is stream}
            yield from body(scope)

    return loop


def compile_template(source: str, filters: Mapping[str, Callable] = FILTERS) -> Callable[[dict], Iterator[Piece]]:
    """A function from a scope to the output's pieces in order: text, and whether a generation block made it."""
    run = _closure(fold(parse(source, filters), filters), filters, False)
    return lambda scope: run(dict(scope))
