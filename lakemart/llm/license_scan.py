"""Licence scans: Aho-Corasick over words, and licence expressions.

One automaton finds the notice phrases in the words of a text; another finds
identifier tags in the lower-cased text. What follows a tag up to the end of
its line is a licence expression: a shunting-yard parser puts its ``and``,
``or`` and ``with`` operators in postfix order and evaluates it to the set of
alternatives it allows. What would have too many alternatives stays factored:
an ``and`` of expressions is then kept as one. Time is linear in a text's length.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakemart.llm.common import pick, slices, prepare, to_batch

# The base phrases and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# The method's own notice phrases (words in order) and labels.
NOTICE_PHRASES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "unlicense": "unlicense",
    "licensed under cc by": "cc-by",
    "licensed under cc by sa": "cc-by-sa",
    "licensed under cc by nc": "cc-by-nc",
    "creative commons attribution": "cc-by",
    "all rights reserved": "proprietary",
}
TAGS = ("spdx-license-identifier:", "license-expression:", "package-license:")
#: Identifier families: a tag's identifier gets the label whose prefix it has.
FAMILIES = ("agpl", "lgpl", "gpl", "apache", "mit", "bsd", "mpl", "epl", "isc", "unlicense", "cc-by-nc", "cc-by-sa", "cc-by", "cc0")

PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:_-]+")
_NOT_WORD = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
#: Where ``and`` would make more alternatives than this, it stays an ``All`` of its operands.
MOST_ALTERNATIVES = 64
#: An expression of more tokens than this is evaluated in order, and an ``and`` of it that would name more than this stays factored.
MOST_TOKENS = 4096


@dataclass(frozen=True)
class All:
    """Sets of alternatives that hold together, one alternative of each; with its
    text and identifiers, made once from those of its parts."""

    parts: frozenset[frozenset]
    text: str = field(init=False, compare=False, repr=False)
    names: frozenset[str] = field(init=False, compare=False, repr=False)

    def __post_init__(self) -> None:
        text = " and ".join(sorted(f"({_show(p)})" if len(p) > 1 else _show(p) for p in self.parts))
        object.__setattr__(self, "text", text)
        object.__setattr__(self, "names", frozenset(x for p in self.parts for a in p for x in _names(a)))


#: Each alternative is a set of identifiers and factored expressions that hold together.
Alternatives = frozenset[frozenset["str | All | Factor"]]


class ExpressionError(ValueError):
    """The text after a tag is no licence expression."""


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operators bind as with > and > or, from the left."""
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    for token in tokens:
        word = token.lower()
        if word in PRECEDENCE:
            if operand_next:
                raise ExpressionError(token)
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[word]:
                out.append(stack.pop())
            stack.append(word)
            operand_next = True
        elif token == "(":
            if not operand_next:
                raise ExpressionError(token)
            stack.append("(")
        elif token == ")":
            if operand_next:
                raise ExpressionError(token)
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise ExpressionError(token)
            stack.pop()
        else:
            if not operand_next:
                raise ExpressionError(token)
            out.append(token)
            operand_next = False
    if operand_next or "(" in stack:
        raise ExpressionError("end")
    return out + stack[::-1]


def longest_expression(tokens: Iterable[str]) -> list[str]:
    """The longest run of tokens from the first that is an expression; tokens are
    taken one by one, no further than an expression could go on."""
    taken: list[str] = []
    best = depth = 0
    operand_next = True
    for token in tokens:
        word = token.lower()
        if operand_next != (token == "(" or token != ")" and word not in PRECEDENCE):
            break
        if token == "(":
            depth += 1
        elif token == ")":
            if not depth:
                break
            depth -= 1
        else:
            operand_next = word in PRECEDENCE
        taken.append(token)
        if not depth and not operand_next:
            best = len(taken)
    return taken[:best]


@dataclass(eq=False)
class Factor:
    """Alternatives within a long expression that stay together, in the order they
    stand in; the exceptions, as text, hold for each of their identifiers."""

    listed: tuple[tuple[str | Factor, ...], ...]
    exceptions: deque[str]

    @property
    def parts(self) -> tuple[Alternatives]:
        return (frozenset(map(frozenset, self.listed)),)

    @property
    def names(self) -> set[str]:
        return set(_walk(self.listed, bare=True))


class Listed(frozenset):
    """The alternatives of a long expression, with a text that has them in order."""

    text: str


def evaluate(expression: str, start: int = 0, stop: int | None = None) -> Alternatives:
    """The alternatives of the expression in ``expression[start:stop]``, each a set
    of identifiers that hold together. Reading stops at the longest prefix of
    tokens that parses."""
    found = _TOKEN.finditer(expression, start, len(expression) if stop is None else stop)
    tokens = longest_expression(m.group() for m in found)
    postfix = to_postfix(tokens) if tokens else []
    if len(tokens) > MOST_TOKENS:
        return _evaluate_long(postfix)
    values: list[Alternatives] = []
    for token in postfix:
        if token not in PRECEDENCE:
            values.append(frozenset([frozenset([token])]))
            continue
        right, left = values.pop(), values.pop()
        if token == "or":
            values.append(left | right)
        elif token == "and" and (len(left) * len(right) > MOST_ALTERNATIVES or _factored(left) or _factored(right)):
            values.append(frozenset([frozenset([All(_factors(left) | _factors(right))])]))
        elif token == "and":
            values.append(frozenset(a | b for a in left for b in right))
        else:
            exceptions = " and ".join(sorted(x for b in right for x in _names(b)))
            values.append(_with(left, exceptions))
    return values[0] if values else frozenset()


class _Value:
    """What an operator of a long expression takes: its alternatives in order, each
    of items that hold together. An item is an identifier, a deque of the texts of
    one with exceptions, or a ``Factor``. ``size`` counts identifiers."""

    __slots__ = ("alternatives", "size")

    def __init__(self, alternatives: deque[deque], size: int):
        self.alternatives, self.size = alternatives, size

    def single(self) -> deque | None:
        return self.alternatives[0] if len(self.alternatives) == 1 else None

    def listed(self) -> tuple[tuple[str | Factor, ...], ...]:
        """The different alternatives, each of its different items."""
        closed = [tuple(dict.fromkeys("".join(x) if isinstance(x, deque) else x for x in a)) for a in self.alternatives]
        first: dict[frozenset, tuple] = {}
        for a in closed:
            first.setdefault(frozenset(a), a)
        return tuple(first.values())


def _evaluate_long(postfix: list[str]) -> Listed:
    """``evaluate`` in time linear in the expression, but for a logarithm: of two
    operands the smaller is moved into the larger. What would grow out of
    proportion stays a ``Factor``."""
    values: list[_Value] = []
    for token in postfix:
        if token not in PRECEDENCE:
            values.append(_Value(deque([deque([token])]), 1))
            continue
        right, left = values.pop(), values.pop()
        if token == "or":
            values.append(_Value(_moved(left.alternatives, right.alternatives), left.size + right.size))
        elif token == "and":
            values.append(_both(left, right))
        else:
            values.append(_excepted(left, right))
    listed = values[0].listed()
    out = Listed(map(frozenset, listed))
    out.text = "".join(_walk(listed))
    return out


def _moved(left: deque, right: deque) -> deque:
    """``left`` and ``right`` in one; both are used up."""
    if len(left) >= len(right):
        left.extend(right)
        return left
    right.extendleft(reversed(left))
    return right


def _both(left: _Value, right: _Value) -> _Value:
    many, more = len(left.alternatives), len(right.alternatives)
    size = left.size * more + right.size * many
    if many > 1 and more > 1 and many * more <= MOST_ALTERNATIVES and size <= MOST_TOKENS:
        return _Value(deque(a + b for a in left.alternatives for b in right.alternatives), size)
    if many * more > MOST_ALTERNATIVES or many * more > 1 and size > MOST_TOKENS:
        left, right, size = _one(left), _one(right), left.size + right.size
    if (a := left.single()) is not None and (b := right.single()) is not None:
        return _Value(deque([_moved(a, b)]), size)
    if a is None:  # the other side has one alternative, which goes to each
        (only,) = right.alternatives
        for x in left.alternatives:
            x.extend(only)
        return _Value(left.alternatives, size)
    for x in right.alternatives:
        x.extendleft(reversed(a))
    return _Value(right.alternatives, size)


def _one(value: _Value) -> _Value:
    """The value with one alternative."""
    if value.single() is not None:
        return value
    return _Value(deque([deque([Factor(value.listed(), deque())])]), value.size)


def _excepted(left: _Value, right: _Value) -> _Value:
    """``left with right``: as in ``_with``, all that ``right`` names are exceptions."""
    texts = _exceptions(right)
    count = sum(map(len, left.alternatives)) if len(left.alternatives) <= MOST_ALTERNATIVES else left.size
    size = left.size + right.size * count
    if count > 1 and size > 4 * MOST_ALTERNATIVES:
        left, count, size = _Value(deque([deque([Factor(left.listed(), deque())])]), left.size), 1, left.size + right.size
    if count > 1:
        return _Value(deque(deque(_bound(x, texts.copy(), False) for x in a) for a in left.alternatives), size)
    ((item,),) = left.alternatives
    return _Value(deque([deque([_bound(item, texts, True)])]), size)


def _bound(item: str | deque | Factor, texts: deque[str], own: bool) -> deque | Factor:
    """The item with exceptions; one that other alternatives may hold too is not changed."""
    texts.appendleft(" with ")
    if isinstance(item, Factor):
        if own:
            item.exceptions = _moved(item.exceptions, texts)
            return item
        return Factor(item.listed, item.exceptions + texts)
    if isinstance(item, deque):
        return _moved(item, texts) if own else item + texts
    texts.appendleft(item)
    return texts


def _exceptions(value: _Value) -> deque[str]:
    """The texts of all items of a value, with ``and`` between."""
    different = {id(x): x for a in value.alternatives for x in a}.values()
    found = [x if isinstance(x, deque) else deque(_walk(((x,),))) for x in different]
    largest = max(range(len(found)), key=lambda i: len(found[i]))
    out = found[largest]
    for x in reversed(found[:largest]):
        out.appendleft(" and ")
        out.extendleft(reversed(x))
    for x in found[largest + 1 :]:
        out.append(" and ")
        out.extend(x)
    return out


def _pieces(listed: tuple[tuple[str | Factor, ...], ...]) -> Iterator[str | Factor | None]:
    for n, alternative in enumerate(listed):
        if n:
            yield " or "
        for m, item in enumerate(alternative):
            if m:
                yield " and "
            yield item


def _walk(listed: tuple[tuple[str | Factor, ...], ...], bare: bool = False) -> Iterator[str]:
    """The texts that make up the alternatives, or (``bare``) just their identifiers;
    factors may stand in one another at any depth."""
    pieces = (lambda alternatives: (x for a in alternatives for x in a)) if bare else _pieces
    open_: list[Iterator] = [iter(pieces(listed))]
    while open_:
        for piece in open_[-1]:
            if not isinstance(piece, Factor):
                yield piece
                continue
            open_.append(iter(pieces(piece.listed)) if bare else chain("(", pieces(piece.listed), ")", piece.exceptions))
            break
        else:
            open_.pop()


def _factored(alternatives: Alternatives) -> bool:
    return any(isinstance(x, All) for a in alternatives for x in a)


def _factors(alternatives: Alternatives) -> frozenset[Alternatives]:
    """The sets of alternatives that an expression is the ``and`` of."""
    if len(alternatives) == 1:
        (only,) = alternatives
        if len(only) == 1:
            (x,) = only
            if isinstance(x, All):
                return x.parts
    return frozenset([alternatives])


def _names(alternative: frozenset[str | All]) -> Iterator[str]:
    """Every identifier in an alternative, those of factored expressions too."""
    for x in alternative:
        if isinstance(x, str):
            yield x
        else:
            yield from x.names


def _with(alternatives: Alternatives, exceptions: str) -> Alternatives:
    def one(x: str | All) -> str | All:
        return All(frozenset(_with(p, exceptions) for p in x.parts)) if isinstance(x, All) else f"{x} with {exceptions}"

    return frozenset(frozenset(one(x) for x in a) for a in alternatives)


def family(identifier: str) -> str | None:
    name = identifier.lower()
    return next((f for f in FAMILIES if name == f or name.startswith((f + "-", f + "+", f + " "))), None)


@dataclass
class Scan:
    """What one text holds."""

    n_words: int
    base: list[tuple[int, str]]  # first word and label of each base phrase
    notices: list[str]
    expressions: list[Alternatives]

    @property
    def labels(self) -> set[str]:
        tagged = {f for e in self.expressions for a in e for x in _names(a) if (f := family(x))}
        return {label for _, label in self.base} | set(self.notices) | tagged

    @property
    def score(self) -> float:
        """Confidence that the text states a licence: 1 for an identifier tag
        that parses, else by the number of phrases found."""
        if any(self.expressions):
            return 1.0
        found = len(self.base) + len(self.notices)
        return 1.0 - 0.5**found if found else 0.0


class Scanner:
    def __init__(self) -> None:
        self.phrases = ahocorasick.Automaton()
        for phrase, label in (BASE_PHRASES | NOTICE_PHRASES).items():
            self.phrases.add_word(f" {phrase} ", (phrase, label, phrase in BASE_PHRASES))
        self.phrases.make_automaton()
        self.tags = ahocorasick.Automaton()
        for tag in TAGS:
            self.tags.add_word(tag, tag)
        self.tags.make_automaton()

    def scan(self, text: bytes) -> Scan:
        words = text.translate(_NOT_WORD).split()
        flat = f" {b' '.join(words).decode('utf-8', 'replace')} "
        base, notices = [], []
        spaces = upto = 0  # spaces before ``upto``: one before the first word, one after each
        for end, (phrase, label, is_base) in self.phrases.iter(flat):
            spaces += flat.count(" ", upto, end + 1)
            upto = end + 1
            if is_base:
                base.append((spaces - 2 - phrase.count(" "), label))
            else:
                notices.append(label)
        expressions = []
        if b":" in text:
            plain = text.decode("utf-8", "replace")
            tags = [(end + 1 - len(tag), end + 1) for end, tag in self.tags.iter(text.lower().decode("utf-8", "replace"))]
            for (_, start), (following, _) in zip(tags, [*tags[1:], (len(plain), 0)]):
                stop = plain.find("\n", start, following)
                expressions.append(evaluate(plain, start, stop if stop >= 0 else following))
        return Scan(len(words), base, notices, expressions)


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``, from its whole text: n_words, n_base,
    first_word, last_word, base_labels, labels, score, and ``expressions``: the
    alternatives of each identifier tag, as text.

    A null text is empty: no words, no labels, score 0, null word places.
    Repeated rows each get their row; a null id is passed through. Text after a
    tag, up to the next tag or the end of its line, that doesn't parse yields the
    longest prefix that does, or nothing. In ``expressions`` an ``and`` that would
    make over ``MOST_ALTERNATIVES`` alternatives stays factored; an expression of
    over ``MOST_TOKENS`` tokens is evaluated likewise, and its alternatives stand
    in the order of the text. Labels and score take all identifiers in any case. Time is linear in the length of a text.
    Map-side only."""
    prepare(docs.sparkSession)
    source = pick(docs, doc_id=doc_id, text=text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch, column in slices(batches):
            found = [scanner.scan(t) for t in column.to_pylist()]
            places = [[p for p, _ in s.base] for s in found]
            yield to_batch(
                doc_id=batch.column(0),
                n_words=np.array([s.n_words for s in found], np.int64),
                n_base=np.array([len(p) for p in places], np.int64),
                first_word=pa.array([min(p, default=None) for p in places], pa.int64()),
                last_word=pa.array([max(p, default=None) for p in places], pa.int64()),
                base_labels=pa.array([",".join(sorted({x for _, x in s.base})) for s in found], pa.string()),
                labels=pa.array([",".join(sorted(s.labels)) for s in found], pa.string()),
                score=np.array([s.score for s in found]),
                expressions=pa.array([[_show(e) for e in s.expressions] for s in found], pa.list_(pa.string())),
            )

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run,
        f"doc_id {id_type}, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, expressions array<string>",
    )


def _show(alternatives: Alternatives) -> str:
    """As text; the parts of a factored expression that have alternatives stand in parentheses."""
    if isinstance(alternatives, Listed):
        return alternatives.text
    return " or ".join(sorted(" and ".join(sorted(x if isinstance(x, str) else x.text for x in a)) for a in alternatives))


def op8_license_scan(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs)
