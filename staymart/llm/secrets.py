"""Secret scan: assignment-aware lexing on top of fixed patterns.

Source and configuration text is read as a run of assignments: a name, an operator, and a
value that is a literal, another name, or several of them joined by ``+``. Names that were
assigned before stand for their literals, so a secret is found where it is written even if
it reaches a sensitive name by way of a harmless one. A literal is scored by the words of
the name it ends up in and by its own look.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from staymart.llm.common import scan

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more is the whole run
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

KINDS = ["assign", "access", "hex", "literal"]

#: A declared type, and ``=`` before a value; without quotes around the value it has no digits.
TYPED = r"""[&*]?[A-Za-z_][A-Za-z_.%s]*+(?:[\[<][^\[<:=\n"'`]*[\]>]*+)*(?:[ \t]*+\|[ \t]*+[A-Za-z_][A-Za-z0-9_.]*+)*\??"""
#: A name, read forward once, and the operator after it; a colon, a type and ``=`` are one.
ASSIGNED = re.compile(
    r"""(?<![A-Za-z0-9_.\-])([A-Za-z_][A-Za-z0-9_.\-]*+)["']?+[ \t]*+(?P<op>:=|=>"""
    rf"""|\??:[ \t]*+(?:{TYPED % "0-9"}[ \t]*+=[ \t]*+(?=["'`])|{TYPED % ""}[ \t]++=[ \t]++(?=[A-Za-z0-9_]))|[:=])""",
    re.ASCII,
)
PART = re.compile(
    r"""[ \t]*(?:"(?P<double>(?:[^"\\\n]|\\.)*)"|'(?P<single>(?:[^'\\\n]|\\.)*)'|`(?P<back>[^`\n]*)`"""
    r"""|(?P<bare>[A-Za-z0-9_+/.=~!@#$%^&*\-]+))"""
)
PLUS = re.compile(r"[ \t]*\+")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z", re.ASCII)
WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
PLACEHOLDER = re.compile(r"(?i)example|changeme|placeholder|dummy|sample|xxxx|\*\*\*|\.\.\.|\$\{|\{\{|<|your")

#: How much a word in a name tells of a secret.
SENSITIVE = {
    "password": 3.0,
    "passwd": 3.0,
    "pwd": 2.5,
    "passphrase": 3.0,
    "secret": 3.0,
    "token": 2.5,
    "apikey": 3.0,
    "credential": 2.5,
    "credentials": 2.5,
    "private": 1.5,
    "auth": 1.5,
    "access": 1.0,
    "api": 1.0,
    "key": 1.5,
    "signature": 1.5,
}
LEAST_SCORE = 5.0


def name_score(name: str) -> float:
    """The words of a name, summed up; ``db.adminPwd`` has db, admin and pwd."""
    return sum(SENSITIVE.get(w.lower(), 0.0) for w in set(WORDS.findall(name)))


@dataclass(eq=False, slots=True)
class Look:
    """What the score of a string needs to know, so that it can be put together from parts."""

    counts: Counter
    plain: bool  # no white space, nothing of a placeholder in any part

    def score(self) -> float:
        """0 for what cannot be a secret; else up to 4 for length, mixture and entropy."""
        size = sum(self.counts.values())
        if size < 8 or not self.plain:
            return 0.0
        entropy = -sum(c / size * math.log2(c / size) for c in self.counts.values())
        kinds = len({kind_of(c) for c in self.counts})
        if kinds < 2 or entropy < 2.5:
            return 0.0
        return 1.0 + (1.0 if size >= 20 else size / 20) + min(1.0, entropy / 4) + kinds / 4


def kind_of(letter: str) -> str:
    if not letter.isascii() or not letter.isalnum():
        return "other"
    return "digit" if letter.isdigit() else "upper" if letter.isupper() else "lower"


def look_of(text: str) -> Look:
    return Look(Counter(text), not (re.search(r"\s", text) or PLACEHOLDER.search(text)))


def merged(one: Look, other: Look) -> Look:
    return Look(one.counts + other.counts, one.plain and other.plain)


@dataclass(eq=False, slots=True)
class Value:
    """A literal with its span, or a concatenation of other values; shared, never copied."""

    parts: tuple[Value, ...] = ()
    span: tuple[int, int] = (0, 0)
    text: str = ""
    look: Look | None = None
    marked: bool = False


def look_at(value: Value) -> Look:
    """The look of a value, computed once for it and for all that it is made of."""
    stack = [value]
    while stack:
        one = stack[-1]
        open_parts = [p for p in one.parts if p.look is None] if one.look is None else []
        if open_parts:
            stack += open_parts
            continue
        if one.look is None:
            one.look = reduce(merged, (p.look for p in one.parts)) if one.parts else look_of(one.text)
        stack.pop()
    return value.look


def mark(value: Value, found: set[tuple[int, int]]) -> None:
    """Puts the spans of all literals of a value into ``found``; what is marked is not gone
    through again."""
    stack = [value]
    while stack:
        one = stack.pop()
        if one.marked:
            continue
        one.marked = True
        if one.parts:
            stack += one.parts
        elif one.span[1] > one.span[0]:
            found.add(one.span)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base patterns, each leftmost and without overlaps."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return sorted(found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)])


def assignments(text: str):
    """``(name, parts)`` in order; a part is ``(start, end, literal)`` or a name as a string."""
    end = 0
    for op in ASSIGNED.finditer(text):
        if op.start("op") < end:
            continue
        parts, at = [], op.end()
        while part := PART.match(text, at):
            kind = part.lastgroup
            value, at = part[kind], part.end()
            if kind == "bare" and IDENTIFIER.match(value):
                parts.append((part.start(kind), part.end(kind), value, True))
            else:
                parts.append((part.start(kind), part.end(kind), value, False))
            plus = PLUS.match(text, at)
            if not plus:
                break
            at = plus.end()
        if parts:
            end = at
            yield op[1], parts


def literal_spans(text: str) -> set[tuple[int, int]]:
    """Spans of literals that end up, directly or by constants, in a sensitive name."""
    if not ("=" in text or ":" in text):
        return set()
    constants: dict[str, Value] = {}
    found: set[tuple[int, int]] = set()
    for name, parts in assignments(text):
        values = tuple(
            constants[word] if identifier and word in constants else Value(span=(start, end), text=word)
            for start, end, word, identifier in parts
        )
        value = constants[name] = values[0] if len(values) == 1 else Value(values)
        score = name_score(name)
        if score >= 2.5 and not value.marked and score + look_at(value).score() >= LEAST_SCORE:
            mark(value, found)
    return found


def apart(spans: set[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The spans that overlap none of ``base``, which is sorted by start."""
    starts, ends = [], []  # the base as stretches without gaps or overlaps
    for start, _, end in base:
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    out = []
    for a, b in spans:
        k = bisect_left(starts, b) - 1  # the last stretch that starts before the span's end
        if k < 0 or ends[k] <= a:
            out.append((a, b))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def secrets_of(text: str | None) -> tuple[int, int, int, str, str, int]:
    text = text or ""
    base = base_spans(text)
    more = [(a, 3, b) for a, b in apart(literal_spans(text), base)]
    counts = Counter(kind for _, kind, _ in base)
    digest = hashlib.sha256(joined(base).encode()).hexdigest()
    return counts[0], counts[1], counts[2], digest, joined(sorted(base + more)), len(more)


def secret_scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_literal`` per row.

    Spans are in code points, end exclusive. A null text counts as empty: no spans and the
    hash of nothing. Other columns do not matter; repeated rows come back each.
    """

    def of_slice(part):
        rows = [secrets_of(x) for x in part["text"]]
        names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_literal"]
        return {"doc_id": part["doc_id"]} | {k: [r[i] for r in rows] for i, k in enumerate(names)}

    return scan(
        docs,
        ["doc_id", "text"],
        of_slice,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long",
    )
