"""Secrets found by reading assignments, beside three fixed patterns.

The fixed patterns give ``assign``, ``access`` and ``hex`` spans. The lexer then reads
source and configuration syntax into pairs of a target name and its literals:

* around every ``=``, ``:``, ``:=`` and ``=>``: a name (plain, dotted, quoted or in
  brackets, with an optional type), and a value: quoted on one line or in three quotes
  over lines, with escapes and prefixes, joined by ``+``, bare to the next delimiter,
  or the indented block after ``name: |``;
* calls: ``put("name", value)`` and ``name(value)``, unless the call's name says that
  it reads something;
* elements: ``<name>value</name>``.

Names that were given a literal are constants. A value that names constants, by itself,
in a sum, in braces of an f-string or as an argument, passes the new name on to their
literals, so a literal is scored by the most sensitive name it reaches: the weight of
the words of that name times the strength of the literal. Constants of a sum are judged
one by one, literals joined directly are judged together. Literals that reach ``LIMIT``
are added as ``named`` spans, unless a fixed pattern has them. A call or a lookup
(``os.getenv(...)``, ``conf["x"]``) is no literal.

Defined cases: a null text is an empty one and has no spans; the whole text is read,
however long, names and gaps of any length, in time in proportion to it (blocks nested
in blocks are read once per level); repeated rows give repeated results; other columns
play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from tablecraft.llm.common import map_texts, pieces

KINDS = ("assign", "access", "hex", "named")
LIMIT = 0.5

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_STEMS = ("passw", "secret", "token", "api")

# How much a word of a target name says that its value is secret.
WORDS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
    "credential": 0.9, "credentials": 0.9, "apikey": 1.0, "privatekey": 1.0, "auth": 0.7,
    "authorization": 0.8, "bearer": 0.9, "pass": 0.8, "key": 0.4,
}
# Words that make a key a secret one.
KEY_WORDS = {"api", "access", "private", "signing", "encryption", "master", "account", "shared"}
STEMS = ("pass", "pwd", "secret", "token", "cred", "key", "auth", "bearer")
PLACEHOLDER = re.compile(
    r"^(?:[x*.\-_#]+|<.*>|\$\{?.*|\{\{.*|%.*%|(?:your|my|the|an?)[-_ ].*|change[-_]?me.*|"
    r"example.*|placeholder.*|todo.*|none|null|nil|true|false|undefined|redacted)$",
    re.IGNORECASE,
)

SEPARATOR = re.compile(r"(?<![=!<>:+*/|&-])(?::=|=>|=|:)(?![=:/])")
# Names are read from their separator to the left, in the reversed text.
NAME = re.compile(r"[ \t]*+[\"'\]]{0,2}([\w.\-]++)")
TYPED = re.compile(r"[ \t]*+[\w.\[\]]++(?<=[A-Za-z_])[ \t]*+:[ \t]*+([\w.\-]++)")
NAME_START = re.compile(r"[A-Za-z_]")
IDENTIFIER = re.compile(r"[A-Za-z_][\w.\-]*")
BLANKS = re.compile(r"[ \t]*")
OPEN = re.compile(r"([rRbBuUfF]{0,2})(\"\"\"|\'\'\'|[\"\'`])")
REST = {q: re.compile(rf"((?:[^{q}\\\n]|\\[\s\S])*+){q}") for q in "\"'`"}
ESCAPE = re.compile(r"\\([\s\S])")
BRACES = re.compile(r"\{([^{}]*)\}")
BARE = re.compile(r"[^\s,;\"'`()<>{}\[\]]+")
PLUS = re.compile(r"[ \t]*\+[ \t]*")
BLOCK = re.compile(r"[|>][+\-0-9]{0,2}[ \t]*(?:#[^\n]*)?\n")
CALL = re.compile(r"(?<![\w.])([A-Za-z_][\w.]*+)\([ \t]*+")
ELEMENT = re.compile(r"<([A-Za-z_][\w.\-:]*+)(?:\s[^<>]*+)?>([^<>]++)</\1\s*>")
CAMEL = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
# Words of a call's name that say that its argument is where to look, not what to keep.
READERS = {
    "get", "read", "load", "fetch", "find", "is", "has", "check", "lookup", "input", "prompt",
    "ask", "require", "delete", "remove", "print", "log",
}


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) of the fixed patterns."""
    out = []
    folded = text.lower()
    if any(stem in folded for stem in ASSIGN_STEMS):
        out += [
            ("assign", m.start(), m.end(), m.start(2))
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= 6
        ]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    return out


def name_weight(name: str) -> float:
    words = [w.lower() for w in CAMEL.findall(name)]
    weight = max((WORDS.get(w, 0.0) for w in words), default=0.0)
    if "key" in words and KEY_WORDS & set(words):
        weight = 1.0
    return weight


def strength(value: str) -> float:
    """0 to 1: how much a literal looks like key material."""
    if len(value) < 6 or PLACEHOLDER.match(value):
        return 0.0
    counts = Counter(value)
    entropy = -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values())
    kinds = sum(
        any(test(c) for c in value)
        for test in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum())
    )
    if kinds < 2 or not any(c.isalnum() for c in value):
        return 0.2
    return min(1.0, entropy / 3.2) * min(1.0, len(value) / 8)


class Literal(NamedTuple):
    """Characters of the text from start to end; ``value`` is what they stand for."""

    value: str
    start: int
    end: int


class Bare(Literal):
    """An unquoted value, which may be the name of a constant."""


def quoted(text: str, at: int) -> tuple[Literal, list[str], int] | None:
    """The quoted literal at ``at``, names in its braces, and the place after it.

    None where no literal starts or it stays open.
    """
    if not (opened := OPEN.match(text, at)):
        return None
    quote, start = opened.group(2), opened.end()
    if len(quote) == 3:
        end = text.find(quote, start)
        if end < 0:
            return None
        value, after = text[start:end], end + 3
    else:
        if not (rest := REST[quote].match(text, start)):
            return None
        value, end, after = ESCAPE.sub(r"\1", rest.group(1)), rest.end(1), rest.end()
    names = []
    if opened.group(1).lower() in ("f", "rf", "fr"):
        names = [n.strip() for n in BRACES.findall(value)]
        value = BRACES.sub("", value)
    return Literal(value, start, end), names, after


def value_at(text: str, at: int, limit: int) -> tuple[list[Literal], list[str]]:
    """Literals and names of constants of the value that starts at ``at``; bare ones end by ``limit``."""
    literals: list[Literal] = []
    names: list[str] = []
    joined: list[Literal] = []
    first = True
    while True:
        if found := quoted(text, at):
            joined.append(found[0])
            names += found[1]
            at = found[2]
        elif bare := BARE.match(text, at, limit):
            value = bare.group().rstrip(".:")
            after = text[bare.end() : bare.end() + 1]
            if not value or (after and after in "([" and IDENTIFIER.fullmatch(value)):
                break
            if first:
                literals.append(Bare(value, at, at + len(value)))
            else:
                names.append(value)
            at = bare.end()
        else:
            break
        first = False
        if not (more := PLUS.match(text, at)):
            break
        at = more.end()
    if joined:
        value = "".join(part.value for part in joined)
        literals.append(Literal(value, joined[0].start, joined[-1].end))
    return literals, names


def block_at(text: str, key: int, at: int) -> Literal | None:
    """Lines from ``at`` that are indented further than the line of ``key``."""
    line = text.rfind("\n", 0, key) + 1
    indent = BLANKS.match(text, line).end() - line
    first = last = None
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        begin = BLANKS.match(text, at, end).end()
        if begin < end:
            if begin - at <= indent:
                break
            first, last = begin if first is None else first, end
        at = end + 1
    return None if first is None else Literal(text[first:last], first, last)


def assignments(text: str) -> list[tuple[int, str, list[Literal], list[str]]]:
    """(place, name, literals, names of constants) around separators."""
    out = []
    back, size = text[::-1], len(text)
    before = earlier = 0  # ends of the last two separators: no name reaches across
    read = 0  # a separator before it is inside a bare value, and its own ends at the next one
    marks = list(SEPARATOR.finditer(text))
    for i, m in enumerate(marks):
        name = m.group() == "=" and TYPED.match(back, size - m.start(), size - earlier)
        name = name or NAME.match(back, size - m.start(), size - before)
        earlier, before = before, m.end()
        if not name:
            continue
        word = name.group(1)[::-1]
        if not (start := NAME_START.search(word)):
            continue
        word = word[start.start() :]
        at = BLANKS.match(text, m.end()).end()
        if m.group() == ":" and (block := BLOCK.match(text, at)):
            if name_weight(word) >= LIMIT and (found := block_at(text, m.start(), block.end())):
                out.append((m.start(), word, [found], []))
            continue
        inner = m.start() < read and i + 1 < len(marks)
        literals, names = value_at(text, at, max(at, marks[i + 1].start()) if inner else size)
        read = max([read, *(v.end for v in literals if isinstance(v, Bare))])
        if literals or names:
            out.append((m.start(), word, literals, names))
    return out


def calls(text: str) -> list[tuple[int, str, list[Literal], list[str]]]:
    """The same from calls of two arguments, the first a name, or of one."""
    out = []
    for m in CALL.finditer(text):
        if found := quoted(text, m.end()):
            literal, names, after = found
            after = BLANKS.match(text, after).end()
            if text[after : after + 1] == "," and IDENTIFIER.fullmatch(literal.value):
                at = BLANKS.match(text, after + 1).end()
                values, names = value_at(text, at, len(text))
                names += [v.value for v in values if isinstance(v, Bare)]
                values = [v for v in values if not isinstance(v, Bare)]
                out.append((m.start(), literal.value, values, names))
                continue
            values = [] if any(map(str.isspace, literal.value)) else [literal]
        elif bare := IDENTIFIER.match(text, m.end()):
            values, names, after = [], [bare.group()], BLANKS.match(text, bare.end()).end()
        else:
            continue
        words = {w.lower() for w in CAMEL.findall(m.group(1))}
        if text[after : after + 1] == ")" and not words & READERS:
            out.append((m.start(), m.group(1), values, names))
    return out


def elements(text: str) -> list[tuple[int, str, list[Literal], list[str]]]:
    """The same from markup."""
    out = []
    for m in ELEMENT.finditer(text):
        if value := m.group(2).strip():
            start = m.end(2) - len(m.group(2).lstrip())
            out.append((m.start(), m.group(1), [Literal(value, start, start + len(value))], []))
    return out


def named_spans(text: str) -> list[tuple[int, int]]:
    """Literals that reach a sensitive name, directly or through constants."""
    literals: list[Literal | None] = []  # None for a value made of others
    weights: list[float] = []
    parts: list[list[int]] = []
    constants: dict[str, int] = {}

    def add(literal: Literal | None, weight: float, of: list[int]) -> int:
        literals.append(literal)
        weights.append(weight)
        parts.append(of)
        return len(literals) - 1

    for _, name, values, names in sorted(
        assignments(text) + calls(text) + elements(text), key=lambda x: x[0]
    ):
        of = [constants[n] for n in names if n in constants]
        for value in values:
            if isinstance(value, Bare):
                used = [value.value] if value.value in constants else value.value.split("+")
                if all(n in constants for n in used):
                    of += [constants[n] for n in used]
                    continue
            of.append(add(value, 0.0, []))
        if of:
            constants[name] = add(None, name_weight(name), of)
    # A value is made of earlier ones, so one pass backwards carries every weight down.
    for i in range(len(literals) - 1, -1, -1):
        for part in parts[i]:
            weights[part] = max(weights[part], weights[i])
    best: dict[tuple[int, int], float] = {}
    for literal, weight in zip(literals, weights):
        if literal and weight >= LIMIT and literal.start < literal.end:
            place = (literal.start, literal.end)
            best[place] = max(best.get(place, 0.0), weight * strength(literal.value))
    return [place for place, score in best.items() if score >= LIMIT]


def outside(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """``spans`` that lie within none of ``taken``."""
    taken = sorted(taken)
    starts = [s for s, _ in taken]
    reach = list(accumulate((e for _, e in taken), max))
    return [
        (a, b) for a, b in spans
        if not (at := bisect_right(starts, a)) or reach[at - 1] < b
    ]


def spans_of(text: str | None) -> list[tuple[str, int, int, int]]:
    """All spans by start, then kind as listed."""
    text = text or ""
    out = base_spans(text)
    folded = text.lower()
    if any(stem in folded for stem in STEMS) and any(mark in text for mark in "=:(<"):
        taken = [(s, e) for _, s, e, _ in out]
        out += [("named", a, b, a) for a, b in outside(named_spans(text), taken)]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def written(spans: list[tuple[str, int, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)


def secret_digest(text: str | None) -> tuple:
    spans = spans_of(text)
    base = [s for s in spans if s[0] != "named"]
    counts = Counter(s[0] for s in spans)
    return (
        *(counts[k] for k in KINDS),
        hashlib.sha256(written(base).encode()).hexdigest(),
        written(spans),
    )


def secret_spans(docs: DataFrame) -> DataFrame:
    """Per document: counts by kind, the digest of the base spans, and all spans."""
    return map_texts(
        docs, ["doc_id"], secret_digest,
        "n_assign long, n_access long, n_hex long, n_named long, base_sha256 string, spans string",
    )


def redacted(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with every value found replaced by ``mark``; overlapping ones once."""
    spans = sorted((v, e) for _, _, e, v in spans_of(text))
    if not spans:
        return text
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in the text; n_chars follows where the text changed."""
    columns = docs.columns

    def run(batches):
        for batch in batches:
            for piece in pieces(batch):
                texts = piece.column("text").to_pylist()
                clean = [redacted(t) for t in texts]
                arrays = dict(zip(columns, (piece.column(c) for c in columns)))
                arrays["text"] = pa.array(clean, pa.string())
                if "n_chars" in arrays:
                    sizes = arrays["n_chars"].to_pylist()
                    arrays["n_chars"] = pa.array(
                        [n if a == b else len(b) for n, a, b in zip(sizes, texts, clean)],
                        arrays["n_chars"].type,
                    )
                yield pa.RecordBatch.from_arrays(list(arrays.values()), names=columns)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, fields)
