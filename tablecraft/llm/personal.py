"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Four base kinds (``email``, ``ip``, ``card``, ``phone``) follow fixed patterns and checks,
and every base span stays. Further kinds are proposed by patterns of their own and pass
three steps: a validator (mod-97 for ``iban``, weighted digit sums for ``routing`` and
``health``, assignable numbers for ``ssn``, the calendar for ``birth``, the digit count
for ``local`` phone numbers), a score of the kind, and the words just before and after
the span, which raise or lower it. A span of score ``LIMIT`` or more is added unless
a base span or a better added one overlaps it.

Defined cases: a null text is an empty one and has no spans; the whole text is read in one
pass per kind, so time grows with its length however it looks; repeated rows give
repeated results; a table without rows gives none; further columns of the input are left
out by ``personal_spans`` and kept by ``mask_personal``, whatever their names.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tablecraft.llm.common import map_texts, pieces

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "routing", "health", "birth", "local")
KINDS = BASE + ADDED
LIMIT = 0.5
AROUND = 48  # characters on each side that count as nearby

Span = tuple[str, int, int]

# The base patterns. Runs are possessive and start where a run starts, which
# finds the same spans as the plain patterns without trying a long run at every place.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def digits_of(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    """Every second digit from the right doubled, its digits summed; the total ends in 0."""
    doubled = (sum(divmod(2 * d, 10)) for d in digits[-2::-2])
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """At every @ the longest local part to its left and domain to its right."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            yield m.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = digits_of(m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= len(digits_of(m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start, then kind as listed."""
    found = [("email", *s) for s in emails(text)] if "@" in text else []
    if HAS_DIGIT.search(text):
        found += [("ip", *s) for s in ips(text)] if "." in text else []
        found += [("card", *s) for s in cards(text)]
        found += [("phone", *s) for s in phones(text)] if "+" in text else []
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


HAS_DIGIT = re.compile(r"[0-9]")
# Added kinds. Every pattern has a bounded reach, so each place costs a bounded time.
IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})([\x20-])([0-9]{2})\2([0-9]{4})(?![0-9]|-[0-9])")
NINE = re.compile(r"(?<![0-9.,-])[0-9]{9}(?![0-9]|[.,-][0-9])")
TEN = re.compile(r"(?<![0-9-])[0-9]{3}[\x20-]?[0-9]{3}[\x20-]?[0-9]{4}(?![0-9]|-[0-9])")
DATE = re.compile(r"(?<![0-9./-])(?:([0-9]{4})([-/.])([0-9]{1,2})\2([0-9]{1,2})|([0-9]{1,2})([-/.])([0-9]{1,2})\6([0-9]{4}))(?![0-9]|[./-][0-9])")
CALL = re.compile(r"(?<![0-9+(.-])\(?[0-9]{2,5}\)?[\x20./-]{1,3}[0-9]{2,4}(?:[\x20./-][0-9]{2,4}){0,3}(?![0-9]|[./-][0-9])")

# The length of an account number by country.
IBAN_LENGTHS = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18,
    "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GI": 23, "GR": 27, "HR": 21, "HU": 28,
    "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31,
    "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27,
}


def mod97(account: str) -> bool:
    """The account moved behind its check digits, letters as 10 to 35, leaves 1."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def ibans(text: str) -> Iterator[tuple[int, int, float]]:
    for m in IBAN.finditer(text):
        # a following word of capitals may look like more of the number: cut by country
        length = IBAN_LENGTHS.get(m.group()[:2])
        plain, at = "", m.start()
        while length and len(plain) < length and at < m.end():
            plain += text[at].strip()
            at += 1
        whole = at == m.end() or text[at] == " "
        if length and len(plain) == length and whole and mod97(plain):
            yield m.start(), at, 0.9


def ssns(text: str) -> Iterator[tuple[int, int, float]]:
    for m in SSN.finditer(text):
        area, group, serial = m.group(1, 3, 4)
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield *m.span(), 0.35


def routings(text: str) -> Iterator[tuple[int, int, float]]:
    """Bank routing numbers: digits weighted 3, 7, 1 sum to a multiple of 10."""
    for m in NINE.finditer(text):
        d = digits_of(m.group())
        if any(d) and sum(w * x for w, x in zip((3, 7, 1) * 3, d)) % 10 == 0:
            yield *m.span(), 0.25


def healths(text: str) -> Iterator[tuple[int, int, float]]:
    """Health service numbers: nine digits weighted 10 down to 2, check digit mod 11."""
    for m in TEN.finditer(text):
        d = digits_of(m.group())
        check = -sum(w * x for w, x in zip(range(10, 1, -1), d)) % 11
        if any(d) and check == d[9]:
            yield *m.span(), 0.25


def births(text: str) -> Iterator[tuple[int, int, float]]:
    for m in DATE.finditer(text):
        year, month, day = m.group(1, 3, 4) if m.group(1) else m.group(8, 7, 5)
        if 1900 <= int(year) <= 2100 and (is_date(year, month, day) or (m.group(8) and is_date(year, day, month))):
            yield *m.span(), 0.2


def is_date(year: str, month: str, day: str) -> bool:
    try:
        dt.date(int(year), int(month), int(day))
    except ValueError:
        return False
    return True


def locals_(text: str) -> Iterator[tuple[int, int, float]]:
    """Telephone numbers without a country: 7 to 11 digits in groups."""
    for m in CALL.finditer(text):
        if 7 <= len(digits_of(m.group())) <= 11:
            yield *m.span(), 0.2


PROPOSE: dict[str, Callable[[str], Iterator[tuple[int, int, float]]]] = {
    "iban": ibans, "ssn": ssns, "routing": routings, "health": healths, "birth": births, "local": locals_,
}
# Words nearby that speak for a kind.
FOR = {
    "iban": "iban account bank konto transfer compte",
    "ssn": "ssn social security taxpayer tin",
    "routing": "routing aba bank wire transit",
    "health": "nhs health patient medical insurance",
    "birth": "born birth birthday dob birthdate geboren",
    "local": "phone tel telephone call mobile cell fax dial contact whatsapp telefon",
}
# Words nearby that speak against all of them.
AGAINST = "order invoice version isbn issn serial sku part example sample test dummy build ticket page"
RAISE, LOWER = 0.4, 0.3
WORD = re.compile(r"[A-Za-z]+")
FOR_WORDS = {kind: frozenset(words.split()) for kind, words in FOR.items()}
AGAINST_WORDS = frozenset(AGAINST.split())


def score(text: str, kind: str, start: int, end: int, prior: float) -> float:
    """``prior`` moved by the nearby words; each side's words count once."""
    near = text[max(0, start - AROUND) : start] + " " + text[end : end + AROUND // 2]
    words = {w.lower() for w in WORD.findall(near)}
    value = prior + RAISE * bool(words & FOR_WORDS[kind]) - LOWER * bool(words & AGAINST_WORDS)
    return min(1.0, max(0.0, value))


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Proposed spans that reach the limit, the best of overlapping ones, none over a base span."""
    if not HAS_DIGIT.search(text):
        return []
    rated = [
        (-value, start, kind, end)
        for kind, propose in PROPOSE.items()
        for start, end, prior in propose(text)
        if (value := score(text, kind, start, end, prior)) >= LIMIT
    ]
    if not rated:
        return []
    taken = bytearray(len(text))
    for _, start, end in base:
        taken[start:end] = b"\1" * (end - start)
    out = []
    for _, start, kind, end in sorted(rated):
        if not any(taken[start:end]):
            taken[start:end] = b"\1" * (end - start)
            out.append((kind, start, end))
    return out


def spans_of(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start, then kind as listed."""
    text = text or ""
    base = base_spans(text)
    return base, in_order(base + added_spans(text, base))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest(text: str | None) -> tuple:
    base, every = spans_of(text)
    counts = Counter(kind for kind, _, _ in every)
    return (
        *(counts[k] for k in BASE), len(every) - len(base),
        hashlib.sha256(written(base).encode()).hexdigest(), written(every),
    )


def personal_spans(docs: DataFrame) -> DataFrame:
    """Per document: counts by base kind and of added spans, the base digest, all spans."""
    counts = ", ".join(f"n_{k} long" for k in BASE)
    return map_texts(docs, ["doc_id"], digest, f"{counts}, n_added long, base_sha256 string, spans string")


def masked(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping ones as one."""
    _, spans = spans_of(text)
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text


def mask_personal(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data masked in ``text``; other columns stay as they are."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                columns = list(piece.columns)
                columns[place] = pa.array([masked(t) for t in piece.column(place).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=piece.schema.names)

    # numbered names, since a name with a dot is read as a field of a struct
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
