"""Exact merge-type (BPE) encoding by backtracking, and decoding.

Spaces become a visible mark, one mark is put before a text that is not empty, and the
pieces of the vocabulary are merged best score first, leftmost first among equals. The
encoder never runs these merges over a text. It takes the longest piece at each place,
as an Aho-Corasick automaton lists them, and accepts a piece after its predecessor only
if merging the two pieces' text again gives just these two; else it tries the next
shorter piece, and steps back where none is left. Since a prefix has one valid encoding
at most, a place that failed once fails always, and a bitfield keeps such places, so
the work stays linear. Characters without a piece become one piece per byte.

A text is encoded in units, cut where no piece can reach across: before a mark that
follows something else, after a letter before anything else (where the vocabulary has
no piece that goes on there), and around characters without a piece. Units met again are
looked up, in a table of bounded size. Units with two marks in a row may meet pieces of
equal score, whose order depends on the place; they are merged directly, over a heap where
they are long.

Defined cases: a null text is encoded as an empty one; an empty text has the end id
only; every row is encoded for itself, so repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import map_texts, pieces

MARK = "\u2581"
# Entries of the per-task tables; a full one is emptied, which changes no result.
UNITS = 150_000
PAIRS = 150_000


class Ids(list):
    """A list of ids that also converts as an array does."""

    def tolist(self) -> list[int]:
        return list(self)


class Encoder:
    """Pieces of a model file, read with its own library, and the encoder over them."""

    def __init__(self, model: str) -> None:
        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        self.end = processor.eos_id()
        self.unknown = processor.unk_id()
        self.text: dict[int, str] = {}
        self.score: dict[str, float] = {}
        self.number: dict[str, int] = {}
        self.byte = [0] * 256
        self.value: dict[int, int] = {}
        for i in range(processor.get_piece_size()):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.value[i] = int(piece[3:5], 16)
            elif not (processor.is_control(i) or processor.is_unknown(i)):
                self.text[i] = piece
                self.number[piece] = i
                self.score[piece] = processor.get_score(i)
        if any(MARK in p.lstrip(MARK) for p in self.number):
            raise ValueError("a piece reaches across words")
        self.automaton = ahocorasick.Automaton()
        made = {p: (len(p), i) for p, i in self.number.items() if self.merge(p) == [p]}
        for piece, found in made.items():
            self.automaton.add_word(piece, found)
        self.automaton.make_automaton()
        # the longest piece that begins a piece and is shorter
        self.shorter = {
            i: next((made[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in made), None)
            for p, (_, i) in made.items()
        }
        self.units = self.unit_pattern()
        self.plain = {i: p.replace(MARK, " ") for i, p in self.text.items()} | {self.end: ""}
        self.cache: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}  # units that do not decode to themselves
        self.pairs: dict[int, bool] = {}

    def unit_pattern(self) -> re.Pattern:
        """Units: marks, then anything known; cut after a letter too, if no piece goes on there."""
        known = {c for p in self.number for c in p} - {MARK}
        letters = {c for c in known if c.isalpha()}
        if any(a in letters and b not in letters for p in self.number for a, b in zip(p, p[1:])):
            letters = set()
        others = re.escape("".join(sorted(known - letters)))
        word = f"[{re.escape(''.join(sorted(letters)))}]*" if letters else ""
        known = re.escape("".join(sorted(known)))
        return re.compile(f"{MARK}+[{others}]*{word}|(?:[{others}]+{word}|{word.replace('*', '+') or '(?!)'})|[^{known}{MARK}]")

    def merge(self, text: str) -> list[str]:
        """Merges, best score first and leftmost among equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def merge_long(self, text: str) -> list[str]:
        """The same merges over a heap of pairs, for texts of any length."""
        parts: list = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        score, heap = self.score, []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(parts):
                pair = parts[at] + parts[after[at]]
                if pair in score:
                    heap.append((-score[pair], at, pair)) if not ready else heapq.heappush(heap, (-score[pair], at, pair))

        ready = False
        for at in range(len(parts)):
            offer(at)
        heapq.heapify(heap)
        ready = True
        while heap:
            _, at, pair = heapq.heappop(heap)
            other = after[at] if parts[at] is not None else len(parts)
            if other >= len(parts) or parts[at] + parts[other] != pair:
                continue  # one of the two has been merged since
            parts[at], parts[other] = pair, None
            after[at] = after[other]
            if after[at] < len(parts):
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [p for p in parts if p is not None]

    def follows(self, left: int, right: int) -> bool:
        """Whether merging the text of both pieces gives just these two."""
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        a, b = self.text[left], self.text[right]
        found = self.pairs[left << 20 | right] = self.merge(a + b) == [a, b]
        return found

    def encode_unit(self, unit: str) -> list[int]:
        if unit.startswith(MARK * 2):
            return [self.number[p] for p in (self.merge if len(unit) < 32 else self.merge_long)(unit)]
        if len(unit) == 1 and unit not in self.number:
            return [self.byte[b] for b in unit.encode()]
        n = len(unit)
        longest: list = [None] * n
        for last, found in self.automaton.iter(unit):
            longest[last + 1 - found[0]] = found  # longer ones come later
        known, shorter = self.pairs.get, self.shorter
        ids: list[int] = []
        places: list[int] = []
        failed, place = 0, 0
        option = longest[0]
        while place < n:
            while option is not None:
                size, i = option
                if not failed >> (place + size) & 1:
                    if not ids:
                        break
                    fits = known(ids[-1] << 20 | i)
                    if fits or fits is None and self.follows(ids[-1], i):
                        break
                option = shorter[i]
            if option is None:
                failed |= 1 << place
                place = places.pop()
                option = shorter[ids.pop()]
            else:
                ids.append(i)
                places.append(place)
                place += size
                option = longest[place] if place < n else None
        return ids

    def unit(self, unit: str) -> bytes:
        """The ids in decimals; kept for the next time. Decoding the ids is checked here."""
        ids = self.encode_unit(unit)
        back = b"".join([self.raw(i) for i in ids])
        if back != unit.replace(MARK, " ").encode():
            self.odd[unit] = back
        found = " ".join(map(str, ids)).encode()
        if len(unit) <= 64:
            if len(self.cache) >= UNITS:
                self.cache.clear()
            self.cache[unit] = found
        return found

    def raw(self, i: int) -> bytes:
        if i in self.value:
            return bytes((self.value[i],))
        return self.text[i].replace(MARK, " ").encode() if i in self.text else b""

    def cut(self, text: str) -> list[str]:
        return self.units.findall(MARK + text.replace(" ", MARK)) if text else []

    def encode(self, text: str | None) -> list[int]:
        """All ids, the end id last."""
        return Ids(self.encode_array(text).tolist())

    def encode_array(self, text: str | None) -> np.ndarray:
        """The ids of ``encode``, smaller in memory; units met before are looked up."""
        known = self.cache.get
        found = [known(u) or self.unit(u) for u in self.cut(text or "")]
        found.append(str(self.end).encode())
        return np.array(b" ".join(found).split(), dtype=np.int32)

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: one leading space is dropped, broken bytes become U+FFFD each."""
        try:
            text = "".join([self.plain[i] for i in ids])
        except KeyError:  # bytes, unknown or control ids
            return self.decode_any(ids)
        return text[1:] if text.startswith(" ") else text

    def decode_any(self, ids: list[int]) -> str:
        out, bytes_ = [], bytearray()
        first = True
        for i in [*ids, self.end]:
            if i in self.value:
                bytes_.append(self.value[i])
                continue
            if bytes_:
                out.append(self.characters(bytes(bytes_)))
                bytes_.clear()
                first = False
            if i == self.unknown:
                out.append(" \u2047 ")
                first = False
            elif i in self.text:
                piece = self.text[i]
                if first and piece.startswith(MARK):
                    piece = piece[1:]
                out.append(piece.replace(MARK, " "))
                first = False
        return "".join(out)

    @staticmethod
    def characters(raw: bytes) -> str:
        out, at = [], 0
        while at < len(raw):
            for size in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + size].decode())
                    at += size
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("\ufffd")
                at += 1
        return "".join(out)

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """(ids, hash of the ids, hash of the decoded text), unit by unit."""
        units, known = self.cut(text or ""), self.cache.get
        found = [known(u) or self.unit(u) for u in units]
        found.append(str(self.end).encode())
        ids = b" ".join(found)
        if self.odd and not self.odd.keys().isdisjoint(units):
            back = b"".join([self.odd.get(u, u.replace(MARK, " ").encode()) for u in units])
        else:
            back = "".join(units).replace(MARK, " ").encode()
        return (
            ids.count(b" ") + 1,
            hashlib.sha256(ids).hexdigest(),
            hashlib.sha256(back[1:]).hexdigest(),  # without the mark that was put before
        )


@lru_cache(maxsize=2)
def encoder(model: str) -> Encoder:
    return Encoder(model)


def token_digests(docs: DataFrame, model: str) -> DataFrame:
    """Per document: number of ids, hash of the ids, hash of the decoded text."""
    return map_texts(
        docs, ["doc_id"], None, "n_tokens long, ids_sha256 string, decoded_sha256 string",
        start=lambda: encoder(model).digest,
    )


def encode_texts(docs: DataFrame, model: str, out: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text in column ``out`` (replaced if it is there)."""
    kept = docs.drop(out) if out in docs.columns else docs
    columns = kept.columns

    def run(batches):
        encode = encoder(model)
        for batch in batches:
            for piece in pieces(batch):
                ids = [encode.encode_array(t) for t in piece.column("text").to_pylist()]
                arrays = [piece.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(ids, pa.list_(pa.int32()))], names=[*columns, out]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields}, `{out}` array<int>")


def decode_ids(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with the text of its ids as text, without the ids."""
    columns = [c for c in encoded.columns if c not in (ids, "text")]

    def run(batches):
        decode = encoder(model).decode
        for batch in batches:
            for piece in pieces(batch):
                texts = [decode(x or []) for x in piece.column(ids).to_pylist()]
                arrays = [piece.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(texts, pa.string())], names=[*columns, "text"]
                )

    fields = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name in columns
    )
    out = encoded.mapInArrow(run, ", ".join(x for x in (fields, "text string") if x))
    return out.select(*[F.col(c) for c in encoded.columns if c != ids and c != "text"], "text")


def round_trip(docs: DataFrame, model: str, ids: str = "token_ids", count: str = "n_tokens") -> DataFrame:
    """``docs`` with ``ids`` and ``count`` of each text, and as text what these ids decode to.

    One pass, so that a task holds the tables of one encoder. Columns named like ``ids`` or
    ``count`` are replaced; the others stay as they are, whatever their names.
    """
    names = [c for c in docs.columns if c not in (ids, count)]
    kept = docs.select(*[F.col(f"`{c}`") for c in names]).toDF(*[f"c{i}" for i in range(len(names))])
    place = names.index("text")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields)

    def run(batches):
        own = encoder(model)
        for batch in batches:
            for piece in pieces(batch, 64):
                found = [own.encode_array(t) for t in piece.column(place).to_pylist()]
                columns = list(piece.columns)
                columns[place] = pa.array([own.decode(f.tolist()) for f in found], pa.string())
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                sizes = pa.array(np.diff(ends).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*columns, lists, sizes], names=[*piece.schema.names, "ids", "count"])

    return kept.mapInArrow(run, f"{fields}, ids array<int>, count long").toDF(*names, ids, count)
