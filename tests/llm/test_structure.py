"""Personal data, conversation repair and whitening against brute force."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest

from tablecraft.llm import personal, turns, whitening
from tablecraft.llm.queries import QUERIES


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- personal data


def plain_spans(text):
    """The base patterns as they are written down."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c in "0123456789"]
        total = sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], personal.KINDS.index(s[0])))


def test_base_spans_of_random_texts():
    rnd = random.Random(5)
    met = set()
    for i in range(20_000):
        letters = ("0123459+++@@..-- a_%é(", "0123456789-  5555")[i % 2]
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(5, 60)))
        got = personal.base_spans(text)
        assert got == plain_spans(text)
        met |= {kind for kind, _, _ in got}
    assert met == set(personal.BASE)


def test_personal_data_of_the_given_tables(spark, data, documents):
    rows = QUERIES["op11_personal_data"](spark, data).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    assert len(rows) == len(texts)
    for row in rows:
        base = plain_spans(texts[row["doc_id"]])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row["base_sha256"] == sha(written)
        assert [row[f"n_{k}"] for k in personal.BASE] == [sum(s[0] == k for s in base) for k in personal.BASE]
        assert set(written.split(",")) - {""} <= set(row["spans"].split(","))
    assert sum(row["n_email"] for row in rows) > 0


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("My IBAN: DE89 3704 0044 0532 0130 00 OK", "iban", "DE89 3704 0044 0532 0130 00"),
        ("account GB82WEST12345698765432.", "iban", "GB82WEST12345698765432"),
        ("account GB82WEST12345698765433.", "iban", None),  # fails mod-97
        ("ssn 123-45-6789", "ssn", "123-45-6789"),
        ("order 123-45-6789", "ssn", None),
        ("ssn 666-45-6789", "ssn", None),
        ("born on 12.03.1984 in", "birth", "12.03.1984"),
        ("released on 12.03.1984 in", "birth", None),
        ("born on 32.13.1984 in", "birth", None),
        ("call (555) 123-4567 now", "local", "(555) 123-4567"),
        ("size (555) 123-4567 now", "local", None),
        ("routing number 021000021 at bank", "routing", "021000021"),
        ("routing number 021000022 at bank", "routing", None),
        ("NHS patient 943 476 5919", "health", "943 476 5919"),
        ("NHS patient 943 476 5918", "health", None),
        ("phone 943 476 5919, example test order", "local", None),
    ],
)
def test_checks_and_nearby_words_decide_added_spans(text, kind, found):
    _, spans = personal.spans_of(text)
    assert [text[a:b] for k, a, b in spans if k == kind] == ([found] if found else [])


def test_base_spans_win_over_added_ones():
    text = "call phone +49 30 123 4567 or 4111 1111 1111 1111"
    base, spans = personal.spans_of(text)
    assert [k for k, _, _ in base] == ["phone", "card"]
    assert spans == base
    assert personal.masked(text) == "call phone [phone] or [card]"


@pytest.mark.parametrize("unit", ["1", "1 ", "a", "@a.", "+1(", "a@", "1.", "AB12 ", "12-34-", "1.2.3.4 a@b.c "])
def test_very_long_texts_take_little_time(unit):
    start = time.time()
    personal.spans_of(unit * (300_000 // len(unit)))
    assert time.time() - start < 8


def test_personal_data_of_odd_rows(spark, odd, none):
    rows = personal.personal_spans(odd).collect()
    assert len(rows) == odd.count()
    assert {r["base_sha256"] for r in rows if not r["spans"]} == {sha("")}
    assert personal.personal_spans(none).count() == 0
    more = odd.selectExpr("*", "'x' AS `n_email`", "'y' AS `a.b`")
    assert sorted(map(str, personal.personal_spans(more).collect())) == sorted(map(str, rows))
    masked = personal.mask_personal(more)
    assert masked.columns == more.columns and masked.count() == odd.count()
    assert personal.mask_personal(none).count() == 0


# --- conversations

BLANKS = " \t\n\x0b\x0c\r"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
FULL = {"u": "user", "a": "assistant"}


def cheapest(rows, faults):
    """(cost, audit, texts) by trying every edit at every place, from the end."""
    memo = {}

    def go(i, phase, inserted):
        if (i, phase, inserted) in memo:
            return memo[i, phase, inserted]
        ways = []
        if i == len(rows) and phase in (0, 3):
            ways.append((0, "", ()))
        steps = []
        if i < len(rows):
            _, role, text = rows[i]
            steps.append((4, "D", (), i + 1, phase))
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 * (faults[i] == "truncated")
                for initial, after in NEXT[phase].items():
                    if role[:1] == initial:
                        steps.append((extra, "K", (role + ":" + text,), i + 1, after))
                    if initial in FULL:
                        steps.append((3 + extra, "R", (FULL[initial] + ":" + text,), i + 1, after))
        if inserted < 3:
            for initial, after in NEXT[phase].items():
                if initial in FULL:
                    steps.append((3, "I", (FULL[initial] + ":",), i, after))
        for cost, letter, said, j, after in steps:
            rest = go(j, after, inserted + 1 if letter == "I" else 0)
            if rest is not None:
                ways.append((cost + rest[0], letter + rest[1], said + rest[2]))
        memo[i, phase, inserted] = min(ways, key=lambda w: w[:2], default=None)
        return memo[i, phase, inserted]

    return go(0, 0, 0)


def brute_repair(rows):
    conversations = {}
    for conv, turn, role, text in rows:
        conversations.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, given in conversations.items():
        after = []
        for turn, role, text in given:
            name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            fate = zlib.crc32(name.encode()) % 20
            if fate == 1:
                text = ""
            if fate == 2:
                text = re.sub("[.!?]", "", text)
            if fate == 4:
                role = "user"
            after += [(turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in after:
            bare = text.rstrip(BLANKS)
            faults.append(
                "blank" if not bare else "duplicate" if (role, text) in seen
                else "truncated" if bare[-1] not in ".!?" else ""
            )
            seen.add((role, text))
        times = [t for t, _, _ in after if t is not None]
        gaps = max(times) - min(times) + 1 - len(set(times)) if times else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
        cost, audit, said = cheapest(after, faults)
        counts = (faults.count(f) for f in ("blank", "duplicate", "truncated"))
        out[conv] = (gaps, *counts, illegal, cost, audit, sha("\n".join(said)))
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(df):
    rows = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def four(df):
    return [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in df.collect()]


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def test_repair_of_the_given_tables(spark, data):
    given = four(spark.read.parquet(f"{data}/conversations.parquet"))
    got = repaired(QUERIES["op12_conversation_repair"](spark, data))
    assert got == brute_repair(given)


def random_conversations(seed, sizes):
    rnd = random.Random(seed)
    roles = ["user", "assistant"] * 4 + ["system", None, "tool", "ux", ""]
    texts = ["hi.", "yes?", "no", " ", None, ""] + [f"x{i}." for i in range(20)] + [f"y{i}" for i in range(5)]
    rows = []
    for conv, size in enumerate(sizes):
        for turn in range(size):
            for _ in range(rnd.choice([1] * 9 + [2])):
                rows.append((conv or None, None if rnd.random() < 0.05 else turn, rnd.choice(roles), rnd.choice(texts)))
    return rows


@pytest.mark.parametrize("most, fan", [(32, 256), (2, 2)])
def test_long_conversations_are_cut_into_stretches(spark, monkeypatch, most, fan):
    monkeypatch.setattr(turns, "FAN", fan)
    rows = random_conversations(most, [300, 1, 2, 3, 40, 0, 7, 90, *[5] * 12])
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(5)
    assert repaired(turns.repair_conversations(df, most)) == brute_repair(rows)


def test_one_conversation_with_most_rows_and_one_row_repeated(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for t in range(400)]
    rows += [(1, None, "user", "again.")] * 300 + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, CONVERSATIONS)
    want = brute_repair(rows)
    assert repaired(turns.repair_conversations(df)) == want
    ranged = turns.with_faults(turns.damaged(df))
    assert ranged.where("turn IS NULL").count() <= 1  # equal rows travel as one with a count


def test_conversations_of_odd_rows(spark):
    long_text = "words and more words. " * 20_000
    rows = [
        (None, None, None, None), (1, 0, "user", long_text), (1, 1, "assistant", long_text), (2, 0, None, "x."),
        (3, 5, "", ""), (4, 0, "user", "a\x85b c."), (4, 9, "assistant", "é!"), (4, 9, "assistant", "é!"),
    ]
    df = spark.createDataFrame(rows, CONVERSATIONS)
    want = brute_repair(rows)
    assert repaired(turns.repair_conversations(df)) == want
    clashing = df.selectExpr("*", "1 AS cost", "'x' AS audit", "2 AS `a.b`")
    assert repaired(turns.repair_conversations(clashing)) == want
    assert turns.repair_conversations(df.where("conv_id > 100")).count() == 0


def test_a_conversation_dropped_whole_is_returned(spark):
    turn = next(t for t in range(10_000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    got = repaired(turns.repair_conversations(spark.createDataFrame([(7, turn, "user", "a.")], CONVERSATIONS)))
    assert got == {7: (0, 0, 0, 0, 0, 0, "", sha(""))}


# --- whitening


def reference(vectors, weights="one", components=16):
    """id -> (n, deviation, whitened values), and the shares of variance."""
    kept = {
        k: np.floor(64 * np.array(v, dtype=np.float64)).astype(int) + 1_000_000
        for k, v in vectors.items()
        if v is not None and all(c is not None and np.isfinite(c) for c in v)
    }
    distinct, counts = np.unique(np.array(list(kept.values())), axis=0, return_counts=True)
    w = np.ones(len(distinct), int) if weights == "one" else counts
    n, sums = int(w.sum()), (distinct * w[:, None]).sum(axis=0)
    centred = (n * distinct - sums) / n
    covariance = (centred * w[:, None]).T @ centred / n
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1], basis[:, ::-1]
    return {
        k: (n, int(((n * x - sums) ** 2).sum()), ((n * x - sums) / n @ basis / np.sqrt(values))[:components])
        for k, x in kept.items()
    }, values / values.sum()


def agrees(rows, vectors, weights="one"):
    want, shares = reference(vectors, weights)
    got = {}
    for r in rows:
        n, deviation, values = want[r["vec_id"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert r["explained"] == pytest.approx(shares[r["component"] - 1], rel=1e-9)
        assert r["identity_error"] < 1e-9
        got[r["vec_id"], r["component"]] = r["whitened"]
    width = min(16, len(shares))
    assert set(got) == {(k, c) for k in want for c in range(1, width + 1)}
    for c in range(1, width + 1):
        a, b = (np.array(x) for x in zip(*[(got[k, c], want[k][2][c - 1]) for k in want]))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8


def test_whitening_of_the_given_tables(spark, data):
    given = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()}
    agrees(QUERIES["op13_embedding_whitening"](spark, data).collect(), given)


VECTORS = "vec_id long, embedding array<float>"


@pytest.mark.parametrize("weights", ["one", "count"])
def test_equal_vectors_are_one_vector_with_a_weight(spark, weights):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 5)).astype(np.float32)
    vectors = {i: [float(c) for c in base[i if i < 40 else 0]] for i in range(400)}
    df = spark.createDataFrame(list(vectors.items()), VECTORS)
    assert whitening.distinct_vectors(whitening.on_grid(df, [])).count() == 40
    agrees(whitening.whiten(df, weights=weights).collect(), vectors, weights)


def test_unusable_vectors_are_dropped(spark):
    good = {i: [float(i), float(i * i % 7), float(i % 3)] for i in range(10)}
    bad = [
        (20, None), (21, [1.0, None, 2.0]), (22, [1.0, float("nan"), 2.0]), (23, [float("inf"), 0.0, 0.0]),
        (24, []), (25, [1.0]),
    ]
    df = spark.createDataFrame([*good.items(), *bad], VECTORS)
    agrees(whitening.whiten(df).collect(), good)
    clashing = df.selectExpr("*", "'x' AS x", "1 AS n", "2 AS whitened", "3 AS `a.b`")
    agrees(whitening.whiten(clashing).collect(), good)


def test_null_and_repeated_ids_keep_their_rows(spark):
    rows = [(None, [1.0, 0.0]), (None, [0.0, 1.0]), (1, [0.5, 0.25]), (1, [0.5, 0.25])]
    out = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(out) == 4 * 2 and {r["n"] for r in out} == {3}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_tables_without_variance_give_no_components(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect() == []


def test_far_entries_and_flat_dimensions(spark):
    rows = [(i, [float(i) * 1e30, 3.0, float(i % 2)]) for i in range(6)]
    out = whitening.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r["component"] for r in out} <= {1, 2} and {r["deviation"] for r in out} == {None}
