"""Operators that relate documents: shards, near copies, repeats, multiset hashes."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from conftest import texts_of
from pyspark.sql import functions as F

from tablecraft.llm import common, multiset, near_copies, repeats, shards
from tablecraft.llm.common import components, rank_rows, store
from tablecraft.llm.queries import QUERIES

WORD = re.compile("[^\x20\x09-\x0d]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def closure(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


# --- helpers


def test_components_of_random_graphs(spark):
    draw = random.Random(4)
    for n, m in ((30, 25), (200, 150), (50, 0)):
        pairs = [(draw.randrange(n), draw.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(n // 3)]
        edges = spark.createDataFrame(pairs, "a long, b long")
        got = {r["node"]: r["component"] for r in components(edges).collect()}
        expected = closure(n, pairs)
        assert got == {i: expected[i] for i in range(n) if expected.count(expected[i]) > 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rank_rows_is_gapless_and_ordered(spark):
    values = [random.Random(9).randrange(50) for _ in range(1000)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long").repartition(7)
    rows = rank_rows(df, [F.col("v"), F.col("id")], "at").sort("at").collect()
    assert [r["at"] for r in rows] == list(range(1000))
    assert [(r["v"], r["id"]) for r in rows] == sorted((v, i) for i, v in enumerate(values))


# --- shards


def check_shards(rows, texts):
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) <= set(range(24)) and len(rows) == len(texts)
    sizes = [counts[s] for s in range(24)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(24):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))
    assert {r["law"] for r in rows} <= {"rows"} and {r["grown_shard"] for r in rows} <= {None}


def test_shards_of_the_given_documents(spark, data, documents):
    rows = QUERIES["op1_label_propagation"](spark, data).collect()
    texts = texts_of(documents)
    check_shards(rows, texts)
    places = {}
    for r in rows:
        text = texts[r["doc_id"]]
        assert r["size"] == len((text or "").encode()) + 8
        assert r["text_crc32"] == zlib.crc32((text or "").encode())
        places.setdefault(text, set()).add(r["shard"])
    assert all(len(p) == 1 for p in places.values())


def test_one_text_with_a_third_of_all_rows_is_cut_little(spark):
    texts = {i: "hot" if i % 3 == 0 else f"t{i // 6}" if i % 5 else f"u{i}" for i in range(900)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = shards.shard_documents(docs).collect()
    check_shards(rows, texts)
    where = {}
    for r in rows:
        where.setdefault(texts[r["doc_id"]], Counter())[r["shard"]] += 1
    # 300 rows fill eight shards of 37 or 38 at best; evenly spread they would keep a third of that
    assert sum(n * n for n in where["hot"].values()) >= 0.5 * 300 * 37.5
    groups = [c for t, c in where.items() if t != "hot" and sum(c.values()) > 1]
    assert sum(len(c) == 1 for c in groups) >= 0.7 * len(groups)


def test_only_linked_documents(spark):
    texts = {i: f"t{i % 40}" for i in range(240)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = shards.shard_documents(docs).collect()
    check_shards(rows, texts)
    before = 40 * 15  # pairs within a group of six
    cut = sum(
        1
        for i in texts
        for j in texts
        if i < j and i % 40 == j % 40
        and next(r["shard"] for r in rows if r["doc_id"] == i) != next(r["shard"] for r in rows if r["doc_id"] == j)
    )
    assert cut < 0.5 * before


def test_quotas_never_exceed_the_room():
    draw = random.Random(2)
    for _ in range(200):
        asked = {(a, b): draw.randrange(20) for a in range(5) for b in range(5) if a != b}
        room = [draw.randrange(-3, 6) for _ in range(5)]
        got = shards.quotas(asked, room)
        assert all(0 <= got[k] <= asked[k] for k in asked)
        for s in range(5):
            net = sum(n for (a, b), n in got.items() if b == s) - sum(n for (a, b), n in got.items() if a == s)
            assert net <= max(0, room[s])


def test_documents_with_several_hubs_gather(spark):
    """Two hubs a document: clusters of twelve with six links each through pairs of hubs."""
    links = [(i, i // 12 * 100 + k, i * 7 % 11 % 6) for i in range(72) for k in (i % 3, 3 + i % 2)]
    df = spark.createDataFrame(links, "uid long, hub long, shard int")

    def together(of):
        return sum(of[i] == of[j] for i in range(72) for j in range(i) if i // 12 == j // 12)

    got = {r["uid"]: r["shard"] for r in shards.propagate(df, [12] * 6, several=True).collect()}
    assert len(got) == 72 and together(got) > 1.5 * together({i: s for i, _, s in links})
    assert max(Counter(got.values()).values()) <= 18


def test_shards_of_odd_rows(odd, none):
    rows = shards.shard_documents(odd.withColumnRenamed("lang", "shard").withColumnRenamed("source", "uid")).collect()
    check_shards(rows, [None] * odd.count())
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] == 3} == {(8, 0)}
    assert shards.shard_documents(none).count() == 0


# --- near copies


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(x) for x in zip(words, words[1:], words[2:])] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    f = np.array(prints, dtype=np.uint64)
    pairs = [
        (i, int(j)) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= 3) + i + 1
    ]
    return closure(len(f), pairs)


def test_near_copies_of_the_given_documents(spark, data, documents):
    got = {r["doc_id"]: r for r in QUERIES["op5_pivot_simhash"](spark, data).collect()}
    ids = sorted(got)
    texts = texts_of(documents)
    prints = [brute_fingerprint(texts[i]) for i in ids]
    assert [got[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i in ids] == [ids[r] for r in brute_groups(prints)]


@pytest.mark.parametrize("chunk", [4, 2048])
def test_groups_of_random_fingerprints(spark, monkeypatch, chunk):
    """Crowds around centres, chains of near fingerprints, and copies; small chunks too."""
    monkeypatch.setattr(near_copies, "CHUNK", chunk)
    draw = random.Random(6)
    prints = [0, 0, 1 << 63, (1 << 64) - 1]
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(25):
            near = centre
            for bit in draw.sample(range(64), draw.randint(0, 5)):
                near ^= 1 << bit
            prints.append(near)
        for step in range(0, 30, 3):
            prints.append(centre ^ ((1 << step) - 1))
    prints += prints[5:30]
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long").withColumn(
        "more", F.array().cast("array<long>")
    )
    got = {r["doc_id"]: r["component_id"] for r in near_copies.grouped(df, 3, 3).collect()}
    assert [got[i] for i in range(len(prints))] == brute_groups(prints)


def test_block_distances_bound_the_bits():
    draw = np.random.default_rng(3)
    a, b = draw.integers(0, 1 << 63, (2, 200), dtype=np.uint64)
    for blocks in (6, 8):
        da, db = near_copies.distances(a, blocks), near_copies.distances(b, blocks)
        gaps = np.abs(da.astype(int) - db.astype(int)).max(axis=2)
        assert (gaps.sum(axis=1) <= np.bitwise_count(a ^ b)).all()


def test_odd_rows_near_copies(odd, none):
    rows = near_copies.near_copies(odd.withColumnRenamed("lang", "fp").withColumnRenamed("source", "key")).collect()
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows]
    zero = "0" * 16
    assert len(got) == odd.count()
    assert {(i, c) for i, f, c in got if f == zero} == {(3, 3), (4, 3), (5, 3), (None, 3)}
    assert {c for i, _, c in got if i in (1, 2)} == {1}
    assert near_copies.near_copies(none).count() == 0


def test_keep_one_of_each_group(spark, odd, none):
    words = [f"w{i}" for i in range(300)]
    edited = words[:150] + ["other"] + words[151:]
    rows = [
        (5, " ".join(words), "a"), (3, " ".join(edited), "b"), (9, " ".join(words), None), (9, " ".join(words), None),
        (1, " ".join(f"v{i}" for i in range(300)), "a"), (7, " ".join(f"u{i}" for i in range(300)), "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 7]
    kept = near_copies.keep_one(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 2").count() == 0
    assert kept.where("doc_id in (1, 6, 7, 8)").count() == 4 and kept.where("text is null or trim(text) = ''").count() == 1
    assert near_copies.keep_one(none).count() == 0


DOCS = "doc_id long, text string"


def test_one_of_each_group_within_three_bits_stays(spark):
    """Edits of every extent, chains of them, a shared passage, copies and texts without words."""
    draw, texts = random.Random(5), []
    for k in range(120):
        words = [f"k{k}w{i}" for i in range(draw.choice([7, 60, 150, 400]))]
        for step in range(3):
            texts.append(" ".join(words))
            words[draw.randrange(len(words))] = f"e{k}_{step}"
    texts += [" ".join([f"u{k}"] + [f"common{i}" for i in range(40)]) for k in range(60)]
    texts += ["", None, " ", "one two", "ONE  two", "three four five six"] + texts[:9]
    groups = brute_groups([np.uint64(np.int64(near_copies.fingerprint64(t))) for t in texts])
    assert 100 < len(set(groups)) < len(texts) - 60
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(5)
    assert sorted(r["doc_id"] for r in near_copies.keep_one(docs).collect()) == sorted(set(groups))


def test_working_names_and_dots_in_other_columns(spark):
    docs = spark.createDataFrame([(2, "a b c d", "x", 1), (1, "a b c d", "y", 2)], "doc_id long, text string, `a.b` string, key long")
    more = docs.selectExpr("*", "key AS component", "key AS at", "key AS c0")
    kept = near_copies.keep_one(more)
    assert kept.columns == more.columns and [tuple(r) for r in kept.collect()] == [(1, "a b c d", "y", 2, 2, 2, 2)]


def test_null_and_repeated_ids_join_nothing(spark):
    texts = [" ".join(f"d{k}w{i}" for i in range(50)) for k in range(12)]
    rows = [(None if k < 6 else 7, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[:2] + [(None, texts[8]), (3, texts[9])], DOCS)
    kept = [tuple(r) for r in near_copies.keep_one(docs).collect()]
    assert sorted(t for _, t in kept) == sorted(texts)
    assert {t: k for k, t in kept} == {t: 3 if k == 9 else None if k < 6 else 7 for k, t in enumerate(texts)}


@pytest.mark.parametrize("run", [near_copies.keep_one, near_copies.near_copies])
def test_no_side_of_a_join_is_broadcast(odd, monkeypatch, run):
    """Rows are multiplied after the planner has sized them; stored files are smaller than their rows."""
    plans = []

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    for module in (near_copies, common):
        monkeypatch.setattr(module, "store", lambda df, name: store(planned(df), name))
    assert planned(run(odd)).count()
    assert sum("SortMergeJoin" in p for p in plans) >= 5 and not any("Broadcast" in p for p in plans)


# --- repeats


def brute_repeats(texts):
    words = [WORD.findall(t or "") for _, t in texts]
    runs = [[tuple(w[i : i + 35]) for i in range(len(w) - 34)] for w in words]
    counts = Counter(r for rs in runs for r in rs)
    out = []
    for (key, _), w, rs in zip(texts, words, runs):
        gone = [False] * len(w)
        for i, r in enumerate(rs):
            if counts[r] > 1:
                gone[i : i + 35] = [True] * 35
        out.append((key, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return Counter(out)


def got_repeats(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def test_repeats_of_the_given_documents(spark, data, documents):
    got = got_repeats(QUERIES["op8_block_anchors"](spark, data))
    expected = brute_repeats(list(texts_of(documents).items()))
    assert got == expected and sum(k[2] for k in got) > 0


@pytest.mark.parametrize("bits", [9, 30])
def test_repeats_of_planted_runs(spark, monkeypatch, bits):
    """Runs of 33 to 37 words and more at any offset, within and across documents; a full table too."""
    monkeypatch.setattr(repeats, "MAX_BITS", max(bits, 16))
    if bits == 9:
        monkeypatch.setattr(repeats, "BITS_PER_BLOCK", 0)
    draw = random.Random(8)
    planted = [[f"p{n}_{i}" for i in range(n)] for n in (33, 34, 35, 36, 37, 60, 90)]
    texts = []
    for d in range(120):
        words = []
        for _ in range(draw.randint(0, 5)):
            words += [f"r{draw.randrange(10**9)}" for _ in range(draw.randint(0, 50))]
            if draw.random() < 0.6:
                words += draw.choice(planted)
        texts.append((d, " ".join(words)))
    texts += [(500, "same " * 80), (501, "x\t\n" * 36), (502, "a b " * 30), (503, texts[3][1]), (503, texts[3][1])]
    texts += [(504, None), (505, ""), (506, "é" * 9000 + " w" * 40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert got_repeats(repeats.deduplicate(docs)) == brute_repeats(texts)


def test_repeats_of_odd_rows(odd, none):
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    clash = odd.withColumnRenamed("lang", "key").withColumnRenamed("source", "h")
    assert got_repeats(repeats.deduplicate(clash)) == brute_repeats(texts)
    assert repeats.deduplicate(none).count() == 0


def test_word_hashes_follow_the_words():
    text = "one two  one\ttwo\n" + "z" * 9000 + " " + "z" * 9001 + " one"
    h = repeats.word_hashes(text).tolist()
    assert h[0] == h[2] == h[6] and h[1] == h[3] and len(set(h)) == 4


# --- multiset hashes


def brute_edits(rows):
    ids = sorted({k for k, _ in rows if k is not None})
    ids = ([None] if any(k is None for k, _ in rows) else []) + ids
    first = {k: min(t or "" for i, t in rows if i == k) for k in ids}
    after = {k: ids[(n + 1) % len(ids)] for n, k in enumerate(ids)}
    out = []
    for k, t in rows:
        t = t or ""
        half = len(t) // 2
        out.append((k, len(t), sha(t[: len(t) - half] + first[after[k]][:half])))
    return Counter(out)


def test_multiset_query(spark, data, documents):
    rows = QUERIES["op9_multiset_hash"](spark, data).collect()
    texts = texts_of(documents)
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows)
    assert got == brute_edits(list(texts.items()))
    prints = {}
    for r in rows:
        prints.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())
    assert all(0 <= r[c] <= 1 for r in rows for c in ("near_edited", "near_next"))
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.9 * len(rows)


def test_multiset_of_odd_rows(odd, none):
    rows = multiset.fingerprints(odd.withColumnRenamed("lang", "half").withColumnRenamed("source", "next_id")).collect()
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows)
    assert got == brute_edits([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert {r["fingerprint"] for r in rows if r["doc_id"] in (3, 4, 5)} == {"0" * 8 * 72}
    assert multiset.fingerprints(none).count() == 0


def test_sums_do_not_depend_on_order_and_come_apart(spark):
    row = spark.createDataFrame(
        [("a b\nc d\na b", "c d\na b\n\na b", "c d", "a b\na b", "c d\na b")], "x string, y string, one string, rest string, z string"
    )
    f = {c: multiset.fingerprint(F.col(c)) for c in row.columns}
    got = row.select(
        (f["x"] == f["y"]).alias("order"),
        (multiset.insert(f["rest"], f["one"]) == f["x"]).alias("inserted"),
        (multiset.delete(f["x"], f["one"]) == f["rest"]).alias("deleted"),
        (f["x"] == f["z"]).alias("repeats"),
        multiset.alike(f["x"], f["y"]).alias("alike"),
    ).first()
    assert tuple(got) == (True, True, True, False, 1.0)


def test_rows_and_loops_give_the_same_lanes(documents):
    rows = documents.select("doc_id", "text")
    a = multiset.with_fingerprint(rows, "text", "f").collect()
    b = rows.select("doc_id", multiset.fingerprint(F.col("text")).alias("f")).collect()
    assert {r["doc_id"]: r["f"] for r in a} == {r["doc_id"]: r["f"] for r in b}


def test_multiset_plan_is_native(spark, data):
    df = QUERIES["op9_multiset_hash"](spark, data)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
