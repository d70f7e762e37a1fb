"""Shards by balanced label propagation.

Documents are linked through hubs (here: equal texts), so a group of any size is as
many links as it has members, never its pairs. Linked documents start spread evenly.
Each round, every document takes the votes of its neighbours' shards and asks to move
to the shard with the most; requests are admitted under quotas. The quotas are a flow
between shards under which none gains more than its room, its share and a small slack
less what it holds; so cut edges fall while sizes stay even. Requests of one kind (from,
to, gain) are admitted in the proportion their quota allows, by a hash of the document,
the largest gains first. Then each shard gives up what it holds above its share, and
this and the documents without links, which cost no edge, fill each shard to its exact
size.

Ties between shards are broken by hub and shard, so that the members of a group ask for
the same one. Votes of a hub are one row per hub, joined from a written table, so that a
hub with a third of all documents is split like any skewed join. What reaches the
driver are counts per pair of shards and class of gain: at most shards^2 * GAINS rows.

Law ``rows``: shards differ by one row at most. Defined cases: null texts have size 8,
checksum 0 and no links; empty texts are equal to each other; repeated rows are
documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import rank_rows, store

SHARDS = 24
ROUNDS = 10
SLACK = 10  # a shard may exceed its share by a tenth until the last step
GAINS = 16  # classes of gain, by powers of two
SETTLED = 500  # fewer admitted moves than one in so many links end the rounds
WIDTH = 1 << 20


def shares(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def quotas(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many may move from one shard to another, so that no shard gains over its room.

    All requests are granted first. Where a shard would gain too much, its inflow is cut
    in proportion to what it may take, its room and its outflow; this takes outflow from
    others, so it is repeated until all fit. Exchanges and longer cycles stay.
    """
    out = dict(asked)
    while True:
        fits = True
        for s in range(len(room)):
            inflow = [k for k in sorted(out) if k[1] == s]
            coming = sum(out[k] for k in inflow)
            may = max(0, room[s] + sum(n for (a, _), n in out.items() if a == s))
            if coming > may:
                fits = False
                left = may
                for k in sorted(inflow, key=lambda k: -out[k]):
                    take = min(left, -(-out[k] * may // coming))
                    left -= take
                    out[k] = take
        if fits:
            return out


def votes_of(links: DataFrame, shards: int) -> DataFrame:
    """One row per hub: how many of its members each shard has."""
    members = [F.count(F.when(F.col("shard") == s, 1)).alias(f"s{s}") for s in range(shards)]
    tally = links.groupBy("hub").agg(*members)
    return tally.select("hub", F.array(*[f"s{s}" for s in range(shards)]).alias("votes"))


def requests(
    links: DataFrame, votes: DataFrame, allowed: list[int], share: int, seed: int, several: bool
) -> DataFrame:
    """``links`` with the shard each document asks for (``best``, null to stay) and its gain.

    A document asks for the shard with the most votes. Neighbours too many for one share
    gather in as many shards as they need: a document in none of these asks for one of
    them by its number. ``several`` says that documents may have more than one hub; the
    votes of a document's hubs are added.
    """
    met = links.join(votes, "hub")
    if several:
        slots = F.size(F.first("votes"))
        added = F.transform(
            F.sequence(F.lit(0), slots - 1),
            lambda i: F.aggregate(F.collect_list("votes"), F.lit(0).cast("long"), lambda t, v: t + F.get(v, i)),
        )
        per_doc = met.groupBy("uid").agg(added.alias("votes"), F.min("hub").alias("first"))
        met = links.join(per_doc, "uid")
    else:
        met = met.withColumn("first", F.col("hub"))
    open_ = F.array(*[F.lit(s) for s in allowed])
    choices = F.transform(
        "votes",
        lambda n, s: F.struct(n.alias("n"), F.xxhash64(F.col("first"), s).alias("tie"), s.alias("best")),
    )
    choices = F.filter(
        choices,
        lambda c: (c["n"] > 0) & (F.array_contains(open_, c["best"]) | (c["best"] == F.col("shard"))),
    )
    everyone = F.aggregate("votes", F.lit(0).cast("long"), lambda t, n: t + n)
    wanted = F.slice(
        F.sort_array(choices, asc=False), 1, F.ceil(everyone / F.lit(max(share, 1))).cast("int")
    )
    number = (F.pmod(F.xxhash64("uid", F.lit(seed)), F.size("wanted")) + 1).cast("int")
    # its own vote does not count for the shard it is in
    gain = F.col("choice.n") - F.get("votes", F.col("shard")) + 1
    moves = ~F.exists("wanted", lambda c: c["best"] == F.col("shard")) & (F.col("gain") > 0)
    return (
        met.withColumn("wanted", wanted)
        .withColumn("choice", F.element_at("wanted", number))
        .withColumn("gain", gain)
        .withColumn("best", F.when(moves, F.col("choice.best")))
        .withColumn("class", F.when(moves, F.least(F.floor(F.log2("gain")), F.lit(GAINS - 1))).cast("int"))
        .select(*links.columns, "best", "class")
    )


def admitted(asked: DataFrame, room: list[int], seed: int) -> tuple[DataFrame, int]:
    """``asked`` with the new shards, and how many requests the quotas grant."""
    counts = {
        (r["shard"], r["best"], r["class"]): r["n"]
        for r in asked.where("best is not null")
        .groupBy("shard", "best", "class")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # shards^2 * GAINS rows
    }
    total: dict[tuple[int, int], int] = {}
    for (a, b, _), n in counts.items():
        total[a, b] = total.get((a, b), 0) + n
    quota = quotas(total, room)
    granted = sum(quota.values())
    limits = []
    for a, b, c in sorted(counts, key=lambda k: (k[0], k[1], -k[2])):
        take = min(counts[a, b, c], quota[a, b])
        quota[a, b] -= take
        limits.append((a, b, c, take * WIDTH // counts[a, b, c]))
    spark = asked.sparkSession
    limit = spark.createDataFrame(limits, "shard int, best int, class int, below long")
    out = asked.join(F.broadcast(limit), ["shard", "best", "class"], "left")
    yes = F.pmod(F.xxhash64("uid", F.lit(-1 - seed)), F.lit(WIDTH)) < F.col("below")
    moved = out.withColumn("shard", F.when(yes, F.col("best")).otherwise(F.col("shard")))
    return moved.drop("best", "class", "below"), granted


def propagate(links: DataFrame, share: list[int], rounds: int = ROUNDS, several: bool = True) -> DataFrame:
    """``links`` (uid, hub, shard, more columns) after the rounds.

    No shard exceeds its share by more than the slack and the spread of the admission.
    """
    shards = len(share)
    for number in range(rounds):
        rows = links.select("uid", "shard").distinct() if several else links
        sizes = [0] * shards
        for r in rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():
            sizes[r["shard"]] = r["n"]
        room = [most + most // SLACK + 1 - n for most, n in zip(share, sizes)]
        allowed = [s for s in range(shards) if room[s] > 0] or list(range(shards))
        votes = store(votes_of(links, shards), "votes")
        asked = store(requests(links, votes, allowed, max(share), number, several), "requests")
        links, n = admitted(asked, room, number)
        if n * SETTLED <= sum(sizes):
            break
    return links


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Every row of ``docs`` with its shard, and its slot there, gapless from 0."""
    base = store(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
            F.coalesce(F.crc32(F.col("text")), F.lit(0)).cast("long").alias("text_crc32"),
            F.when(F.col("text").isNotNull(), F.xxhash64("text", F.length("text"))).alias("hub"),
        ).withColumn("uid", F.monotonically_increasing_id()),  # fixed by being written
        "rows",
    )
    share = shares(base.count(), shards)
    crowds = base.where("hub is not null").groupBy("hub").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowds = store(crowds.select("hub", F.lit(True).alias("linked")), "hubs")
    rows = store(base.join(crowds, "hub", "left").withColumn("linked", F.coalesce("linked", F.lit(False))), "flagged")
    start = F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int")
    links = propagate(rows.where("linked").withColumn("shard", start), share, rounds, several=False)

    # linked documents take the first slots of their shard, up to its share; the last of
    # the order, neighbours of each other, and the documents without links fill the rest
    kept = rank_rows(links, [F.col("shard"), F.col("hub"), F.col("uid")], "at")
    held = [0] * shards
    for r in kept.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect():
        held[r["shard"]] = r["n"]
    firsts = [sum(held[:s]) for s in range(shards)]
    kept = kept.withColumn("slot", F.col("at") - pick(firsts, F.col("shard")))
    fits = F.col("slot") < pick(share, F.col("shard"))
    sizes = [min(n, most) for n, most in zip(held, share)]
    free = rows.where("not linked").unionByName(kept.where(~fits).select(*rows.columns))
    free = rank_rows(free, [F.desc("linked"), F.col("uid")], "at")
    ends, end = [], 0
    for s in range(shards):
        end += share[s] - sizes[s]
        ends.append(end)
    shard = sum((F.when(F.col("at") >= e, 1).otherwise(0) for e in ends[:-1]), F.lit(0))
    shifts = [sizes[s] - (ends[s - 1] if s else 0) for s in range(shards)]
    free = free.withColumn("shard", shard.cast("int"))
    free = free.withColumn("slot", F.col("at") + pick(shifts, F.col("shard")))
    columns = ["doc_id", "size", "text_crc32", "shard", "slot", "linked"]
    return kept.where(fits).select(*columns).unionByName(free.select(*columns))


def pick(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), at + 1)


def shard_documents(docs: DataFrame) -> DataFrame:
    return assign(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "linked",
    )
