"""Repair of conversation structure: cheapest edits to a grammar of alternating roles.

A repaired conversation has the role initials ``(s?(ua)+)?``. Turns are kept, given
another role, deleted or inserted; the cheapest audit of edits is wanted, of equally cheap
ones the first in ASCII order. A stretch of turns is aligned by the Wagner-Fischer table to
the alternating string from each phase of the grammar; since shorter targets are prefixes
of longer ones, the last row of one table has the costs of every feasible length. Cells
beyond an incumbent cost, found by a greedy repair, are left out (Ukkonen's band), and each
cell keeps its backtraced audit, so equal costs are settled by comparing audits.

A conversation may hold any share of the rows. Turns are ranged over (conversation, turn)
and cut into stretches of at most ``STRETCH`` rows; a stretch gives the cheapest audit for
each pair of phases at its two ends. Conversations of one stretch are done with that. For
longer ones the costs to the end are combined over stretches in a tree of groups of
``FAN``, which leaves each stretch one choice per phase at its start, and a second pass
down the tree says which phase that is. Insertions belong to the turn that follows, so two
audits of one stretch are never prefixes of one another and the order of whole audits
follows from the order within stretches.

The digest of a repaired conversation is a single hash over its text in order: rows are
sorted by conversation, which spills, and stream through a task that holds one text at a
time. Audits are one value per conversation by contract.

Defined cases: nulls count as one space, also in the ids that decide the damage; a null
conversation is one of its own. Rows of one turn are ordered by role, then by the first 64
characters of the text, then by its hash; equal rows are interchangeable and are kept as
one row with a count, so a row repeated a billion times is one row. A conversation
without rows after the damage has zeros, an empty audit and the digest of an empty text.
Texts may be empty or very long. A table without rows gives none; other columns are left
out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial, reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tablecraft.llm.common import store

STRETCH = 32
FAN = 256
KEEP, REROLE, DELETE, INSERT, SHORT = 0, 3, 4, 3, 3
NEVER = 1 << 40
ROLES = {"u": "user", "a": "assistant"}
# Phases: nothing yet, after a system turn, after a user turn, after an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
# What the end of a conversation still needs in each phase.
ENDING = ["", "ua", "a", ""]
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
SPACES = " \t\n\x0b\x0c\r"

Cell = tuple[int, str]
Item = tuple[str, bool]  # role initial, truncated

ROW = "struct<turn:{turn},role:string,head:string,h1:bigint,h2:bigint,fault:int,copies:bigint>"


# ------------------------------------------------------------------ alignment


def target(start: str, j: int) -> str:
    """Role ``j`` (from 1) of the string that begins with ``start`` and then alternates."""
    if start == "s":
        return "s" if j == 1 else "ua"[j % 2]
    return start if j % 2 else ("a" if start == "u" else "u")


def greedy(items: list[Item], start: str) -> int:
    """The cost of one repair, found in a single pass; the incumbent."""
    cost = at = 0
    if start == "s":
        while at < len(items) and items[at][0] != "s":
            at, cost = at + 1, cost + DELETE
        if at == len(items):
            return NEVER
        at, cost, start = at + 1, cost + SHORT * items[at][1], "u"
    wanted = start
    for i in range(at, len(items)):
        role, short = items[i]
        following = items[i + 1][0] if i + 1 < len(items) else ""
        if role == wanted:
            cost += SHORT * short
            wanted = "a" if wanted == "u" else "u"
        elif role in ROLES and following == wanted:
            cost += INSERT + SHORT * short
        elif role not in ROLES and following == wanted:
            cost += DELETE
        else:
            cost += REROLE + SHORT * short
            wanted = "a" if wanted == "u" else "u"
    return cost


def align(items: list[Item], start: str) -> dict[int, Cell]:
    """(cost, audit) for every feasible length of the target string, no insertion at the end."""
    incumbent = greedy(items, start)
    if incumbent >= NEVER:
        return {}
    # one turn more or less reaches the other phase; beyond that a cell can not be best
    limit = incumbent + DELETE
    row: dict[int, Cell] = {0: (0, "")}
    if start != "s" and items:
        for j in range(1, limit // INSERT + 1):
            row[j] = (INSERT * j, "I" * j)
    for i, (role, short) in enumerate(items, 1):
        first, last = min(row), max(row) + 1
        new: dict[int, Cell] = {}
        for j in range(first, last + 1 if i == len(items) else i + limit // INSERT + 1):
            best = (NEVER, "")
            above, diagonal = row.get(j), row.get(j - 1)
            if above is not None:
                best = (above[0] + DELETE, above[1] + "D")
            if j:
                wanted = target(start, j)
                if diagonal is not None:
                    if role == wanted:
                        best = min(best, (diagonal[0] + SHORT * short, diagonal[1] + "K"))
                    elif wanted != "s":
                        best = min(best, (diagonal[0] + REROLE + SHORT * short, diagonal[1] + "R"))
                left = new.get(j - 1)
                if left is not None and wanted != "s" and i < len(items):
                    best = min(best, (left[0] + INSERT, left[1] + "I"))
            if best[0] <= limit:
                new[j] = best
            elif j > last:
                break
        row = new
        if not row:
            return {}
    return row


def best_by_parity(row: dict[int, Cell], least: int) -> tuple[Cell, Cell]:
    """The best cell of odd and of even lengths from ``least`` on."""
    never = (NEVER, "")
    odd = min((c for j, c in row.items() if j >= least and j % 2), default=never)
    even = min((c for j, c in row.items() if j >= least and j % 2 == 0), default=never)
    return odd, even


def transitions(items: list[Item], whole: bool) -> dict[tuple[int, int], Cell]:
    """The cheapest audit from phase to phase; only from the first one if ``whole``."""
    nothing = (DELETE * len(items), "D" * len(items))
    found = {(NOTHING, NOTHING): nothing}
    u_odd, u_even = best_by_parity(align(items, "u"), 1)
    systems = [i for i, item in enumerate(items) if item[0] == "s"]
    s_odd, s_even = best_by_parity(align(items, "s"), 2) if systems else ((NEVER, ""), (NEVER, ""))
    if systems:
        found[NOTHING, SYSTEM] = min(
            (nothing[0] - DELETE + SHORT * items[i][1], "D" * i + "K" + "D" * (len(items) - i - 1))
            for i in systems
        )
    found[NOTHING, USER] = min(u_odd, s_even)
    found[NOTHING, ASSISTANT] = min(u_even, s_odd)
    if not whole:
        a_odd, a_even = best_by_parity(align(items, "a"), 1)
        found |= {
            (SYSTEM, SYSTEM): nothing, (SYSTEM, USER): u_odd, (SYSTEM, ASSISTANT): u_even,
            (USER, USER): min(nothing, a_even), (USER, ASSISTANT): a_odd,
            (ASSISTANT, USER): u_odd, (ASSISTANT, ASSISTANT): min(nothing, u_even),
        }
    return {pair: cell for pair, cell in found.items() if cell[0] < NEVER}


def choose(found: dict[tuple[int, int], Cell], start: int, after: list[int], last: bool) -> int:
    """The phase at the end of the stretch on the cheapest way, by audit where costs are equal."""
    ways = [
        (cost + after[end], audit + "I" * (len(ENDING[end]) if last else 0), end)
        for (begin, end), (cost, audit) in found.items()
        if begin == start and after[end] < NEVER
    ]
    return min(ways)[2] if ways else -1


END_COSTS = [INSERT * len(rest) for rest in ENDING]


# ------------------------------------------------------------------ stretches


def replay(
    rows: list[dict], audit: str, phase: int, last: bool
) -> tuple[str, list[dict]]:
    """The audit with deleted rows written out, and what each row adds to the repaired text."""
    letters, out, lines, at = [], [], [], 0

    def key(row: dict) -> dict:
        return {k: row[k] for k in ("turn", "role", "head", "h1", "h2")}

    for row in rows:
        copies = row["copies"]
        if row["fault"] in (BLANK, DUPLICATE):
            letters.append("D" * copies)
            continue
        while audit[at] == "I":
            phase = ASSISTANT if phase == USER else USER
            lines.append(("assistant" if phase == ASSISTANT else "user") + ":")
            letters.append("I")
            at += 1
        letters.append(audit[at] + "D" * (copies - 1))
        if audit[at] != "D":
            if audit[at] == "K":
                phase = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[row["role"][0]]
                role = row["role"]
            else:
                phase = ASSISTANT if phase == USER else USER
                role = "assistant" if phase == ASSISTANT else "user"
            out.append(key(row) | {"kind": 0, "lead": "\n".join([*lines, role + ":"]), "full": True})
            lines = []
        at += 1
    if last:
        lines += [ROLES[r] + ":" for r in ENDING[phase]]
        letters.append("I" * len(ENDING[phase]))
    if lines:
        out.append(key(rows[-1]) | {"kind": 2, "lead": "\n".join(lines), "full": False})
    return "".join(letters), out


def items_of(rows: list[dict]) -> list[Item]:
    return [(r["role"][:1], r["fault"] == TRUNCATED) for r in rows if r["fault"] not in (BLANK, DUPLICATE)]


def faults_of(rows: list[dict]) -> dict:
    """Counts by first fault and the deletions they force; all copies but the first are duplicates."""
    blank = sum(r["copies"] for r in rows if r["fault"] == BLANK)
    duplicate = sum(r["copies"] - (r["fault"] != DUPLICATE) for r in rows if r["fault"] != BLANK)
    truncated = sum(r["fault"] == TRUNCATED for r in rows)
    return {"blank": blank, "duplicate": duplicate, "truncated": truncated, "forced": DELETE * (blank + duplicate)}


LEGAL = {"su", "ua", "au"}


def order_of(rows: list[dict], before: dict | None) -> dict:
    """Illegal neighbours and new turns, as seen after ``before``."""
    illegal = turns = 0
    for row in rows:
        initial = row["role"][:1]
        if before is not None:
            illegal += before["role"][:1] + initial not in LEGAL
        illegal += (row["copies"] - 1) * (initial * 2 not in LEGAL)
        turns += row["turn"] is not None and (before is None or before["turn"] != row["turn"])
        before = row
    return {"illegal": illegal, "turns": turns}


DECISION = "struct<turn:{turn},role:string,head:string,h1:bigint,h2:bigint,kind:int,lead:string,full:boolean>"
STRETCHES = (
    "conv_id {conv}, part int, slot bigint, open boolean, leading boolean, "
    "first_role string, first_turn {turn}, last_role string, last_turn {turn}, low {turn}, high {turn}, "
    "blank bigint, duplicate bigint, truncated bigint, forced bigint, illegal bigint, turns bigint, "
    "cost bigint, audit string, decisions array<{decision}>, "
    "cells array<bigint>, audits array<string>, rows array<{row}>"
)


def each(batches: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield from batch.slice(at, size).to_pylist()


def stretch(conv: object, piece: list[dict], before: dict | None, opened: bool) -> dict:
    """Counts of one stretch; its edits, or what any start and end of it would cost."""
    found = transitions(items_of(piece), whole=not opened)
    turns = [r["turn"] for r in piece if r["turn"] is not None]
    out = {
        "conv_id": conv, "open": opened,
        "first_role": piece[0]["role"], "first_turn": piece[0]["turn"],
        "last_role": piece[-1]["role"], "last_turn": piece[-1]["turn"],
        "low": min(turns, default=None), "high": max(turns, default=None),
        **faults_of(piece), **order_of(piece, before),
    }
    if opened:
        pairs = [found.get((p, q), (NEVER, "")) for p in range(4) for q in range(4)]
        return out | {"cells": [c for c, _ in pairs], "audits": [a for _, a in pairs], "rows": piece}
    end = choose(found, NOTHING, END_COSTS, last=True)
    cost, audit = found[NOTHING, end]
    audit, decisions = replay(piece, audit, NOTHING, last=True)
    return out | {"cost": cost + END_COSTS[end], "audit": audit, "decisions": decisions}


def cut(batches: Iterator[pa.RecordBatch], most: int = STRETCH) -> Iterator[dict]:
    """All stretches of a partition, in order, of ``most`` rows or fewer.

    The first and the last conversation of a partition may go on in others, so their
    stretches stay open, as those of every conversation of several stretches.
    """
    part, slot = TaskContext.get().partitionId(), 0
    conv, piece, before, first_conv, first_piece = None, [], None, True, True

    def close(opened: bool) -> dict:
        nonlocal slot
        out = stretch(conv, piece, before, opened)
        out |= {"part": part, "slot": slot, "leading": first_conv and first_piece}
        slot += opened
        return out

    for row in each(batches):
        own = row.pop("conv_id")
        if piece and own != conv:
            yield close(first_conv or not first_piece)
            piece, before, first_conv, first_piece = [], None, False, True
        elif len(piece) == most:
            yield close(True)
            piece, before, first_piece = [], piece[-1], False
        conv = own
        piece.append(row)
    if piece:
        yield close(True)


def in_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def map_rows(df: DataFrame, of_batches: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)
    return df.mapInArrow(lambda batches: in_batches(of_batches(batches), arrow), kind)


def each_row(per_row: Callable[[dict], Iterator[dict]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]:
    return lambda batches: (out for row in each(batches) for out in per_row(row))


# ------------------------------------------------------------ damage and faults


def filled(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows after the damage that their ids decide; a repeated row has two ``copies``."""
    fate = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = filled("text")
    return (
        conversations.select("conv_id", "turn", "role", "text", fate.alias("fate"))
        .where("fate <> 0")
        .select(
            "conv_id", "turn",
            F.when(F.col("fate") == 4, "user").otherwise(filled("role")).alias("role"),
            F.when(F.col("fate") == 1, "")
            .when(F.col("fate") == 2, F.translate(text, ".!?", ""))
            .otherwise(text)
            .alias("text"),
            F.when(F.col("fate") == 3, 2).otherwise(1).cast("long").alias("copies"),
        )
    )


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with what orders and compares their texts."""
    return rows.withColumns(
        {
            "head": F.substring("text", 1, 64),
            "h1": F.xxhash64("text"),
            "h2": F.xxhash64(F.lit(1), "text"),
        }
    )


def order() -> list[Column]:
    return [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "head", "h1", "h2"]


def with_faults(rows: DataFrame) -> DataFrame:
    """One row per turn, role and text with its first fault and its copies."""
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    one = keyed(rows).withColumn("bare", bare)
    one = store(
        one.groupBy("conv_id", "turn", "role", "head", "h1", "h2").agg(
            F.sum("copies").alias("copies"),
            F.max(F.col("bare") == "").alias("blank"),
            F.max(~F.substring("bare", -1, 1).isin(".", "!", "?")).alias("short"),
        ),
        "turns",
    )
    same = ["conv_id", "role", "h1", "h2"]
    repeats = store(
        one.groupBy(*same)
        .agg(F.min(F.struct(F.col("turn").isNotNull().alias("set"), "turn")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(*[F.col(c).alias(f"_{c}") for c in same], "first"),
        "repeats",
    )
    met = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same])
    later = F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    fault = F.when(F.col("blank"), BLANK).when(later, DUPLICATE).when(F.col("short"), TRUNCATED).otherwise(0)
    return one.join(repeats, met, "left").select(
        "conv_id", "turn", "role", "head", "h1", "h2", fault.cast("int").alias("fault"), "copies"
    )


# ------------------------------------------------- conversations of many stretches


def pushed(df: DataFrame, above: DataFrame | None, of_group: Callable[[list, list | None], list]) -> DataFrame:
    """``of_group`` over groups of ``FAN`` nodes (conv_id, idx, val), with the group's value from above.

    Without ``above`` the result is one value per group, else one per node.
    """
    conv = df.schema["conv_id"].dataType.simpleString()
    rows = df.select("conv_id", F.expr(f"idx div {FAN}").alias("group"), "idx", "val")
    if above is not None:
        rows = rows.union(above.select("conv_id", F.col("idx").alias("group"), F.lit(-1).cast("long"), "val"))
    upward = above is None
    groups = rows.groupBy("conv_id", "group").agg(F.sort_array(F.collect_list(F.struct("idx", "val"))).alias("nodes"))

    def per_group(row: dict) -> Iterator[dict]:
        nodes = row["nodes"]
        if upward:
            yield {"conv_id": row["conv_id"], "idx": row["group"], "val": of_group([n["val"] for n in nodes], None)}
        else:
            values = of_group([n["val"] for n in nodes[1:]], nodes[0]["val"])
            for node, value in zip(nodes[1:], values):
                yield {"conv_id": row["conv_id"], "idx": node["idx"], "val": value}

    return map_rows(groups, each_row(per_group), f"conv_id {conv}, idx bigint, val array<bigint>")


def product(costs: list[list[int]], _: None) -> list[int]:
    """The cheapest cost from phase to phase over neighbouring nodes."""

    def times(a: list[int], b: list[int]) -> list[int]:
        return [
            min(min(a[4 * p + k] + b[4 * k + q] for k in range(4)), NEVER) for p in range(4) for q in range(4)
        ]

    return reduce(times, costs)


def costs_after(costs: list[list[int]], after: list[int]) -> list[list[int]]:
    """For each node the costs from its end to the end of the conversation, and whether it is last."""
    out = []
    for node in reversed(costs):
        out.append(after)
        rest = [min(min(node[4 * p + q] + after[q] for q in range(4)), NEVER) for p in range(4)]
        after = [*rest, 0]
    return out[::-1]


def composed(maps: list[list[int]], _: None) -> list[int]:
    def then(a: list[int], b: list[int]) -> list[int]:
        return [b[p] if p >= 0 else -1 for p in a]

    return reduce(then, maps)


def phases_before(maps: list[list[int]], start: list[int]) -> list[list[int]]:
    out, phase = [], start[0]
    for node in maps:
        out.append([phase])
        phase = node[phase]
    return out


def several(nodes: DataFrame) -> bool:
    return not nodes.groupBy("conv_id").count().where("count > 1").isEmpty()


def climb(nodes: DataFrame, of_group: Callable, heights: int | None = None) -> list[DataFrame]:
    """Levels of the tree, up to one node per conversation or to ``heights`` levels."""
    levels = [nodes]
    while several(levels[-1]) if heights is None else len(levels) < heights:
        levels.append(store(pushed(levels[-1], None, of_group), "level"))
    return levels


def descend(levels: list[DataFrame], top: list[int], of_group: Callable) -> DataFrame:
    values = F.array(*[F.lit(v).cast("long") for v in top])
    down = levels[-1].withColumn("val", values)
    for level in reversed(levels[:-1]):
        down = store(pushed(level, down, of_group), "down")
    return down


def solved(opened: DataFrame, turn: str) -> DataFrame:
    """(conv_id, cost, audit, decisions, idx) of the stretches of long conversations."""
    conv = opened.schema["conv_id"].dataType.simpleString()
    levels = climb(opened.select("conv_id", "idx", F.col("cells").alias("val")), product)
    after = descend(levels, [*END_COSTS, 1], costs_after)

    def both(name: str, values: DataFrame) -> DataFrame:
        same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("idx") == F.col("_i"))
        return values.select(F.col("conv_id").alias("_c"), F.col("idx").alias("_i"), F.col("val").alias(name)), same

    right, same = both("after", after)
    known = opened.join(right, same).drop("_c", "_i")

    def cells(row: dict) -> dict[tuple[int, int], Cell]:
        pairs = zip(row["cells"], row["audits"])
        return {divmod(i, 4): cell for i, cell in enumerate(pairs) if cell[0] < NEVER}

    def ways(row: dict) -> Iterator[dict]:
        found, last = cells(row), bool(row["after"][4])
        ends = [choose(found, p, row["after"][:4], last) for p in range(4)]
        yield {"conv_id": row["conv_id"], "idx": row["idx"], "val": ends}

    chosen = map_rows(
        known.select("conv_id", "idx", "cells", "audits", "after"), each_row(ways),
        f"conv_id {conv}, idx bigint, val array<bigint>",
    )
    levels = climb(store(chosen, "choices"), composed, len(levels))
    left, same = both("entry", descend(levels, [NOTHING], phases_before))
    known = known.join(left, same).drop("_c", "_i")

    def edits(row: dict) -> Iterator[dict]:
        found, last = cells(row), bool(row["after"][4])
        entry = row["entry"][0]
        end = choose(found, entry, row["after"][:4], last)
        cost, audit = found[entry, end]
        written, decisions = replay(row["rows"], audit, entry, last)
        yield {
            "conv_id": row["conv_id"], "idx": row["idx"], "cost": cost + (END_COSTS[end] if last else 0),
            "audit": written, "decisions": decisions,
        }

    return map_rows(
        known.select("conv_id", "idx", "cells", "audits", "after", "entry", "rows"), each_row(edits),
        f"conv_id {conv}, idx bigint, cost bigint, audit string, decisions array<{DECISION.format(turn=turn)}>",
    )


# --------------------------------------------------------------------- repair


def digests(decisions: DataFrame, texts: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): decisions and texts meet in order, one text at a time."""
    key = ["conv_id", "turn", "role", "head", "h1", "h2"]
    said = decisions.select(*key, "kind", "lead", "full", F.lit(None).cast("string").alias("text"))
    have = texts.select(*key, F.lit(1).alias("kind"), F.lit(None).cast("string").alias("lead"), F.lit(False).alias("full"), "text")
    rows = said.union(have).repartition("conv_id").sortWithinPartitions(*order(), "kind")
    conv = decisions.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        now, sha, empty, wanted = None, None, True, False
        for row in each(batches, 64):
            if sha is None or row["conv_id"] != now:
                if sha is not None:
                    yield {"conv_id": now, "repaired_sha256": sha.hexdigest()}
                now, sha, empty, wanted = row["conv_id"], hashlib.sha256(), True, False
            if row["kind"] != 1:
                sha.update((("" if empty else "\n") + row["lead"]).encode())
                empty, wanted = False, row["full"]
            elif wanted:
                sha.update(row["text"].encode())
                wanted = False
        if sha is not None:
            yield {"conv_id": now, "repaired_sha256": sha.hexdigest()}

    columns = ["conv_id", "kind", "lead", "full", "text"]
    return map_rows(rows.select(*columns), run, f"conv_id {conv}, repaired_sha256 string")


def repair(rows: DataFrame, most: int = STRETCH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The edits of (conv_id, turn, role, text, copies): counts, audits and decisions.

    Counts: partial sums per conversation. Audits: (conv_id, idx, cost, audit), to be
    joined in the order of idx. Decisions: for every kept row its key, the ``lead`` written
    before its text, and lines of inserted turns.
    """
    turn, conv = (rows.schema[c].dataType.simpleString() for c in ("turn", "conv_id"))
    schema = STRETCHES.format(
        conv=conv, turn=turn, decision=DECISION.format(turn=turn), row=ROW.format(turn=turn)
    )
    ranged = with_faults(rows).repartitionByRange(*order()).sortWithinPartitions(*order())
    pieces = store(map_rows(ranged, partial(cut, most=most), schema), "stretches")
    sums = ["blank", "duplicate", "truncated", "forced", "illegal", "turns"]
    counts = pieces.select("conv_id", *sums, "low", "high")
    edits = pieces.where("not open").select("conv_id", F.lit(0).cast("long").alias("idx"), "cost", "audit", "decisions")
    sizes = pieces.where("open").groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    # one row per partition
    opened = pieces.where("open").join(F.broadcast(before), "part").withColumn("idx", F.col("slot") + F.col("before"))
    if not sizes.isEmpty():
        edits = edits.union(store(solved(opened, turn).select(*edits.columns), "solved"))
        counts = counts.union(borders(opened).select(*counts.columns))
    decisions = edits.select("conv_id", F.explode("decisions").alias("d")).select("conv_id", "d.*")
    return counts, edits.drop("decisions"), decisions


def borders(opened: DataFrame) -> DataFrame:
    """Corrections where a conversation goes on in the next partition; at most one per partition."""
    left = opened.select(
        F.col("conv_id").alias("_c"), (F.col("idx") + 1).alias("_i"), F.col("last_role").alias("_role"),
        F.col("last_turn").alias("_turn"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("idx") == F.col("_i"))
    pair = F.concat(F.substring("_role", 1, 1), F.substring("first_role", 1, 1))
    zero = F.lit(0).cast("long")
    return (
        opened.where("leading")
        .join(left, same)
        .select(
            "conv_id", *[zero.alias(c) for c in ("blank", "duplicate", "truncated", "forced")],
            F.when(pair.isin(*LEGAL), 0).otherwise(1).cast("long").alias("illegal"),
            F.when(F.col("first_turn") == F.col("_turn"), -1).otherwise(0).cast("long").alias("turns"),
            F.lit(None).cast(opened.schema["low"].dataType).alias("low"),
            F.lit(None).cast(opened.schema["high"].dataType).alias("high"),
        )
    )


EMPTY = hashlib.sha256().hexdigest()


def repair_conversations(conversations: DataFrame, most: int = STRETCH) -> DataFrame:
    """Per original conversation: faults after the damage, the cheapest audit, the repaired digest."""
    rows = damaged(conversations)
    counts, edits, decisions = repair(rows, most)
    kept = rows.where(F.rtrim(F.col("text"), F.lit(SPACES)) != "")
    figures = ["blank", "duplicate", "truncated", "illegal"]
    parts = [
        conversations.select("conv_id").distinct(),
        counts, edits, digests(decisions, keyed(kept)),
    ]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    pieces = F.sort_array(F.collect_list(F.when(F.col("audit").isNotNull(), F.struct("idx", "audit"))))
    return every.groupBy("conv_id").agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).cast("long").alias("gaps"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in figures],
        (F.coalesce(F.sum("cost"), F.lit(0)) + F.coalesce(F.sum("forced"), F.lit(0))).cast("long").alias("cost"),
        F.array_join(pieces["audit"], "").alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(EMPTY)).alias("repaired_sha256"),
    )
