"""Homomorphic multiset hash of a text's paragraphs, by DataFrame functions only.

A paragraph is a line that is not blank. It has a wide vector: eight lanes from its
SHA-256, and 64 lanes of which each piece of up to eight words raises one, named by the
piece's hash, by the piece's length. A fingerprint is the sum of its paragraphs'
vectors, lane by lane modulo 2^32. So the order of paragraphs does not matter, repeats
count, and a paragraph is inserted or deleted by adding or subtracting its vector.
Equal first lanes stand for equal multisets; the other lanes say how alike two texts
are: the sum of the smaller lanes over the sum of the larger ones.

Defined cases: a null text is an empty one; a text without paragraphs has all lanes 0,
and two such texts have likeness 1; fingerprints of equal multisets have likeness 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.llm.common import rank_rows, store

EXACT = 8
LANES = 64
PIECE_WORDS = 8
MODULUS = 1 << 32


def paragraphs(text: Column) -> Column:
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(lines, lambda p: p.rlike(r"\S"))


def pieces_of(found: Column) -> Column:
    """The pieces of up to PIECE_WORDS words of paragraphs."""
    pattern = F.lit(rf"(?:\S+\s*){{1,{PIECE_WORDS}}}")
    return F.flatten(F.transform(found, lambda p: F.regexp_extract_all(p, pattern, F.lit(0))))


def exact_lanes(found: Column) -> Column:
    digests = F.transform(found, lambda p: F.sha2(p, 256))
    return F.transform(
        F.sequence(F.lit(0), F.lit(EXACT - 1)),
        lambda i: F.pmod(
            F.aggregate(
                digests,
                F.lit(0).cast("long"),
                lambda total, d: total + F.conv(F.substring(d, i * 8 + 1, F.lit(8)), 16, 10).cast("long"),
            ),
            F.lit(MODULUS),
        ),
    )


def lane(piece: Column) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(LANES)).cast("int")


def fingerprint(text: Column) -> Column:
    """array<long>: the exact lanes, then the likeness lanes; for single paragraphs and short texts."""
    found = paragraphs(text)
    weighed = F.transform(
        pieces_of(found), lambda w: F.struct(lane(w).alias("lane"), F.length(w).cast("long").alias("size"))
    )
    likeness = F.transform(
        F.sequence(F.lit(0), F.lit(LANES - 1)),
        lambda i: F.pmod(
            F.aggregate(
                weighed,
                F.lit(0).cast("long"),
                lambda total, w: total + F.when(w["lane"] == i, w["size"]).otherwise(F.lit(0).cast("long")),
            ),
            F.lit(MODULUS),
        ),
    )
    return F.concat(exact_lanes(found), likeness)


def with_fingerprint(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with the fingerprint of column ``text`` in place of it.

    Same lanes as ``fingerprint``, but the pieces become rows and the lanes sums, which
    is generated code and no loop over lanes for every piece. All columns but the text
    identify a row, so they are the groups; nothing is moved where rows are already
    dealt out by one of them.
    """
    keys = [c for c in rows.columns if c != text]
    found = rows.select(*keys, paragraphs(F.col(text)).alias("_found")).select(
        *keys, exact_lanes(F.col("_found")).alias("_exact"), pieces_of(F.col("_found")).alias("_pieces")
    )
    exact = [F.get("_exact", F.lit(i)).alias(f"_e{i}") for i in range(EXACT)]
    each = found.select(*keys, *exact, F.explode_outer("_pieces").alias("_piece")).select(
        *keys, *[f"_e{i}" for i in range(EXACT)], lane(F.col("_piece")).alias("_lane"),
        F.length("_piece").cast("long").alias("_size"),
    )
    each = each.withColumn("_lane", F.when(F.col("_size").isNotNull(), F.col("_lane")))
    summed = each.groupBy(*keys, *[f"_e{i}" for i in range(EXACT)]).agg(
        *[F.sum(F.when(F.col("_lane") == i, F.col("_size"))).alias(f"_s{i}") for i in range(LANES)]
    )
    zero = F.lit(0).cast("long")
    lanes = [F.col(f"_e{i}") for i in range(EXACT)] + [
        F.pmod(F.coalesce(f"_s{i}", zero), F.lit(MODULUS)) for i in range(LANES)
    ]
    return summed.select(*keys, F.array(*lanes).alias(out))


def insert(total: Column, other: Column) -> Column:
    """The fingerprint with the paragraphs of ``other`` put in."""
    return F.zip_with(total, other, lambda a, b: F.pmod(a + b, F.lit(MODULUS)))


def delete(total: Column, other: Column) -> Column:
    """The fingerprint with the paragraphs of ``other`` taken out."""
    return F.zip_with(total, other, lambda a, b: F.pmod(a - b, F.lit(MODULUS)))


def written(total: Column) -> Column:
    return F.array_join(F.transform(total, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def alike(a: Column, b: Column) -> Column:
    """0 to 1; 1 for equal multisets."""

    def lanes(pick) -> Column:
        both = F.zip_with(F.slice(a, EXACT + 1, LANES), F.slice(b, EXACT + 1, LANES), pick)
        return F.aggregate(both, F.lit(0).cast("long"), lambda total, x: total + x)

    same = F.slice(a, 1, EXACT) == F.slice(b, 1, EXACT)
    return F.when(same, F.lit(1.0)).otherwise(
        F.coalesce(F.try_divide(lanes(lambda x, y: F.least(x, y)), lanes(lambda x, y: F.greatest(x, y))).cast("double"), F.lit(0.0))
    )


def key_of(doc_id: str) -> Column:
    """The id as text after a mark, null as an empty text, so that null ids meet in a plain join."""
    return F.coalesce(F.concat(F.lit("="), F.col(doc_id).cast("string")), F.lit(""))


def followers(texts: DataFrame) -> DataFrame:
    """(key, next_key, half): the next id in ascending order, the first after the last.

    ``half`` is half the longest text of an id, rounded down. Null ids come first.
    """
    size = F.length(F.coalesce("text", F.lit("")))
    sizes = texts.groupBy("doc_id").agg(F.max(F.floor(size / 2)).alias("half"))
    ranked = rank_rows(sizes, [F.col("doc_id").asc_nulls_first()], "at")
    total = max(1, ranked.count())
    after = ranked.select(key_of("doc_id").alias("next_key"), F.pmod(F.col("at") - 1, F.lit(total)).alias("at"))
    return store(ranked.join(after, "at").select(key_of("doc_id").alias("key"), "next_key", "half"), "followers")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its text with the tail replaced, and likenesses.

    A repeated doc_id is followed by the next larger one; to the one before it, it lends
    the first of its texts and the first of its fingerprints.
    """
    order = followers(docs)
    # both joins read these columns and no others, so the texts are moved once for both
    texts = docs.select(key_of("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType
    doc_id = F.when(F.col("key") != "", F.expr("substring(key, 2)").cast(kind)).alias("doc_id")
    # each text is dealt out by its key once; only the part that is needed goes on
    lent = (
        texts.join(order.select(F.col("key").alias("for_key"), F.col("next_key").alias("key"), "half"), "key")
        .select("for_key", F.col("key").alias("next_key"), F.expr("substring(text, 1, cast(half as int))").alias("head"))
        .groupBy("for_key", "next_key")
        .agg(F.min("head").alias("head"))
    )
    half = "cast(floor(length(text) / 2) as int)"
    edited = F.expr(f"concat(substring(text, 1, length(text) - {half}), substring(head, 1, {half}))")
    joined = texts.join(lent, texts["key"] == lent["for_key"]).select(
        "key", "next_key", doc_id, "text", F.length("text").cast("long").alias("n_chars"),
        F.when(F.length("text") > 1, edited).otherwise(F.col("text")).alias("edited"),
        F.monotonically_increasing_id().alias("row"),  # tells repeated rows apart within this stage
    )
    both = joined.select(
        "key", "next_key", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "row",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("which"), F.col("text").alias("text")),
                F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")),
            )
        ).alias("t"),
    ).select("key", "next_key", "doc_id", "n_chars", "edited_sha256", "row", "t.which", "t.text")
    # both rows of a document are still in one place: they become one before it is written
    prints = store(
        with_fingerprint(both, "text", "lanes")
        .groupBy("key", "next_key", "doc_id", "n_chars", "edited_sha256", "row")
        .agg(
            F.max(F.when(F.col("which") == 0, F.col("lanes"))).alias("own"),
            F.max(F.when(F.col("which") == 1, F.col("lanes"))).alias("changed"),
        )
        .drop("row"),
        "fingerprints",
    )
    following = prints.groupBy(F.col("key").alias("next_key")).agg(F.min("own").alias("next_own"))
    return prints.drop("key").join(following, "next_key").select(
        "doc_id", "n_chars", "edited_sha256",
        written(F.col("own")).alias("fingerprint"),
        written(F.col("changed")).alias("edited_fingerprint"),
        alike(F.col("own"), F.col("changed")).alias("near_edited"),
        alike(F.col("own"), F.col("next_own")).alias("near_next"),
    )
