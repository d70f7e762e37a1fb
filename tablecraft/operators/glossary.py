"""Glossary search, term extraction and exact auto-mapping without pair scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecraft.functions.scalars import title_words, words
from tablecraft.operators.windows import join_per_key
from tablecraft.session import cut_lineage

# Match scores.
SCORE_EQUAL = 1.0
SCORE_CONTAINS = 0.9
SCORE_WORDS = 0.7
SCORE_DESCRIPTION = 0.6
DEFAULT_MIN_CONFIDENCE = 0.7


def search_terms(
    terms: DataFrame, query: str, synonyms: bool = True, category: str | None = None
) -> DataFrame:
    """Terms whose name, definition or a synonym contains the query, without case."""
    text = query.lower()
    hit = F.lower("name").contains(text) | F.lower("definition").contains(text)
    if synonyms:
        hit = hit | F.exists("synonyms", lambda s: F.lower(s).contains(text))
    hit = F.coalesce(hit, F.lit(False))
    if category is not None:
        hit = hit & (F.col("category") == category)
    return terms.filter(hit)


GRAM = 3


def _grams(col: Column, size: Column) -> Column:
    """Distinct runs of ``size`` characters, or the whole text where it is shorter."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(col) - size + 1, F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(col, i, size)))


def contains_pairs(needles: DataFrame, needle: str, hay: DataFrame, text: str) -> DataFrame:
    """Distinct (needle, text) pairs where the needle occurs in the text.

    A needle is joined by its rarest gram, the run of three characters that the fewest
    texts have, and the pairs that meet are checked. Grams are counted over the texts
    before anything meets, and a text gives no more grams than it has characters.
    Needles of one or two characters are their own gram and meet runs of their length.
    """
    small = needles.select(F.col(needle).alias("_needle")).filter(F.length("_needle") > 0).distinct()
    big = hay.select(F.col(text).alias("_text")).filter(F.col("_text").isNotNull()).distinct()
    small = small.withColumn("_size", F.least(F.length("_needle"), F.lit(GRAM)))
    offered = small.select(
        "_needle", "_size", F.explode(_grams(F.col("_needle"), F.col("_size"))).alias("_gram")
    )
    sizes = F.array(*[F.lit(n) for n in range(1, GRAM + 1)])
    runs = big.select("_text", F.explode(sizes).alias("_size")).filter(F.length("_text") >= F.col("_size"))
    runs = runs.join(small.select("_size").distinct(), "_size", "left_semi")
    runs = runs.select("_text", "_size", F.explode(_grams(F.col("_text"), F.col("_size"))).alias("_gram"))
    frequency = runs.groupBy("_gram").agg(F.count(F.lit(1)).alias("_texts"))
    # a gram that no text has rules its needle out; else the rarest one is kept
    rarest = (
        offered.join(frequency, "_gram", "left")
        .groupBy("_needle")
        .agg(
            F.min_by("_gram", F.struct(F.coalesce("_texts", F.lit(0)), F.col("_gram"))).alias("_gram"),
            F.min(F.coalesce("_texts", F.lit(0))).alias("_texts"),
        )
        .filter(F.col("_texts") > 0)
    )
    # stored, so that the partition of a gram that many texts have can be split
    rarest = cut_lineage(rarest.select("_needle", "_gram"), "needles")
    return (
        runs.join(rarest, "_gram")
        .filter(F.col("_text").contains(F.col("_needle")))
        .select("_needle", "_text")
    )


def _word_pairs(terms: DataFrame, targets: DataFrame, min_conf: float) -> DataFrame:
    """Pairs of word sets that can reach the score, with their exact score.

    A pair reaches it only if the overlap is at least ``need`` = min/0.7 of the
    larger set. So two sets must share a word among the rarest
    ``size - ceil(need * size) + 1`` words of each; only those words are joined.
    """
    need = min_conf / SCORE_WORDS
    if need > 1 + 1e-9:
        return terms.join(targets, F.lit(False)).select("term_id", "target_id").withColumn(
            "score", F.lit(0.0)
        )
    sets = terms.select(
        F.lit("t").alias("side"), F.col("term_id").alias("id"), "words"
    ).unionByName(targets.select(F.lit("g").alias("side"), F.col("target_id").alias("id"), "words"))
    each = sets.select("side", "id", F.explode("words").alias("word"))
    freq = each.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    # groups are the words of one name, so they are small
    rare = Window.partitionBy("side", "id").orderBy("freq", "word")
    sized = sets.select("side", "id", F.size("words").alias("n"))
    keep = F.col("n") - F.ceil(F.col("n") * need - 1e-9) + 1
    prefix = (
        join_per_key(each, freq, ["word"], "freq", keep_n=True)
        .withColumn("pos", F.row_number().over(rare))
        .join(sized, ["side", "id"])
        .filter(F.col("pos") <= keep)
    )
    left = prefix.filter(F.col("side") == "t").select(F.col("id").alias("term_id"), "word")
    right = prefix.filter(F.col("side") == "g").select(F.col("id").alias("target_id"), "word")
    candidates = left.join(right, "word").select("term_id", "target_id").distinct()
    scored = (
        candidates.join(terms.select("term_id", F.col("words").alias("_tw")), "term_id")
        .join(targets.select("target_id", F.col("words").alias("_gw")), "target_id")
        .withColumn("_o", F.size(F.array_intersect("_tw", "_gw")))
    )
    score = (F.lit(SCORE_WORDS) * F.col("_o")) / F.greatest(F.size("_tw"), F.size("_gw"))
    return (
        scored.filter(F.col("_o") > 0)
        .withColumn("score", score)
        .select("term_id", "target_id", "score")
    )


def term_words(name: Column, synonyms: Column) -> Column:
    """Words of the name plus whole synonyms, lower case."""
    parts = F.filter(F.split(F.lower(name), r"\s+"), lambda w: w != "")
    others = F.transform(F.coalesce(synonyms, F.array().cast("array<string>")), F.lower)
    return F.array_union(parts, others)


def auto_map(
    terms: DataFrame, targets: DataFrame, min_conf: float = DEFAULT_MIN_CONFIDENCE
) -> DataFrame:
    """(term_id, target_id, score) for every pair that scores ``min_conf`` or more.

    ``terms``: term_id, name, synonyms. ``targets``: target_id, name, description.
    Equal names 1.0; one name inside the other 0.9; shared words 0.7 times their
    part of the larger set; name inside the description 0.6. The first rule that
    applies decides, and ``min_conf`` must be above 0.
    """
    if min_conf <= 0:
        raise ValueError("min_conf must be above 0: every pair would qualify")
    # both sides are read by several joins: compute their sources once
    terms = cut_lineage(
        terms.select(
            "term_id",
            F.lower("name").alias("_name"),
            term_words(F.col("name"), F.col("synonyms")).alias("words"),
        )
    )
    targets = cut_lineage(
        targets.select(
            "target_id",
            F.lower("name").alias("_target"),
            words(F.col("name")).alias("words"),
            F.lower("description").alias("_desc"),
        )
    )
    inside = contains_pairs(terms, "_name", targets, "_target")
    around = contains_pairs(targets, "_target", terms, "_name")
    names = inside.select(F.col("_needle").alias("_name"), F.col("_text").alias("_target")).unionByName(
        around.select(F.col("_text").alias("_name"), F.col("_needle").alias("_target"))
    ).distinct()
    by_name = (
        names.join(terms.select("term_id", "_name"), "_name")
        .join(targets.select("target_id", "_target"), "_target")
        .withColumn(
            "score",
            F.when(F.col("_name") == F.col("_target"), SCORE_EQUAL).otherwise(SCORE_CONTAINS),
        )
        .withColumn("_rule", F.lit(1))
        .select("term_id", "target_id", "score", "_rule")
    )
    # words decide before the description even when their score is the lower one,
    # so a pair that shares any word must not reach the description rule
    by_words = _word_pairs(terms, targets, min_conf).withColumn("_rule", F.lit(2))
    found = by_name.unionByName(by_words)
    if min_conf <= SCORE_DESCRIPTION:
        described = targets.filter(F.col("_desc").isNotNull())
        hits = contains_pairs(terms, "_name", described, "_desc")
        by_text = (
            hits.join(terms, hits["_needle"] == terms["_name"])
            .select("term_id", "_text", F.col("words").alias("_tw"))
            .join(described, F.col("_text") == described["_desc"])
            .filter(~F.arrays_overlap("_tw", "words"))
            .select("term_id", "target_id")
            .withColumn("score", F.lit(SCORE_DESCRIPTION))
            .withColumn("_rule", F.lit(3))
        )
        found = found.unionByName(by_text)
    best = found.groupBy("term_id", "target_id").agg(F.min_by("score", "_rule").alias("score"))
    return best.filter(F.col("score") >= min_conf)


def extract_terms(entity: DataFrame, attribute: DataFrame, category: str = "business") -> DataFrame:
    """Draft terms from described entities and attributes."""

    def draft(df: DataFrame, key: str, kind: str) -> DataFrame:
        described = df.filter(F.col("description").isNotNull() & (F.col("description") != ""))
        return described.select(
            F.concat(F.lit("term_"), F.col(key)).alias("term_id"),
            title_words(F.col("name")).alias("name"),
            F.col("description").alias("definition"),
            F.lit(category).alias("category"),
            F.lit("draft").alias("status"),
            F.concat(F.lit(f"{kind}:"), F.col(key)).alias("source"),
        )

    owned = attribute.join(entity.select("entity_id"), "entity_id", "left_semi")
    return draft(entity, "entity_id", "entity").unionByName(
        draft(owned, "attribute_id", "attribute")
    )


def terms_for(mapping: DataFrame, terms: DataFrame, target: str) -> DataFrame:
    """Distinct terms per entity or attribute; ``target`` is the mapping column."""
    links = mapping.filter(F.col(target).isNotNull()).select(target, "term_id").distinct()
    return links.join(terms, "term_id")
