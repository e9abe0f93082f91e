"""Fuzzy joins of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devigil.functions.similarity import (
    indel_ratio,
    levenshtein_ratio,
    sorted_tokens,
    subsequence_similarity,
)
from devigil.functions.text import company_key
from devigil.operators.blocks import blocked_join
from devigil.operators.vectors import char_grams, tfidf
from devigil.session import cut_lineage

THRESHOLD = 0.95
MAX_PAIRS_PER_KEY = 10_000
MAX_LEVELS = 4
PAIRS_PER_TASK = 20_000


def distinct_names(df: DataFrame, column: str) -> DataFrame:
    """Distinct lower-cased names."""
    return df.select(F.lower(column).alias("name")).dropna().distinct()


def _edits(la: Column, lb: Column, threshold: float) -> Column:
    """Most insertions and deletions that a pair of these lengths may need.

    Their number has the parity of the summed lengths, so an odd one out is not allowed either.
    """
    total = la + lb
    most = F.floor(total * (1 - threshold) + F.lit(1e-9)).cast("int")
    return most - (most + total) % 2


def _with_partner_lengths(names: DataFrame, threshold: float, is_left: bool) -> DataFrame:
    """One row per name and feasible partner length; ``rest`` is what no key covers yet."""
    own = F.length("name")
    shortest = F.ceil(own * threshold / (2 - threshold) - F.lit(1e-9)).cast("int")
    longest = F.floor(own * (2 - threshold) / threshold + F.lit(1e-9)).cast("int")
    rows = names.select(
        "name", own.alias("own"), F.explode(F.sequence(shortest, longest)).alias("other")
    )
    la, lb = ("own", "other") if is_left else ("other", "own")
    return (
        rows.withColumn("d", _edits(F.col(la), F.col(lb), threshold))
        .filter(F.abs(F.col("own") - F.col("other")) <= F.col("d"))
        .select(
            "name",
            F.col("name").alias("rest"),
            F.col(la).alias("la"),
            F.col(lb).alias("lb"),
            "d",
            F.xxhash64(la, lb).alias("k"),
        )
    )


def _split(rows: DataFrame, is_left: bool) -> DataFrame:
    """Refine the key by one piece of what is left of the name.

    The left rest is cut into d + 1 pieces. With at most d edits one piece survives unharmed, moved
    by no more than the edits before it. The right side offers every such place.
    """
    pieces = rows.withColumn("i", F.explode(F.expr("sequence(0, d)")))
    start = F.floor(F.col("i") * F.col("la") / (F.col("d") + 1)).cast("int")
    end = F.floor((F.col("i") + 1) * F.col("la") / (F.col("d") + 1)).cast("int")
    pieces = pieces.withColumns({"start": start, "size": end - start})
    if is_left:
        placed = pieces.withColumn("at", F.col("start"))
    else:
        drift = F.col("lb") - F.col("la")
        placed = (
            pieces.withColumn("shift", F.explode(F.expr("sequence(-d, d)")))
            .filter(F.abs("shift") + F.abs(drift - F.col("shift")) <= F.col("d"))
            .withColumn("at", F.col("start") + F.col("shift"))
            .filter((F.col("at") >= 0) & (F.col("at") + F.col("size") <= F.col("lb")))
        )
    piece = F.substring("rest", F.col("at") + 1, F.col("size"))
    rest = F.concat(
        F.substring("rest", F.lit(1), F.col("at")),
        F.substring("rest", F.col("at") + F.col("size") + 1, F.length("rest")),
    )
    return placed.select(
        "name",
        rest.alias("rest"),
        (F.col("la") - F.col("size")).alias("la"),
        (F.col("lb") - F.col("size")).alias("lb"),
        "d",
        F.xxhash64("k", "i", piece).alias("k"),
    ).distinct()


def _crowded(left: DataFrame, right: DataFrame, limit: int) -> DataFrame:
    """Keys that would bring more than ``limit`` pairs together."""
    nl = left.groupBy("k").agg(F.count(F.lit(1)).alias("nl"))
    nr = right.groupBy("k").agg(F.count(F.lit(1)).alias("nr"))
    return nl.join(nr, "k").filter(F.col("nl") * F.col("nr") > limit).select("k")


def _close(left: DataFrame, right: DataFrame, crowded: bool = False) -> DataFrame:
    """Pairs under a common key within the allowed edits (a substitution counts once here)."""
    a = left.select(F.col("name").alias("a"), "k", "d")
    b = right.select(F.col("name").alias("b"), "k")
    within = F.expr("levenshtein(a, b, d) >= 0")
    met = blocked_join(a, b, "k") if crowded else a.join(b, "k")
    return met.filter(within).select("a", "b").distinct()


def candidate_pairs(
    left: DataFrame,
    right: DataFrame,
    threshold: float = THRESHOLD,
    max_pairs_per_key: int = MAX_PAIRS_PER_KEY,
    levels: int = MAX_LEVELS,
) -> DataFrame:
    """``a, b`` of ``name`` frames: a superset of the pairs with indel ratio >= ``threshold``.

    Names meet under an exactly equal piece, never all with all. A key that is too crowded is not
    joined but refined by a further piece of the remaining text, which loses no pair either; after the
    last level it is joined block by block.
    """
    lefts = _split(_with_partner_lengths(left, threshold, True), True)
    rights = _split(_with_partner_lengths(right, threshold, False), False)
    found = None
    for level in range(1, levels + 1):
        lefts, rights = cut_lineage(lefts), cut_lineage(rights)
        crowded = cut_lineage(_crowded(lefts, rights, max_pairs_per_key))
        over = crowded.isEmpty()
        last = level == levels or over
        calm_l = lefts if last else lefts.join(crowded, "k", "left_anti")
        calm_r = rights if last else rights.join(crowded, "k", "left_anti")
        pairs = _close(calm_l, calm_r, crowded=last and not over)
        found = pairs if found is None else found.unionByName(pairs)
        if last:
            break
        lefts = _split(lefts.join(crowded, "k", "left_semi"), True)
        rights = _split(rights.join(crowded, "k", "left_semi"), False)
    return found.distinct()


def fuzzy_join(
    left: DataFrame,
    left_column: str,
    right: DataFrame,
    right_column: str,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``a, b, score`` of the distinct lower-cased names with indel ratio >= ``threshold``."""
    pairs = candidate_pairs(
        distinct_names(left, left_column), distinct_names(right, right_column), threshold
    )
    # the exact ratio is much work on few bytes, so the pairs must not be packed by size
    pairs = cut_lineage(pairs)
    spread = pairs.repartition(max(1, -(-pairs.count() // PAIRS_PER_TASK)))
    return spread.withColumn("score", indel_ratio(F.col("a"), F.col("b"))).filter(
        F.col("score") >= threshold
    )


def best_scores(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(F.max("score").alias("score"))


def _rank(df: DataFrame, k: int, score: str) -> DataFrame:
    best_first = Window.partitionBy("a").orderBy(F.desc(score), "b")
    return df.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)


def nearest_by_grams(
    left: DataFrame,
    right: DataFrame,
    k: int = 3,
    sizes: tuple[int, ...] = (2, 3),
    first_look: int = 500,
) -> DataFrame:
    """``a, b, cosine, rank``: the k most similar right names of every left name, exactly.

    Weights are TF-IDF over character n-grams of the right names. A first look at the partners under
    the rarest n-grams of a name finds k good ones, whose true cosines bound the k-th best from
    below. The frequent n-grams that together cannot reach that bound need no lookup: a name that
    shares nothing but those is no better. They still count in the final cosine.
    """
    master = cut_lineage(
        tfidf(right, "name", "name", char_grams(F.col("name"), sizes)).select(
            F.col("name").alias("b"), "term", "df", F.col("weight").alias("wb")
        )
    )
    terms = master.groupBy("term").agg(
        F.first("df").alias("df"), F.max("wb").alias("greatest")
    )
    total = right.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = (
        left.select(
            F.col("name").alias("a"), F.explode(char_grams(F.col("name"), sizes)).alias("term")
        )
        .groupBy("a", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    raw = F.col("tf") * (F.ln((1 + total) / (1 + F.col("df"))) + 1)
    by_name = Window.partitionBy("a")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    rare_first = by_name.orderBy("df", "term").rowsBetween(*so_far)
    frequent_first = by_name.orderBy(F.desc("df"), F.desc("term")).rowsBetween(*so_far)
    square = F.col("wa") * F.col("wa")
    queries = cut_lineage(
        counts.join(terms, "term")
        .withColumn("raw", raw)
        .withColumn("wa", F.col("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(by_name)))
        .select(
            "a",
            "term",
            "wa",
            F.sum("df").over(rare_first).alias("partners"),
            F.row_number().over(rare_first).alias("rarity"),
            F.least(
                F.sum(F.col("wa") * F.col("greatest")).over(frequent_first),
                F.sqrt(F.sum(square).over(frequent_first)),
            ).alias("reach"),
        )
    )
    weights = queries.select("a", "term", "wa")
    postings = master.select("b", "term", "wb")
    product = F.sum(F.col("wa") * F.col("wb")).alias("cosine")

    def cosines(pairs: DataFrame) -> DataFrame:
        shared = pairs.join(weights, "a").join(postings, ["b", "term"])
        return shared.groupBy("a", "b").agg(product)

    look = queries.filter((F.col("partners") <= first_look) | (F.col("rarity") == 1))
    seen = look.select("a", "term", "wa").join(postings, "term").groupBy("a", "b").agg(product)
    good = _rank(seen, k, "cosine").select("a", "b")
    bound = (
        cosines(good)
        .groupBy("a")
        .agg(F.min("cosine").alias("bound"), F.count(F.lit(1)).alias("found"))
        .filter(F.col("found") == k)
    )
    needed = cut_lineage(
        queries.join(bound, "a", "left")
        .filter(F.col("reach") >= F.coalesce("bound", F.lit(0.0)) - 1e-9)
        .select("a", "term")
    )
    # a frequent n-gram stands in much of both sides, so its lists meet block by block
    met = blocked_join(needed, postings.select("b", "term"), "term")
    candidates = met.select("a", "b").distinct()
    # rounded, because the last bits of a sum depend on the order of addition
    exact = cosines(candidates).withColumn("cosine", F.round("cosine", 9))
    return _rank(exact, k, "cosine")


def match_score(a: Column, b: Column) -> Column:
    """0 to 100: mean of edit, token-order-free edit and subsequence similarity."""
    return (
        100
        * (
            levenshtein_ratio(a, b)
            + levenshtein_ratio(sorted_tokens(a), sorted_tokens(b))
            + subsequence_similarity(a, b)
        )
        / 3
    )


def match_names(
    left: DataFrame, left_column: str, right: DataFrame, right_column: str, k: int = 3
) -> DataFrame:
    """``a, b, score, rank``: the best matches among the k nearest names, on cleaned names."""
    a = left.select(company_key(F.col(left_column)).alias("name")).filter("name <> ''").distinct()
    b = right.select(company_key(F.col(right_column)).alias("name")).filter("name <> ''").distinct()
    near = cut_lineage(nearest_by_grams(a, b, k).select("a", "b"))
    # the kernel is much work on few bytes, so the pairs must not be packed by size
    spread = near.repartition(max(1, -(-near.count() // PAIRS_PER_TASK)))
    scored = spread.withColumn("score", match_score(F.col("a"), F.col("b")))
    return _rank(scored.withColumn("score", F.round("score", 6)), k, "score")
