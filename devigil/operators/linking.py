"""Links between vectors that meet under keys, enough of them to keep every connection."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devigil.operators.blocks import blocked_join
from devigil.session import cut_lineage

MAX_PAIRS_PER_KEY = 10_000
MAX_ROUNDS = 5


def link_members(
    members: DataFrame,
    cosines: Callable[[DataFrame], DataFrame],
    minimum: float,
    max_pairs_per_key: int = MAX_PAIRS_PER_KEY,
    rounds: int = MAX_ROUNDS,
) -> DataFrame:
    """``a, b, cosine`` of pairs with cosine >= ``minimum`` that connect all that all such pairs connect.

    In ``members`` (``x, k, decides``) the vectors of a similar pair share a key ``k`` under which at
    least one of them decides. ``cosines`` gives ``a, b, cosine`` of pairs ``a, b``; it may leave out
    pairs that are below twice the angle of ``minimum``.

    A crowded group is compared with one of its members only. Everybody similar to that one is
    connected already, so of the others only those within twice the angle can still have a partner
    among them, and all others are compared among themselves in the next round. What is still crowded
    after the last round, and the border of a crowded group, is joined block by block.
    """
    members = cut_lineage(members)
    found = []
    for number in range(1, rounds + 1):
        size = members.groupBy("k").agg(
            (F.count(F.lit(1)) * F.count_if("decides") > max_pairs_per_key).alias("crowded"),
            F.min("x").alias("first"),
        )
        crowded = cut_lineage(size.filter("crowded").select("k", "first"))
        over = crowded.isEmpty()
        last = number == rounds or over
        calm = members if last else members.join(crowded, "k", "left_anti")
        met = meet(calm.filter("decides"), calm, crowded=last and not over)
        found.append(cosines(met))
        if last:
            break
        star = members.join(crowded, "k")
        to_first = cosines(
            star.filter("x <> first").select(F.col("first").alias("a"), F.col("x").alias("b"))
        ).toDF("first", "x", "cosine")
        star = cut_lineage(
            star.join(to_first, ["first", "x"], "left").select(
                "k",
                "x",
                "decides",
                "first",
                F.when(F.col("x") == F.col("first"), 1.0)
                .otherwise(F.coalesce("cosine", F.lit(0.0)))
                .alias("cosine"),
            )
        )
        near, far = F.col("cosine") >= minimum, F.col("cosine") < minimum
        reachable = F.col("cosine") >= 2 * minimum**2 - 1 - 1e-9 if minimum > 0 else F.lit(True)
        found.append(
            star.filter(near & (F.col("x") != F.col("first"))).select(
                F.col("first").alias("a"), F.col("x").alias("b"), "cosine"
            )
        )
        border = meet(star.filter(far & reachable), star.filter(near), crowded=True)
        found.append(cosines(border))
        members = cut_lineage(star.filter(far).select("x", "k", "decides"))
    pairs = reduce(DataFrame.unionByName, found)
    return pairs.filter(F.col("cosine") >= minimum)


def meet(left: DataFrame, right: DataFrame, crowded: bool = False) -> DataFrame:
    a = left.select("x", "k")
    b = right.select(F.col("x").alias("y"), "k")
    met = (blocked_join(a, b, "k") if crowded else a.join(b, "k")).filter("x <> y")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
