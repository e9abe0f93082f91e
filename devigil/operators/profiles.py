"""Similarity of similarity profiles: rows of the matrix of all cosines, compared with each other.

The profile of a text is its cosine with every text. For vectors ``X`` with ``copies`` C of each, the
product of two profiles is ``x_i G x_j`` with ``G = X'CX``, the products of term columns. So neither the
similarity matrix nor its square is built: a product needs the entries of ``G`` for the terms of two
texts. That suits short texts such as names.
"""

from __future__ import annotations

from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devigil.operators.blocks import blocked_join
from devigil.operators.linking import MAX_PAIRS_PER_KEY, MAX_ROUNDS, link_members
from devigil.session import cut_lineage

#: Profiles that span the space in which others are placed, and axes of that space that make the cells.
PIVOTS, CELL_AXES = 16, 3
#: Rounding of places and cosines, far above that of doubles.
SLACK = 1e-6


def term_products(vectors: DataFrame, copies: DataFrame, key: str) -> DataFrame:
    """``term, other, g``: entries of ``G`` for all terms that occur together, in both orders."""
    one = vectors.select(key, "term", F.col("weight").alias("w"))
    two = vectors.join(copies, key).select(
        key, F.col("term").alias("other"), (F.col("weight") * F.col("copies")).alias("v")
    )
    # a long text is dealt into blocks of terms, so its pairs are not the work of one task
    together = blocked_join(one, two, key)
    return together.groupBy("term", "other").agg(F.sum(F.col("w") * F.col("v")).alias("g"))


def profile_products(pairs: DataFrame, rows: DataFrame, products: DataFrame) -> DataFrame:
    """``a, b, product`` of the profiles of pairs ``a, b``; ``rows`` has ``x, terms``."""
    sides = pairs.select("a", "b")
    for side in ("a", "b"):
        own = rows.select(F.col("x").alias(side), F.col("terms").alias(f"terms_{side}"))
        sides = sides.join(own, side)
    one = sides.select("a", "b", "terms_b", F.explode("terms_a").alias("t"))
    both = one.select("a", "b", "t", F.explode("terms_b").alias("o"))
    weighted = both.select(
        "a",
        "b",
        F.col("t.term").alias("term"),
        F.col("o.term").alias("other"),
        (F.col("t.weight") * F.col("o.weight")).alias("w"),
    )
    met = weighted.join(products, ["term", "other"])
    return met.groupBy("a", "b").agg(F.sum(F.col("w") * F.col("g")).alias("product"))


def _placed(vectors: DataFrame, rows: DataFrame, products: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``place``: unit profiles projected on the span of some of them, along its axes of
    falling variance. Places are never farther apart than the profiles.

    The pivots are the first rows by a hash of the key; only their products, a matrix of ``PIVOTS``
    rows, and the covariance of the places reach the driver.
    """
    chosen = [r["x"] for r in rows.orderBy(F.xxhash64("x"), "x").select("x").limit(PIVOTS).collect()]
    pivots = rows.filter(F.col("x").isin(chosen)).select("x", "norm", F.explode("terms").alias("t"))
    along = pivots.select("x", "norm", F.col("t.term").alias("other"), F.col("t.weight").alias("w"))
    names = [f"p{i}" for i in range(len(chosen))]

    def sums(value: Column) -> list[Column]:
        return [F.sum(F.when(F.col("x") == x, value)).alias(p) for p, x in zip(names, chosen)]

    by_term = along.join(products, "other").groupBy("term")
    by_term = by_term.agg(*sums(F.col("w") * F.col("g") / F.col("norm"))).na.fill(0.0)
    projected = vectors.select(F.col(key).alias("x"), "term", "weight").join(by_term, "term")
    projected = projected.groupBy("x").agg(*[F.sum(F.col("weight") * F.col(p)).alias(p) for p in names])
    # without a common term with any pivot's partners all cosines with pivots are 0
    cosines = rows.join(projected, "x", "left").na.fill(0.0, names)
    cosines = cosines.select(*rows.columns, *[(F.col(p) / F.col("norm")).alias(p) for p in names])
    cosines = cut_lineage(cosines)
    found = {r["x"]: r for r in cosines.filter(F.col("x").isin(chosen)).select("x", *names).collect()}
    gram = np.array([[found[x][p] for p in names] for x in chosen])
    size, axes = np.linalg.eigh((gram + gram.T) / 2)
    held = size > 1e-8
    basis = axes[:, held] / np.sqrt(size[held])

    def turned(matrix: np.ndarray) -> Column:
        columns = [
            sum((F.col(p) * float(x) for p, x in zip(names, column)), F.lit(0.0)) for column in matrix.T
        ]
        return F.array(*columns)

    upper = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    moments = cosines.agg(
        *[F.avg(p) for p in names],
        *[F.avg(F.col(names[i]) * F.col(names[j])) for i, j in upper],
    ).first()
    mean = np.array(moments[: len(names)])
    second = np.zeros((len(names), len(names)))
    for (i, j), value in zip(upper, moments[len(names) :]):
        second[i, j] = second[j, i] = value
    spread = basis.T @ (second - np.outer(mean, mean)) @ basis
    _, turn = np.linalg.eigh(spread)
    return cosines.select(*rows.columns, turned(basis @ turn[:, ::-1]).alias("place"))


def profile_links(
    vectors: DataFrame,
    copies: DataFrame,
    key: str,
    minimum: float,
    max_pairs_per_key: int = MAX_PAIRS_PER_KEY,
    rounds: int = MAX_ROUNDS,
) -> DataFrame:
    """``a, b, cosine`` of texts whose profiles have cosine >= ``minimum`` (above 0), enough pairs to
    connect everything that all of them connect.

    ``vectors`` are unit vectors ``key, term, weight`` of different texts, ``copies`` (``key, copies``)
    how many columns of the similarity matrix each stands for. Profiles within the minimum are at most
    ``sqrt(2 - 2 minimum)`` apart, and so are their places in a few dimensions: pairs meet in cells of
    that width and their neighbours, then by the whole places, and only what is left is multiplied out.
    Crowded cells are linked as in ``link_members``.
    """
    if not 0 < minimum <= 1:
        raise ValueError(f"a minimum between 0 and 1 is needed, not {minimum}")
    vectors = cut_lineage(vectors.select(key, "term", "weight"))
    products = cut_lineage(term_products(vectors, copies, key))
    rows = cut_lineage(
        vectors.groupBy(F.col(key).alias("x")).agg(
            F.collect_list(F.struct("term", "weight")).alias("terms")
        )
    )
    if rows.isEmpty():
        empty = rows.select(F.col("x").alias("a"), F.col("x").alias("b"))
        return empty.withColumn("cosine", F.lit(0.0))
    own = profile_products(rows.select(F.col("x").alias("a"), F.col("x").alias("b")), rows, products)
    sized = rows.join(own.select(F.col("a").alias("x"), F.sqrt("product").alias("norm")), "x")
    rows = cut_lineage(_placed(vectors, cut_lineage(sized), products, key))

    reach = (2 - 2 * minimum) ** 0.5 + SLACK
    # what is left out by ``cosines`` has to be beyond twice the angle
    twice = max(0.0, 2 - 2 * (2 * minimum**2 - 1)) + SLACK
    axes = min(CELL_AXES, rows.select(F.size("place")).first()[0])
    cell = [F.floor(F.col("place")[i] / reach) for i in range(axes)]
    around = [
        F.struct(
            F.xxhash64(*[c + F.lit(step) for c, step in zip(cell, steps)]).alias("k"),
            F.lit(not any(steps)).alias("decides"),
        )
        for steps in product((0, -1, 1), repeat=axes)
    ]
    members = rows.select("x", F.explode(F.array(*around)).alias("m")).select("x", "m.k", "m.decides")

    def cosines(pairs: DataFrame) -> DataFrame:
        near = pairs.distinct()
        for side in ("a", "b"):
            place = rows.select(F.col("x").alias(side), F.col("place").alias(f"place_{side}"))
            near = near.join(place, side)
        apart = F.aggregate(
            F.zip_with("place_a", "place_b", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d
        )
        near = cut_lineage(near.filter(apart <= twice).select("a", "b"))
        found = profile_products(near, rows, products)
        for side in ("a", "b"):
            norm = rows.select(F.col("x").alias(side), F.col("norm").alias(f"norm_{side}"))
            found = found.join(norm, side)
        cosine = F.col("product") / (F.col("norm_a") * F.col("norm_b"))
        return found.select("a", "b", cosine.alias("cosine"))

    return link_members(members, cosines, minimum, max_pairs_per_key, rounds)
