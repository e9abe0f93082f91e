"""Sparse text vectors as rows: TF-IDF with unit length, and plain counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devigil.functions.text import tokens


def term_counts(df: DataFrame, key: str, terms: Column) -> DataFrame:
    """``key, term, tf``."""
    return (
        df.select(key, F.explode(terms).alias("term"))
        .groupBy(key, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def inverse_frequency(n: Column, df: Column) -> Column:
    """Smoothed: as if one more document held every term."""
    return F.ln((1 + n) / (1 + df)) + 1


def tfidf(
    df: DataFrame,
    key: str,
    text: str,
    terms: Column | None = None,
    weight: str | None = None,
    total: Column | None = None,
) -> DataFrame:
    """``key, term, tf, df, weight``: TF-IDF of every text, scaled to unit length.

    ``weight`` names a column with the number of documents a row stands for, ``total`` is the number
    of documents if ``df`` does not hold them all.
    """
    copies = F.col(weight) if weight else F.lit(1)
    terms = tokens(F.col(text)) if terms is None else terms
    counts = term_counts(df.select(key, text), key, terms)
    if weight:
        sized = counts.join(df.select(key, weight), key)
    else:
        sized = counts
    # mentioning tf keeps both uses of the counts identical, so Spark computes them once
    present = F.when(F.col("tf") > 0, copies)
    frequency = sized.groupBy("term").agg(F.sum(present).cast("bigint").alias("df"))
    if total is None:
        total = df.agg(F.sum(copies).alias("n")).scalar()
    raw = F.col("tf") * inverse_frequency(total, F.col("df"))
    return unit_length(counts.join(frequency, "term").withColumn("weight", raw), key)


def unit_length(vectors: DataFrame, key: str) -> DataFrame:
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(key)))
    return vectors.withColumn("weight", F.col("weight") / norm)


def char_grams(c: Column, sizes: tuple[int, ...]) -> Column:
    """All character n-grams of a string, for every n in ``sizes``."""

    def grams(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length(c) - (n - 1))
        cut = F.transform(starts, lambda i: F.substring(c, i, F.lit(n)))
        return F.when(F.length(c) >= n, cut).otherwise(F.array().cast("array<string>"))

    return F.concat(*[grams(n) for n in sizes])
