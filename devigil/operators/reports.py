"""Counts, rankings and latest-record lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devigil.functions.temporal import month_start, trailing_days, within_last_year


def count_by(df: DataFrame, *columns: str, ordered: bool = False) -> DataFrame:
    """Rows per category, the NULL category included."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(*[F.asc_nulls_last(c) for c in columns]) if ordered else counts


def summarize_by(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.groupBy(column).agg(
        F.count(F.lit(1)).alias("count"),
        F.sum(value).alias("total"),
        F.avg(value).alias("average"),
    )


def top_categories(
    df: DataFrame, column: str, n: int = 10, keep_null: bool = False
) -> DataFrame:
    """The most frequent values; ties go to the smaller value."""
    rows = df if keep_null else df.dropna(subset=[column])
    return count_by(rows, column).orderBy(F.desc("count"), F.asc_nulls_last(column)).limit(n)


def top_entities(df: DataFrame, name: str, metric: str, n: int = 5) -> DataFrame:
    """The ``n`` (1 to 20) entities with the largest metric; all columns break ties."""
    if not 1 <= n <= 20:
        raise ValueError("n must be between 1 and 20")
    rest = [c for c in df.columns if c not in (name, metric)]
    order = [F.desc_nulls_last(metric), *[F.asc_nulls_last(c) for c in (name, *rest)]]
    return df.orderBy(*order).limit(n)


def latest(
    df: DataFrame,
    date_column: str,
    n: int = 100,
    drop: Sequence[str] = (),
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The ``n`` most recent records; records without a date come last."""
    order = [F.desc_nulls_last(date_column), *[F.asc_nulls_last(c) for c in tie_break]]
    return df.orderBy(*order).limit(n).drop(*drop)


def newest_first(df: DataFrame, date_column: str, nulls_first: bool = False) -> DataFrame:
    """``nulls_first`` is what a descending SQL sort does by default.

    Rows of one date have no order of their own; a hash of the row lets the sort split them.
    """
    order = F.desc_nulls_first if nulls_first else F.desc_nulls_last
    return df.orderBy(order(date_column), F.xxhash64(*df.columns))


def key_figures(df: DataFrame, date_column: str, reference: Column, days: int = 30) -> DataFrame:
    """Total and recent count in one pass."""
    recent = trailing_days(F.col(date_column), reference, days)
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(recent).alias("recent")
    )


def monthly_trend(df: DataFrame, date_column: str, as_of: Column) -> DataFrame:
    """Counts per month of the last year, months without rows left out."""
    recent = df.filter(within_last_year(F.col(date_column), as_of))
    return (
        recent.groupBy(month_start(F.col(date_column)).alias("month"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("month")
    )


def distinct_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """UNION of two frames; each side is made distinct first, so less is shuffled."""
    return left.distinct().unionByName(right.distinct()).distinct()


def joined_counts(left: DataFrame, left_name: str, right: DataFrame, right_name: str) -> DataFrame:
    """Names of both sides with their row counts, compared in lower case.

    Each side is reduced to one row per name before the join, so frequent names cost nothing.
    """
    a = left.groupBy(F.lower(left_name).alias("name")).agg(
        F.count(F.lit(1)).alias("event_counts")
    )
    b = right.groupBy(F.lower(right_name).alias("name")).agg(
        F.count(F.lit(1)).alias("recall_counts")
    )
    return a.join(b, "name")
