"""Monthly count series without gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devigil.functions.temporal import month_start, parse_date

# --- fixed values: regulation milestones --------------------------------------------------------
POLICIES = (
    ("1906-01-01", "Pure Food and Drugs Act"),
    ("1938-01-01", "Federal Food, Drug, and Cosmetic Act"),
    ("1944-01-01", "Public Health Service Act"),
    ("1968-01-01", "Radiation Control for Health and Safety Act"),
    ("1976-01-01", "Medical Device Amendments to the FD&C Act"),
    ("1990-01-01", "Safe Medical Devices Act"),
    ("1992-01-01", "Mammography Quality Standards Act"),
    ("1997-01-01", "FDA Modernization Act"),
    ("2002-01-01", "Medical Device User Fee and Modernization Act"),
    ("2007-01-01", "FDA Amendments Act"),
    ("2012-01-01", "FDA Safety and Innovation Act"),
    ("2016-01-01", "21st Century Cures Act"),
    ("2017-01-01", "FDA Reauthorization Act"),
    ("2020-01-01", "Coronavirus Aid, Relief, and Economic Security Act"),
    ("2022-01-01", "FDAUFRA; FDORA; PREVENT Pandemics Act"),
)
# --- end of fixed values ------------------------------------------------------------------------


def monthly_counts(df: DataFrame, date_column: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, month_end, count`` for every month between a series' first and last one.

    Unparsable and missing dates are left out. Rows are reduced to one per key and month before
    anything else, so the window below sees at most one row per calendar month of a key.
    """
    is_text = isinstance(df.schema[date_column].dataType, T.StringType)
    parsed = parse_date(F.col(date_column)) if is_text else F.col(date_column).cast("date")
    counted = (
        df.select(*keys, month_start(parsed).alias("month"))
        .dropna(subset=["month"])
        .groupBy(*keys, "month")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_key = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("month")
    following = counted.withColumn("next", F.lead("month").over(by_key))
    gap_end = F.coalesce(F.add_months("next", -1), F.col("month"))
    filled = following.select(
        *keys,
        F.col("month").alias("first"),
        "n",
        F.explode(F.sequence("month", gap_end, F.expr("interval 1 month"))).alias("month"),
    )
    return filled.select(
        *keys,
        F.last_day("month").alias("month_end"),
        F.when(F.col("month") == F.col("first"), F.col("n")).otherwise(0).alias("count"),
    )


def split_holdout(series: DataFrame, keys: Sequence[str] = (), share: float = 0.1) -> DataFrame:
    """Mark the last ``round(share * n)`` months of each series (halves round to even)."""
    everything = Window.partitionBy(*(keys or [F.lit(0)]))
    backwards = everything.orderBy(F.desc("month_end"))
    size = F.bround(F.count(F.lit(1)).over(everything) * F.lit(share), 0).cast("int")
    return series.select(
        "*", (F.row_number().over(backwards) <= size).alias("held_out")
    )


def policies(df: DataFrame) -> DataFrame:
    """The milestones as a 15-row literal."""
    return df.sparkSession.createDataFrame(POLICIES, "date string, label string").select(
        F.col("date").cast("date").alias("date"), "label"
    )


def policy_overlay(series: DataFrame, date_column: str = "month_end") -> DataFrame:
    """Milestones inside the time span of the series."""
    span = series.agg(F.min(date_column).alias("first"), F.max(date_column).alias("last"))
    inside: Column = F.col("date").between(F.col("first"), F.col("last"))
    return span.join(F.broadcast(policies(series)), inside).select("date", "label")
