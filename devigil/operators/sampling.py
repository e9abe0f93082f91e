"""Samples towards a target size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devigil.operators.features import hash_share

TARGET_ROWS = 500_000
SAMPLE_SEED = 200


def sample_percent(total: int, target: int = TARGET_ROWS) -> float:
    """Percentage that brings ``total`` rows near ``target``, between 0.01 and 100."""
    return round(min(100.0, max(0.01, target / total * 100)), 2) if total else 100.0


def sample_percent_column(total: Column, target: int = TARGET_ROWS) -> Column:
    share = F.try_divide(F.lit(float(target)), total) * 100
    bounded = F.least(F.lit(100.0), F.greatest(F.lit(0.01), share))
    return F.round(F.when(total > 0, bounded).otherwise(100.0), 2)


def drawn(keys: Sequence[str], fraction: float, seed: int) -> Column:
    """A condition that holds for about ``fraction`` of the keys, always for the same ones."""
    joined = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return hash_share(joined, seed) < fraction


def sample_to_target(
    df: DataFrame,
    total: int,
    keys: Sequence[str],
    target: int = TARGET_ROWS,
    seed: int = SAMPLE_SEED,
) -> DataFrame:
    """About ``target`` rows, drawn by a hash of ``keys``, so however the rows are partitioned the same
    ones come out; a smaller table comes back whole."""
    percent = sample_percent(total, target)
    return df if percent >= 100 else df.filter(drawn(keys, percent / 100, seed))


def sample_with_children(
    parents: DataFrame, children: DataFrame, key: str, fraction: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """A parent sample by key and exactly the child rows that belong to it."""
    chosen = parents.filter(drawn([key], fraction, seed))
    # the hash of the key leaves most child rows out before the join
    likely = children.filter(drawn([key], fraction, seed))
    return chosen, likely.join(chosen.select(key), key, "left_semi")
