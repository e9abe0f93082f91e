"""Joins on keys that may be crowded on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 4096


def blocked_join(left: DataFrame, right: DataFrame, key: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """``left`` and ``right`` (no other column in common) joined on ``key``, a crowded key in parts.

    Both sides of a key are dealt into blocks of about ``rows`` rows and every pair of blocks is a join
    key of its own, so no task gets more than two blocks of a key, however many rows it has.
    """
    counts = [
        side.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / rows).alias(name))
        for side, name in ((left, "left blocks"), (right, "right blocks"))
    ]
    blocks = counts[0].join(counts[1], key)

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        columns = [F.col(f"`{c}`") for c in side.columns if c != key]
        placed = side.join(blocks, key)
        return placed.select(
            key,
            *columns,
            F.pmod(F.xxhash64(*columns), F.col(f"`{own}`")).alias(own.removesuffix("s")),
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"`{other}`") - 1)).alias(
                other.removesuffix("s")
            ),
        )

    a = dealt(left, "left blocks", "right blocks")
    b = dealt(right, "right blocks", "left blocks")
    return a.join(b, [key, "left block", "right block"]).drop("left block", "right block")
