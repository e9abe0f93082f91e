"""Documents as batches of bounded bytes, and settings of the jobs that send them to Python."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devigil.landing import Landing, setting  # noqa: F401

#: Bytes of text that a Python worker turns into arrays at a time; a longer text goes alone.
SLICE_BYTES = 1 << 20


def arrow_rows(spark: SparkSession, rows: int):
    """Jobs that start inside send at most ``rows`` rows at once to Python, so that rows with long texts
    do not add up."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, last row + 1, bytes, offsets`` of runs of whole texts; null reads as empty."""
    flat = texts.cast(pa.large_string()).fill_null("")
    if not len(flat):
        return
    where = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    held = flat.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(flat):
        last = int(np.searchsorted(where, where[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(flat))
        yield first, last, data[where[first] : where[last]], where[first : last + 1] - where[first]
        first = last


def partitions_of(bytes_: float, each: float, least: int = 1) -> int:
    """A number of partitions that follows the amount of data."""
    return max(least, int(-(-bytes_ // each)))


def likely_among(column: str, ids: DataFrame, bits: int = 1 << 26):
    """A condition that holds for every row whose ``column`` is in the one column of ``ids``, and for few
    others: a bitmap of ``bits`` bits, whatever the number of ids, goes to the workers. It keeps large
    rows out of the shuffle of the join that decides."""
    place = F.pmod(F.xxhash64(ids.columns[0]), F.lit(bits))
    words = ids.select(place.alias("p")).groupBy(F.floor(F.col("p") / 64).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("x")
    )
    found = words.toPandas()
    held = np.zeros(bits // 64, np.uint64)
    held[found["w"].to_numpy()] = found["x"].to_numpy().astype(np.int64).view(np.uint64)
    shared = ids.sparkSession.sparkContext.broadcast(held)

    @F.pandas_udf("boolean")
    def among(p: pd.Series) -> pd.Series:
        at = p.to_numpy()
        return pd.Series((shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0)

    return among(F.pmod(F.xxhash64(column), F.lit(bits)))


def total(df: DataFrame, column) -> float:
    return float(df.agg(F.sum(column)).first()[0] or 0)
