"""Large JSON envelopes, ``{"meta": ..., "results": [...]}``, read by many tasks.

An enclosing object cannot be parsed piece by piece, but its records can be found: a first pass sums up every
chunk of a file, for both answers to the question whether the chunk starts inside a string: how many
brackets opened before it are closed in it, which brackets it leaves open, and whether it ends inside a
string. One fold over a file's few chunk rows then gives the state at the start of each chunk, and a
second pass cuts out the records that start in a chunk, reading on to the end of the last one. Parsing
is left to ``from_json``.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devigil.sources.parquet_blocks import deal_out, open_anywhere

CHUNK_BYTES = 8 << 20
QUOTE, BACKSLASH, CURLY, CURLY_END, SQUARE, SQUARE_END = b'"\\{}[]'
#: A record stands in an array that stands in the enclosing object.
RECORD_DEPTH = 2
RESULTS_KEY = re.compile(rb'(?<!\\)"results"\s*:\s*$')


def chunk_list(files: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``path, first, last`` of the chunks of ``files`` (``path, length``), last excluded."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(chunk_bytes).cast("bigint"))
    each = files.select("path", "length", F.explode(starts).alias("first"))
    return each.select("path", "first", F.least(F.col("first") + chunk_bytes, "length").alias("last"))


def _escaped_start(file, first: int) -> bool:
    """Whether the byte at ``first`` follows an odd number of backslashes."""
    run, at = 0, first
    while at > 0:
        size = min(64, at)
        file.seek(at - size)
        before = file.read(size)
        held = len(before) - len(before.rstrip(b"\\"))
        run += held
        if held < size:
            break
        at -= size
    return run % 2 == 1


def _marks(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places of the quotes that open or close strings, and of all brackets."""
    quotes = np.flatnonzero(data == QUOTE)
    slashes = data == BACKSLASH
    if slashes.any() or escaped:
        # length of the run of backslashes in front of every quote
        places = np.arange(len(data))
        last_other = np.maximum.accumulate(np.where(slashes, -1, places))
        before = quotes - 1
        other = np.where(before >= 0, last_other[np.maximum(before, 0)], -1)
        run = before - other
        run = run + ((other == -1) & escaped)
        quotes = quotes[run % 2 == 0]
    brackets = np.flatnonzero((data == CURLY) | (data == CURLY_END) | (data == SQUARE) | (data == SQUARE_END))
    return quotes, brackets


def _outside(quotes: np.ndarray, brackets: np.ndarray, inside: bool) -> np.ndarray:
    """The brackets that stand in no string."""
    parity = np.searchsorted(quotes, brackets) % 2
    return brackets[parity == int(inside)]


def summarise(data: np.ndarray, escaped: bool, inside: bool) -> tuple[bool, int, np.ndarray]:
    """For a chunk: does it end in a string, how many brackets from before it does it close, and the places
    of those it leaves open."""
    quotes, brackets = _marks(data, escaped)
    kept = _outside(quotes, brackets, inside)
    step = np.where((data[kept] == CURLY) | (data[kept] == SQUARE), 1, -1)
    depth = np.cumsum(step)
    closed = max(0, -int(depth.min(initial=0)))
    # open to the end: the depth never falls below the one it gives
    lowest = np.minimum.accumulate(depth[::-1])[::-1]
    opened = kept[(step == 1) & (lowest >= depth) & (depth > -closed)]
    return bool((len(quotes) + inside) % 2), closed, opened


def _summaries(chunks: DataFrame) -> DataFrame:
    def told(batches):
        for batch in batches:
            for path, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                with open_anywhere(path) as file:
                    escaped = _escaped_start(file, first)
                    file.seek(first)
                    data = np.frombuffer(file.read(last - first), np.uint8)
                row = {"path": [path], "first": [first], "last": [last]}
                for inside in (False, True):
                    ends, closed, opened = summarise(data, escaped, inside)
                    row |= {f"ends{int(inside)}": [ends], f"closed{int(inside)}": [closed], f"opened{int(inside)}": [(opened + first).tolist()]}
                yield pa.RecordBatch.from_pydict(row, schema=schema)

    half = "ends{0} boolean, closed{0} bigint, opened{0} array<bigint>"
    ddl = f"path string, first bigint, last bigint, {half.format(0)}, {half.format(1)}"
    longs = pa.list_(pa.int64())
    schema = pa.schema(
        [("path", pa.string()), ("first", pa.int64()), ("last", pa.int64())]
        + [(f"{n}{i}", t) for i in (0, 1) for n, t in (("ends", pa.bool_()), ("closed", pa.int64()), ("opened", longs))]
    )
    return chunks.mapInArrow(told, ddl)


def _states(summaries: DataFrame) -> DataFrame:
    """``path, first, last, inside, open_at``: the state at the start of every chunk. A file is one group of
    one short row a chunk."""

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("first")
        inside, held, out = False, [], []
        for row in rows.itertuples():
            out.append((row.path, row.first, row.last, inside, list(held)))
            kind = int(inside)
            closed = getattr(row, f"closed{kind}")
            held = held[: max(0, len(held) - closed)] + list(getattr(row, f"opened{kind}"))
            inside = getattr(row, f"ends{kind}")
        return pd.DataFrame(out, columns=["path", "first", "last", "inside", "open_at"])

    return summaries.groupBy("path").applyInPandas(
        fold, "path string, first bigint, last bigint, inside boolean, open_at array<bigint>"
    )


def _is_results(file, at: int, known: dict[int, bool]) -> bool:
    """Whether the bracket at ``at`` opens the array called ``results``."""
    if at not in known:
        start = max(0, at - 256)
        file.seek(start)
        found = file.read(at - start + 1)
        known[at] = found[-1:] == b"[" and RESULTS_KEY.search(found[:-1]) is not None
    return known[at]


def _records_of_chunk(file, first: int, last: int, inside: bool, open_at: list[int], ahead: int):
    """``offset, text`` of the records that start in the chunk."""
    known: dict[int, bool] = {}
    escaped = _escaped_start(file, first)
    file.seek(first)
    data = np.frombuffer(file.read(last - first), np.uint8)
    stack, record, pieces, at = list(open_at), None, [], first
    while True:
        quotes, brackets = _marks(data, escaped)
        for place in _outside(quotes, brackets, inside).tolist():
            if data[place] in (CURLY, SQUARE):
                starts = data[place] == CURLY and len(stack) == RECORD_DEPTH and at + place < last
                if starts and _is_results(file, stack[-1], known):
                    record, pieces = place, []
                stack.append(at + place)
            elif stack:
                stack.pop()
                if record is not None and len(stack) == RECORD_DEPTH:
                    text = b"".join([*pieces, data[record : place + 1].tobytes()])
                    yield at + place + 1 - len(text), text.decode("utf-8", "replace")
                    record = None
                    if at + place + 1 >= last:
                        return
        if record is None and at + len(data) >= last:
            return
        if record is not None:
            pieces.append(data[record:].tobytes())
            record = 0
        inside = bool((len(quotes) + inside) % 2)
        at += len(data)
        escaped = _escaped_start(file, at)
        file.seek(at)
        data = np.frombuffer(file.read(ahead), np.uint8)
        if not len(data):
            # a file that ends within a record has lost it
            return


def record_texts(spark: SparkSession, root: str, glob: str | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``path, offset, text``: every object in the ``results`` of the envelopes below ``root`` (only files
    whose name fits ``glob``, if given) as JSON text, with the place of its first byte.

    Elements of ``results`` that are no objects have no row. Files are UTF-8. An empty file, one without
    ``results`` or with an empty one gives no rows; of a file that breaks off the whole records come out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(root).select("path", "length")
    return records_of_files(files, chunk_bytes)


def records_of_files(files: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``record_texts`` of the files ``path, length``."""
    chunks = deal_out(chunk_list(files.filter("length > 0"), chunk_bytes))
    tasks = chunks.rdd.getNumPartitions()
    states = _states(_summaries(chunks)).repartition(tasks)

    def cut(batches):
        for batch in batches:
            for path, first, last, inside, open_at in zip(*(c.to_pylist() for c in batch.columns)):
                with open_anywhere(path) as file:
                    held, size = [], 0
                    for offset, text in _records_of_chunk(file, first, last, inside, open_at, min(chunk_bytes, 1 << 20)):
                        held.append((offset, text))
                        size += len(text)
                        if size > 4 << 20:
                            yield _batch(path, held)
                            held, size = [], 0
                    if held:
                        yield _batch(path, held)

    return states.mapInArrow(cut, "path string, offset bigint, text string")


def _batch(path: str, held: list) -> pa.RecordBatch:
    offsets, texts = zip(*held)
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(held), pa.string()), pa.array(offsets, pa.int64()), pa.array(texts, pa.string())],
        names=["path", "offset", "text"],
    )


def split_records(texts: DataFrame, record: T.StructType, file: str, position: str) -> DataFrame:
    """``file, position, r`` of the texts of records; the position is the place of the first byte."""
    return texts.select(
        F.col("path").alias(file), F.col("offset").alias(position), F.from_json("text", record).alias("r")
    )
