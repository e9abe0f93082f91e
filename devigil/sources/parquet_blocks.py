"""Samples of whole row groups of Parquet files: blocks that are not drawn are never read.

The footers of the files say how many row groups and rows there are, so neither the row estimate nor
the choice of blocks reads any data. A hash of the file, the number of the row group and a seed draws a
block, always the same ones. Drawn blocks are dealt out to tasks, and only the columns asked for.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from devigil.operators.features import hash_share
from devigil.operators.sampling import SAMPLE_SEED, TARGET_ROWS, sample_percent

#: Tasks that lists of files, footers and chunks are dealt to at most.
MOST_TASKS = 10_000
BLOCKS = "path string, block int, block_rows bigint, block_bytes bigint"


def open_anywhere(path: str):
    """A file for random access wherever it is: only the ranges that are asked for are fetched."""
    from pyarrow import fs

    system, inside = fs.FileSystem.from_uri(path) if "://" in path or ":/" in path else (fs.LocalFileSystem(), path)
    return system.open_input_file(inside)


def deal_out(rows: DataFrame) -> DataFrame:
    """Short rows that each stand for much work, one a task as far as possible."""
    return rows.repartition(min(max(1, rows.count()), MOST_TASKS))


def block_list(spark: SparkSession, root: str) -> DataFrame:
    """``path, block, block_rows, block_bytes`` of every row group below ``root``, from footers alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    # listing keeps the contents out; the number of tasks is given, as a file is only a short row here
    paths = deal_out(files.load(root).select("path"))

    def footers(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_anywhere(path) as file:
                    footer = pq.ParquetFile(file).metadata
                groups = [footer.row_group(i) for i in range(footer.num_row_groups)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(groups), pa.string()),
                        pa.array(range(len(groups)), pa.int32()),
                        pa.array([g.num_rows for g in groups], pa.int64()),
                        pa.array([g.total_byte_size for g in groups], pa.int64()),
                    ],
                    names=["path", "block", "block_rows", "block_bytes"],
                )

    return paths.mapInArrow(footers, BLOCKS)


def estimated_rows(blocks: DataFrame) -> int:
    """Rows of the table by its footers."""
    return blocks.agg(F.coalesce(F.sum("block_rows"), F.lit(0))).first()[0]


def drawn_blocks(
    blocks: DataFrame, percent: float, seed: int = SAMPLE_SEED, name: Callable[[Column], Column] | None = None
) -> DataFrame:
    """The blocks in a sample of ``percent``. ``name`` of a path stands for the file in the hash; without
    it the path does, so that a copy of a table elsewhere has another sample."""
    file = (name or (lambda path: path))(F.col("path"))
    key = F.concat_ws(":", file, F.col("block").cast("string"))
    return blocks.filter(hash_share(key, seed) < percent / 100) if percent < 100 else blocks


def read_blocks(blocks: DataFrame, schema: T.StructType, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``blocks``. ``schema`` is the table's; files without one of its columns give nulls."""
    wanted = T.StructType([schema[c] for c in columns]) if columns is not None else schema
    arrow = to_arrow_schema(wanted)

    def rows(batches):
        for batch in batches:
            for path, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_anywhere(path) as file:
                    source = pq.ParquetFile(file)
                    present = set(source.schema_arrow.names)
                    held = source.iter_batches(row_groups=[block], columns=[f.name for f in arrow if f.name in present])
                    for part in held:
                        filled = [
                            part.column(f.name).cast(f.type) if f.name in present else pa.nulls(part.num_rows, f.type)
                            for f in arrow
                        ]
                        yield pa.RecordBatch.from_arrays(filled, schema=arrow)

    return deal_out(blocks.select("path", "block")).mapInArrow(rows, wanted)


def sample_blocks(
    spark: SparkSession,
    root: str,
    target: int = TARGET_ROWS,
    seed: int = SAMPLE_SEED,
    columns: Sequence[str] | None = None,
    name: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """About ``target`` rows of the Parquet table below ``root`` as whole row groups.

    The percentage is that of the row sample, with the row count of the footers. Every block is drawn by
    itself, so a table of few blocks may give none or all of its rows. An empty table gives none.
    """
    blocks = block_list(spark, root)
    percent = sample_percent(estimated_rows(blocks), target)
    return read_blocks(drawn_blocks(blocks, percent, seed, name), spark.read.parquet(root).schema, columns)
