"""Table sinks, scans, statistics and sampled copies."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devigil.operators.features import hash_share
from devigil.operators.quality import Split


def write_table(df: DataFrame, path: str, date_column: str | None = None) -> None:
    """A Parquet table, split by the year of ``date_column`` so that date filters skip files."""
    writer = df
    if date_column:
        writer = df.withColumn("year", F.year(date_column)).hint("rebalance", "year")
        writer.write.mode("overwrite").partitionBy("year").parquet(path)
    else:
        writer.write.mode("overwrite").parquet(path)


def write_load(tables: Mapping[str, Split], root: str) -> None:
    """Accepted rows below ``root/<table>``, rejected ones below ``root/_rejected/<table>``."""
    for name, (accepted, rejected) in tables.items():
        write_table(accepted, f"{root}/{name}")
        write_table(rejected, f"{root}/_rejected/{name}")


def read_table(spark: SparkSession, root: str, name: str, query: str | None = None) -> DataFrame:
    """A stored table, or the result of ``query`` with that table visible under its name."""
    table = spark.read.parquet(f"{root}/{name}")
    if query is None:
        return table
    table.createOrReplaceTempView(name)
    return spark.sql(query)


def analyze_tables(spark: SparkSession, database: str = "default") -> list[str]:
    """Statistics for every catalogue table of a database, for the optimizer."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    for name in names:
        spark.sql(f"ANALYZE TABLE `{database}`.`{name}` COMPUTE STATISTICS")
    return names


def parents_first(tables: Iterable[str], parents: Mapping[str, tuple[str, str]]) -> list[str]:
    """The names with every parent before its children; a cycle is an error. A parent that is not among the
    tables counts as none."""
    known, out, open_ = list(tables), [], []

    def visit(name: str) -> None:
        if name in out:
            return
        if name in open_:
            raise ValueError(f"tables that are each other's parents: {', '.join(open_)}")
        open_.append(name)
        if name in parents and parents[name][0] in known:
            visit(parents[name][0])
        open_.pop()
        out.append(name)

    for name in known:
        visit(name)
    return out


def write_sampled_catalog(
    tables: Mapping[str, DataFrame],
    root: str,
    parents: Mapping[str, tuple[str, str]] | None = None,
    fraction: float = 0.1,
    seed: int = 12345,
) -> None:
    """A sampled copy of several tables below ``root``; the originals stay as they are.

    ``parents`` maps a child table to (parent table, key): such a child keeps exactly the rows
    whose parent was drawn, read back from the parent's written sample. The others are drawn by a
    hash of the row, so equal rows are drawn together and a second run draws the same ones.
    """
    parents = parents or {}
    order = parents_first(tables, parents)
    spark = next(iter(tables.values())).sparkSession
    for name in order:
        if name in parents and parents[name][0] in tables:
            parent, key = parents[name]
            drawn = spark.read.parquet(f"{root}/{parent}").select(key)
            rows = tables[name].join(drawn, key, "left_semi")
        else:
            whole = F.to_json(F.struct(*tables[name].columns))
            rows = tables[name].filter(hash_share(whole, seed) < fraction)
        rows.write.mode("overwrite").parquet(f"{root}/{name}")


__all__ = [
    "analyze_tables",
    "parents_first",
    "read_table",
    "write_load",
    "write_sampled_catalog",
    "write_table",
]
