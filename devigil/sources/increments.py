"""Loads into a table that exists: stored rows win over new ones, and a load is committed as a whole.

A table is a folder of row folders, one a load, and of numbered manifests. A manifest lists the row folders
of its version; readers take the last one, so rows that a failed load has left behind are never seen.
A version is committed by renaming its manifest to the next number, which fails if another load came
first. The keys that are stored are also held as a Bloom filter, bits in a table of 64-bit words that are
merged by OR; only new rows whose bits are all set can be duplicates and take part in the join with the
stored keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devigil.operators.quality import REASONS, Split, all_rejected, split_by_parent, split_first_per_key
from devigil.session import broadcast_if_small, cut_lineage
from devigil.sources.catalog import parents_first

#: Bits of the filter and how many of them a key sets.
FILTER_BITS, FILTER_HASHES = 1 << 26, 4


class ConcurrentLoad(RuntimeError):
    """Another load has committed the version that this one was about to."""


@dataclass(frozen=True)
class Version:
    """``number`` of the last commit (0: none), folders of ``rows``, folders of filter ``words``, and the
    ``loads`` that have been committed."""

    number: int = 0
    rows: tuple[str, ...] = ()
    words: tuple[str, ...] = ()
    loads: tuple[str, ...] = ()
    schema: str | None = None


class StoredTable:
    """One table of a store: unique on ``keys`` (rows with a null in them all pass), its rows ordered by
    ``order`` within a load, which must identify a row."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str]):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.order = list(keys), list(order)

    # --- versions -------------------------------------------------------------------------------

    def _path(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> Version:
        path, files = self._path("_versions")
        if not files.exists(path):
            return Version()
        names = [s.getPath().getName() for s in files.listStatus(path)]
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(("_", "."))]
        if not numbers:
            return Version()
        at, files = self._path("_versions", f"{max(numbers):08d}.json")
        stream = files.open(at)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        held = json.loads(text)
        return Version(max(numbers), tuple(held["rows"]), tuple(held["words"]), tuple(held["loads"]), held["schema"])

    def _commit(self, before: Version, rows: str, words: str, load: str, schema: T.StructType) -> Version:
        number = before.number + 1
        after = Version(number, (*before.rows, rows), (*before.words, words), (*before.loads, load), schema.json())
        text = json.dumps({"rows": after.rows, "words": after.words, "loads": after.loads, "schema": after.schema})
        draft, files = self._path("_versions", f"_{uuid.uuid4().hex}")
        stream = files.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        final, files = self._path("_versions", f"{number:08d}.json")
        if files.exists(final) or not files.rename(draft, final):
            files.delete(draft, False)
            raise ConcurrentLoad(f"version {number} of {self.root} exists already")
        return after

    # --- reading --------------------------------------------------------------------------------

    def read(self, version: Version | None = None) -> DataFrame | None:
        """The rows of a version, the last one by default; None before the first load."""
        version = version or self.version()
        if not version.number:
            return None
        schema = T.StructType.fromJson(json.loads(version.schema))
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{r}" for r in version.rows])

    # --- loading --------------------------------------------------------------------------------

    def _bits(self) -> list[Column]:
        """Places of a row's key in the filter."""
        text = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in self.keys]
        return [F.pmod(F.xxhash64(*text, F.lit(seed)), F.lit(FILTER_BITS)) for seed in range(FILTER_HASHES)]

    def _words(self, rows: DataFrame) -> DataFrame:
        """``w, x``: words of the filter with the bits of the keys of ``rows`` set."""
        place = rows.dropna(subset=self.keys).select(F.explode(F.array(*self._bits())).alias("p"))
        bit = F.expr("shiftleft(1L, cast(p % 64 as int))")
        return place.groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.bit_or(bit).alias("x"))

    def _may_be_stored(self, rows: DataFrame, version: Version) -> DataFrame:
        """The distinct keys of ``rows`` whose bits are all set in the filter of the version."""
        parts = self.spark.read.schema("w bigint, x bigint").parquet(*[f"{self.root}/{w}" for w in version.words])
        words = cut_lineage(parts.groupBy("w").agg(F.bit_or("x").alias("x")))
        # at most FILTER_BITS / 64 rows, whatever the number of keys; measured all the same
        words = broadcast_if_small(words, 64 << 20)
        keys = rows.dropna(subset=self.keys)
        each = keys.select(*self.keys, F.explode(F.array(*self._bits())).alias("p"))
        each = each.withColumn("w", F.floor(F.col("p") / 64)).join(words, "w")
        hit = each.filter(F.expr("(x & shiftleft(1L, cast(p % 64 as int))) <> 0"))
        counted = hit.groupBy(*self.keys).agg(F.count_distinct("p").alias("hits"))
        # hash functions may agree on a place: a key has as many places as it has different ones
        places = F.size(F.array_distinct(F.array(*self._bits())))
        return counted.filter(F.col("hits") >= places).select(*self.keys)

    def split(self, rows: DataFrame, version: Version | None = None) -> Split:
        """New rows and those that a stored row or an earlier new row with the same key keeps out."""
        version = version or self.version()
        first, repeated = split_first_per_key(rows, self.keys, self.order, "duplicate key")
        if not version.number:
            return Split(first, repeated)
        possible = self._may_be_stored(first, version)
        stored = self.read(version).select(*self.keys).join(possible, self.keys, "left_semi").distinct()
        stored = cut_lineage(stored)
        fresh = first.join(stored, self.keys, "left_anti")
        known = first.join(stored, self.keys, "left_semi").withColumn(REASONS, F.array(F.lit("stored key")))
        return Split(fresh, all_rejected(repeated.select(*rows.columns, REASONS), known.select(*rows.columns, REASONS)))

    def load(self, rows: DataFrame, load: str) -> Split:
        """Add ``rows`` under the name ``load``; returns what was accepted and what was kept out.

        A load whose name is committed already changes nothing; what it added then is returned, with
        the rest of ``rows`` unjudged. Rows are written before the commit, so a load that fails on the
        way leaves the table as it was and can be run again.
        """
        before = self.version()
        if load in before.loads:
            at = before.rows[before.loads.index(load)]
            known = T.StructType.fromJson(json.loads(before.schema))
            nothing = rows.limit(0).withColumn(REASONS, F.array().cast("array<string>"))
            return Split(self.spark.read.schema(known).parquet(f"{self.root}/{at}"), nothing)
        held = before.schema and T.StructType.fromJson(json.loads(before.schema))
        if held and [(f.name, f.dataType) for f in held] != [(f.name, f.dataType) for f in rows.schema]:
            raise ValueError(f"columns of the load {load} are not those of {self.root}")
        accepted, rejected = self.split(rows, before)
        name = uuid.uuid4().hex
        accepted.write.parquet(f"{self.root}/rows/{name}")
        written = self.spark.read.schema(rows.schema).parquet(f"{self.root}/rows/{name}")
        self._words(written).write.parquet(f"{self.root}/words/{name}")
        self._commit(before, f"rows/{name}", f"words/{name}", load, rows.schema)
        return Split(written, rejected)


def append_load(
    tables: Mapping[str, Split],
    root: str,
    load: str,
    keys: Mapping[str, Sequence[str]],
    order: Sequence[str],
    parents: Mapping[str, tuple[str, str]] | None = None,
) -> dict[str, Split]:
    """Add the accepted rows of several tables below ``root/<table>`` under the name ``load``.

    ``keys`` has the unique columns of each table and ``parents`` maps a child table to (parent table,
    key). Parents come before their children at any depth, and children of a parent that was kept out are
    kept out too. Tables commit one by one; after a failure the same load goes on where it stopped.
    """
    parents = parents or {}
    spark = next(iter(tables.values())).accepted.sparkSession
    out: dict[str, Split] = {}
    for name in parents_first(tables, parents):
        rows, before = tables[name]
        lost = [before]
        if name in parents and parents[name][0] in out:
            parent, key = parents[name]
            rows, orphans = split_by_parent(rows, out[parent].accepted, key)
            lost.append(orphans)
        accepted, rejected = StoredTable(spark, f"{root}/{name}", keys[name], order).load(rows, load)
        out[name] = Split(accepted, all_rejected(*lost, rejected))
    return out
