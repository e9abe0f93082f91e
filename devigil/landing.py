"""Tables landed in the shared folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from devigil.session import ensure_checkpoint_dir


class Landing:
    """Intermediate Parquet tables in the folder that all executors share.

    A table replaces a long lineage: after the loss of an executor its readers start from the files.
    ``drop`` removes a table once whatever was derived from it is landed too. With ``release`` the shuffle
    files of a landing are removed when its table is written, not when the driver's JVM finds that nothing
    refers to them any more, which may be a landing or two later.
    """

    def __init__(self, spark: SparkSession, operator: str, release: bool = False):
        self.spark, self.release = spark, release
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{operator}-{uuid.uuid4().hex}"

    def _write(self, writer: DataFrameWriter, name: str) -> None:
        if self.release:
            with setting(self.spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
                writer.parquet(f"{self.folder}/{name}")
        else:
            writer.parquet(f"{self.folder}/{name}")
            # shuffle files go when the driver's JVM collects the plans that made them: help it along
            self.spark._jvm.System.gc()

    def land(self, df: DataFrame, name: str) -> DataFrame:
        self._write(df.write, name)
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def land_parts(self, df: DataFrame, name: str, column: str, values: tuple) -> list[DataFrame]:
        """A table of its own for each of the values of ``column``, which they do not hold any more."""
        self._write(df.write.partitionBy(column), name)
        schema = df.drop(column).schema
        # an absent value has no folder
        whole = self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")
        present = {row[0] for row in whole.select(column).distinct().collect()}
        return [
            self.spark.read.schema(schema).parquet(f"{self.folder}/{name}/{column}={value}")
            if value in present
            else self.spark.createDataFrame([], schema)
            for value in values
        ]

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            files.delete(path, True)

    def drop_others(self, *names: str) -> None:
        """All tables go but the named ones."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        present = [status.getPath().getName() for status in files.listStatus(path)]
        self.drop(*[name for name in present if name not in names])


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Jobs that start inside run with this setting."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)
