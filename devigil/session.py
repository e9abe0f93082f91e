"""Session settings, reliable checkpoints and measured broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot join keys: AQE splits the oversized shuffle partition
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(app: str = "devigil", cores: int | str = 8, **extra: str) -> SparkSession:
    """A session for tests and single-machine measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RECOMMENDED_CONF, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without that setting it is a folder of the warehouse, which executors share as well.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that an iterative job neither replans nor recomputes it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_estimates(df: DataFrame) -> DataFrame:
    """``cut_lineage`` that forgets the estimated size of ``df`` as well.

    A checkpoint keeps the estimate of its plan, and that of a join is a product. Where a table joins
    itself in every round, the number of its digits doubles with every round and planning ends up
    slower than the work. Sizes are measured at run time here, so nothing is lost but the estimate.
    """
    spark, kept = df.sparkSession, cut_lineage(df)
    plain = spark._jsparkSession.createDataFrame(kept._jdf.javaRDD(), kept._jdf.schema())
    return DataFrame(plain, spark)


def parts_for(df: DataFrame, rows: int) -> int:
    """Partitions of ``df`` with about ``rows`` rows each; for tables that are counted without reading them."""
    return max(1, -(-df.count() // rows))


def broadcast_if_small(df: DataFrame, max_bytes: int = 16 << 20) -> DataFrame:
    """Hint a broadcast for a materialised frame, only after measuring what its rows hold."""
    held = F.octet_length(F.to_json(F.struct(*df.columns)))
    size = df.agg(F.coalesce(F.sum(held), F.lit(0)).alias("bytes")).first()["bytes"]
    return F.broadcast(df) if size <= max_bytes else df
