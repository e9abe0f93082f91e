"""Principal components of TF-IDF vectors over the whole vocabulary, without a vocabulary on the driver.

A randomized range finder: every text is projected on random signs of its terms, the projections give
a basis of the texts, and the terms seen through that basis give the components. Only matrices of
sketch width by sketch width reach the driver; terms stay rows of a table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devigil.functions.text import tokens
from devigil.operators.vectors import inverse_frequency
from devigil.session import cut_lineage

MARGIN = 10
#: Eigenvalues below this share of the largest are rounding errors.
RANK_LIMIT = 1e-9


def signs(terms: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Random signs of every term that depend on the term and the seed only."""
    out = np.empty((len(terms), width))
    for i, term in enumerate(terms):
        bits = hashlib.shake_128(f"{seed}:{term}".encode()).digest(-(-width // 8))
        out[i] = np.unpackbits(np.frombuffer(bits, np.uint8))[:width] * 2.0 - 1.0
    return out


def weighed_texts(df: DataFrame, text: str, idf: DataFrame) -> DataFrame:
    """``text, terms, weights`` for the distinct texts: TF-IDF of unit length; unknown terms have none."""
    texts = df.select(F.col(text).alias("text")).distinct()
    each = texts.select("text", F.explode(tokens(F.col("text"))).alias("term"))
    counts = each.groupBy("text", "term").agg(F.count(F.lit(1)).alias("tf"))
    known = counts.join(idf, "term").select(
        "text", F.struct("term", (F.col("tf") * F.col("idf")).alias("weight")).alias("entry")
    )
    rows = known.groupBy("text").agg(F.collect_list("entry").alias("entries"))
    squares = F.aggregate("entries", F.lit(0.0), lambda a, e: a + e["weight"] * e["weight"])
    scaled = F.transform("entries", lambda e: e["weight"] / F.sqrt(squares))
    return rows.select("text", F.col("entries.term").alias("terms"), scaled.alias("weights"))


def _flat(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of a batch, and term number, weight and text number of every entry."""
    lengths = batch["terms"].map(len).to_numpy()
    unique, place = np.unique(np.concatenate(batch["terms"].to_list()), return_inverse=True)
    weight = np.concatenate(batch["weights"].to_list())
    return unique, place, weight, np.repeat(np.arange(len(batch)), lengths)


def _sums(rows: DataFrame, of, width: int) -> np.ndarray:
    """Sum over batches of arrays with ``width`` numbers, by position."""

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = of(batch)
            yield pd.DataFrame({"i": np.arange(len(found)), "x": found})

    summed = rows.mapInPandas(parts, "i long, x double").groupBy("i").agg(F.sum("x").alias("x"))
    found = dict(summed.collect())
    return np.array([found.get(i, 0.0) for i in range(width)])


@dataclass
class TextComponents:
    """``idf`` has ``term, idf`` and ``loadings`` has ``term, loading``, an array with a number for each
    component; ``center`` is the mean of the projected texts."""

    idf: DataFrame
    loadings: DataFrame
    center: list[float]

    @property
    def size(self) -> int:
        return len(self.center)

    def scores(self, df: DataFrame, text: str) -> DataFrame:
        """``text, score`` for the distinct texts; texts without known terms have none."""
        rows = weighed_texts(df, text, self.idf)
        each = rows.select("text", F.explode(F.arrays_zip("terms", "weights")).alias("e"))
        each = each.select("text", F.col("e.terms").alias("term"), F.col("e.weights").alias("weight"))
        parts = each.join(self.loadings, "term").select(
            "text", "weight", F.posexplode("loading").alias("i", "x")
        )
        summed = parts.groupBy("text", "i").agg(F.sum(F.col("weight") * F.col("x")).alias("x"))
        ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
        return summed.groupBy("text").agg(ordered["x"].alias("score"))

    def transform(self, df: DataFrame, text: str, output: str) -> DataFrame:
        """``df`` with the vector ``output``, centered like the texts of the fit."""
        center = F.array(*[F.lit(float(c)) for c in self.center])
        nothing = F.array(*[F.lit(0.0)] * self.size)
        scores = self.scores(df, text).withColumnRenamed("text", text)
        joined = df.join(scores, text, "left")
        centered = F.zip_with(F.coalesce("score", nothing), center, lambda a, b: a - b)
        return joined.withColumn(output, array_to_vector(centered)).drop("score")

    def save(self, path: str) -> None:
        self.idf.write.mode("overwrite").parquet(f"{path}/idf")
        self.loadings.write.mode("overwrite").parquet(f"{path}/loadings")
        spark = self.idf.sparkSession
        kept = spark.createDataFrame([(json.dumps(self.center),)], "center string")
        kept.write.mode("overwrite").parquet(f"{path}/center")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TextComponents:
        center = json.loads(spark.read.parquet(f"{path}/center").first()["center"])
        return cls(spark.read.parquet(f"{path}/idf"), spark.read.parquet(f"{path}/loadings"), center)


def fit_components(
    df: DataFrame, text: str, k: int, passes: int = 2, seed: int = 62, copies: str | None = None
) -> TextComponents:
    """At most ``k`` principal components of the TF-IDF vectors of the rows of ``df``.

    Every row counts, equal texts as often as they occur; ``copies`` names a column with the number of
    rows that a row stands for. Components stop at the rank of the texts;
    ``passes`` power iterations sharpen those that the sketch cannot hold exactly.
    """
    held = F.sum(F.col(copies)).cast("bigint") if copies else F.count(F.lit(1))
    counted = df.groupBy(F.col(text).alias("text")).agg(held.alias("copies"))
    counted = cut_lineage(counted)
    n = int(counted.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"])
    present = counted.select("copies", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
    frequency = present.groupBy("term").agg(F.sum("copies").alias("df"))
    idf = cut_lineage(frequency.select("term", inverse_frequency(F.lit(n), F.col("df")).alias("idf")))
    rows = cut_lineage(weighed_texts(counted, "text", idf).join(counted, "text"))
    width = min(k, n) + MARGIN

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                unique, place, weight, text_ = _flat(batch)
                seen = np.zeros((len(batch), width))
                np.add.at(seen, text_, signs(unique, width, seed)[place] * weight[:, None])
                yield batch.assign(y=list(seen))

    schema = "text string, terms array<string>, weights array<double>, copies long, y array<double>"
    projected = cut_lineage(rows.mapInPandas(sketch, schema))

    def basis(width: int) -> tuple[np.ndarray, np.ndarray]:
        """The mean of ``y`` and what turns centered ``y`` into an orthonormal basis of the texts."""

        def moments(batch: pd.DataFrame) -> np.ndarray:
            y = np.stack(batch["y"].to_list())
            weighed = y * batch["copies"].to_numpy()[:, None]
            return np.concatenate([weighed.sum(0), (weighed.T @ y).ravel()])

        found = _sums(projected, moments, width + width * width)
        mean = found[:width] / max(1, n)
        gram = found[width:].reshape(width, width) - n * np.outer(mean, mean)
        values, vectors = np.linalg.eigh(gram)
        kept = values > max(values.max(initial=0.0), 0.0) * RANK_LIMIT
        kept &= values > 0
        return mean, vectors[:, kept] / np.sqrt(values[kept])

    def seen_terms(mean: np.ndarray, turn: np.ndarray) -> DataFrame:
        """``term, z``: every term through the basis."""

        def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                unique, place, weight, text_ = _flat(batch)
                q = (np.stack(batch["y"].to_list()) - mean) @ turn
                q *= batch["copies"].to_numpy()[:, None]
                z = np.zeros((len(unique), q.shape[1]))
                np.add.at(z, place, q[text_] * weight[:, None])
                for i in range(q.shape[1]):
                    yield pd.DataFrame({"term": unique, "i": i, "x": z[:, i]})

        summed = projected.mapInPandas(parts, "term string, i int, x double")
        summed = summed.groupBy("term", "i").agg(F.sum("x").alias("x"))
        ordered = F.array_sort(F.collect_list(F.struct("i", "x")))
        return cut_lineage(summed.groupBy("term").agg(ordered["x"].alias("z")))

    mean, turn = basis(width)
    for turn_number in range(passes + 1):
        if not turn.shape[1]:
            return TextComponents(idf, idf.select("term", F.array().cast("array<double>").alias("loading")), [])
        terms, rank = seen_terms(mean, turn), turn.shape[1]
        if turn_number == passes or rank < width:
            break  # below the sketch width the basis holds all of the texts already
        again = TextComponents(idf, terms.withColumnRenamed("z", "loading"), [0.0] * rank)
        scores = again.scores(rows, "text").withColumnRenamed("score", "y")
        projected = cut_lineage(rows.join(scores, "text"))
        mean, turn = basis(rank)

    def outer(batch: pd.DataFrame) -> np.ndarray:
        z = np.stack(batch["z"].to_list())
        return (z.T @ z).ravel()

    values, vectors = np.linalg.eigh(_sums(terms, outer, rank * rank).reshape(rank, rank))
    order = np.argsort(-values)[: min(k, rank)]
    order = order[values[order] > values.max() * RANK_LIMIT]
    rotate = vectors[:, order] / np.sqrt(values[order])

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                loading = np.stack(batch["z"].to_list()) @ rotate
                yield pd.DataFrame({"term": batch["term"], "loading": list(loading)})

    loadings = cut_lineage(terms.mapInPandas(load, "term string, loading array<double>"))
    # the mean score is the weighed mean loading of the entries
    each = rows.select("copies", F.explode(F.arrays_zip("terms", "weights")).alias("e"))
    means = each.groupBy(F.col("e.terms").alias("term")).agg(
        F.sum(F.col("copies") * F.col("e.weights")).alias("m")
    )
    parts = means.join(loadings, "term").select("m", F.posexplode("loading").alias("i", "x"))
    found = dict(parts.groupBy("i").agg(F.sum(F.col("m") * F.col("x"))).collect())
    return TextComponents(idf, loadings, [float(found.get(i, 0.0)) / n for i in range(len(order))])
