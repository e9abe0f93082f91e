"""Feature vectors with Spark ML: one-hot categories, text components, numbers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSizeHint
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devigil.functions.text import number_or_zero
from devigil.operators.text_components import TextComponents, fit_components

MISSING = "__missing__"


@dataclass(frozen=True)
class FeatureSpec:
    """What goes into a feature vector; of the text at most ``components`` principal components."""

    categorical: Sequence[str] = ()
    text: str | None = None
    numeric: Sequence[str] = ()
    components: int = 500
    output: str = "features"


def prepare(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """NULL categories get a category of their own, bad numbers become 0, NULL text empty text."""
    ready = {c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING)) for c in spec.categorical}
    ready.update({c: number_or_zero(F.col(c)) for c in spec.numeric})
    if spec.text:
        ready[spec.text] = F.coalesce(spec.text, F.lit(""))
    return df.withColumns(ready)


def one_hot_stages(columns: Sequence[str]) -> list:
    """The slot that ``dropLast`` removes is the one for unseen values, which get all zeros."""
    indexed = [f"{c}_index" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_onehot" for c in columns]),
    ]


@dataclass
class FeatureModel:
    """Fitted features: one-hot models, text components and the assembler, applied in that order."""

    spec: FeatureSpec
    encoder: PipelineModel
    text: TextComponents | None
    assembler: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        df = self.encoder.transform(df)
        if self.text:
            df = self.text.transform(df, self.spec.text, f"{self.spec.text}_pca")
        return self.assembler.transform(df)

    def save(self, path: str) -> None:
        self.encoder.write().overwrite().save(f"{path}/encoder")
        self.assembler.write().overwrite().save(f"{path}/assembler")
        if self.text:
            self.text.save(f"{path}/text")

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: FeatureSpec) -> FeatureModel:
        text = TextComponents.load(spark, f"{path}/text") if spec.text else None
        parts = [PipelineModel.load(f"{path}/{part}") for part in ("encoder", "assembler")]
        return cls(spec, parts[0], text, parts[1])


def fit_features(
    df: DataFrame, spec: FeatureSpec, copies: str | None = None
) -> tuple[FeatureModel, DataFrame]:
    """The fitted feature model and the transformed rows, for rows from ``prepare``.

    ``copies`` names a column with the number of rows that a row stands for; categories have no such weight.
    """
    if copies and spec.categorical:
        raise ValueError("categories are ordered by rows, not by copies")
    fitted, inputs, text, ready = [], [], None, df
    if spec.categorical:
        for stage in one_hot_stages(spec.categorical):
            fitted.append(stage.fit(ready))
            ready = fitted[-1].transform(ready)
        inputs += [f"{c}_onehot" for c in spec.categorical]
    if spec.text:
        text = fit_components(df, spec.text, spec.components, copies=copies)
        inputs.append(f"{spec.text}_pca")
    inputs += list(spec.numeric)
    last = [VectorAssembler(inputCols=inputs, outputCol=spec.output)]
    if text:  # the assembler would look at a row to learn the length
        last.insert(0, VectorSizeHint(inputCol=f"{spec.text}_pca", size=text.size))
    assembler = PipelineModel(last)
    model = FeatureModel(spec, PipelineModel(fitted), text, assembler)
    return model, model.transform(df)


def ordinal_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``num_<column>``: position of each value in alphabetical order."""
    indexer = StringIndexer(
        inputCols=list(columns),
        outputCols=[f"num_{c}" for c in columns],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )
    return indexer.fit(df).transform(df)


def hash_share(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on nothing but the key and the seed."""
    digest = F.sha2(F.concat_ws(":", F.lit(seed).cast("string"), key.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def in_training(key: Column, train_share: float = 0.8, seed: int = 62) -> Column:
    return hash_share(key, seed) < train_share


def split_by_hash(
    df: DataFrame, key: str, train_share: float = 0.8, seed: int = 62
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows that stay the same however the data is partitioned."""
    train = in_training(F.col(key), train_share, seed)
    return df.filter(train), df.filter(~train)
