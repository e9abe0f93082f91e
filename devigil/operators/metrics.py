"""Classification metrics as aggregates."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _counts(label: Column, prediction: Column) -> dict[str, Column]:
    hit = label == prediction
    return {
        "n": F.count(F.lit(1)),
        "correct": F.count_if(hit),
        "tp": F.count_if(hit & (label == 1)),
        "fp": F.count_if(~hit & (prediction == 1)),
        "fn": F.count_if(~hit & (label == 1)),
    }


def _share(part: Column, whole: Column) -> Column:
    """A ratio that is 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    whole = 2 * tp + fp + fn
    return F.when(whole == 0, F.lit(0.0)).otherwise(2 * tp / whole)


def binary_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``accuracy, f1`` in one pass; both are 0 without rows."""
    c = _counts(F.col(label), F.col(prediction))
    return df.agg(
        _share(c["correct"], c["n"]).alias("accuracy"), _f1(c["tp"], c["fp"], c["fn"]).alias("f1")
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``label, prediction, n, share``: shares of each true label add up to one."""
    counts = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = counts.groupBy("label").agg(F.sum("n").alias("total"))
    return counts.join(totals, "label").select(
        "label", "prediction", "n", _share(F.col("n"), F.col("total")).alias("share")
    )


def flatten_labels(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``target, label, prediction``: the label columns of a multi-label result, stacked."""
    entries = [
        F.struct(
            F.lit(name).alias("target"),
            F.col(label).alias("label"),
            F.col(prediction).alias("prediction"),
        )
        for name, (label, prediction) in pairs.items()
    ]
    return df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def multilabel_metrics(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``target, accuracy, f1, support, weighted_f1``; F1 weighted by the positives of a target.

    Shares are 0 where there are no rows, and ``weighted_f1`` where no target has a positive.
    """
    out = []
    for name, (label, prediction) in pairs.items():
        c = _counts(F.col(label), F.col(prediction))
        out.append(
            F.struct(
                F.lit(name).alias("target"),
                _share(c["correct"], c["n"]).alias("accuracy"),
                _f1(c["tp"], c["fp"], c["fn"]).alias("f1"),
                (c["tp"] + c["fn"]).alias("support"),
            )
        )
    rows = df.agg(F.array(*out).alias("targets"))
    weighted = reduce(
        lambda a, b: a + b,
        [F.col("targets")[i]["f1"] * F.col("targets")[i]["support"] for i in range(len(out))],
    )
    support = reduce(lambda a, b: a + b, [F.col("targets")[i]["support"] for i in range(len(out))])
    return rows.select(
        F.explode("targets").alias("t"), _share(weighted, support).alias("weighted_f1")
    ).select("t.*", "weighted_f1")
