"""The corpus pipeline: five stages from raw documents to a weighted mixture.

Every stage reads what the one before has written and keeps the columns of documents; the last adds
how often each document is to be seen.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devigil.llm import contamination, language, lines, mixing, near, queries
from devigil.llm.shared import Landing

OWN = "stage_"
#: The columns that stages read, and the one that holds all others meanwhile.
BASE, REST = ("doc_id", "text", "lang", "source", "n_chars"), "stage_rest"
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_any_columns(stage: Stage) -> Stage:
    """A stage that keeps further columns whatever they are called.

    The columns of ``BASE`` keep their names (exact ones, in any order), the others travel as the fields of
    one struct, so no name of theirs meets one of a stage or is parsed. Columns that the stage adds come
    last; a column of the input with such a name, in any case, gives way to them.
    """

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        names = docs.columns
        plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
        place = {name: f"c{names.index(name)}" for name in BASE}
        others = [f"c{i}" for i in range(len(names)) if f"c{i}" not in place.values()]
        packed = plain.select(
            *[F.col(c).alias(name) for name, c in place.items()], *([F.struct(*others).alias(REST)] if others else [])
        )
        out = stage(spark, packed, folder)
        added = [c for c in out.columns if c not in (*BASE, REST)]
        taken = {c.lower() for c in added}
        kept = [i for i, name in enumerate(names) if name.lower() not in taken]
        base = {c: name for name, c in place.items()}
        columns = [F.col(base.get(f"c{i}", f"{REST}.c{i}")).alias(f"c{i}") for i in kept]
        return out.select(*columns, *added).toDF(*[names[i] for i in kept], *added)

    return run


@with_any_columns
def language_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in a language that the models know; those without letters or all noise go."""
    model = language.train(language.labelled(docs))
    found = language.identify(docs, model, prefix=OWN)
    return found.filter(language.accepted(prefix=OWN)).select(*docs.columns)


@with_any_columns
def line_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Cross-site boilerplate lines go; so does a document that had nothing else."""
    cleaned = lines.remove_boilerplate(docs)
    left = (F.col("n_removed") == 0) | (F.length(F.trim("text")) > 0)
    renewed = cleaned.filter(left).withColumn("n_chars", F.length("text").cast("bigint"))
    return renewed.select(*docs.columns)


@with_any_columns
def near_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays; rows without doc_id all stay.

    A document is all rows of its doc_id. Of rows equal in doc_id and text one stays, the first by its
    other columns; different texts under one doc_id stay or go together.
    """
    kept = near.near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id").distinct()
    repeated = docs.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id")
    stays = docs.join(kept, "doc_id", "left_semi")
    # texts of documents with one row, nearly all, are not shuffled for this
    single = stays.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    several = stays.join(repeated, "doc_id", "left_semi").select(F.struct(*docs.columns).alias("r"))
    first = several.groupBy("r.doc_id", F.sha2("r.text", 256)).agg(F.min_by("r", F.to_json("r")).alias("r"))
    return single.unionByName(first.select("r.*")).unionByName(docs.filter("doc_id is null"))


@with_any_columns
def benchmark_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that contain passages of the benchmark go."""
    found = contamination.scan(docs, queries.table(spark, folder, "benchmark"), prefix=OWN)
    return found.filter(f"not {OWN}contaminated").select(*docs.columns)


@with_any_columns
def mixing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document with its rate; those whose rate is 0 go."""
    mixed = mixing.mix(docs, queries.domains(spark, folder))
    return mixed.filter("rate > 0")


STAGES = [
    ("language", language_stage),
    ("lines", line_stage),
    ("near duplicates", near_stage),
    ("benchmark", benchmark_stage),
    ("mixing", mixing_stage),
]

#: Trained models and fitted rates have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Apply the stages to the documents table, each to the landed rows of the one before."""
    store = Landing(spark, "pipeline")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.land(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
