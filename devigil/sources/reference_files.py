"""Small reference inputs: gazetteer, rewrite rules, seed dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from devigil.sources.schemas import MEDICAL_SPECIALTIES

# fixed values: columns of the headerless postal gazetteer
GAZETTEER_DDL = """
country_code string, postal_code string, place_name string, admin_name1 string,
admin_code1 string, admin_name2 string, admin_code2 string, admin_name3 string,
admin_code3 string, latitude double, longitude double, accuracy string
"""

RULES_DDL = "edits array<struct<`from`: array<string>, `to`: string>>"


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated postal places; codes stay text, so leading zeros survive."""
    return _trimmed(spark.read.schema(GAZETTEER_DDL).csv(path, sep="\t", quote=""))


def gazetteer_of_text(lines: DataFrame, text: str) -> DataFrame:
    """The same places from lines in a column."""
    place = F.from_csv(F.col(text), GAZETTEER_DDL.replace("\n", " "), {"sep": "\t", "quote": ""})
    return _trimmed(lines.select(place.alias("p")).select("p.*"))


def _trimmed(places: DataFrame) -> DataFrame:
    codes = ("country_code", "postal_code")
    return places.withColumns({c: F.trim(c) for c in codes})


def read_rewrite_rules(spark: SparkSession, path: str) -> DataFrame:
    """``original_name, normalized_name`` pairs of an exported list of rewrite operations."""
    return flatten_rules(spark.read.schema(RULES_DDL).option("multiLine", True).json(path))


def flatten_rules(operations: DataFrame) -> DataFrame:
    edits = operations.select(F.explode("edits").alias("e"))
    return edits.select(
        F.explode("e.from").alias("original_name"), F.col("e.to").alias("normalized_name")
    )


def write_mapping_csv(mapping: DataFrame, path: str) -> None:
    mapping.write.mode("overwrite").csv(path, header=True)


def medical_specialties(spark: SparkSession) -> DataFrame:
    """The seed dimension; its 20 rows are a literal, so a broadcast is always safe."""
    return F.broadcast(
        spark.createDataFrame(MEDICAL_SPECIALTIES, "code string, description string")
    )
