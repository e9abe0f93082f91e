"""Differently shaped sources to one canonical table, with one-hot columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devigil.functions.text import array_to_csv, canonical_text

# --- fixed values: canonical columns (1 = clean the text) and the source mappings ----------------
CANONICALS = {
    "source_id": 0,
    "device_name": 1,
    "granular_name": 1,
    "generic_name": 1,
    "device_class": 0,
    "manufacturer_name": 1,
    "manufacturer_fei": 0,
    "pma_number": 1,
    "k_number": 0,
    "event_type": 0,
    "event_status": 1,
    "event_date": 0,
    "implant_flag": 0,
    "manufacturer_street": 1,
    "manufacturer_city": 1,
    "manufacturer_state": 1,
    "manufacturer_postal_code": 1,
    "manufacturer_country": 1,
    "regulation_number": 0,
    "product_quantity": 0,
    "medical_specialty_description": 0,
    "source": 0,
}
MAPPINGS = {
    "device_events": {
        "event_id": "source_id",
        "openfda_device_name": "device_name",
        "brand_name": "granular_name",
        "generic_name": "generic_name",
        "openfda_device_class": "device_class",
        "event_type": "event_type",
        "date_of_event": "event_date",
        "remedial_action": "event_status",
        "manufacturer_d_name": "manufacturer_name",
        "manufacturer_d_address_1": "manufacturer_street",
        "manufacturer_d_city": "manufacturer_city",
        "manufacturer_d_state": "manufacturer_state",
        "manufacturer_d_postal_code": "manufacturer_postal_code",
        "manufacturer_d_country": "manufacturer_country",
        "openfda_regulation_number": "regulation_number",
        "openfda_medical_specialty_description": "medical_specialty_description",
    },
    "recall": {
        "id": "source_id",
        "openfda_device_name": "device_name",
        "openfda_device_class": "device_class",
        "recalling_firm": "manufacturer_name",
        "firm_fei_number": "manufacturer_fei",
        "openfda_k_number": "k_number",
        "source": "event_type",
        "recall_status": "event_status",
        "event_date_initiated": "event_date",
        "address_1": "manufacturer_street",
        "city": "manufacturer_city",
        "state": "manufacturer_state",
        "postal_code": "manufacturer_postal_code",
        "country": "manufacturer_country",
        "openfda_regulation_number": "regulation_number",
        "product_quantity": "product_quantity",
        "openfda_medical_specialty_description": "medical_specialty_description",
    },
    "pma_submission": {
        "id": "source_id",
        "openfda_device_name": "device_name",
        "trade_name": "granular_name",
        "generic_name": "generic_name",
        "openfda_device_class": "device_class",
        "applicant": "manufacturer_name",
        "pma_number": "pma_number",
        "decision_code": "event_status",
        "decision_date": "event_date",
        "street_1": "manufacturer_street",
        "city": "manufacturer_city",
        "state": "manufacturer_state",
        "zip": "manufacturer_postal_code",
        "openfda_regulation_number": "regulation_number",
        "openfda_medical_specialty_description": "medical_specialty_description",
    },
    "submission": {
        "id": "source_id",
        "openfda_device_name": "device_name",
        "openfda_device_class": "device_class",
        "applicant": "manufacturer_name",
        "k_number": "k_number",
        "decision_code": "event_status",
        "decision_date": "event_date",
        "address_1": "manufacturer_street",
        "city": "manufacturer_city",
        "state": "manufacturer_state",
        "postal_code": "manufacturer_postal_code",
        "country_code": "manufacturer_country",
        "openfda_regulation_number": "regulation_number",
        "openfda_medical_specialty_description": "medical_specialty_description",
    },
}
EVENT_TYPES = (
    "death",
    "injury",
    "malfunction",
    "other",
    "no answer provided",
    "not provided",
    "recall",
)
CLASS_VALUES = ("1", "2", "3", "u", "n", "f")
SPECIALTIES = (
    "Anesthesiology",
    "Cardiovascular",
    "Clinical Chemistry",
    "Dental",
    "Ear, Nose, Throat",
    "Gastroenterology, Urology",
    "General Hospital",
    "Hematology",
    "Immunology",
    "Medical Genetics",
    "Microbiology",
    "Neurology",
    "Obstetrics/Gynecology",
    "Ophthalmic",
    "Orthopedic",
    "Pathology",
    "Physical Medicine",
    "Radiology",
    "General, Plastic Surgery",
    "Clinical Toxicology",
)
# --- end of fixed values ------------------------------------------------------------------------

PIVOTS = {
    "event_type": EVENT_TYPES,
    "device_class": CLASS_VALUES,
    # values as the clean-up leaves them
    "medical_specialty_description": tuple(
        re.sub("[^a-z0-9]+", " ", name.lower()) for name in SPECIALTIES
    ),
}


def fold_event_type(c: Column) -> Column:
    """The documented spellings ``Injury (IN/IL/IJ)`` count as one event type."""
    return F.when(F.lower(c).startswith("injury"), "injury").otherwise(c)


def harmonize(
    df: DataFrame, mapping: Mapping[str, str], canonicals: Mapping[str, int] = CANONICALS
) -> DataFrame:
    """Project one source onto the canonical columns; unmapped and empty ones are NULL."""
    raw_of = {canonical: raw for raw, canonical in mapping.items()}
    out = []
    for canonical, clean in canonicals.items():
        if canonical not in raw_of:
            out.append(F.lit(None).cast("string").alias(canonical))
            continue
        value = F.col(raw_of[canonical])
        if isinstance(df.schema[raw_of[canonical]].dataType, T.ArrayType):
            value = array_to_csv(value)
        text = value.cast("string")
        value = canonical_text(value) if clean else F.nullif(text, F.lit(""))
        out.append(value.alias(canonical))
    return df.select(*out)


def union_sources(
    tables: Mapping[str, DataFrame],
    mappings: Mapping[str, Mapping[str, str]] = MAPPINGS,
    canonicals: Mapping[str, int] = CANONICALS,
) -> DataFrame:
    """Harmonized sources one below the other, with ``source`` filled; other tables are ignored."""
    parts = []
    for name in [name for name in mappings if name in tables]:
        labelled = tables[name].withColumn("source", F.lit(name))
        part = harmonize(labelled, mappings[name], canonicals)
        parts.append(part.withColumn("source", F.lit(name)) if "source" in canonicals else part)
    master = parts[0]
    for part in parts[1:]:
        master = master.unionByName(part)
    if "event_type" in canonicals:
        master = master.withColumn("event_type", fold_event_type(F.col("event_type")))
    return master


def one_hot(
    df: DataFrame, pivots: Mapping[str, Sequence[str]], prefix: bool = False
) -> DataFrame:
    """A 0/1 column per declared value of each pivot column, without a shuffle; NULL gives all zeros.

    ``<column>_undeclared`` marks values outside the declared ones. Open domains, whose values nobody
    can declare, are for ``one_hot_rows``.
    """
    added = {}
    for column, values in pivots.items():
        for value in values:
            name = f"{column}_{value}" if prefix else value
            added[name] = F.coalesce((F.col(column) == value).cast("int"), F.lit(0))
        outside = F.col(column).isNotNull() & ~F.col(column).isin(*values)
        added[f"{column}_undeclared"] = outside.cast("int")
    return df.withColumns(added)


def one_hot_rows(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``key, column, value`` for every value that is not NULL: the ones of an open one-hot table."""
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    stacked = df.select(key, F.explode(F.array(*entries)).alias("e"))
    return stacked.select(key, "e.column", "e.value").filter("value is not null")


def integrate(
    tables: Mapping[str, DataFrame],
    pivots: Mapping[str, Sequence[str]] = PIVOTS,
    mappings: Mapping[str, Mapping[str, str]] = MAPPINGS,
    canonicals: Mapping[str, int] = CANONICALS,
) -> DataFrame:
    return one_hot(union_sources(tables, mappings, canonicals), pivots)


def join_events(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Events with their devices; where both have a column, the device's value is kept."""
    shared = (set(events.columns) & set(devices.columns)) - {"event_id"}
    return events.drop(*shared).join(devices, "event_id")


def display_types(df: DataFrame) -> DataFrame:
    """Types that every client can show: nested values as text, numbers as double or bigint."""
    out = []
    for column in df.schema:
        value, kind = F.col(column.name), column.dataType
        if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            value = F.to_json(value)
        elif isinstance(kind, (T.FloatType, T.DecimalType)):
            value = value.try_cast("double")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            value = value.try_cast("bigint")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            value = value.cast("string")
        out.append(value.alias(column.name))
    return df.select(*out)


def approval_flags(submission_type: Column) -> dict[str, Column]:
    """``1`` stands for a 510(k) clearance and ``2`` for a premarket approval; NULL for neither."""
    return {
        "pma_approval": F.coalesce((submission_type == "2").cast("int"), F.lit(0)),
        "510k_approval": F.coalesce((submission_type == "1").cast("int"), F.lit(0)),
    }
