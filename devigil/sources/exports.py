"""Nested JSON exports: file routing, envelope reading, flattening and child tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devigil.functions.text import drop_trailing_backslashes, normalize_array, normalize_scalar
from devigil.operators.quality import (
    REASONS,
    Split,
    all_rejected,
    split_by_parent,
    split_first_per_key,
    typed_load,
)
from devigil.sources import schemas as S
from devigil.sources.envelopes import records_of_files, split_records

# --- fixed values: markers in file paths, tested in this order, and names to leave out -----------
FEED_MARKERS = (
    ("device-event", "device_event"),
    ("device-enforcement", "device_enforcements"),
    ("device-classification", "device_classification"),
    ("device-udi", "skipped"),
    ("510", "submission"),
    ("device-pma", "pma_submission"),
    ("recall", "recall"),
)
SKIPPED_NAMES = ("zip", "pdf")
# --- end of fixed values ------------------------------------------------------------------------

UNRECOGNIZED = "unrecognized"
FILE, POSITION = "source_file", "source_position"


def route(path: Column, markers: Sequence[tuple[str, str]] = FEED_MARKERS) -> Column:
    """The feed of a path: the first marker it contains decides."""
    chosen = None
    for marker, feed in markers:
        hit = path.contains(marker)
        chosen = F.when(hit, feed) if chosen is None else chosen.when(hit, feed)
    return chosen.otherwise(UNRECOGNIZED)


def wanted_name(name: Column, skipped: Sequence[str] = SKIPPED_NAMES) -> Column:
    keep = F.lit(True)
    for part in skipped:
        keep = keep & ~name.contains(part)
    return keep


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root`` with their feed; contents are not read."""
    path = F.col("path")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", F.element_at(F.split(path, "/"), -1).alias("name"))
        .filter(wanted_name(F.col("name")))
        .select("path", "name", route(path).alias("feed"))
    )


def read_records(
    spark: SparkSession,
    root: str,
    feed: str,
    record: T.StructType,
    layout: str = "envelope",
    with_meta: bool = False,
) -> DataFrame:
    """The records of one feed as ``source_file, source_position, r`` (and ``meta``).

    ``envelope`` files hold ``{"meta": ..., "results": [...]}``: one task parses one file, and the
    records are rebalanced before any further work. ``lines`` files hold one record per line and
    are split like any text file; there the position comes from what the line holds. ``split`` reads
    envelopes by many tasks a file; there the position is the place of the record's first byte, and
    elements of ``results`` that are no objects have no row (nor has ``meta``).
    """
    if layout == "split":
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        named = wanted_name(F.element_at(F.split("path", "/"), -1)) & (route(F.col("path")) == feed)
        return split_records(records_of_files(files.filter(named).select("path", "length")), record, FILE, POSITION)
    reader = spark.read.option("recursiveFileLookup", True)
    wanted = wanted_name(F.col("_metadata.file_name")) & (
        route(F.col("_metadata.file_path")) == feed
    )
    if layout == "lines":
        rows = reader.text(root).filter(wanted)
        return records_of_lines(rows.withColumn(FILE, F.col("_metadata.file_path")), "value", record)
    files = reader.schema(envelope(record)).option("multiLine", True).json(root).filter(wanted)
    return unpack_envelopes(files.withColumn(FILE, F.col("_metadata.file_path")), with_meta)


def envelope(record: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("meta", T.StructType.fromDDL(S.META_DDL)),
            T.StructField("results", T.ArrayType(record)),
        ]
    )


def unpack_envelopes(files: DataFrame, with_meta: bool = False) -> DataFrame:
    """``source_file, source_position, r`` (and ``meta``) of parsed envelopes, one row each."""
    extra = ["meta"] if with_meta else []
    return files.select(FILE, *extra, F.posexplode("results").alias(POSITION, "r")).hint("rebalance")


def records_of_text(
    texts: DataFrame, text: str, record: T.StructType, with_meta: bool = False
) -> DataFrame:
    """The records of envelopes that are text in a column; ``source_file`` names each."""
    parsed = F.from_json(text, envelope(record))
    return unpack_envelopes(texts.select(FILE, parsed.alias("e")).select(FILE, "e.*"), with_meta)


def records_of_lines(lines: DataFrame, text: str, record: T.StructType) -> DataFrame:
    """The records of lines of JSON. A record's position is the hash of its line and a number among the
    equal lines of its file, so it does not depend on where files are split."""
    hashed = lines.filter(F.trim(text) != "").select(FILE, text, F.sha2(text, 256).alias("line_key"))
    counted = hashed.groupBy(FILE, "line_key").agg(
        F.first(text).alias(text), F.count(F.lit(1)).alias("copies")
    )
    each = counted.select(
        FILE, "line_key", text, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("n")
    )
    position = F.concat_ws(":", "line_key", F.lpad(F.col("n").cast("string"), 9, "0"))
    return each.select(FILE, position.alias(POSITION), F.from_json(text, record).alias("r"))


def surrogate_key(*parts: Column) -> Column:
    """A key that parent and children derive alike, also when a task is run again."""
    text = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("\x1f", *text), 256)


def flatten(spec: S.TableSpec, root: str = "r") -> list[Column]:
    """Columns of a table out of a nested record, normalized; absent keys become NULL."""
    out = []
    for column in spec.columns:
        if column.name.startswith(S.OPENFDA_PREFIX):
            path = f"{root}.openfda.{column.name.removeprefix(S.OPENFDA_PREFIX)}"
        else:
            path = f"{root}.{spec.renamed.get(column.name, column.name)}"
        value = F.col(path)
        cleaned = normalize_array(value) if S.is_array(column) else normalize_scalar(value)
        out.append(cleaned.alias(column.name))
    return out


def load_flat(records: DataFrame, spec: S.TableSpec) -> Split:
    """One record, one row."""
    key = surrogate_key(F.col(f"r.{spec.natural_key}"), F.col(FILE), F.col(POSITION))
    rows = records.select(key.alias(spec.id_column), FILE, POSITION, *flatten(spec))
    return _load(rows, spec)


def _load(rows: DataFrame, spec: S.TableSpec) -> Split:
    accepted, rejected = typed_load(rows, spec)
    for key in spec.unique:
        accepted, duplicates = split_first_per_key(
            accepted, [key], [FILE, POSITION], f"duplicate {key}"
        )
        rejected = all_rejected(
            rejected.select(spec.id_column, FILE, POSITION, REASONS),
            duplicates.select(spec.id_column, FILE, POSITION, REASONS),
        )
    return Split(accepted, rejected.select(spec.id_column, FILE, POSITION, REASONS))


def load_events(records: DataFrame, staging: str | None = None) -> dict[str, Split]:
    """Events with their devices, patients, patient problems and narratives.

    An empty or missing child array gives no child rows and keeps the event. Children of a rejected
    event are rejected too. With a ``staging`` folder the accepted parents are landed there once,
    instead of being worked out again for each child table.
    """

    def landed(split: Split, name: str) -> Split:
        if staging is None:
            return split
        return Split(stage(split.accepted, f"{staging}/accepted_{name}"), split.rejected)

    keyed = records.withColumn(
        "event_id", surrogate_key(F.col("r.mdr_report_key"), F.col(FILE), F.col(POSITION))
    )
    event_rows = keyed.select("event_id", FILE, POSITION, *flatten(S.DEVICE_EVENT))
    events = landed(_load(event_rows, S.DEVICE_EVENT), "device_event")

    def children(name: str, spec: S.TableSpec) -> DataFrame:
        child = keyed.select("event_id", FILE, F.posexplode(f"r.{name}").alias("n", "r"))
        return child.select(
            "event_id",
            surrogate_key(F.col("event_id"), F.lit(name), F.col("n")).alias(spec.id_column),
            FILE,
            F.concat_ws(":", "event_id", F.lpad(F.col("n").cast("string"), 9, "0")).alias(
                POSITION
            ),
            "r",
        )

    def finish(rows: DataFrame, spec: S.TableSpec, parents: DataFrame, key: str) -> Split:
        valid, invalid = _load(rows, spec)
        kept, orphans = split_by_parent(valid, parents, key)
        return Split(
            kept,
            all_rejected(invalid, orphans.select(spec.id_column, FILE, POSITION, REASONS)),
        )

    patients = children("patient", S.PATIENT)
    patient_rows = patients.select(
        "event_id", "patient_id", FILE, POSITION, *flatten(S.PATIENT)
    )
    patient = landed(finish(patient_rows, S.PATIENT, events.accepted, "event_id"), "patient")
    problems = patients.select(
        "event_id",
        "patient_id",
        FILE,
        F.col("r.patient_sequence_number").alias("patient_sequence_number"),
        F.posexplode(
            F.arrays_zip(
                F.col("r.patient_problems").alias("problem_description"),
                F.col("r.sequence_number_outcome").alias("outcome"),
                F.col("r.sequence_number_treatment").alias("treatment_description"),
            )
        ).alias("n", "p"),
    )
    outcome = F.regexp_replace(F.col("p.outcome"), r"^\s*[0-9]+\s*[.,]\s*", "")
    problem_rows = problems.select(
        "event_id",
        "patient_id",
        surrogate_key(F.col("patient_id"), F.col("n")).alias("problem_id"),
        FILE,
        F.concat_ws(":", "patient_id", F.lpad(F.col("n").cast("string"), 9, "0")).alias(POSITION),
        normalize_scalar(F.col("patient_sequence_number")).alias("patient_sequence_number"),
        normalize_scalar(F.col("p.problem_description")).alias("problem_description"),
        normalize_scalar(outcome).alias("outcome"),
        normalize_scalar(F.col("p.treatment_description")).alias("treatment_description"),
    )
    devices = children("device", S.DEVICE)
    device_rows = devices.select(
        "event_id",
        "device_id",
        FILE,
        POSITION,
        F.col("event_id").alias("device_event_key"),
        *flatten(S.DEVICE),
    )
    texts = children("mdr_text", S.MDR_TEXT)
    narrative = drop_trailing_backslashes(F.col("r.text"))
    text_rows = texts.select(
        "event_id",
        "mdr_text_id",
        FILE,
        POSITION,
        *flatten(S.MDR_TEXT),
        normalize_scalar(narrative).alias("narrative"),
    ).withColumn("text", F.col("narrative")).drop("narrative")
    return {
        "device_event": events,
        "patient": patient,
        "patient_problem": finish(problem_rows, S.PATIENT_PROBLEM, patient.accepted, "patient_id"),
        "device": finish(device_rows, S.DEVICE, events.accepted, "event_id"),
        "mdr_text": finish(text_rows, S.MDR_TEXT, events.accepted, "event_id"),
    }


def stage(records: DataFrame, folder: str) -> DataFrame:
    """Parse once: land the nested records as Parquet, so that every table prunes its columns."""
    records.write.mode("overwrite").parquet(folder)
    return records.sparkSession.read.parquet(folder)


def load_feed(
    spark: SparkSession,
    root: str,
    feed: str,
    layout: str = "envelope",
    staging: str | None = None,
) -> dict[str, Split]:
    """All tables that one feed fills. ``staging`` is a shared folder for the parsed records."""
    spec = S.FLAT_FEEDS.get(feed)
    record = S.flat_record(spec) if spec else S.event_record()
    records = read_records(spark, root, feed, record, layout)
    if staging:
        records = stage(records, f"{staging}/{feed}")
    return {spec.name: load_flat(records, spec)} if spec else load_events(records, staging)


def load_all(
    spark: SparkSession, root: str, layout: str = "envelope", staging: str | None = None
) -> dict[str, Split]:
    tables: dict[str, Split] = {}
    for feed in ("device_event", *S.FLAT_FEEDS):
        tables.update(load_feed(spark, root, feed, layout, staging))
    return tables


def explode_child(df: DataFrame, key: str, values: Column, name: str) -> DataFrame:
    """One row per item of a repeated field, with its position."""
    return df.select(key, F.posexplode(values).alias("position", name))


def normalize_recalls(records: DataFrame) -> dict[str, DataFrame]:
    """Recalls as one table per repeated field; records come from ``read_records(with_meta=True)``."""
    keyed = records.withColumn(
        "recall_id", surrogate_key(F.col("r.cfres_id"), F.col(FILE), F.col(POSITION))
    )
    openfda = keyed.filter(F.col("r.openfda").isNotNull())
    regulation = openfda.filter(F.col("r.openfda.regulation_number").isNotNull())
    return {
        "recall": keyed.select("recall_id", "r.*").drop("openfda"),
        "recall_k_numbers": explode_child(keyed, "recall_id", F.col("r.k_number"), "k_number"),
        "recall_openfda": openfda.select(
            "recall_id",
            F.upper("r.openfda.device_class").alias("device_class"),
            F.col("r.openfda.device_name").alias("device_name"),
            F.col("r.openfda.medical_specialty_description").alias(
                "medical_specialty_description"
            ),
        ),
        "recall_openfda_k_numbers": explode_child(
            openfda, "recall_id", F.col("r.openfda.k_number"), "k_number"
        ),
        "recall_openfda_registration_numbers": explode_child(
            openfda, "recall_id", F.col("r.openfda.registration_number"), "registration_number"
        ),
        "recall_openfda_fei_numbers": explode_child(
            openfda, "recall_id", F.col("r.openfda.fei_number"), "fei_number"
        ),
        "recall_openfda_regulation_numbers": regulation.select(
            "recall_id", F.col("r.openfda.regulation_number").alias("regulation_number")
        ),
        "recall_meta": keyed.select(
            "recall_id", "meta.disclaimer", "meta.license", "meta.last_updated"
        ),
        "recall_meta_results": keyed.select("recall_id", "meta.results.*"),
    }
