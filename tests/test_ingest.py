import json

import pytest
from pyspark.sql import functions as F

from devigil.operators.harmonize import MAPPINGS, integrate, join_events
from devigil.operators.marts import device_view
from devigil.operators.quality import REASONS, Split, split_first_per_key
from devigil.sources import catalog, exports, reference_files, schemas
from exports_fixture import write_exports


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    folder = tmp_path_factory.mktemp("exports")
    write_exports(folder)
    return str(folder)


@pytest.fixture(scope="module")
def tables(spark, root, tmp_path_factory):
    """Everything loaded once, stored and read back."""
    folder = str(tmp_path_factory.mktemp("tables"))
    loaded = exports.load_all(spark, root, staging=f"{folder}/_staging")
    catalog.write_load(loaded, folder)
    return {
        name: Split(
            catalog.read_table(spark, folder, name),
            catalog.read_table(spark, f"{folder}/_rejected", name),
        )
        for name in loaded
    }


def test_files_are_routed_in_order_and_skipped_by_name(spark, root, rows):
    files = exports.list_files(spark, root)
    assert rows(files, "name", "feed") == [
        ("510k.json", "submission"),
        ("device-classification.json", "device_classification"),
        ("device-enforcement.json", "device_enforcements"),
        ("device-event-0001.json", "device_event"),
        ("device-event-0002.json", "device_event"),
        ("device-pma.json", "pma_submission"),
        ("device-udi.json", "skipped"),
        ("notes.json", "unrecognized"),
        ("recall-0001.json", "recall"),
    ]


def test_events_keep_first_key_all_null_keys_and_drop_bad_dates(tables, rows):
    accepted, rejected = tables["device_event"]
    assert rows(accepted, "mdr_report_key", "event_type") == [
        ("100", "injury (in)"), ("101", "death"), (None, "malfunction"), (None, "other"),
    ]
    assert rows(rejected, REASONS) == [
        (["bad date: date_of_event"],), (["duplicate mdr_report_key"],),
    ]


def test_event_values_are_normalized(tables):
    row = tables["device_event"].accepted.filter("mdr_report_key = '100'").first()
    assert (row.event_location, row.report_to_fda, row.report_number) == ("", None, None)
    assert row.product_problems == ["Leak", "Alarm"]
    assert row.remedial_action is None
    assert str(row.date_of_event) == "2024-01-31" and str(row.date_received) == "2024-02-01"
    assert len(row.asDict()) == 80  # 77 columns of the record, the id and where it came from


def test_children_follow_their_parent(tables, rows):
    devices = tables["device"]
    assert devices.accepted.count() == 3 and devices.rejected.count() == 2
    kept = devices.accepted.filter("openfda_device_name is not null")
    assert {(r.brand_name, r.openfda_device_class) for r in kept.collect()} == {("acme pump", "2")}
    assert devices.accepted.filter("event_id = device_event_key").count() == 3
    parents = tables["device_event"].accepted
    assert devices.accepted.join(parents, "event_id", "left_anti").isEmpty()


def test_narratives_lose_backslashes_and_need_a_numeric_unique_key(tables, rows):
    texts = tables["mdr_text"]
    assert rows(texts.accepted, "mdr_text_key", "text") == [(7, "pump leaked")]
    assert sorted(r[0][0] for r in rows(texts.rejected, REASONS)) == [
        "bad bigint: mdr_text_key", "duplicate mdr_text_key", "parent rejected",
    ]


def test_patient_problems_are_one_row_each_and_outcomes_have_a_domain(tables, rows):
    problems = tables["patient_problem"]
    assert rows(
        problems.accepted, "problem_description", "outcome", "treatment_description"
    ) == [("burn", "hospitalization", "surgery")]
    assert rows(problems.rejected, REASONS) == [(["outside domain: outcome"],)]
    assert tables["patient"].accepted.count() == 1


def test_flat_feeds(tables, rows):
    assert rows(tables["recall"].rejected, REASONS) == [(["too long: postal_code"],)]
    assert rows(tables["device_enforcements"].accepted, "recall_event_id") == [(12,)]
    assert rows(tables["device_enforcements"].rejected, REASONS) == [
        (["bad bigint: recall_event_id"],)
    ]
    assert rows(tables["submission"].accepted, "k_number", "third_party_flag", "applicant") == [
        ("k1", True, "acme")
    ]
    assert rows(tables["submission"].rejected, REASONS) == [
        (["bad boolean: third_party_flag"],), (["duplicate k_number"],),
        (["too long: country_code"],),
    ]
    assert rows(tables["pma_submission"].rejected, REASONS) == [(["too long: zip"],)]
    assert rows(tables["device_classification"].accepted, "openfda_k_number") == [(["K1"],)]


def test_accepted_and_rejected_add_up(spark, root, tables):
    counts = {"device_event": 6, "recall": 2, "submission": 4, "pma_submission": 2,
              "device_enforcements": 2, "device_classification": 1, "device": 5, "mdr_text": 4,
              "patient": 1, "patient_problem": 2}
    for name, (accepted, rejected) in tables.items():
        assert accepted.count() + rejected.count() == counts[name], name


def test_keys_are_stable_and_staging_changes_nothing(spark, root, tables, rows):
    direct = exports.load_feed(spark, root, "device_event")
    for name, id_column in (("device_event", "event_id"), ("device", "device_id")):
        assert rows(direct[name].accepted, id_column) == rows(tables[name].accepted, id_column)


def test_line_layout(spark, tmp_path, rows):
    lines = [{"cfres_id": "1", "city": "Bonn"}, {"cfres_id": "2", "city": "Ulm"}]
    (tmp_path / "recall.json").write_text("\n".join(map(json.dumps, lines)))
    loaded = exports.load_feed(spark, str(tmp_path), "recall", layout="lines")["recall"]
    assert rows(loaded.accepted, "cfres_id", "city") == [("1", "bonn"), ("2", "ulm")]


def test_recall_children(spark, root, rows):
    record = schemas.flat_record(schemas.RECALL)
    parts = exports.normalize_recalls(
        exports.read_records(spark, root, "recall", record, with_meta=True)
    )
    assert rows(parts["recall_k_numbers"], "position", "k_number") == [(0, "K1"), (1, "K2")]
    assert rows(parts["recall_openfda"], "device_class") == [("F",)]
    assert parts["recall_openfda_registration_numbers"].count() == 2
    assert rows(parts["recall_openfda_regulation_numbers"], "regulation_number") == [("880.5725",)]
    assert rows(parts["recall_meta"], "license") == [("l",), ("l",)]
    assert rows(parts["recall_meta_results"], "skip", "limit", "total") == [(0, 2, 2)] * 2


def test_loaded_tables_feed_the_device_mart(tables, rows):
    events = join_events(tables["device_event"].accepted, tables["device"].accepted)
    sources = {
        "device_events": events,
        **{n: tables[n].accepted for n in ("recall", "pma_submission", "submission")},
    }
    assert set(sources) == set(MAPPINGS)
    view = device_view(integrate(sources)).filter("device_name = 'infusion pump'")
    got = rows(view, "manufacturer_name", "device_class", "deaths", "injuries", "recalls",
               "class_2", "records", "pma_submissions", "k_submissions")
    assert got == [
        ("acme gmbh", "f", 0, 0, 1, 0, 1, 0, 1),
        ("acme inc", "2", 1, 1, 0, 1, 2, 0, 0),
        (None, "2", 0, 0, 0, 1, 1, 1, 0),
    ]


def test_first_per_key_with_a_hot_key(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(0).alias("k"))
    kept, dropped = split_first_per_key(df, ["k"], ["id"])
    assert kept.count() == 2001 and dropped.count() == 999
    assert kept.filter("k = 0").first().id == 0


def test_tables_round_trip_with_partitions_and_queries(spark, tables, tmp_path, rows):
    root = str(tmp_path)
    catalog.write_load({"recall": tables["recall"]}, root)
    assert catalog.read_table(spark, root, "recall").count() == 1
    assert catalog.read_table(spark, root, "_rejected/recall").count() == 1
    found = catalog.read_table(spark, root, "recall", "select cfres_id from recall")
    assert rows(found) == [("1",)]
    dated = spark.createDataFrame([("2020-01-05", 1), ("2021-07-01", 2)], "d string, n int")
    catalog.write_table(dated.withColumn("d", F.col("d").cast("date")), f"{root}/t", "d")
    assert rows(catalog.read_table(spark, root, "t").filter("year = 2021"), "n") == [(2,)]


def test_sampled_catalog_keeps_families_together(spark, tmp_path):
    parents = spark.range(2000).withColumnRenamed("id", "event_id")
    children = parents.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(3))))
    catalog.write_sampled_catalog(
        {"device": children, "device_event": parents}, str(tmp_path),
        {"device": ("device_event", "event_id")},
    )
    drawn = spark.read.parquet(f"{tmp_path}/device_event")
    lines = spark.read.parquet(f"{tmp_path}/device")
    assert 100 < drawn.count() < 320
    assert lines.count() == 3 * drawn.count()
    assert lines.join(drawn, "event_id", "left_anti").isEmpty()


def test_statistics_of_catalog_tables(spark):
    spark.range(5).write.mode("overwrite").saveAsTable("analyzed_numbers")
    try:
        assert "analyzed_numbers" in catalog.analyze_tables(spark)
        described = spark.sql("DESCRIBE EXTENDED analyzed_numbers").filter("col_name = 'Statistics'")
        assert "5 rows" in described.first().data_type
    finally:
        spark.sql("DROP TABLE analyzed_numbers")


def test_gazetteer_and_rewrite_rules(spark, tmp_path, rows):
    line = "DE\t01067\tDresden\tSachsen\tSN\t\t\t\t\t51.05\t13.74\t4"
    (tmp_path / "places.txt").write_text(line + "\n")
    places = reference_files.read_gazetteer(spark, str(tmp_path / "places.txt"))
    assert rows(places, "country_code", "postal_code", "latitude") == [("DE", "01067", 51.05)]
    rules = [{"op": "mass-edit", "edits": [{"from": ["a", "b"], "to": "c"}]}]
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    mapping = reference_files.read_rewrite_rules(spark, str(tmp_path / "rules.json"))
    assert rows(mapping) == [("a", "c"), ("b", "c")]
    reference_files.write_mapping_csv(mapping, str(tmp_path / "mapping"))
    assert rows(spark.read.csv(str(tmp_path / "mapping"), header=True)) == [("a", "c"), ("b", "c")]
    assert reference_files.medical_specialties(spark).count() == 20
