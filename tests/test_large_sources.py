"""Block samples, splittable envelopes and loads into existing tables."""

import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devigil.operators.quality import REASONS, Split
from devigil.sources import catalog, envelopes, exports, increments, parquet_blocks
from exports_fixture import write_exports

# --- samples of row groups ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def blocks_folder(tmp_path_factory):
    """Four files of ten row groups; the table's third column is missing from one file."""
    folder = tmp_path_factory.mktemp("blocks")
    for f in range(4):
        n = range(f * 1000, f * 1000 + 1000)
        columns = {"id": pa.array(n, pa.int64()), "word": [f"w{i}" * 40 for i in n]}
        if f < 3:
            columns["at"] = pa.array([i * 1_000_000 for i in n], pa.timestamp("us", tz="UTC"))
        pq.write_table(pa.table(columns), folder / f"{f}.parquet", row_group_size=100)
    return folder


def test_blocks_and_estimate_come_from_footers(spark, blocks_folder):
    blocks = parquet_blocks.block_list(spark, str(blocks_folder))
    assert blocks.count() == 40 and parquet_blocks.estimated_rows(blocks) == 4000
    whole = parquet_blocks.sample_blocks(spark, str(blocks_folder), target=10_000)
    assert whole.columns == ["id", "word", "at"] and whole.count() == 4000
    assert whole.filter("at is null").count() == 1000 and whole.filter("id = 7").first()["at"].second == 7


def test_blocks_that_are_not_drawn_are_never_read(spark, blocks_folder, tmp_path):
    for file in sorted(blocks_folder.iterdir()):
        (tmp_path / file.name).write_bytes(file.read_bytes())
    name = lambda path: F.element_at(F.split(path, "/"), -1)
    blocks = parquet_blocks.block_list(spark, str(tmp_path))
    drawn = {(r["path"].rsplit("/", 1)[1], r["block"]) for r in parquet_blocks.drawn_blocks(blocks, 25.0, name=name).collect()}
    assert 0 < len(drawn) < 25
    # everything of the other blocks becomes rubbish
    for file in tmp_path.iterdir():
        footer, data = pq.ParquetFile(file).metadata, bytearray(file.read_bytes())
        for b in range(footer.num_row_groups):
            if (file.name, b) not in drawn:
                for c in range(footer.num_columns):
                    chunk = footer.row_group(b).column(c)
                    at = chunk.dictionary_page_offset or chunk.data_page_offset
                    data[at : at + chunk.total_compressed_size] = b"\xff" * chunk.total_compressed_size
        file.write_bytes(data)
    sample = parquet_blocks.sample_blocks(spark, str(tmp_path), target=1000, columns=["id"], name=name)
    want = {i for f, b in drawn for i in range(int(f[0]) * 1000 + b * 100, int(f[0]) * 1000 + b * 100 + 100)}
    assert {r["id"] for r in sample.collect()} == want
    assert len(sample.columns) == 1 and sample.rdd.getNumPartitions() == len(drawn)


def test_block_sample_of_an_empty_table(spark, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/none")
    assert parquet_blocks.sample_blocks(spark, f"{tmp_path}/none").count() == 0


# --- envelopes ----------------------------------------------------------------------------------

PIECES = ['"', "\\", "\\\\", '\\"', "{", "}", "[", "]", ",", ":", "é", "漢", "\n", " ", "a", "results", '"results": [', "\\\\\\"]


def random_value(rng, depth=0):
    kind = rng.randrange(5 if depth < 3 else 3)
    if kind == 3:
        return [random_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    if kind == 4:
        return {"".join(rng.choices(PIECES, k=2)) + str(i): random_value(rng, depth + 1) for i in range(rng.randrange(4))}
    return "".join(rng.choices(PIECES, k=rng.randrange(12))) if kind else rng.randrange(100)


@pytest.mark.parametrize("chunk", [7, 64, 1000, 1 << 20])
def test_records_equal_the_parsed_envelope(spark, tmp_path, chunk):
    rng = random.Random(chunk)
    wanted = {}
    for f in range(3):
        records = [{"id": i, "v": random_value(rng)} for i in range(rng.randrange(1, 30 if chunk > 7 else 6))]
        whole = {"meta": {"results": {"a": ["{"]}, "t": random_value(rng)}, "list": [{"no": 1}], "results": records, "after": [{"no": 2}]}
        path = tmp_path / f"{f}.json"
        path.write_text(json.dumps(whole, indent=rng.choice([None, 1]), ensure_ascii=rng.choice([True, False])))
        wanted[path.name] = records
    for name, text in {"empty.json": "", "none.json": '{"meta": {}}', "no.json": '{"results": []}', "odd.json": '{"results": [1, "x", null, [{"in": 1}]]}'}.items():
        (tmp_path / name).write_text(text)
    cut = '{"results": [{"id": 1}, {"id": "cu'
    (tmp_path / "cut.json").write_text(cut)
    wanted["cut.json"] = [{"id": 1}]
    found = {}
    for r in envelopes.record_texts(spark, str(tmp_path), "*.json", chunk).orderBy("path", "offset").collect():
        found.setdefault(r["path"].rsplit("/", 1)[1], []).append(json.loads(r["text"]))
    assert found == wanted


def test_one_large_file_is_many_tasks(spark, tmp_path):
    record = {"id": 1, "text": "x" * 1000}
    (tmp_path / "one.json").write_text(json.dumps({"results": [record | {"id": i} for i in range(2000)]}))
    texts = envelopes.record_texts(spark, str(tmp_path), chunk_bytes=1 << 16)
    tasks = {r[0] for r in texts.select(F.spark_partition_id()).collect()}
    assert texts.count() == 2000 and len(tasks) >= 30
    assert texts.select("offset").distinct().count() == 2000


def test_split_layout_loads_what_the_envelope_layout_loads(spark, tmp_path):
    write_exports(tmp_path)
    for feed, name in (("device_event", "device_event"), ("submission", "submission")):
        whole = exports.load_feed(spark, str(tmp_path), feed)[name]
        split = exports.load_feed(spark, str(tmp_path), feed, layout="split")[name]
        # ids and positions depend on the layout, the rows do not
        own = [c for c in whole.accepted.columns if c not in ("event_id", "id", "submission_id", exports.FILE, exports.POSITION)]
        rows = lambda df: sorted((tuple(r) for r in df.select(*own).collect()), key=repr)
        assert rows(split.accepted) == rows(whole.accepted)
        assert split.rejected.count() == whole.rejected.count()


# --- loads into existing tables -----------------------------------------------------------------

ROWS = "key string, at int, value string"


def stored(spark, root):
    return increments.StoredTable(spark, str(root), ["key"], ["at"])


def test_two_loads_equal_one_and_a_second_run_changes_nothing(spark, tmp_path, rows):
    rng = random.Random(1)
    all_rows = [(rng.choice([None, *(f"k{i}" for i in range(60))]), i, f"v{i}") for i in range(400)]
    frame = spark.createDataFrame(all_rows, ROWS)
    one = stored(spark, tmp_path / "one")
    one.load(frame, "all")
    two = stored(spark, tmp_path / "two")
    two.load(frame.filter("at < 150"), "first")
    accepted, rejected = two.load(frame.filter("at >= 150"), "second")
    assert rows(two.read()) == rows(one.read())
    assert accepted.count() + rejected.count() == 250
    assert {r[0][0] for r in rejected.select(REASONS).collect()} <= {"stored key", "duplicate key"}
    before = two.version()
    again = two.load(frame.filter("at >= 150"), "second")
    assert two.version() == before and before.number == 2 and before.loads == ("first", "second")
    assert rows(again.accepted) == rows(accepted) and again.rejected.count() == 0
    assert two.load(frame.limit(0), "nothing").accepted.count() == 0 and rows(two.read()) == rows(one.read())


def test_filter_has_no_false_negatives_and_leaves_most_others_out(spark, tmp_path):
    store = stored(spark, tmp_path)
    frame = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").cast("int").alias("at"), F.lit("v").alias("value"))
    store.load(frame.filter("at < 1000"), "first")
    possible = store._may_be_stored(frame, store.version())
    assert possible.filter(F.substring("key", 2, 9).cast("int") < 1000).count() == 1000 and possible.count() < 1010


def test_a_failed_load_leaves_no_trace_and_versions_do_not_collide(spark, tmp_path, monkeypatch, rows):
    store, frame = stored(spark, tmp_path), spark.createDataFrame([("a", 1, "x")], ROWS)
    monkeypatch.setattr(store, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        store.load(frame, "first")
    monkeypatch.undo()
    assert store.read() is None
    late = store.version()
    store.load(frame, "first")
    with pytest.raises(increments.ConcurrentLoad):
        store._commit(late, "rows/x", "words/x", "other", frame.schema)
    assert rows(store.read()) == [("a", 1, "x")]
    with pytest.raises(ValueError, match="columns"):
        store.load(frame.withColumn("more", F.lit(1)), "second")


def test_children_follow_their_parents_at_any_depth(spark, tmp_path, rows):
    nothing = spark.createDataFrame([], "at int").withColumn(REASONS, F.array().cast("array<string>"))

    def tables(first, events):
        event = spark.createDataFrame([(f"e{i}-{first}", k, i) for i, k in enumerate(events)], "event_id string, report string, at int")
        patient = event.select(F.concat("event_id", F.lit("p")).alias("patient_id"), "event_id", "at")
        problem = patient.select(F.concat("patient_id", F.lit("q")).alias("problem_id"), "patient_id", "at")
        return {"problem": Split(problem, nothing), "patient": Split(patient, nothing), "event": Split(event, nothing)}

    keys = {"event": ["report"], "patient": ["patient_id"], "problem": ["problem_id"]}
    parents = {"patient": ("event", "event_id"), "problem": ("patient", "patient_id")}
    root = str(tmp_path / "store")
    increments.append_load(tables("a", ["r1", "r2"]), root, "a", keys, ["at"], parents)
    for _ in range(2):
        increments.append_load(tables("b", ["r2", "r3"]), root, "b", keys, ["at"], parents)
    problems = increments.StoredTable(spark, f"{root}/problem", ["problem_id"], ["at"]).read()
    assert rows(problems, "problem_id") == [("e0-apq",), ("e1-apq",), ("e1-bpq",)]


def test_sampled_catalogue_with_grandchildren(spark, tmp_path):
    event = spark.range(500).select(F.col("id").alias("event_id"))
    patient = event.select((F.col("event_id") * 10).alias("patient_id"), "event_id")
    problem = patient.select((F.col("patient_id") * 10).alias("problem_id"), "patient_id")
    parents = {"patient": ("event", "event_id"), "problem": ("patient", "patient_id")}
    catalog.write_sampled_catalog({"problem": problem, "patient": patient, "event": event}, str(tmp_path), parents)
    kept = {n: {r[0] for r in spark.read.parquet(f"{tmp_path}/{n}").select(c).collect()} for n, c in (("event", "event_id"), ("patient", "event_id"), ("problem", "patient_id"))}
    assert 20 < len(kept["event"]) < 90 and kept["patient"] == kept["event"] and kept["problem"] == {e * 10 for e in kept["event"]}
    with pytest.raises(ValueError, match="parents"):
        catalog.parents_first(["a", "b"], {"a": ("b", "k"), "b": ("a", "k")})


def test_envelopes_are_as_many_as_the_rows_need(spark, tmp_path, monkeypatch):
    from devigil.plans import check_ingest, registry

    registry.load_all()
    rows = [(i, f"{i} [{{\"" + "x" * 2000, "en", "one", 2010) for i in range(3000)]
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    documents = spark.createDataFrame(rows, columns)
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    folder = str(tmp_path / "envelopes")
    monkeypatch.setattr(check_ingest, "_shared_folder", lambda t, name: folder)
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "16k")
    try:
        found = registry.QUERIES["ing3_split_envelopes"](spark, str(tmp_path))
        assert sorted(tuple(r) for r in found.collect()) == rows
    finally:
        spark.conf.unset(setting)
    held = spark.read.text(folder).filter("length(value) > 1000")
    per_file = held.groupBy(F.input_file_name()).count().collect()
    assert len(per_file) > 1 and max(r["count"] for r in per_file) < 2000
