import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from devigil.operators import models as M
from devigil.operators.features import FeatureSpec, prepare, split_by_hash
from devigil.operators.text_components import fit_components
from devigil.operators.metrics import binary_metrics, multilabel_metrics
from devigil.operators.sampling import sample_percent_column
from devigil.operators.vectors import tfidf
from devigil.session import ensure_checkpoint_dir

SPEC = FeatureSpec(
    categorical=("product_code", "event_type"), text="device_name", numeric=("num_events",),
    components=5,
)


@pytest.fixture(scope="module")
def facts(spark):
    names = ["infusion pump", "heart valve", "hip implant", "glucose meter", "pump set"]
    rows = [
        (f"{i}", names[i % 5], f"P{i % 3}", ["death", "injury", None][i % 3], str(i % 7),
         int(i % 5 in (0, 4)), int(i % 3 == 0))
        for i in range(200)
    ]
    return spark.createDataFrame(
        rows, "id string, device_name string, product_code string, event_type string, "
        "num_events string, recall int, death int"
    ).cache()


def test_binary_model_learns_saves_and_scores(spark, facts, tmp_path):
    trained = M.train_binary(facts, "recall", "id", SPEC, M.booster("recall", "features", 5))
    metrics = trained.metrics.first()
    assert metrics.accuracy > 0.9 and metrics.f1 > 0.9
    trained.save(str(tmp_path))
    model, stored = M.load(spark, str(tmp_path), SPEC)
    assert stored.first() == metrics
    scores = M.score_devices(model, facts, SPEC).collect()
    by_name = {r.device_name: r.recall_probability for r in scores}
    assert by_name["infusion pump"] > 0.5 > by_name["heart valve"]
    unseen = facts.limit(1).withColumns(
        {"product_code": F.lit("never seen"), "num_events": F.lit("many")}
    )
    assert M.score_devices(model, unseen, SPEC).count() == 1
    assert M.score_devices(model, facts.limit(0), SPEC).isEmpty()
    top = M.importances(model.stages[-1], trained.predictions).collect()
    assert len(top) == 5 and top[0].weight >= top[-1].weight


def test_training_lands_keys_of_held_out_rows_only(spark, facts):
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.glob("training-*"))
    trained = M.train_binary(facts, "recall", "id", SPEC, M.booster("recall", "features", 2))
    (landed,) = set(folder.glob("training-*")) - before
    rows = spark.read.parquet(f"{landed}/rows")
    train, test = ({r.id for r in side.collect()} for side in split_by_hash(facts, "id", 0.8, M.SEED))
    assert rows.count() == 200 and {r.id for r in rows.filter("_train").collect()} == {None}
    assert {r.id for r in rows.filter("not _train").collect()} == test
    assert {r.id for r in trained.predictions.collect()} == test and train | test == {f"{i}" for i in range(200)}


def test_equal_classifications_meet_counts_once(spark):
    events = spark.createDataFrame([(f"{i}",) for i in range(6)], "event_id string")
    devices = spark.createDataFrame(
        [(f"{i}", ["Pump", "valve", "stent"][i % 3], "death", "7", None, None, None) for i in range(6)],
        "event_id string, openfda_device_name string, event_type string, openfda_regulation_number string, "
        "manufacturer_d_name string, device_report_product_code string, model_number string",
    )
    classes = spark.createDataFrame(
        [("PUMP", "A", "1", "7", "2")] * 50 + [("PUMP", "B", "1", "7", "1"), ("VALVE", "A", "2", "7", "3")],
        "device_name string, product_code string, device_class string, regulation_number string, "
        "submission_type_id string",
    )
    recalls = spark.createDataFrame([("pump",)], "openfda_device_name string")
    found = M.device_features(events, devices, classes)
    got = {(r.device_name, r.product_code, r.num_events) for r in found.collect()}
    assert got == {("Pump", "A", 100), ("Pump", "B", 2), ("valve", "A", 2), ("stent", None, 2)}
    facts = M.event_facts(events, devices)
    features = M.recall_features(facts, classes, recalls)
    got = {(r.device_name, r.product_code, r.recall, r.num_events) for r in features.collect()}
    assert got == {("PUMP", "A", 1, 50), ("PUMP", "B", 1, 1), ("VALVE", "A", 0, 1)}
    for frame in (found, features):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "copies" in plan


def test_multilabel_model_gives_the_likeliest_type(facts):
    spec = FeatureSpec(text="device_name", components=4)
    trained = M.train_multilabel(facts, ["death", "recall"], "id", spec, rounds=3)
    assert {r.target for r in trained.metrics.collect()} == {"death", "recall"}
    rows = M.score_event_types(trained.model, facts, ["death", "recall"], spec).collect()
    by_name = {r.device_name: r.event_type for r in rows}
    assert len(rows) == 5 and by_name["infusion pump"] == "recall"


def test_equal_inputs_are_trained_on_and_scored_once(facts):
    spec = FeatureSpec(text="device_name", numeric=("num_events",), components=4)
    flat = M.logistic_baseline("recall").setRegParam(0.1).setStandardization(False)
    trained = M.train_binary(facts, "recall", "id", spec, flat)
    train, test = split_by_hash(facts, "id")
    fitted = trained.model.stages[-1]
    different = train.select("device_name", "num_events", "recall").distinct()
    assert fitted.summary.predictions.count() == different.count() < train.count()
    assert trained.predictions.count() == test.count()
    # the weighted fit is that of all rows
    every = trained.model.features.transform(prepare(train, spec))
    whole = flat.fit(every)
    assert np.allclose(whole.coefficients.toArray(), fitted.coefficients.toArray(), atol=1e-3)
    expected = whole.transform(trained.model.features.transform(prepare(test, spec)))
    rows = {r.id: r.p for r in expected.select("id", M.positive().alias("p")).collect()}
    found = trained.predictions.select("id", M.positive().alias("p")).collect()
    assert all(abs(rows[r.id] - r.p) < 1e-3 for r in found)


def test_missing_categories_are_their_own_and_numbers_default_to_zero(facts):
    rows = prepare(facts, SPEC).filter("id in ('2', '3')").orderBy("id").collect()
    assert rows[0].event_type == "__missing__" and rows[1].num_events == 3.0


def products(rows):
    """Centered inner products of sparse rows ``{key: {term: weight}}``, by pairs of keys."""
    terms = sorted({t for v in rows.values() for t in v})
    dense = np.array([[v.get(t, 0.0) for t in terms] for v in rows.values()])
    dense -= dense.mean(0)
    return dict(zip([(a, b) for a in rows for b in rows], (dense @ dense.T).ravel()))


def test_components_keep_the_products_of_all_terms(spark):
    # more than 10,000 distinct terms, each in one text only but for two
    rng = random.Random(1)
    texts = [f"shared{i % 2} " + " ".join(f"t{i}x{j}" for j in range(rng.randrange(250, 270))) for i in range(42)]
    df = spark.createDataFrame([(t,) for t in texts], "name string")
    model = fit_components(df, "name", 500)
    assert model.idf.count() > 10_000 and model.loadings.count() == model.idf.count()
    weights = {}
    for r in tfidf(df, "name", "name").collect():
        weights.setdefault(r.name, {})[r.term] = r.weight
    scores = {r.text: np.array(r.score) for r in model.scores(df, "name").collect()}
    center = np.mean(list(scores.values()), axis=0)
    assert np.allclose(center, model.center) and model.size == 41
    for (a, b), product in products(weights).items():
        assert abs((scores[a] - center) @ (scores[b] - center) - product) < 1e-6
    # a rare term alone decides what is near
    rare = spark.createDataFrame([("t7x3",), ("nothing known",)], "name string")
    found = {r.name: r.v.toArray() for r in model.transform(rare, "name", "v").collect()}
    near = max(scores, key=lambda t: found["t7x3"] @ (scores[t] - center))
    assert near == texts[7] and np.allclose(found["nothing known"], -np.array(model.center))


def test_few_components_are_the_principal_ones(spark):
    rng = random.Random(2)
    texts = [" ".join(f"w{int(rng.paretovariate(1))}" for _ in range(12)) for _ in range(80)]
    df = spark.createDataFrame([(t,) for t in texts], "name string")
    model = fit_components(df, "name", 3)
    rows = {r.name: {} for r in df.collect()}
    for r in tfidf(df.distinct(), "name", "name").collect():
        rows[r.name][r.term] = r.weight
    terms = sorted({t for v in rows.values() for t in v})
    dense = np.array([[v.get(t, 0.0) for t in terms] for v in rows.values()])
    exact = np.linalg.svd(dense - dense.mean(0), compute_uv=False)[:3]
    score = np.array([r.score for r in model.scores(df, "name").collect()])
    assert np.allclose(np.sqrt(((score - score.mean(0)) ** 2).sum(0)), exact, rtol=0.05)


def test_hash_split_ignores_partitioning(facts):
    ids = [
        sorted(r.id for r in split_by_hash(df, "id")[0].collect())
        for df in (facts, facts.repartition(7))
    ]
    assert ids[0] == ids[1] and 130 < len(ids[0]) < 190


def test_recall_features_flag_and_count(spark):
    facts = spark.createDataFrame(
        [("m1", "death", "p", "r", "x", "ACME Pump, Inc"), ("m2", "death", "p", "r", "x", "acme pump"),
         ("m3", "injury", "p", "r", "x", None)],
        "manufacturer_d_name string, event_type string, device_report_product_code string, "
        "openfda_regulation_number string, model_number string, openfda_device_name string",
    )
    classes = spark.createDataFrame(
        [("Acme Pump", "FRN", "2", "880", "1"), (None, "X", "1", "1", "2")],
        "device_name string, product_code string, device_class string, regulation_number string, "
        "submission_type_id string",
    )
    recalls = spark.createDataFrame([("ACME PUMP",), ("acme pump inc",)], "openfda_device_name string")
    rows = M.recall_features(facts, classes, recalls).collect()
    assert [r.asDict() for r in rows] == [
        {"device_name": "Acme Pump", "product_code": "FRN", "event_type": "death",
         "device_class": "2", "regulation_number": "880", "pma_approval": 0, "510k_approval": 1,
         "recall": 1, "num_events": 2}
    ]


def test_kmeans_labels_both_sides(facts):
    model, labelled = M.kmeans_names(facts, "device_name", k=3)
    assert M.cluster_number(100) == 75 and M.cluster_number(10**6) == 1000
    both = {r.device_name: r.cluster for r in labelled.collect()}
    again = model.transform(facts.select("device_name")).distinct()
    assert {r.device_name: r.cluster for r in again.collect()} == both
    assert "reduced_component_y" in M.project_2d(labelled, "name_vector").columns


def test_kmeans_sizes_count_equal_inputs_by_weight(spark, monkeypatch):
    held = {("heart valve", 0): 90, ("hip implant", 1000): 30, ("pump set", 5000): 7, (None, 5000): 3}
    rows = [(i, n, e) for (n, e), many in held.items() for i in range(many)]
    df = spark.createDataFrame(rows, "id int, name string, events int")
    spec = FeatureSpec(text="name", numeric=("events",), components=2)
    seen, fitted = [], M.kmeans
    monkeypatch.setattr(M, "kmeans", lambda rows, *a, **k: seen.append(rows.count()) or fitted(rows, *a, **k))
    sizes = sorted(r["size"] for r in M.kmeans_sizes(df, spec, 3).collect())
    assert sizes == [10, 30, 90] and seen == [4]
    counted = df.groupBy("name").agg(F.count(F.lit(1)).alias("many"))
    one, two = fit_components(df.na.fill(""), "name", 2), fit_components(counted.na.fill(""), "name", 2, copies="many")
    assert np.allclose(np.abs(one.center), np.abs(two.center))


def test_metrics_without_rows_or_positives(spark):
    none = spark.createDataFrame([], "y double, p double")
    assert binary_metrics(none, "y", "p").collect() == [(0.0, 0.0)]
    negative = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0)], "y double, p double")
    assert multilabel_metrics(negative, {"t": ("y", "p")}).collect() == [("t", 0.5, 0.0, 0, 0.0)]
    assert multilabel_metrics(none, {"t": ("y", "p")}).collect() == [("t", 0.0, 0.0, 0, 0.0)]
    assert none.agg(sample_percent_column(F.count(F.lit(1)))).first()[0] == 100.0
