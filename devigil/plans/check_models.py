"""Registered queries: classifiers, their scores and importances, k-means and projections.

Trained models have no SQL counterpart, so these queries carry no check; what goes into them (the
feature tables, TF-IDF, encodings, splits) and what is computed from them (metrics) is checked.
"""

from __future__ import annotations

from functools import cache

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from devigil.functions import text as X
from devigil.operators import models as M
from devigil.operators.features import FeatureSpec, fit_features, prepare
from devigil.operators.clusters import cluster_texts
from devigil.operators.harmonize import one_hot
from devigil.plans import bindings as B
from devigil.plans.check_pages import (
    CLASSES_SQL,
    DEVICE_FEATURES_SQL,
    _classes,
    _event_side,
    recall_training_rows,
)
from devigil.plans.dashboards import cluster_members, cluster_view, predictions_page
from devigil.plans.registry import Tables, query

TARGETS = ("death", "injury", "malfunction", "not provided", "other")
RECALL, EVENT = M.RECALL_FEATURES, M.EVENT_FEATURES


def _keyed(df):
    return df.withColumn("row_key", F.sha2(F.concat_ws("|", *df.columns), 256))


def _training_rows(t):
    return _keyed(recall_training_rows(t))


@cache
def _recall_model(application: str, folder: str, spark):
    t = Tables(spark, folder)
    return M.train_binary(_training_rows(t), "recall", "row_key", RECALL)


def recall_model(t):
    return _recall_model(t.spark.sparkContext.applicationId, t.folder, t.spark)


@cache
def _event_model(application: str, folder: str, spark):
    t = Tables(spark, folder)
    facts = M.event_facts(*_event_side(t))
    named = facts.select(
        X.company_key(F.col("openfda_device_name")).alias("device_name"),
        "manufacturer_d_name",
        "openfda_regulation_number",
        "model_number",
        F.when(F.col("event_type").startswith("injury"), "injury")
        .otherwise(F.col("event_type"))
        .alias("event_type"),
    )
    flags = one_hot(named, {"event_type": TARGETS})
    return M.train_multilabel(_keyed(flags), TARGETS, "row_key", EVENT)


def event_model(t):
    return _event_model(t.spark.sparkContext.applicationId, t.folder, t.spark)


@query("ml8_recall_predictions")
def _(t):
    return recall_model(t).predictions.select(
        "row_key", "recall", "prediction", M.positive().alias("probability")
    )


@query("ml8_recall_metrics")
def _(t):
    return recall_model(t).metrics


@query("ml9_event_type_metrics")
def _(t):
    return event_model(t).metrics


@query("ml10_logistic_baseline")
def _(t):
    trained = M.train_binary(
        _training_rows(t), "recall", "row_key", RECALL, M.logistic_baseline("recall"), 0.7
    )
    return trained.predictions.select(
        "row_key", "recall", "prediction", M.positive().alias("probability")
    )


@query("ml12_recall_scores")
def _(t):
    features = M.device_features(*_event_side(t), _classes(t))
    return M.score_devices(recall_model(t).model, features, RECALL)


@query("ml13_event_type_scores")
def _(t):
    devices = B.devices_of_lines(t).select(
        X.company_key(F.col("openfda_device_name")).alias("device_name")
    )
    return M.score_event_types(event_model(t).model, devices, TARGETS, EVENT)


@query("ml14_srt4_top_features")
def _(t):
    trained = recall_model(t)
    return M.importances(trained.model.stages[-1], trained.predictions)


def _names_of(part):
    return part.select(F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("name"))


NAME_VECTORS_SQL = r"""
names AS (SELECT DISTINCT lower(concat_ws(' ', p_name, p_brand, p_type)) AS name FROM part),
tokens AS (SELECT name, unnest(regexp_extract_all(name, '[\p{L}\p{N}_]{2,}')) AS term FROM names),
counts AS (SELECT name, term, count(*) AS tf FROM tokens GROUP BY 1, 2),
raw AS (SELECT name, term, tf * (ln((1 + (SELECT count(*) FROM names)) /
    (1 + count(*) OVER (PARTITION BY term))) + 1) AS w FROM counts),
unit AS (SELECT name, term, w / sqrt(sum(w * w) OVER (PARTITION BY name)) AS w FROM raw),
center AS (SELECT term, sum(w) / (SELECT count(*) FROM names) AS m FROM unit GROUP BY 1)
"""


@query(
    "ml4_text_components",
    f"""WITH {NAME_VECTORS_SQL}
SELECT name, round(sum(w * w) - 2 * sum(w * m) + (SELECT sum(m * m) FROM center), 6) AS square
FROM unit JOIN center USING (term) GROUP BY name""",
)
def _(t):
    """Squared distances from the center: all components together keep what the terms have."""
    rows = prepare(_names_of(t.part).distinct(), FeatureSpec(text="name"))
    components = fit_features(rows, FeatureSpec(text="name"))[1]
    vector = vector_to_array("name_pca")
    square = F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x)
    return components.select("name", F.round(square, 6).alias("square"))


@query("er6_kmeans_names")
def _(t):
    model, _ = M.kmeans_names(_names_of(t.part), "name")
    reported = t.lineitem.select(F.col("l_partkey").alias("p_partkey"))
    reported_parts = t.part.join(reported, "p_partkey", "left_semi")
    sides = _names_of(t.part).withColumn("side", F.lit("classified")).unionByName(
        _names_of(reported_parts).withColumn("side", F.lit("reported"))
    )
    return model.transform(sides.distinct()).select("name", "side", "cluster")


@query("er6_kmeans_recall_features")
def _(t):
    spec = FeatureSpec(text="device_name", numeric=("num_events", "pma_approval"))
    return M.kmeans_sizes(recall_training_rows(t), spec)


@query("er7_projection")
def _(t):
    _, labelled = M.kmeans_names(_names_of(t.part), "name", k=10)
    return M.project_2d(labelled, "name_vector").select(
        "name", "cluster", "reduced_component_x", "reduced_component_y"
    )


# --- the page of one device ---------------------------------------------------------------------

CHOSEN = "Blue Anvil"


def _named_clusters(t):
    """Parts with their full names and the clusters of those names."""
    parts = t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("name"))
    return parts.join(cluster_texts(parts, "p_partkey", "name"), "p_partkey")


def _page(t):
    return predictions_page(
        M.device_features(*_event_side(t), _classes(t)),
        CHOSEN,
        (recall_model(t).model, RECALL),
        (event_model(t).model, EVENT, TARGETS),
        _named_clusters(t),
        "name",
    )


@query("page3_recall_of_device")
def _(t):
    return _page(t)["recall"]


@query("page3_event_types_of_device")
def _(t):
    return _page(t)["event_types"]


@query(
    "page3_summary_of_device",
    f"""WITH {B.EVENTS_SQL}, {CLASSES_SQL}, {DEVICE_FEATURES_SQL}
SELECT product_code, device_class, regulation_number, pma_approval, "510k_approval",
  CAST(sum(num_events) AS BIGINT) AS total_events FROM device_features
WHERE lower(device_name) = lower('{CHOSEN}') AND product_code IS NOT NULL
  AND device_class IS NOT NULL AND regulation_number IS NOT NULL GROUP BY ALL""",
)
def _(t):
    features = M.device_features(*_event_side(t), _classes(t))
    return M.prediction_summary(features.filter(F.lower("device_name") == CHOSEN.lower()))


@query(
    "page3_cluster_members",
    r"""WITH named AS (
  SELECT p_partkey, concat_ws(' ', p_name, p_brand, p_type) AS name FROM part),
signed AS (SELECT *, list_sort(regexp_extract_all(lower(name), '[\p{L}\p{N}_]{2,}')) AS s FROM named),
labelled AS (SELECT p_partkey, name, min(p_partkey) OVER (PARTITION BY s) AS cluster FROM signed)
SELECT p_partkey, name, cluster FROM labelled WHERE cluster IN (SELECT cluster FROM labelled
  WHERE name = (SELECT name FROM named GROUP BY name ORDER BY count(*) DESC, name LIMIT 1))""",
)
def _(t):
    clusters = _named_clusters(t)
    counts = t.part.groupBy(F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("name")).count()
    chosen = counts.orderBy(F.desc("count"), "name").first()["name"]
    return cluster_members(clusters, "name", chosen).select("p_partkey", "name", "cluster")


@query("page3_cluster_view")
def _(t):
    return cluster_view(_named_clusters(t), "name")
