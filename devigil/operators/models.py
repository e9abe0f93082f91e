"""Recall-probability and event-type classifiers, baselines, name clusters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devigil.functions.text import company_key
from devigil.operators.features import (
    FeatureModel,
    FeatureSpec,
    fit_features,
    in_training,
    prepare,
)
from devigil.operators.harmonize import approval_flags, join_events
from devigil.operators.metrics import binary_metrics, multilabel_metrics
from devigil.landing import Landing
from devigil.session import cut_lineage

SEED = 62
ROUNDS = 50
RECALL_KEYS = (
    "device_name",
    "product_code",
    "event_type",
    "device_class",
    "regulation_number",
    "pma_approval",
    "510k_approval",
    "recall",
)
RECALL_FEATURES = FeatureSpec(
    categorical=("product_code", "event_type", "device_class", "regulation_number"),
    text="device_name",
    numeric=("pma_approval", "510k_approval", "num_events"),
)
EVENT_FEATURES = FeatureSpec(text="device_name")


# --- training data ------------------------------------------------------------------------------


def event_facts(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Distinct device facts of typed events."""
    return (
        join_events(events, devices)
        .filter(F.col("event_type").isNotNull())
        .select(
            "manufacturer_d_name",
            "event_type",
            "device_report_product_code",
            "openfda_regulation_number",
            "model_number",
            "openfda_device_name",
        )
        .distinct()
    )


def recall_counts(recalls: DataFrame, name: str = "openfda_device_name") -> DataFrame:
    return recalls.groupBy(name).agg(F.count(F.lit(1)).alias("recall_count"))


def recall_features(
    facts: DataFrame, classification: DataFrame, recalls: DataFrame
) -> DataFrame:
    """Event counts per classified device with approval flags and a recall flag.

    Names are compared in cleaned form and empty ones never join. Facts are counted per name and
    event type first: everything else comes from the other two tables, so those small counts are
    what the joins move, however often a name occurs.
    """
    counts = (
        facts.select(company_key(F.col("openfda_device_name")).alias("key"), "event_type")
        .filter("key <> ''")
        .groupBy("key", "event_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    classes = classification.select(
        company_key(F.col("device_name")).alias("key"),
        "device_name",
        "product_code",
        "device_class",
        "regulation_number",
        "submission_type_id",
    ).filter("key <> ''")
    # equal classifications of a name meet its counts once
    classes = classes.groupBy(*classes.columns).agg(F.count(F.lit(1)).alias("copies"))
    per_name = (
        recall_counts(recalls)
        .select(company_key(F.col("openfda_device_name")).alias("key"), "recall_count")
        .groupBy("key")
        .agg(F.sum("recall_count").alias("recall_count"))
    )
    merged = (
        counts.join(classes, "key", "left")
        .withColumns(approval_flags(F.col("submission_type_id")))
        .join(per_name.filter("key <> ''"), "key", "left")
        .withColumn("recall", (F.coalesce("recall_count", F.lit(0)) > 0).cast("int"))
    )
    return (
        merged.dropna(subset=list(RECALL_KEYS))
        .groupBy(*RECALL_KEYS)
        .agg(F.sum(F.col("n") * F.col("copies")).alias("num_events"))
    )


def device_features(
    events: DataFrame, devices: DataFrame, classification: DataFrame
) -> DataFrame:
    """What the recall model is asked about: the same columns for every device with events.

    Counted per name, event type and regulation before the classification comes in.
    """
    counts = (
        join_events(events, devices)
        .groupBy("openfda_device_name", "event_type", "openfda_regulation_number")
        .agg(F.count("event_id").alias("n"))
    )
    classes = classification.select(
        F.lower("device_name").alias("key"), "product_code", "device_class", "submission_type_id"
    )
    classes = classes.groupBy(*classes.columns).agg(F.count(F.lit(1)).alias("copies"))
    joined = counts.join(classes, F.lower("openfda_device_name") == F.col("key"), "left")
    return (
        joined.withColumns(approval_flags(F.col("submission_type_id")))
        .groupBy(
            F.col("openfda_device_name").alias("device_name"),
            "product_code",
            "event_type",
            "device_class",
            F.col("openfda_regulation_number").alias("regulation_number"),
            "pma_approval",
            "510k_approval",
        )
        .agg(F.sum(F.col("n") * F.coalesce("copies", F.lit(1))).alias("num_events"))
    )


def candidate_devices(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Names of devices with at least one typed event."""
    typed = events.filter(F.col("event_type").isNotNull()).select("event_id")
    return (
        devices.join(typed, "event_id", "left_semi")
        .select(F.col("openfda_device_name").alias("device_name"))
        .distinct()
    )


def prediction_summary(features: DataFrame) -> DataFrame:
    keys = ["product_code", "device_class", "regulation_number", "pma_approval", "510k_approval"]
    return (
        features.dropna(subset=keys).groupBy(*keys).agg(F.sum("num_events").alias("total_events"))
    )


# --- classifiers --------------------------------------------------------------------------------


def booster(label: str, features: str, rounds: int = ROUNDS, suffix: str = "") -> GBTClassifier:
    trees = GBTClassifier(
        labelCol=label,
        featuresCol=features,
        predictionCol=f"prediction{suffix}",
        maxIter=rounds,
        maxDepth=5,
        stepSize=0.3,
        seed=SEED,
    )
    return trees.setProbabilityCol(f"probability{suffix}").setRawPredictionCol(f"raw{suffix}")


@dataclass
class Scorer:
    """Fitted features and the classifiers over them."""

    features: FeatureModel
    classifiers: PipelineModel

    @property
    def stages(self) -> list:
        return self.classifiers.stages

    def transform(self, df: DataFrame) -> DataFrame:
        return self.classifiers.transform(self.features.transform(df))

    def save(self, path: str) -> None:
        self.features.save(f"{path}/features")
        self.classifiers.write().overwrite().save(f"{path}/classifiers")

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: FeatureSpec) -> Scorer:
        features = FeatureModel.load(spark, f"{path}/features", spec)
        return cls(features, PipelineModel.load(f"{path}/classifiers"))


@dataclass
class Trained:
    """A fitted model, its held-out predictions and the metrics over them."""

    model: Scorer
    predictions: DataFrame
    metrics: DataFrame

    def save(self, path: str) -> None:
        self.model.save(f"{path}/model")
        self.metrics.write.mode("overwrite").parquet(f"{path}/metrics")


def load(spark: SparkSession, path: str, spec: FeatureSpec) -> tuple[Scorer, DataFrame]:
    return Scorer.load(spark, f"{path}/model", spec), spark.read.parquet(f"{path}/metrics")


def _inputs(spec: FeatureSpec) -> list[str]:
    return [*spec.categorical, *spec.numeric, *([spec.text] if spec.text else [])]


def _fit_rows(
    df: DataFrame, labels: Sequence[str], key: str, spec: FeatureSpec, train_share: float
) -> tuple[FeatureModel, DataFrame, DataFrame, DataFrame]:
    """The fitted features, the training rows, the held-out rows and the held-out inputs.

    Rows with equal inputs have equal features, whatever their keys. Training rows that agree in the
    labels as well are one row with its number as ``copies``, a weight that gives the same fit; held-out
    inputs are scored once each. So vectors exist for different inputs only. Keys are kept for held-out rows,
    which are asked for by them.
    """
    inputs = _inputs(spec)
    doubles = [F.col(f"`{c}`").cast("double").alias(c) for c in labels]
    store = Landing(df.sparkSession, "training", release=True)
    source = prepare(df, spec).select(key, *doubles, *inputs)
    source = source.withColumn("_train", in_training(F.col(key), train_share, SEED))
    kept_key = F.when(~F.col("_train"), F.col(key)).alias(key)
    columns = [f"`{c}`" for c in source.columns if c != key]
    source = store.land(source.select(kept_key, *columns), "rows")
    features, _ = fit_features(source, spec)
    train = source.filter("_train")
    test = source.filter("not _train").drop("_train")
    counted = train.groupBy(*inputs, *[f"`{c}`" for c in labels])
    counted = counted.agg(F.count(F.lit(1)).cast("double").alias("copies"))
    rows = features.transform(cut_lineage(counted))
    rows = cut_lineage(rows.select(*[f"`{c}`" for c in labels], "copies", spec.output))
    asked = features.transform(cut_lineage(test.select(*inputs).distinct()))
    return features, rows, test, cut_lineage(asked.select(*inputs, spec.output))


def train_binary(
    df: DataFrame,
    label: str,
    key: str,
    spec: FeatureSpec,
    estimator=None,
    train_share: float = 0.8,
) -> Trained:
    """Fit features and one classifier (boosted trees unless given), score the held-out rows.

    Every stage of a fit passes over its input, so the input is written out once.
    """
    features, rows, test, asked = _fit_rows(df, [label], key, spec, train_share)
    classifier = (estimator or booster(label, spec.output)).copy()
    if classifier.hasParam("weightCol"):
        classifier.setWeightCol("copies")
    else:
        rows = rows.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    model = classifier.fit(rows)
    scored = cut_lineage(model.transform(asked))
    predictions = test.join(scored, _inputs(spec))
    return Trained(
        Scorer(features, PipelineModel([model])),
        predictions,
        binary_metrics(predictions, label, "prediction"),
    )


def train_multilabel(
    df: DataFrame, targets: Sequence[str], key: str, spec: FeatureSpec, rounds: int = ROUNDS
) -> Trained:
    """One booster per 0/1 target column over the same, once computed, features.

    A booster is many short jobs, one after the other, so the targets are fitted side by side.
    """
    features, rows, test, asked = _fit_rows(df, targets, key, spec, 0.8)
    rows.persist()

    def fitted(target: str):
        return booster(target, spec.output, rounds, f"_{target}").setWeightCol("copies").fit(rows)

    with ThreadPool(len(targets)) as pool:
        models = pool.map(inheritable_thread_target(df.sparkSession)(fitted), targets)
    rows.unpersist()
    scored = asked
    for model in models:
        scored = model.transform(scored)
    predictions = test.join(cut_lineage(scored), _inputs(spec))
    pairs = {t: (t, f"prediction_{t}") for t in targets}
    return Trained(
        Scorer(features, PipelineModel(models)), predictions, multilabel_metrics(predictions, pairs)
    )


def logistic_baseline(label: str, features: str = "features") -> LogisticRegression:
    return LogisticRegression(labelCol=label, featuresCol=features)


def positive(probability: str = "probability") -> Column:
    return vector_to_array(F.col(probability))[1]


def score_devices(model: Scorer, features: DataFrame, spec: FeatureSpec) -> DataFrame:
    """``device_name, recall_probability`` for all devices at once: the worst case over their rows."""
    scored = model.transform(prepare(features, spec))
    return scored.groupBy(spec.text).agg(F.max(positive()).alias("recall_probability"))


def score_event_types(
    model: Scorer, devices: DataFrame, targets: Sequence[str], spec: FeatureSpec
) -> DataFrame:
    """The probability of every event type and the likeliest one, per distinct device name."""
    names = prepare(devices, spec).select(spec.text).distinct()
    scored = model.transform(names).select(
        spec.text, *[positive(f"probability_{t}").alias(t) for t in targets]
    )
    best = F.greatest(*[F.col(f"`{t}`") for t in targets]) if len(targets) > 1 else F.col(targets[0])
    likeliest = F.coalesce(*[F.when(F.col(f"`{t}`") == best, F.lit(t)) for t in targets])
    return scored.withColumn("event_type", likeliest)


def importances(model, rows: DataFrame, features: str = "features", n: int = 5) -> DataFrame:
    """The ``n`` features with the largest weight; names come from the vector's metadata."""
    weights = (
        model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
    ).toArray()
    attributes = rows.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a.get("name", "") for group in attributes.values() for a in group}
    table = [(i, names.get(i, f"{features}_{i}"), float(w)) for i, w in enumerate(weights)]
    return (
        rows.sparkSession.createDataFrame(table, "position int, feature string, weight double")
        .orderBy(F.desc("weight"), "position")
        .limit(n)
    )


# --- clusters -----------------------------------------------------------------------------------


def cluster_number(n: int, most: int = 1000) -> int:
    return max(2, int(min(most, n * 0.75)))


def kmeans_names(
    names: DataFrame, column: str, k: int | None = None, components: int = 500, seed: int = 52
) -> tuple[Scorer, DataFrame]:
    """Clusters of distinct names over the components of their TF-IDF; ``transform`` of the model
    labels other frames."""
    spec = FeatureSpec(text=column, components=components, output="name_vector")
    distinct = cut_lineage(prepare(names.select(column), spec).distinct())
    features, rows = fit_features(distinct, spec)
    rows = cut_lineage(rows.select(column, spec.output))
    model = kmeans(rows, spec.output, k or cluster_number(distinct.count()), seed)
    return Scorer(features, PipelineModel([model])), model.transform(rows)


def kmeans(
    rows: DataFrame, features: str, k: int = 10, seed: int = 52, copies: str | None = None
) -> KMeansModel:
    """``copies`` names a column with the number of rows that a row stands for."""
    estimator = KMeans(featuresCol=features, predictionCol="cluster", k=k, seed=seed)
    return (estimator.setWeightCol(copies) if copies else estimator).fit(rows)


def kmeans_sizes(df: DataFrame, spec: FeatureSpec, k: int = 10) -> DataFrame:
    """``cluster, size``: rows of ``df`` clustered by features of texts and numbers.

    Rows with equal inputs have equal features. They are one row with its number as ``copies``, a weight
    of the components and of the means, so vectors exist for different inputs only.
    """
    counted = prepare(df, spec).groupBy(*_inputs(spec)).agg(F.count(F.lit(1)).alias("copies"))
    rows = fit_features(cut_lineage(counted), spec, "copies")[1]
    # every pass of k-means reads the vectors
    rows = cut_lineage(rows.select("copies", spec.output))
    labelled = kmeans(rows, spec.output, k, copies="copies").transform(rows)
    return labelled.groupBy("cluster").agg(F.sum("copies").alias("size"))


def project_2d(rows: DataFrame, features: str) -> DataFrame:
    """Two principal components for a scatter of clustered vectors."""
    model = PCA(k=2, inputCol=features, outputCol="_reduced").fit(rows)
    at = vector_to_array(F.col("_reduced"))
    return (
        model.transform(rows)
        .withColumns({"reduced_component_x": at[0], "reduced_component_y": at[1]})
        .drop("_reduced")
    )


