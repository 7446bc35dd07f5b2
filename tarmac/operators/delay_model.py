"""Arrival-delay model on ``pyspark.ml``: training, contract check, scoring."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.requests import (
    CARRIER_PATTERN, CATEGORICAL_FEATURES, FEATURE_ORDER, NUMERIC_FEATURES, TARGET, feature_matrix, hydrate,
)

# Training defaults.
TREES = 400
LEARNING_RATE = 0.05
VALIDATION_PERCENT = 20
MIN_ROWS_PER_LEAF = 40
SEED = 42
# Boosting ends once so many rounds have passed without a lower validation error.
PATIENCE = 25
# Rows that one task passes over at each level of each tree.
ROWS_PER_TASK = 50_000


@dataclass(frozen=True)
class DelayModel:
    pipeline: PipelineModel
    metadata: dict[str, Any]


def training_rows(silver: DataFrame) -> DataFrame:
    """Features and target of flights that arrived, with their key for splitting."""
    arrived = silver.filter(
        F.col(TARGET).isNotNull() & F.col("scheduled_dep_ts").isNotNull()
        & F.col("distance_miles").isNotNull()
    )
    return feature_matrix(arrived, "flight_event_natural_key", TARGET)


def split(rows: DataFrame, key: str, seed: int = SEED, percent: int = VALIDATION_PERCENT) -> DataFrame:
    """Adds ``is_validation``. It depends on key and seed only, not on partitioning."""
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return rows.withColumn("is_validation", place < percent)


def kept_rounds(curve: Sequence[float], patience: int = PATIENCE) -> int:
    """Rounds up to the best one that is seen before ``patience`` rounds bring no lower error."""
    best = 0
    for i, error in enumerate(curve):
        if error < curve[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1 if curve else 0


def first_trees(model: GBTRegressionModel, count: int) -> GBTRegressionModel:
    """The ensemble of the first ``count`` rounds."""
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, count)
    weights = gateway.new_array(gateway.jvm.double, count)
    all_trees, all_weights = java.trees(), java.treeWeights()
    for i in range(count):
        trees[i], weights[i] = all_trees[i], all_weights[i]
    cut = gateway.jvm.org.apache.spark.ml.regression.GBTRegressionModel(java.uid(), trees, weights)
    return GBTRegressionModel(java.copyValues(cut, java.extractParamMap()))


def train(
    rows: DataFrame, trained_at: dt.datetime, trees: int = TREES,
    learning_rate: float = LEARNING_RATE, depth: int = 6, max_categories: int = 1024,
    seed: int = SEED, patience: int = PATIENCE,
) -> DelayModel:
    """Boosted trees on absolute error, as many rounds as lower the validation error.

    ``rows`` come from ``split``. Codes never seen in training share one extra category. Spark's own
    early stop has no patience, so all rounds are trained; then one pass over the validation rows
    gives the error after each round, and the ensemble is cut at the round that boosting with
    ``patience`` rounds would have kept. Without validation rows all are kept. The metadata hold
    the errors, and that of the training rows' median for comparison.
    """
    indexed = [f"{c}_index" for c in CATEGORICAL_FEATURES]
    n_rows = rows.count()
    # Boosting passes over the rows once per tree level; cached blocks that are lost with an
    # executor are computed again from the plan. Few rows in many tasks would cost more than the rows.
    rows = rows.repartition(-(-n_rows // ROWS_PER_TASK) or 1, "is_validation", *FEATURE_ORDER).persist()
    try:
        training, validation = rows.filter("not is_validation"), rows.filter("is_validation")
        prepared = Pipeline(stages=[
            StringIndexer(inputCols=CATEGORICAL_FEATURES, outputCols=indexed, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            VectorAssembler(inputCols=indexed + NUMERIC_FEATURES, outputCol="features"),
        ]).fit(training)  # codes of training rows only
        boosted = GBTRegressor(
            labelCol=TARGET, featuresCol="features", predictionCol="prediction",
            lossType="absolute", maxIter=trees, stepSize=learning_rate, maxDepth=depth,
            minInstancesPerNode=MIN_ROWS_PER_LEAF, maxBins=max_categories, seed=seed,
        ).fit(prepared.transform(training))
        curve = []
        if not validation.isEmpty():
            curve = [float(e) for e in boosted.evaluateEachIteration(prepared.transform(validation), "absolute")]
        rounds = kept_rounds(curve, patience) or trees
        median = training.agg(F.median(TARGET)).first()[0]
        constant = validation.agg(F.avg(F.abs(F.col(TARGET) - F.lit(median)))).first()[0]
    finally:
        rows.unpersist()
    return DelayModel(PipelineModel([*prepared.stages, first_trees(boosted, rounds)]), {
        "trained_at": trained_at.isoformat(),
        "n_rows": n_rows,
        "seed": seed,
        "feature_order": FEATURE_ORDER,
        "categorical_features": CATEGORICAL_FEATURES,
        "numeric_features": NUMERIC_FEATURES,
        "target": TARGET,
        "val_mae_minutes": round(curve[rounds - 1], 3) if curve else None,
        "median_mae_minutes": None if constant is None else round(constant, 3),
        "best_iteration": rounds,
        "val_mae_by_round": [round(e, 4) for e in curve],
    })


def model_mae(predictions: DataFrame, constant: float | None = None) -> DataFrame:
    """Mean absolute error of the predictions, and of ``constant`` in their place."""
    error = lambda guess: F.avg(F.abs(F.col(TARGET) - guess))
    return predictions.agg(
        error(F.col("prediction")).alias("mae_minutes"), error(F.lit(constant).cast("double")).alias("constant_mae_minutes"),
        F.count(F.lit(1)).alias("rows"))


def save(spark: SparkSession, model: DelayModel, path: str) -> None:
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    text = json.dumps(model.metadata, indent=2, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/metadata", lineSep="\u0000")


def load(spark: SparkSession, path: str) -> DelayModel:
    """A saved model; refused if its features are not the ones scoring will supply."""
    metadata = json.loads(
        spark.read.text(f"{path}/metadata", wholetext=True).first()[0].rstrip("\u0000"))
    check_contract(metadata)
    return DelayModel(PipelineModel.load(f"{path}/pipeline"), metadata)


def check_contract(metadata: dict[str, Any]) -> None:
    found = list(metadata.get("feature_order") or [])
    if found != FEATURE_ORDER:
        raise ValueError(f"feature_order mismatch: model has {found}, expected {FEATURE_ORDER}")


def score(model: DelayModel, features: DataFrame, source: str = "request") -> DataFrame:
    """Adds the predicted arrival delay in minutes, rounded to two places."""
    missing = [c for c in FEATURE_ORDER if c not in features.columns]
    if missing:
        raise ValueError(f"missing features: {missing}")
    scored = model.pipeline.transform(features)
    return scored.select(
        *features.columns,
        F.round("prediction", 2).alias("predicted_arr_delay_min"),
        F.lit(model.metadata["trained_at"]).alias("model_version"),
        F.lit(source).alias("feature_source"),
    )


def score_by_id(model: DelayModel, requests: DataFrame, silver: DataFrame) -> DataFrame:
    """Scores requests from silver features. Those silver lacks come back as ``not_found``,
    those without a proper carrier code as ``invalid``."""
    asked = hydrate(requests, silver)
    keys = list(dict.fromkeys([*requests.columns, "carrier_code", "flight_number", "flight_date"]))
    hits = score(model, asked.filter("found"), "silver").select(
        *keys, "predicted_arr_delay_min", "model_version", "feature_source",
        F.lit("ok").alias("status"))
    proper = F.coalesce(F.col("carrier_code").rlike(CARRIER_PATTERN), F.lit(False))
    misses = asked.filter(~F.col("found")).select(*keys).withColumn(
        "status", F.when(proper, "not_found").otherwise("invalid"))
    return hits.unionByName(misses, allowMissingColumns=True)
