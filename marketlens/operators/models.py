"""Regression models over the training features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .accuracy import regression_metrics
from .features import TARGET

SEED = 42


def pipelines(
    features: Sequence[str], target: str = TARGET, trees: int = 100, depth: int = 15, rounds: int = 100,
    boost_depth: int = 6, seed: int = SEED,
) -> dict[str, Pipeline]:
    """Random forest, boosted trees, and linear regression on scaled features."""
    vector = VectorAssembler(inputCols=list(features), outputCol="raw")
    scale = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)
    common = {"labelCol": target, "predictionCol": "y_pred"}
    forest = RandomForestRegressor(
        featuresCol="raw", numTrees=trees, maxDepth=depth, minInstancesPerNode=2, seed=seed, **common
    )
    boost = GBTRegressor(featuresCol="raw", maxIter=rounds, maxDepth=boost_depth, stepSize=0.1, seed=seed, **common)
    linear = LinearRegression(featuresCol="scaled", **common)
    return {
        "random_forest": Pipeline(stages=[vector, forest]),
        "gradient_boosting": Pipeline(stages=[vector, boost]),
        "linear_regression": Pipeline(stages=[vector, scale, linear]),
    }


def fit_all(split: DataFrame, plans: Mapping[str, Pipeline], columns: Sequence[str]) -> dict[str, PipelineModel]:
    """Fit every model on the training rows; ``split`` should be a saved table."""
    train = split.filter("is_train").select(*columns).persist()
    try:
        return {name: plan.fit(train) for name, plan in plans.items()}
    finally:
        train.unpersist()


def evaluate_all(split: DataFrame, models: Mapping[str, PipelineModel], target: str = TARGET) -> DataFrame:
    """Error measures of every model on the test rows."""
    test = split.filter("not is_train")
    scored = [
        model.transform(test).select(F.lit(name).alias("model_name"), F.col(target).alias("y"), "y_pred")
        for name, model in models.items()
    ]
    return regression_metrics(reduce(DataFrame.unionByName, scored), ["model_name"])


def importance(spark: SparkSession, models: Mapping[str, PipelineModel], features: Sequence[str]) -> DataFrame:
    """Importance of every feature in the tree models; one row per feature."""
    rows = []
    for name, model in models.items():
        last = model.stages[-1]
        if hasattr(last, "featureImportances"):
            weights = last.featureImportances.toArray()
            rows += [(name, feature, float(w)) for feature, w in zip(features, weights)]
    return spark.createDataFrame(rows, "model_name string, feature string, importance double")


def best_model(measures: DataFrame) -> DataFrame:
    """The model with the smallest mean absolute error."""
    return measures.agg(F.min_by(F.struct("*"), F.struct("mae", "model_name")).alias("b")).select("b.*")
