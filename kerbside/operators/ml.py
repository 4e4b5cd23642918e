"""Classifiers as Spark ML models; the fit of the forest is in ``forest``, the boosted ensemble in ``boosting``.

The caller persists the training frame if it fits several models.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from kerbside.operators import forest
from kerbside.schema import MODEL_FEATURES
from kerbside.sources.readers import path_exists
from kerbside.sources.scratch import written
from kerbside.sources.sinks import model_slug


def assembler(features: list[str] = MODEL_FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


def usable(df: DataFrame, features: list[str] = MODEL_FEATURES, unknown_town: int = -1) -> DataFrame:
    """Rows whose features are all present. A town without a number gets a code of its own, so
    its rows are trained on and scored like any others."""
    return df.fillna({"town_code": unknown_town}).dropna(subset=features)


def fit_logistic(train: DataFrame, features: list[str] = MODEL_FEATURES, c: float = 1.0,
                 max_iter: int = 1000) -> PipelineModel:
    """Standardised multinomial logistic regression.

    Spark averages the loss over rows, so the penalty 1/C becomes 1/(C * n).
    """
    n = train.count()
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="error"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        LogisticRegression(family="multinomial", maxIter=max_iter, regParam=1.0 / (c * max(n, 1)),
                           elasticNetParam=0.0, standardization=False),
    ]).fit(train)


def fit_forest(train: DataFrame, features: list[str] = MODEL_FEATURES, trees: int = 200,
               depth: int = 20, min_leaf: int = 10, bins: int = 64, seed: int = 42) -> PipelineModel:
    """Random forest with balanced class weights and square-root feature sampling, fitted on every
    row (``forest``) and given as Spark's own model. ``train`` is read some four times."""
    return PipelineModel([assembler(features), forest.fit(train, features, trees, depth, min_leaf, bins, seed)])


def feature_importance(spark, models: dict[str, list[float]], features: list[str] = MODEL_FEATURES) -> DataFrame:
    """Importance per model and feature, sorted, from a list of shares per model.

    The table has one row per model and feature, whatever the data size.
    """
    rows = [(name, f, float(share)) for name, shares in models.items() for f, share in zip(features, shares)]
    return (spark.createDataFrame(rows, "model string, feature string, importance double")
            .orderBy("model", F.desc("importance"), "feature"))


def logistic_slope(train: DataFrame, model: PipelineModel, c: float = 1.0) -> float:
    """Largest component of the gradient of the penalised loss at a fitted logistic model: 0 at
    the optimum. One pass over the rows."""
    fitted = model.stages[-1]
    scaled = model.transform(train).select("label", vector_to_array("features").alias("z"),
                                           vector_to_array("probability").alias("p"))
    sizes = range(fitted.numFeatures)
    sums = []
    for k in range(fitted.numClasses):
        miss = F.element_at("p", k + 1) - (F.col("label") == k).cast("double")
        sums += [F.avg(miss).alias(f"b{k}"), *[F.avg(miss * F.element_at("z", j + 1)).alias(f"w{k}_{j}") for j in sizes]]
    slope = scaled.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    weights = fitted.coefficientMatrix.toArray()
    return max(max(abs(slope[f"b{k}"]), *[abs(slope[f"w{k}_{j}"] + weights[k, j] / (c * slope.n)) for j in sizes])
               for k in range(fitted.numClasses))


def load_model(spark, directory: str, name: str) -> PipelineModel | None:
    path = f"{directory.rstrip('/')}/{model_slug(name)}"
    return PipelineModel.load(path) if path_exists(spark, path) else None
