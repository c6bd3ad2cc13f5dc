"""Distributed tree models from MLlib behind the same feature preparation as the linear models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _features(numeric: Sequence[str], categorical: Sequence[str]) -> list:
    stages = []
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__ohe", dropLast=True, handleInvalid="keep")]
    stages.append(VectorAssembler(inputCols=[*numeric, *[f"{c}__ohe" for c in categorical]],
                                  outputCol="features", handleInvalid="keep"))
    return stages


def fit_gbt_classifier(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str,
                       max_iter: int = 20, max_depth: int = 3, seed: int = 42) -> PipelineModel:
    """Gradient-boosted trees with log loss (binary); unknown categories map to an all-zero block."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, seed=seed,
                        lossType="logistic")
    return Pipeline(stages=[*_features(numeric, categorical), gbt]).fit(train)


def fit_rf_regressor(train: DataFrame, numeric: Sequence[str], label: str, max_depth: int = 3,
                     num_trees: int = 20, seed: int = 42) -> PipelineModel:
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, maxDepth=max_depth, numTrees=num_trees,
                               seed=seed)
    return Pipeline(stages=[*_features(numeric, []), rf]).fit(train)


def positive_probability(scored: DataFrame, col: str = "probability") -> DataFrame:
    return scored.withColumn("p1", vector_to_array(F.col(col))[1])
