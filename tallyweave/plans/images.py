"""Image featurisation: files -> label, features, index, principal components -> flat table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, StringIndexer
from pyspark.sql import DataFrame

from tallyweave.functions.text import s3_to_https
from tallyweave.operators.features import ArrayToVector, PathLabel, VectorToColumns
from tallyweave.operators.pluggable import featurise
from tallyweave.session import staged


def featurised(files: DataFrame, load: Callable, state=None) -> DataFrame:
    """(path, label, features), written once: fitting and transforming both read it, the images only once."""
    return staged(featurise(PathLabel().transform(files), "content", load, state).drop("content"), "features")


def projection_stages(k: int, centre: bool = True) -> Pipeline:
    """Vector, label index, (centring,) PCA."""
    stages = [ArrayToVector(input_col="features", output_col="vector"), StringIndexer(inputCol="label", outputCol="label_index")]
    if centre:
        stages.append(StandardScaler(inputCol="vector", outputCol="centred", withMean=True, withStd=False))
    stages.append(PCA(k=k, inputCol="centred" if centre else "vector", outputCol="pca"))
    return Pipeline(stages=stages)


def project(features: DataFrame, k: int, centre: bool = True) -> tuple[PipelineModel, DataFrame]:
    model = projection_stages(k, centre).fit(features)
    return model, model.transform(features)


def flat_table(projected: DataFrame, k: int, region: str | None = None) -> DataFrame:
    """path, label, label_index, pca_1..pca_k; object-store paths become https addresses when a region is given."""
    narrow = projected.select("path", "label", "label_index", "pca")
    if region:
        narrow = narrow.withColumn("path", s3_to_https("path", region))
    return VectorToColumns(input_col="pca", prefix="pca_", size=k).transform(narrow)
