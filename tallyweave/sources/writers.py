"""Writers and model persistence."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.sampling import hash_split, stratified_sample


def write_parquet(df: DataFrame, path: str, partition_by=()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv_single(df: DataFrame, path: str) -> None:
    """One CSV file with header. One file means one task; ``write_csv`` makes a folder of parts."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", encoding: str = "UTF-8") -> None:
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .csv(path)
    )


def write_json_dict(df: DataFrame, path: str, key: str, value: str) -> None:
    """Key to value records, one JSON object per line."""
    df.select(F.col(key).alias("key"), F.col(value).alias("value")).write.mode("overwrite").json(path)


def write_splits(df: DataFrame, path: str, target: str, id_col: str, fractions, test_share: float) -> None:
    """Per fraction: stratified sample, train / test split, features and target kept apart.

    Layout: ``path/<fraction>/{X,y}_{train,test}``. All splits hash the id, so a
    rerun after a lost executor writes the same rows.
    """
    for fraction in fractions:
        sample = stratified_sample(df, id_col, {}, default=fraction) if fraction < 1 else df
        parts = hash_split(sample, id_col, test_share)
        for side in ("train", "test"):
            part = parts.filter(F.col("split") == side).drop("split")
            part.drop(target).write.mode("overwrite").parquet(f"{path}/{fraction}/X_{side}")
            part.select(id_col, target).write.mode("overwrite").parquet(f"{path}/{fraction}/y_{side}")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
