"""Featurisation by an external model: loaded once per task, fed in Arrow batches.

``load`` runs on the executor and returns ``predict(batch of inputs) -> (n, d) array``.
What it needs (weights, settings) travels as a broadcast variable.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _featuriser(spark, load: Callable, state):
    shared = spark.sparkContext.broadcast(state)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load(shared.value)
        for batch in batches:
            out = np.asarray(predict(batch), dtype="float32") if len(batch) else np.empty((0, 0))
            yield pd.Series(list(out))

    return F.pandas_udf(run, "array<float>")


def featurise(df: DataFrame, column: str, load: Callable, state=None, out: str = "features") -> DataFrame:
    """Adds ``out``: one float vector per row of a text or binary column.

    Apply it to the narrow (id, content) columns, store the result, and join; content is not read twice then.
    """
    return df.withColumn(out, _featuriser(df.sparkSession, load, state)(F.col(column)))


def embed_text(df: DataFrame, column: str, load: Callable, state=None, out: str = "embedding") -> DataFrame:
    return featurise(df, column, load, state, out)
