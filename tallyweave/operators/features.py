"""Feature-engineering stages.

What learns something is an ``Estimator`` whose model keeps small fitted tables
or numbers; what learns nothing is a plain function on columns.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.columns import numeric_columns, q
from tallyweave.operators.joins import map_codes
from tallyweave.operators.ordered import apply_cascade, fit_cascade
from tallyweave.operators.quantiles import column_modes, exact_quantiles


# --- plain functions -------------------------------------------------------------------------


def kv_wide(df: DataFrame, key: str, column: str, groups: dict, default: str, prefix: str, names) -> DataFrame:
    """``k:v,k:v`` strings to one numeric column per mapped key (sums), one row per ``key``.

    Items without ``:`` or without a number are skipped; unknown keys count as
    ``default``. Keys that have only skipped items keep a row of zeros.
    """
    item = F.explode(F.split(F.coalesce(q(column), F.lit("")), ","))
    parts = df.select(key, item.alias("item")).select(key, F.split("item", ":").alias("kv"))
    value = F.when(F.size("kv") > 1, F.get("kv", F.lit(1)).try_cast("decimal(18,4)"))
    long = parts.select(key, map_codes(F.get("kv", F.lit(0)), groups, default, prefix).alias("name"), value.alias("value"))
    sums = [
        F.coalesce(F.sum(F.when(F.col("name") == prefix + n, F.col("value"))).cast("double"), F.lit(0.0)).alias(prefix + n)
        for n in names
    ]
    return long.groupBy(key).agg(*sums)


def kv_columns(column, groups: dict, default: str, prefix: str, names) -> dict[str, Column]:
    """Row-local form of ``kv_wide`` for frames with one row per key: name -> column, no shuffle."""
    items = F.filter(F.split(F.coalesce(q(column), F.lit("")), ","), lambda i: F.contains(i, F.lit(":")))
    pairs = F.transform(
        items,
        lambda i: F.struct(
            map_codes(F.split_part(i, F.lit(":"), F.lit(1)), groups, default, prefix).alias("name"),
            F.split_part(i, F.lit(":"), F.lit(2)).try_cast("decimal(28,4)").alias("value"),
        ),
    )
    zero = F.lit(0).cast("decimal(38,4)")
    total = lambda name: F.aggregate(
        F.filter(pairs, lambda p: (p["name"] == prefix + name) & p["value"].isNotNull()),
        zero,
        lambda acc, p: (acc + p["value"]).cast("decimal(38,4)"),
    )
    return {prefix + n: total(n).cast("double") for n in names}


def argmax_column(columns) -> Column:
    """Name of the column with the largest positive value; ties go to the first name in order."""
    best = F.lit(None).cast("string")
    top = F.greatest(*[q(c) for c in columns]) if len(columns) > 1 else q(columns[0])
    for c in sorted(columns, reverse=True):
        best = F.when((q(c) == top) & (q(c) > 0), F.lit(c)).otherwise(best)
    return best


def vector_columns(df: DataFrame, array: str, size: int, prefix: str) -> DataFrame:
    """Array elements as columns ``{prefix}1`` .. ``{prefix}{size}``."""
    rest = [q(c) for c in df.columns if c != array]
    return df.select(*rest, *[q(array)[i].alias(f"{prefix}{i + 1}") for i in range(size)])


def corrected_moments(df: DataFrame, columns) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis of several columns, one pass, one row per column."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("double").alias("value")) for c in columns])
    )
    long = df.select(cells.alias("cell")).select("cell.*")
    n = F.col("n")
    m = long.groupBy("column").agg(
        F.count("value").alias("n"), F.skewness("value").alias("g1"), F.kurtosis("value").alias("g2")
    )
    skew = F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
    kurt = F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6))
    return m.select("column", "n", skew.alias("skew"), kurt.alias("kurtosis"))


# --- stages ------------------------------------------------------------------------------------


class _Columns(Params):
    columns = Param(Params._dummy(), "columns", "input columns", TypeConverters.toListString)

    def _cols(self, df: DataFrame) -> list[str]:
        return self.getOrDefault("columns") if self.isDefined("columns") else numeric_columns(df)


class _FittedModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Model whose learned state is one JSON text, so it saves and loads with the pipeline."""

    state = Param(Params._dummy(), "state", "fitted state (JSON)", TypeConverters.toString)

    def __init__(self, state=None):
        super().__init__()
        if state is not None:
            self._set(state=json.dumps(state))

    @property
    def learned(self):
        return json.loads(self.getOrDefault("state"))


class LogSkewedModel(_FittedModel):
    def _transform(self, df):
        return df.withColumns({c: F.log1p(q(c)) for c in self.learned}) if self.learned else df


class LogSkewed(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """log1p on the columns whose corrected kurtosis or skewness is large in the fitted data."""

    max_kurtosis = Param(Params._dummy(), "max_kurtosis", "excess kurtosis limit", TypeConverters.toFloat)
    max_skew = Param(Params._dummy(), "max_skew", "absolute skewness limit", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, columns=None, max_kurtosis=8.0, max_skew=1.0):
        super().__init__()
        self._setDefault(max_kurtosis=8.0, max_skew=1.0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df):
        big = (F.col("kurtosis") > self.getOrDefault("max_kurtosis")) | (
            F.abs("skew") > self.getOrDefault("max_skew")
        )
        return LogSkewedModel([r["column"] for r in corrected_moments(df, self._cols(df)).filter(big).collect()])


class SimpleImputeModel(_FittedModel):
    def _transform(self, df):
        fills = {c: v for c, v in self.learned.items() if v is not None}
        return df.withColumns({c: F.coalesce(q(c), F.lit(v)) for c, v in fills.items()}) if fills else df


class SimpleImpute(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Missing numbers take the exact median, missing texts the most frequent value (ties: smallest)."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        if columns is not None:
            self._set(columns=columns)

    def _fit(self, df):
        chosen = self.getOrDefault("columns") if self.isDefined("columns") else df.columns
        numbers = [c for c in numeric_columns(df) if c in chosen]
        fills = {}
        if numbers:
            fills = {r["column"]: r["q"][0] for r in exact_quantiles(df, [], numbers, [0.5]).collect()}
        texts = [c for c, kind in df.dtypes if c in chosen and kind == "string"]
        if texts:
            fills |= column_modes(df, texts)
        return SimpleImputeModel(fills)


class ScaleModel(_FittedModel):
    """``(x - centre) / width``; a zero width gives 0."""

    def _transform(self, df):
        return df.withColumns(
            {c: F.when(q(c).isNotNull(), F.lit(0.0) if w == 0 else (q(c) - m) / w) for c, (m, w) in self.learned.items()}
        )

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: q(c) * w + m for c, (m, w) in self.learned.items() if c in df.columns})


class Scale(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """``standard``: mean and population deviation; ``minmax``: minimum and range. One pass, one row."""

    method = Param(Params._dummy(), "method", "standard or minmax", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns=None, method="standard"):
        super().__init__()
        self._setDefault(method="standard")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df):
        cols = self._cols(df)
        if self.getOrDefault("method") == "standard":
            aggs = [(F.avg(q(c)), F.stddev_pop(q(c))) for c in cols]
        else:
            aggs = [(F.min(q(c)), F.max(q(c)) - F.min(q(c))) for c in cols]
        row = df.agg(*[x.cast("double").alias(f"v{i}{j}") for i, pair in enumerate(aggs) for j, x in enumerate(pair)]).first()
        return ScaleModel({c: [row[f"v{i}0"] or 0.0, row[f"v{i}1"] or 0.0] for i, c in enumerate(cols)})


class OneHotModel(_FittedModel):
    def _transform(self, df):
        learned = self.learned
        rest = [q(c) for c in df.columns if c not in learned]
        flags = [
            F.coalesce(q(c) == v, F.lit(False)).cast("int").alias(f"{c}[{v}]") for c, values in learned.items() for v in values
        ]
        return df.select(*rest, *flags)


class OneHot(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """0/1 column per fitted value, named ``column[value]``; values not seen in the fit give all zeros."""

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df):
        cols = self.getOrDefault("columns") if self.isDefined("columns") else [c for c, k in df.dtypes if k == "string"]
        # One pass for all columns. The result is one output column per value, so the values fit the driver.
        found = df.agg(*[F.collect_set(q(c).cast("string")).alias(f"v{i}") for i, c in enumerate(cols)]).first() if cols else ()
        learned = {c: sorted(found[i]) for i, c in enumerate(cols)}
        return OneHotModel(learned)


class _GroupImputeWriter(MLWriter):
    """Settings as metadata, each fill table as Parquet beside it; tables never pass the driver."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path):
        one = self.instance
        told = {"levels": one.levels, "last_wins": one.last_wins, "targets": one.targets}
        if isinstance(one, GroupImputeModel):
            told["tables"] = [targets for targets, _ in one.tables]
            for i, (_, fills) in enumerate(one.tables):
                fills.write.parquet(f"{path}/fills-{i}")
        DefaultParamsWriter.saveMetadata(one, path, self.sparkSession, extraMetadata={"settings": told})


class _GroupImputeReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        told = metadata["settings"]
        if self.cls is GroupImputeModel:
            tables = [(targets, self.sparkSession.read.parquet(f"{path}/fills-{i}")) for i, targets in enumerate(told["tables"])]
            one = GroupImputeModel(told["levels"], tables, told["last_wins"])
        else:
            one = self.cls(told["targets"], told["levels"], told["last_wins"])
        one._resetUid(metadata["uid"])
        return one


class _GroupImputeStored(MLReadable, MLWritable):
    def write(self):
        return _GroupImputeWriter(self)

    @classmethod
    def read(cls):
        return _GroupImputeReader(cls)


class GroupImputeModel(Model, _GroupImputeStored):
    """Holds the per-level reference tables as DataFrames; they can outgrow a driver.

    Saves and loads alone or as a stage of a pipeline model.
    """

    def __init__(self, levels, tables, last_wins):
        super().__init__()
        self.levels, self.tables, self.last_wins = levels, tables, last_wins
        self.targets = [c for targets, _ in tables for c in targets]

    def _transform(self, df):
        for targets, fills in self.tables:
            df = apply_cascade(df, targets, self.levels, fills, self.last_wins)
        return df


class GroupImpute(Estimator, _GroupImputeStored):
    """Missing targets from the median (text: mode) of the fitted rows that agree on a list of keys.

    ``levels`` lists key sets, finest first. The first level with a value wins;
    ``last_wins`` lets the coarsest one win instead.
    """

    def __init__(self, targets, levels, last_wins: bool = False):
        super().__init__()
        self.targets, self.levels, self.last_wins = list(targets), [list(k) for k in levels], last_wins

    def _fit(self, df):
        kinds = dict(df.dtypes)
        texts = [c for c in self.targets if kinds[c] == "string"]
        numbers = [c for c in self.targets if kinds[c] != "string"]
        tables = []
        if texts:
            tables.append((texts, fit_cascade(df, texts, self.levels, "mode")))
        if numbers:
            tables.append((numbers, fit_cascade(df, numbers, self.levels, "median")))
        return GroupImputeModel(self.levels, tables, self.last_wins)


class PathLabel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the parent folder of a path as label."""

    input_col = Param(Params._dummy(), "input_col", "path column", TypeConverters.toString)
    output_col = Param(Params._dummy(), "output_col", "label column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, input_col="path", output_col="label"):
        super().__init__()
        self._setDefault(input_col="path", output_col="label")
        self._set(**self._input_kwargs)

    def _transform(self, df):
        from tallyweave.functions.text import parent_folder  # noqa: PLC0415

        return df.withColumn(self.getOrDefault("output_col"), parent_folder(self.getOrDefault("input_col")))


class ArrayToVector(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Array column to ML vector."""

    input_col = Param(Params._dummy(), "input_col", "array column", TypeConverters.toString)
    output_col = Param(Params._dummy(), "output_col", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, input_col="features", output_col="vector"):
        super().__init__()
        self._setDefault(input_col="features", output_col="vector")
        self._set(**self._input_kwargs)

    def _transform(self, df):
        from pyspark.ml.functions import array_to_vector  # noqa: PLC0415

        return df.withColumn(
            self.getOrDefault("output_col"), array_to_vector(q(self.getOrDefault("input_col")).cast("array<double>"))
        )


class VectorToColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """ML vector to one double column per element."""

    input_col = Param(Params._dummy(), "input_col", "vector column", TypeConverters.toString)
    prefix = Param(Params._dummy(), "prefix", "output column prefix", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "number of elements", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, input_col="pca", prefix="pca_", size=1):
        super().__init__()
        self._setDefault(input_col="pca", prefix="pca_", size=1)
        self._set(**self._input_kwargs)

    def _transform(self, df):
        from pyspark.ml.functions import vector_to_array  # noqa: PLC0415

        col = self.getOrDefault("input_col")
        return vector_columns(
            df.withColumn(col, vector_to_array(q(col))), col, self.getOrDefault("size"), self.getOrDefault("prefix")
        )
