"""Sampling and splits by a hash of the row id: repeatable on any cluster, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLIT_BUCKETS = 1 << 16  # buckets of the hash of an id; a class has at most so many


def unit_hash(id_col, salt: str = "") -> Column:
    """Number in [0, 1) that depends on the id only."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(col.cast("string"), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def uniform_sample(df: DataFrame, fraction: float, id_col=None, seed: int = 42) -> DataFrame:
    """Each row kept with probability ``fraction``; by id hash where an id is given."""
    if id_col is None:
        return df.sample(fraction=fraction, seed=seed)
    return df.filter(unit_hash(id_col, str(seed)) < fraction)


def stratified_sample(df: DataFrame, id_col, fractions: dict, by: str | None = None, default: float = 0.0) -> DataFrame:
    """Rows kept with the fraction of their class; classes not listed use ``default``."""
    limit = F.lit(float(default))
    for value, fraction in fractions.items():
        limit = F.when(F.col(by) == value, F.lit(float(fraction))).otherwise(limit)
    return df.filter(unit_hash(id_col, "strat") < limit)


def hash_split(df: DataFrame, id_col, test_share: float, column: str = "split") -> DataFrame:
    """Adds ``train`` / ``test``. The id hash is independent of any class, so shares hold per class too."""
    return df.withColumn(column, F.when(unit_hash(id_col, "split") < test_share, "test").otherwise("train"))


def stratified_split(df: DataFrame, id_col: str, by: str, test_share: float, column: str = "split") -> DataFrame:
    """Adds ``train`` / ``test`` with exact class shares: of n rows of a class, test_share * n (rounded half up) are test.

    The rows with the least (hash, id) of a class are test. Counts per class and hash bucket say in which bucket
    that ends; only this bucket is sorted, so no class is ever held in one task. Null classes are one class.
    """
    place = unit_hash(id_col, "split")
    rows = df.select(
        F.col(by).alias("_class"), place.alias("_place"), F.col(id_col).alias("_id"), F.floor(place * SPLIT_BUCKETS).alias("_bucket")
    )
    counts = rows.groupBy("_class", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0))
    wanted = F.floor(F.sum("_n").over(Window.partitionBy("_class")) * F.lit(float(test_share)) + 0.5)
    last = counts.select("_class", "_bucket", "_n", (wanted - upto + F.col("_n")).alias("_open"))
    last = last.filter((F.col("_open") > 0) & (F.col("_open") <= F.col("_n"))).select(
        F.col("_class").alias("_class2"), F.col("_bucket").alias("_bucket2"), "_open"
    )
    here = F.col("_class").eqNullSafe(F.col("_class2")) & (F.col("_bucket") == F.col("_bucket2"))
    rank = F.row_number().over(Window.partitionBy("_class", "_bucket").orderBy("_place", "_id"))
    edge = rows.join(last, here).withColumn("_rank", rank).filter("_rank = _open")
    edge = edge.select(F.col("_class").alias("_class3"), F.struct("_place", "_id").alias("_edge"))
    place_of = F.struct(place.alias("_place"), F.col(id_col).alias("_id"))
    marked = df.join(edge, F.col(by).eqNullSafe(F.col("_class3")), "left")
    return marked.withColumn(column, F.when(place_of <= F.col("_edge"), "test").otherwise("train")).drop("_class3", "_edge")


def first_rows(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows of an order (TakeOrdered: each task keeps its own n)."""
    return df.orderBy(*order).limit(n)
