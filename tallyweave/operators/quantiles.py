"""Exact quantiles, medians and modes that survive a hot group.

The built-in exact percentile keeps every distinct value of a group in one task.
Here values are counted in buckets, map-side combined, so what is shuffled depends on the number of buckets and not on
the rows or distinct values. The first buckets are the sign, exponent and leading mantissa bits of the value, an
order-preserving key that needs no statistics of the group. Only a bucket that holds a wanted rank is opened: its values
are dealt to equal parts of its own range and counted again, until its values are few; these are counted one by one. A
bucket whose least and largest values agree is done at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.operators.columns import q
from tallyweave.session import staged

MANTISSA_STEPS = 1 << 16  # buckets per power of two: a group of any size has about a million at most
PARTS = 1 << 16  # parts that an opened bucket is dealt to
FEW = 200_000  # values of an opened bucket that are counted one by one


def value_bucket(x: Column) -> Column:
    """Monotone integer key of a double."""
    size = F.abs(x)
    exponent = F.floor(F.log2(size))
    step = F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * MANTISSA_STEPS)
    key = (exponent + 1100) * MANTISSA_STEPS + step
    return F.when(x == 0, F.lit(0).cast("long")).otherwise((F.signum(x) * key).cast("long"))


def _cells(df: DataFrame, keys, columns) -> DataFrame:
    """(keys, column, value) of the finite cells of ``columns``; null keys are dropped."""
    base = df.dropna("any", subset=list(keys)) if keys else df
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("double").alias("value")) for c in columns])
    )
    long = base.select(*[q(k) for k in keys], cells.alias("cell")).select(
        *[q(k) for k in keys], F.col("cell.column").alias("column"), F.col("cell.value").alias("value")
    )
    return long.filter(F.abs("value") < float("inf"))  # neither NULL nor NaN nor infinite


def value_counts(df: DataFrame, keys, columns) -> DataFrame:
    """(keys, column, value, n) over the non-null cells of ``columns``; null keys are dropped."""
    kept = _cells(df, keys, columns)
    return kept.groupBy(*[q(k) for k in keys], "column", "value").agg(F.count(F.lit(1)).alias("n"))


def _wanted_ranks(probs: list[float]) -> Column:
    """1-based ranks of the order statistics below and above each position p (n - 1), for n in ``total``."""
    at = lambda p, f: f(p * (F.col("total") - 1)).cast("long") + 1
    return F.array_distinct(F.array(*[at(p, f) for p in probs for f in (F.floor, F.ceil)]))


def quantiles_of_counts(counts: DataFrame, group, probs) -> DataFrame:
    """(group, n, q: array<double>) with linear interpolation between order statistics.

    ``counts`` holds the group columns, ``value`` and its weight ``n``; a value may stand in several rows.
    """
    probs = [float(p) for p in probs]
    group = list(group)
    g = [q(k) for k in group]
    summary = [F.sum("n").alias("held"), F.count(F.lit(1)).alias("rows"), F.min("value").alias("lo"), F.max("value").alias("hi")]

    def within(buckets: DataFrame, part, order: str, start: Column) -> DataFrame:
        """Buckets that hold a wanted rank, with the weight before them; a part has a bounded number of buckets."""
        running = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        placed = buckets.withColumn("before", start + F.sum("held").over(running) - F.col("held"))
        here = F.filter("ranks", lambda r: (r > F.col("before")) & (r <= F.col("before") + F.col("held")))
        hit = placed.withColumn("ranks", here).filter(F.size("ranks") > 0)
        return staged(hit.select(*g, "total", "ranks", "before", "rows", "lo", "hi"), "buckets")

    first = counts.groupBy(*g, value_bucket(F.col("value")).alias("bucket")).agg(*summary)
    first = first.withColumn("total", F.sum("held").over(Window.partitionBy(*g)))
    level = within(first.withColumn("ranks", _wanted_ranks(probs)), g, "bucket", F.lit(0))
    hits = []
    while True:
        hits.append(level.filter("lo = hi").select(*g, "total", "ranks", F.col("lo").alias("value")))
        opened = level.filter("lo < hi")
        most = opened.agg(F.max("rows")).first()[0]
        if most is None:
            break
        inside = counts.join(
            opened.select(*g, "total", "ranks", F.col("before").alias("start"), F.col("lo").alias("from"), F.col("hi").alias("to")), group
        ).filter((F.col("value") >= F.col("from")) & (F.col("value") <= F.col("to")))
        # The least value falls into the first part and the largest into the last, so every round gets on.
        share = F.floor((F.col("value") - F.col("from")) / (F.col("to") - F.col("from")) * (PARTS - 1))
        part = share.cast("double") if most > FEW else F.col("value")
        found = inside.groupBy(*g, "total", "ranks", "start", "from", part.alias("part")).agg(*summary)
        level = within(found, [*g, F.col("from")], "part", F.col("start"))
    found = hits[0]
    for more in hits[1:]:
        found = found.unionByName(more)
    at = (
        found.select(*g, "total", "value", F.explode("ranks").alias("rank"))
        .groupBy(*g)
        .agg(
            F.first("total").alias("n"),
            F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"),
        )
    )

    def quantile(p: float) -> Column:
        position = p * (F.col("n") - 1)
        low = F.element_at("at", F.floor(position).cast("long") + 1)
        high = F.element_at("at", F.ceil(position).cast("long") + 1)
        return low + (high - low) * (position - F.floor(position))

    return at.select(*g, "n", F.array(*[quantile(p) for p in probs]).alias("q"))


def exact_quantiles(df: DataFrame, keys, columns, probs) -> DataFrame:
    """Quantiles of several columns per group, long form: (keys, column, n, q)."""
    return quantiles_of_counts(_cells(df, keys, columns).withColumn("n", F.lit(1).cast("long")), [*keys, "column"], probs)


def group_medians(df: DataFrame, keys, columns) -> DataFrame:
    """One row per group with the exact median of each column (NULL where it has no value)."""
    long = exact_quantiles(df, keys, columns, [0.5])
    picks = [F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(c) for c in columns]
    return long.groupBy(*[q(k) for k in keys]).agg(*picks) if keys else long.agg(*picks)


def group_modes(df: DataFrame, keys, column: str, name: str | None = None) -> DataFrame:
    """Most frequent non-null value per group; ties go to the smallest value."""
    kept = df.dropna("any", subset=[*keys, column])
    counts = kept.groupBy(*[q(k) for k in keys], q(column)).agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(q(column), F.struct(-F.col("n"), q(column))).alias(name or column)
    return counts.groupBy(*[q(k) for k in keys]).agg(best) if keys else counts.agg(best)


def column_modes(df: DataFrame, columns) -> dict:
    """Most frequent non-null text of each column, one job for all; ties go to the smallest."""
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value")) for c in columns])
    )
    counts = (
        df.select(cells.alias("cell"))
        .select("cell.*")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("value"))
    return {r["column"]: r["value"] for r in best.collect()}
