"""Grouped aggregation. Everything combines map-side, so hot groups shrink before the shuffle."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.columns import numeric_columns, q
from tallyweave.operators.ordered import global_rank
from tallyweave.operators.quantiles import exact_quantiles


def profile_by_key(df: DataFrame, key: str, table: str, columns=None) -> DataFrame:
    """Per key: row count, then min, max, mean, sample variance and sum of every numeric column.

    Names: ``{table}_NB_ROWS`` and ``{table}_{column}_{stat}``.
    """
    out = [F.count(F.lit(1)).alias(f"{table}_NB_ROWS")]
    for c in columns or numeric_columns(df, but=(key,)):
        col = q(c)
        out += [
            F.min(col).alias(f"{table}_{c}_min"),
            F.max(col).alias(f"{table}_{c}_max"),
            F.avg(col).alias(f"{table}_{c}_mean"),
            F.var_samp(col).alias(f"{table}_{c}_var"),
            F.sum(col).alias(f"{table}_{c}_sum"),
        ]
    return df.dropna("any", subset=[key]).groupBy(q(key)).agg(*out)


def weighted_means(df: DataFrame, key: str, columns, weight: str) -> DataFrame:
    """Weighted mean of each column per group."""
    w = q(weight)
    return df.groupBy(q(key)).agg(*[(F.sum(q(c) * w) / F.sum(w)).alias(c) for c in columns])


def fill_profile(df: DataFrame) -> DataFrame:
    """Per column: type, filled count, filled percentage, distinct values (NULL counts as one).

    Cells are first reduced to (column, value) counts, so no value set is held whole.
    """
    kinds = dict(df.dtypes)
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("string").alias("value")) for c in df.columns])
    )
    values = (
        df.select(cells.alias("cell")).select("cell.*").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    kind = F.create_map(*[F.lit(x) for c in df.columns for x in (c, kinds[c])])
    return values.groupBy("column").agg(
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("filled"),
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("distinct_values"),
    ).select(
        "column",
        F.element_at(kind, F.col("column")).alias("type"),
        "filled",
        (F.col("filled") * 100.0 / F.col("rows")).alias("filled_pct"),
        "distinct_values",
    )


def describe_columns(df: DataFrame, columns) -> DataFrame:
    """count, mean, std, min, quartiles, max, skewness and excess kurtosis, one row per column.

    Moments are the population (biased) form; see ``features`` for the corrected one.
    """
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast("double").alias("value")) for c in columns])
    )
    long = df.select(cells.alias("cell")).select("cell.*").filter(F.col("value").isNotNull())
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.skewness("value").alias("skewness"),
        F.kurtosis("value").alias("kurtosis"),
    )
    quartiles = exact_quantiles(df, [], columns, [0.25, 0.5, 0.75]).select(
        "column", F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q75")
    )
    return moments.join(quartiles, "column")


def pivot_first(df: DataFrame, key, indicator: str, value: str, names) -> DataFrame:
    """Long (key, indicator, value) to one row per key; ``names`` is the fixed column list."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).pivot(indicator, list(names)).agg(F.max(value))


def string_concat(df: DataFrame, keys, item, order, separator: str = ",", part_items: int = 10_000) -> DataFrame:
    """All items of a group joined to one text in a given order: (keys, part, text).

    Part p holds the items from place p * ``part_items`` of the order on, so the texts of a group, joined in the
    order of their parts, are the whole list. Each is a bounded cell, and no task holds a whole hot group: places
    come from a range-partitioned sort. Equal order columns are told apart by the item.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    base = df.select(
        *[q(k).alias(n) for k, n in zip(keys, names, strict=True)], item.alias("_item"), F.struct(*order).alias("_ord")
    ).filter(F.col("_item").isNotNull())
    placed = global_rank(base, *names, "_ord", "_item", column="_place")
    starts = placed.groupBy(*names).agg(F.min("_place").alias("_start"))
    starts = starts.withColumnsRenamed({n: f"{n}_of" for n in names})
    # Null keys are a group, too.
    same = reduce(lambda x, y: x & y, [F.col(n).eqNullSafe(F.col(f"{n}_of")) for n in names])
    part = F.floor((F.col("_place") - F.col("_start")) / part_items).cast("int").alias("part")
    dealt = placed.join(starts, same).select(*names, part, "_place", "_item")
    pieces = dealt.groupBy(*names, "part").agg(F.sort_array(F.collect_list(F.struct("_place", "_item"))).alias("_items"))
    out = [F.col(n).alias(k) for n, k in zip(names, keys, strict=True)]
    return pieces.select(*out, "part", F.array_join(F.col("_items._item"), separator).alias("text"))


def duplicate_groups(df: DataFrame, keys) -> DataFrame:
    """Keys with more than one row, most frequent first."""
    keys = list(keys)
    return (
        df.dropna("any", subset=keys)
        .groupBy(*[q(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .orderBy(F.desc("n"), *keys)
    )


def term_document_frequency(df: DataFrame, terms) -> DataFrame:
    """Rows per distinct term, where ``terms`` yields the distinct terms of a row."""
    return df.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def indicator_coverage(long: DataFrame, year: str, entity: str, indicator: str, value: str) -> DataFrame:
    """Per year: entities by number of indicators they have a value for."""
    filled = long.filter(F.col(value).isNotNull()).select(year, entity, indicator).distinct()
    per_entity = filled.groupBy(year, entity).agg(F.count(F.lit(1)).alias("indicators"))
    return per_entity.groupBy(year, "indicators").agg(F.count(F.lit(1)).alias("entities"))


def visual_histogram(df: DataFrame, key: str, word: str, words: int) -> DataFrame:
    """Per image, the share of each codeword among its descriptors: array of ``words`` doubles."""
    counts = df.groupBy(key, word).agg(F.count(F.lit(1)).alias("n"))
    # At most ``words`` pre-aggregated entries per image.
    packed = counts.groupBy(key).agg(
        F.sum("n").alias("total"), F.map_from_entries(F.collect_list(F.struct(F.col(word), F.col("n")))).alias("m")
    )
    bins = F.transform(
        F.sequence(F.lit(0), F.lit(words - 1)),
        lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0)) / F.col("total"),
    )
    return packed.select(key, bins.alias("histogram"))
