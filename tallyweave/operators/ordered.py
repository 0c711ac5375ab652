"""Ordered and group-repair operators: weekly bins, running totals, ranks, de-duplication, imputation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.functions.dates import week_ending_monday
from tallyweave.operators.columns import q
from tallyweave.operators.joins import complete_calendar
from tallyweave.operators.neighbours import TILE_ROWS, blocked_join
from tallyweave.operators.quantiles import group_medians, quantiles_of_counts, value_counts
from tallyweave.session import cut_lineage, staged


def weekly_totals(df: DataFrame, ts: str, value: Column | None = None, by=()) -> DataFrame:
    """Rows and value sum per week ending on Monday, empty weeks included."""
    value = F.lit(0.0) if value is None else value
    weekly = df.groupBy(*by, week_ending_monday(ts).alias("week")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value.cast("decimal(18,4)")).cast("double").alias("total")
    )
    return complete_calendar(weekly, "week", 7, ["n", "total"], by)


def running_totals(weekly: DataFrame, columns, order: str = "week", by=()) -> DataFrame:
    """Running sums along an aggregated calendar (a few hundred rows per group)."""
    over = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return weekly.withColumns({f"cum_{c}": F.sum(c).over(over) for c in columns})


def global_rank(df: DataFrame, *order, column: str = "rank") -> DataFrame:
    """Row number in a total order without moving all rows to one task.

    Range-partitioned sort; ranks are the position in the partition plus the rows of
    the partitions before. The sorted rows are checkpointed in between, since range
    bounds are sampled and must not be drawn twice.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(
        placed.withColumns(
            {
                "_part": F.spark_partition_id(),
                # the low 33 bits of the id count rows inside the partition
                "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(column, F.col("_before") + F.col("_at") + 1)
        .drop("_part", "_at", "_before")
    )


def latest_non_null(long: DataFrame, keys, year: str, value: str, cutoffs) -> DataFrame:
    """Latest known value at or before each cut-off year, all cut-offs in one pass.

    A partial aggregate per cut-off column, then unpivoted; no loop over years.
    """
    cutoffs = list(cutoffs)
    at = [
        F.max_by(q(value), F.when(F.col(value).isNotNull() & (F.col(year) <= c), F.col(year))).alias(str(c))
        for c in cutoffs
    ]
    wide = long.groupBy(*keys).agg(*at)
    tall = wide.unpivot(list(keys), [q(str(c)) for c in cutoffs], "cutoff", "latest_value")
    return tall.withColumn("cutoff", F.col("cutoff").cast("int")).filter(F.col("latest_value").isNotNull())


def last_row(df: DataFrame, key: str, order) -> DataFrame:
    """The row of each key that is last in ``order``, as a mergeable aggregate."""
    rest = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*[q(c) for c in rest]), F.struct(*order)).alias("_last")
    return df.groupBy(key).agg(best).select(key, "_last.*")


def merge_duplicates(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: per column the first non-null value in ``order``. Null keys are dropped."""
    keys, rank = list(keys), F.struct(*order)
    rest = [c for c in df.columns if c not in keys]
    firsts = [F.min_by(q(c), F.when(q(c).isNotNull(), rank)).alias(c) for c in rest]
    return df.dropna("any", subset=keys).groupBy(*[q(k) for k in keys]).agg(*firsts).select(*[q(c) for c in df.columns])


def repair_by_group_median(df: DataFrame, bad: dict[str, Column], ref: str) -> DataFrame:
    """Bad cells replaced by the median of the good cells with the same reference value.

    ``bad`` maps each column to repair to its condition; all columns go through in one pass. The
    reference comparison ignores case and outer blanks. Medians come from the state before any
    repair and never include a bad cell. Where no good cell exists the value stays as it is.
    """
    key = F.lower(F.trim(q(ref).cast("string")))
    flags = {c: F.coalesce(cond, F.lit(False)) for c, cond in bad.items()}
    flagged = df.withColumns({"_key": key, **{f"_bad_{c}": f for c, f in flags.items()}})
    good = flagged.select("_key", *[F.when(~q(f"_bad_{c}"), q(c)).alias(c) for c in bad])
    medians = group_medians(good, ["_key"], list(bad)).withColumnsRenamed({c: f"_median_{c}" for c in bad})
    fixed = {c: F.when(q(f"_bad_{c}"), F.coalesce(q(f"_median_{c}"), q(c))).otherwise(q(c)) for c in bad}
    return flagged.join(medians, "_key", "left").withColumns(fixed).select(*[q(c) for c in df.columns])


def repair_by_word_median(df: DataFrame, bad: dict[str, Column], words: Column, min_rows: int) -> DataFrame:
    """Bad cells replaced by the median over the good cells of rows that hold all frequent words of the row.

    Rows are reduced to their set of frequent words first, and good cells further to
    (set, column, value, count). A bad set meets only the good sets that hold its rarest
    word, then must be contained in them. Sets that share a busy word are met in cells of bounded size, and what a cell
    finds is summed before it is shuffled, so a word in a third of the rows is many small tasks.
    """
    flags = {f"_bad_{c}": F.coalesce(cond, F.lit(False)) for c, cond in bad.items()}
    tagged = df.withColumns({"_words": words, **flags})
    frequent = (
        tagged.select(F.explode("_words").alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") >= min_rows)
    )
    # Words of a row are few; its frequent ones are gathered per distinct word list.
    lists = tagged.select("_words").distinct()
    sets = (
        lists.select("_words", F.explode("_words").alias("word"))
        .join(frequent, "word")
        .groupBy("_words")
        .agg(
            F.array_sort(F.collect_set("word")).alias("_set"),
            F.min_by("word", F.struct("rows", "word")).alias("_rarest"),
        )
    )
    rows = staged(tagged.join(sets, "_words", "left"), "word-sets")
    known = rows.filter(F.col("_set").isNotNull())
    good = value_counts(
        known.select(F.col("_set").alias("_have"), *[F.when(~q(f"_bad_{c}"), q(c)).alias(c) for c in bad]),
        ["_have"],
        list(bad),
    )
    by_word = good.select("_have").distinct().select("_have", F.explode("_have").alias("_rarest"))
    any_bad = reduce(lambda a, b: a | b, [q(f"_bad_{c}") for c in bad])
    needed = known.filter(any_bad).select("_set", "_rarest").distinct()
    # A set has one rarest word, so each pair of sets is met once.
    met = blocked_join(needed, by_word, "_rarest", "_set", "_have", TILE_ROWS)
    contains = met.filter(F.size(F.array_except("_set", "_have")) == 0).select("_set", "_have")
    counts = contains.join(good, "_have").groupBy("_set", "column", "value").agg(F.sum("n").alias("n"))
    long = quantiles_of_counts(counts, ["_set", "column"], [0.5])
    medians = long.groupBy("_set").agg(
        *[F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(f"_median_{c}") for c in bad]
    )
    fixed = {c: F.when(q(f"_bad_{c}"), F.coalesce(q(f"_median_{c}"), q(c))).otherwise(q(c)) for c in bad}
    return rows.join(medians, "_set", "left").withColumns(fixed).select(*[q(c) for c in df.columns])


def _level_key(level: int, keys) -> Column:
    """Text that names one group of one level; NULL where a key is missing."""
    known = reduce(lambda a, b: a & b, [q(k).isNotNull() for k in keys])
    return F.when(known, F.to_json(F.struct(F.lit(level).alias("level"), *[q(k) for k in keys])))


def fit_cascade(df: DataFrame, targets, levels, kind: str = "median") -> DataFrame:
    """Fill values of all targets for all key sets: (group, one column per target).

    The rows are read once and reduced to value counts over all keys; each count then goes to its
    group of every level, and one pass yields all medians, means or modes.
    """
    targets, keys = list(targets), sorted({k for level in levels for k in level})
    as_type = "string" if kind == "mode" else "double"
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), q(c).cast(as_type).alias("value")) for c in targets])
    )
    base = (
        df.select(*[q(k) for k in keys], cells.alias("cell"))
        .filter(F.col("cell.value").isNotNull())
        .groupBy(*[q(k) for k in keys], F.col("cell.column").alias("column"), F.col("cell.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    groups = F.explode(F.array(*[_level_key(i, level) for i, level in enumerate(levels)]))
    counts = (
        base.select(groups.alias("group"), "column", "value", "n")
        .filter(F.col("group").isNotNull())
        .groupBy("group", "column", "value")
        .agg(F.sum("n").alias("n"))
    )
    by = counts.groupBy("group", "column")
    if kind == "median":
        long = quantiles_of_counts(counts, ["group", "column"], [0.5])
        long = long.select("group", "column", F.col("q")[0].alias("fill"))
    elif kind == "mean":
        long = by.agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("fill"))
    else:
        long = by.agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("fill"))
    wide = long.groupBy("group").agg(*[F.max(F.when(F.col("column") == c, F.col("fill"))).alias(c) for c in targets])
    return staged(wide, "fills")


def apply_cascade(df: DataFrame, targets, levels, fills: DataFrame, last_wins: bool = False) -> DataFrame:
    """Missing targets filled from the finest level that has a value (or the last, with ``last_wins``)."""
    # Fills are gathered once for each distinct combination of the keys, so rows are joined once, not once a level.
    keys = sorted({k for level in levels for k in level})
    each = df.select(*[q(k) for k in keys]).distinct()
    for i, level in enumerate(levels):
        table = fills.select(F.col("group").alias("_group"), *[q(c).alias(f"_fill{i}_{c}") for c in targets])
        each = each.withColumn("_group", _level_key(i, level)).join(table, "_group", "left").drop("_group")
    order = range(len(levels) - 1, -1, -1) if last_wins else range(len(levels))
    found = {c: F.coalesce(*[q(f"_fill{i}_{c}") for i in order]).alias(f"_fill_{c}") for c in targets}
    each = each.select(*[q(k).alias(f"_key{j}") for j, k in enumerate(keys)], *found.values())
    same = reduce(lambda a, b: a & b, [q(k).eqNullSafe(F.col(f"_key{j}")) for j, k in enumerate(keys)])
    new = {c: F.coalesce(q(c), q(f"_fill_{c}")) for c in targets}
    return df.join(each, same, "left").withColumns(new).select(*[q(c) for c in df.columns])


def cascade_impute(df: DataFrame, targets, levels, kind: str = "median", last_wins: bool = False) -> DataFrame:
    targets = [targets] if isinstance(targets, str) else list(targets)
    return apply_cascade(df, targets, levels, fit_cascade(df, targets, levels, kind), last_wins)
