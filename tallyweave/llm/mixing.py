"""Mix sources to target weights by Poisson replication, in DataFrame functions alone.

Each source has a target share of the mixed corpus. Its repetition rate is that share of the wanted
total over what the source holds. Each document is repeated k times, where k is Poisson with the rate
of its source as mean, found by inverting the distribution at a uniform number hashed from the seed
and the document id, or the whole row if it has none. The same document gets the same count in every run, on any partitioning, and
after the loss of an executor. The copies are then dealt to partitions and sorted by a hash, which is
the global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.session import staged

# Means above this are drawn as a sum of several independent Poisson numbers, as exp(-mean) must not vanish.
LARGEST_MEAN = 400.0


def drawn_name(row: str, key: str, text: str) -> Column:
    """What a row draws by: its key, or without one a digest of all its columns (``null`` if it has no text either)."""
    no_text = F.coalesce(F.octet_length(F.col(f"{row}.`{text}`")), F.lit(0)) == 0
    whole = F.concat(F.lit("null:"), F.md5(F.to_json(row).cast("binary")))
    return F.coalesce(F.col(f"{row}.`{key}`").cast("string"), F.when(no_text, "null").otherwise(whole))


def uniform(seed: int, name: Column, draw: Column) -> Column:
    """Number in [0, 1) from 52 bits of a digest of seed, draw and name."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), draw.cast("string"), name))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(mean: Column) -> Column:
    """P(k <= 0), P(k <= 1), ... far enough that the rest is below the precision of a double."""
    first = F.exp(-mean)
    steps = F.sequence(F.lit(1), F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int"))
    return F.aggregate(
        steps,
        F.struct(F.array(first).alias("cdf"), first.alias("p")),
        lambda done, k: F.struct(
            F.concat(done["cdf"], F.array(F.element_at(done["cdf"], -1) + done["p"] * mean / k)).alias("cdf"),
            (done["p"] * mean / k).alias("p"),
        ),
        lambda done: done["cdf"],
    )


def repetition_rates(
    docs: DataFrame,
    source: str,
    size: Column,
    weights: dict[str, float] | None,
    temperature: float,
    epochs: float,
) -> DataFrame:
    """One row per source (null is a source of its own): rate, number of draws, cumulated probabilities."""
    held = staged(docs.groupBy(F.col(source).alias("mix_source")).agg(F.sum(size).alias("held")), "mix-sources")
    if weights is None:
        weight = F.pow(F.col("held"), F.lit(temperature))
    else:
        named = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.create_map()
        weight = F.coalesce(F.try_element_at(named, F.col("mix_source")) if weights else F.lit(0.0), F.lit(0.0))
    held = held.withColumn("weight", weight.cast("double"))
    total = held.agg(F.sum("held"), F.sum("weight")).first()
    wanted, share = float(total[0] or 0) * epochs, float(total[1] or 0)
    rate = F.col("weight") / F.lit(share or 1.0) * F.lit(wanted) / F.col("held")
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / LARGEST_MEAN)).cast("int")
    return (
        held.withColumn("rate", rate)
        .withColumn("draws", draws)
        .select("mix_source", "rate", "draws", poisson_cdf(F.col("rate") / F.col("draws")).alias("cdf"))
    )


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    temperature: float = 0.5,
    epochs: float = 1.0,
    seed: int = 7,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """All columns of ``docs`` with ``mix_rate`` and ``mix_copy`` (1, 2, ...), one row per copy, in shuffled order.

    ``weights``: target shares by source, in any unit; a source not named has share 0. Without them the
    share of a source is its size to the power ``temperature``. Sizes are UTF-8 bytes plus one per
    document, so null and empty texts count too. ``epochs``: size of the mix against that of the input.
    A document whose count is 0 is absent: that is the method. Rows with the same key draw the same
    count, and of rows without a key those that are equal in all columns or have no text. Input columns named mix_rate or mix_copy are replaced. An empty table gives no rows.
    """
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1
    rates = repetition_rates(docs, source, size, weights, temperature, epochs)
    kept = [c for c in docs.columns if c not in ("mix_rate", "mix_copy")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("mix_row"))
    drawn = F.transform(
        F.sequence(F.lit(1), F.col("draws")), lambda j: uniform(seed, drawn_name("mix_row", key, text), j)
    )
    counted = rows.join(rates, F.col(f"mix_row.{source}").eqNullSafe(F.col("mix_source"))).select(
        "mix_row",
        "rate",
        F.aggregate(
            drawn, F.lit(0), lambda n, u: n + F.size(F.filter("cdf", lambda p: p <= u))
        ).alias("mix_n"),
    )
    copies = counted.where("mix_n > 0").select(
        "mix_row", "rate", F.explode(F.sequence(F.lit(1), F.col("mix_n"))).alias("mix_copy")
    )
    place = F.xxhash64(F.lit(seed), F.col(f"mix_row.{key}"), "mix_copy", F.xxhash64(F.col(f"mix_row.{text}")))
    return (
        copies.withColumn("mix_place", place)
        .repartition("mix_place")
        .sortWithinPartitions("mix_place")
        .select("mix_row.*", F.col("rate").alias("mix_rate"), "mix_copy")
    )
