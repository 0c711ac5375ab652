"""Connected components of a link table, by alternating star contractions in Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.session import staged


def _links(links: DataFrame, a: str, b: str) -> DataFrame:
    """Links as (high, low) with high > low, each once."""
    return (
        links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).where("high <> low").distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Join the larger neighbours of each node to the least of its neighbours and itself."""
    both = links.select(F.col("high").alias("node"), F.col("low").alias("other")).union(
        links.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.withColumn("least", F.least("node", "least"))
    return _links(links.join(least, links.low == least.node).select("high", "least"), "high", "least")


def _small_star(links: DataFrame) -> DataFrame:
    """Join the smaller neighbours of each node, and itself, to the least of them."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    kept = least.select("high", "least")
    moved = links.join(least.withColumnRenamed("high", "node"), links.high == F.col("node")).select("low", "least")
    return _links(kept.union(moved), "high", "least")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links`` but the roots; a root is the least node of its component.

    Nodes may be of any type that can be ordered. Null ends, loops and repeated links are passed over.
    Each round is written to the shared folder, so plans stay short and lost executors do no harm; the
    rounds end at the fixed point, after a number of them that grows with the log of the longest path.
    """
    links = staged(_links(links.where(F.col(a).isNotNull() & F.col(b).isNotNull()), a, b), "links")
    mark = None
    while True:
        now = links.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == mark:
            return links.select(F.col("high").alias("node"), F.col("low").alias("root"))
        mark = now
        links = staged(_small_star(_large_star(links)), "links")
