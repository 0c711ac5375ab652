"""Balanced label propagation: documents into shards of equal counts, linked ones together.

Documents with equal texts are linked. Labels (shards) start from a hash of the row. In each round the
documents of a group look at where their group stands; those outside its strongest shard with room ask
to move there. Shards admit requests up to their quota, the largest gains first: requests are counted
by target and size of the gain, a threshold is set per target from these counts, and requests at the
threshold pass by a hash. Only counts per shard and gain class reach the driver.

Then the counts are made exact, at most one apart. Rows are numbered within their shard, linked ones
first, and what lies beyond the shard's size, unlinked rows before all, fills the free slots of others.
Numbers come from counts per bucket of a hash and positions within a bucket, so no shard and no group is
ever sorted in one task, and a row's place depends on its data alone.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.session import staged

# Requests are admitted by powers of two of their gain, up to this class.
GAIN_CLASSES = 40
# Rows numbered in one window partition, on average.
BUCKET_ROWS = 10_000


def _coin(*parts) -> Column:
    """Number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def sizes_of(rows: DataFrame, label: str, shards: int) -> list[int]:
    found = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    return [found.get(k, 0) for k in range(shards)]


def _admission(asked: list, room: list[int]) -> dict[tuple[int, int], float]:
    """Share of the requests admitted for each (target, gain class)."""
    left, share = list(room), {}
    for target, gain, n in sorted(((r["target"], r["gain"], r["n"]) for r in asked), key=lambda r: (r[0], -r[1])):
        share[target, gain] = max(0.0, min(1.0, left[target] / n))
        left[target] -= min(left[target], n)
    return share


def propagate(linked: DataFrame, sizes: list[int], capacity: int, rounds: int, seed: int) -> DataFrame:
    """Move labels of ``linked`` (row_id, group, label) towards those of their groups.

    ``sizes``: linked rows by shard; ``capacity``: how many a shard may take.
    """
    shards = len(sizes)
    for turn in range(rounds):
        room = [max(0, capacity - n) for n in sizes]
        open_shards = [k for k in range(shards) if room[k] > 0]
        blocks = staged(linked.groupBy("group", "label").agg(F.count("*").alias("n")), "shard-blocks")
        # The strongest shard of a group: that with the most of its rows; ties by a hash, alike for all its rows.
        strength = F.struct("n", F.xxhash64("group", "label", F.lit(seed)).alias("tie"), "label")
        best = blocks.groupBy("group").agg(
            F.max(strength).alias("top"),
            F.max(F.when(F.col("label").isin(open_shards), strength)).alias("free"),
        )
        wish = F.when(F.col("top.label") == F.col("label"), F.lit(None)).otherwise(F.col("free"))
        wishes = (
            blocks.join(best, "group")
            .select("group", "label", "n", wish.alias("to"), F.xxhash64("group", "label", F.lit(seed)).alias("tie"))
            .where(
                "to is not null and to.label <> label and (to.n > n or (to.n = n and to.tie > tie))"
            )
            .select(
                "group",
                "label",
                "n",
                F.col("to.label").alias("target"),
                F.least(F.lit(GAIN_CLASSES), F.log2(F.col("to.n") - F.col("n") + 1).cast("int")).alias("gain"),
            )
        )
        asked = wishes.groupBy("target", "gain").agg(F.sum("n").alias("n")).collect()  # at most shards x gain classes
        share = _admission(asked, room)
        if not any(share.values()):
            break
        admitted = F.create_map(*[F.lit(x) for (t, g), s in share.items() for x in (t * 1000 + g, s)])
        wishes = wishes.select(
            "group", "label", "target", "n", F.element_at(admitted, F.col("target") * 1000 + F.col("gain")).alias("share")
        )
        # A small block moves as a whole; a block that is large against a shard moves in part.
        coin = F.when(F.col("n") > capacity / 50, _coin("row_id", F.lit(turn), F.lit(seed))).otherwise(
            _coin("group", "label", F.lit(turn), F.lit(seed))
        )
        linked = staged(
            linked.join(wishes, ["group", "label"], "left").select(
                "row_id",
                "group",
                F.when(coin < F.col("share"), F.col("target")).otherwise(F.col("label")).alias("label"),
                F.col("label").alias("was"),
            ),
            "shard-labels",
        )
        change = {(r["was"], r["label"]): r["count"] for r in linked.groupBy("was", "label").count().collect()}
        moved = {k: n for k, n in change.items() if k[0] != k[1]}
        for (a, b), n in moved.items():
            sizes[a] -= n
            sizes[b] += n
        linked = linked.drop("was")
        if not moved:
            break
    return linked


def _place_exactly(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """Rows (row_id, linked, label) with shard and slot: sizes at most one apart, slots gapless from 0."""
    total, shards = sum(sizes), len(sizes)
    base, more = divmod(total, shards)
    largest = sorted(range(shards), key=lambda k: (-sizes[k], k))
    goal = {k: base + (i < more) for i, k in enumerate(largest)}
    buckets = max(1, math.ceil(total / shards / BUCKET_ROWS))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row_id"), F.lit(buckets)).cast("int"))
    rows = rows.withColumn("late", F.when(F.col("linked"), 0).otherwise(1))
    counts = rows.groupBy("label", "late", "part").agg(F.count("*").alias("n"))  # 2 x buckets rows a shard
    before = counts.withColumn(
        "before",
        F.coalesce(
            F.sum("n").over(
                Window.partitionBy("label").orderBy("late", "part").rowsBetween(Window.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    ).drop("n")
    number = F.row_number().over(Window.partitionBy("label", "late", "part").orderBy("row_id")) - 1
    numbered = rows.withColumn("number", number).join(before, ["label", "late", "part"])
    rank = F.col("before") + F.col("number")

    goals = F.array(*[F.lit(goal[k]) for k in range(shards)])
    beyond = [max(0, sizes[k] - goal[k]) for k in range(shards)]
    first = F.array(*[F.lit(x) for x in list(accumulate(beyond, initial=0))[:shards]])
    free = [max(0, goal[k] - sizes[k]) for k in range(shards)]
    starts = list(accumulate(free, initial=0))
    shard, slot = F.col("label"), F.col("rank")
    for k in range(shards):
        if free[k]:
            here = (F.col("extra") >= starts[k]) & (F.col("extra") < starts[k + 1])
            shard = F.when(here, F.lit(k)).otherwise(shard)
            slot = F.when(here, F.col("extra") - starts[k] + sizes[k]).otherwise(slot)
    own_goal = F.element_at(goals, F.col("label") + 1)
    extra = F.when(F.col("rank") >= own_goal, F.col("rank") - own_goal + F.element_at(first, F.col("label") + 1))
    return (
        numbered.withColumn("rank", rank)
        .withColumn("extra", extra)
        .select("row_id", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))
    )


def shard_documents(
    docs: DataFrame,
    shards: int = 16,
    rounds: int = 8,
    seed: int = 11,
    key: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep`` (default: ``key``) with size, text_crc32, law (``rows``), shard, slot and grown_shard (null).

    Counts of any two shards differ by one at most. A null text counts as the empty text (size 1, crc32 0). Repeated rows are rows of
    their own. Null keys are allowed, input columns named like the added ones are replaced, and an empty
    table gives no rows.
    """
    keep = [c for c in (keep or [key]) if c not in ("size", "text_crc32", "law", "shard", "slot", "grown_shard")]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = staged(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"),
            (F.octet_length(body) + 1).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.md5(body.cast("binary")).alias("group"),
            F.monotonically_increasing_id().alias("row_id"),
        ),
        "shard-rows",
    )
    start = F.pmod(F.xxhash64("row_id", F.lit(seed)), F.lit(shards)).cast("int")
    groups = rows.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group")
    linked = staged(rows.join(groups, "group").select("row_id", "group", start.alias("label")), "shard-labels")
    # Linked rows may fill a shard: unlinked rows have no links to lose, and make room at the end.
    capacity = max(1, rows.count() // shards)
    linked = propagate(linked, sizes_of(linked, "label", shards), capacity, rounds, seed)
    labels = rows.select("row_id", start.alias("start")).join(
        linked.select("row_id", "label"), "row_id", "left"
    )
    labels = labels.select(
        "row_id", F.col("label").isNotNull().alias("linked"), F.coalesce("label", "start").alias("label")
    )
    placed = _place_exactly(labels, sizes_of(labels, "label", shards))
    return rows.join(placed, "row_id").select(
        "kept.*",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def cut_links(sharded: DataFrame, group: Column) -> DataFrame:
    """Per group with rows in several shards: its rows, and those outside its strongest shard."""
    blocks = sharded.groupBy(group.alias("group"), "shard").agg(F.count("*").alias("n"))
    return blocks.groupBy("group").agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_shards"), (F.sum("n") - F.max("n")).alias("n_apart")
    ).where("n_shards > 1")
