"""Stream forms of the weekly totals, the running customer figures and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.session import scratch_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_events(spark: SparkSession, path: str, schema, ts: str = "ts", files_per_batch: int | None = None) -> DataFrame:
    """Stream over Parquet files; the time column becomes a timestamp in session time (UTC)."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))


def weekly_totals(events: DataFrame, ts: str, value: str, by=(), late: str = "7 days") -> DataFrame:
    """Rows and value sum per week ending on Monday; records later than ``late`` are dropped."""
    # Weeks run Tuesday 00:00 to Tuesday 00:00: five days after the epoch's Thursday.
    week = F.window(ts, "7 days", "7 days", "5 days")
    totals = events.withWatermark(ts, late).groupBy(*by, week).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("decimal(18,4)")).alias("total")
    )
    label = F.date_sub(F.to_date(F.col("window.end")), 1).alias("week")
    return totals.select(*by, label, "n", F.col("total").cast("double").alias("total"))


def customer_figures(events: DataFrame, user: str, ts: str, value: str) -> DataFrame:
    """Running latest time, count and sum per user."""
    return events.groupBy(user).agg(
        F.max(ts).alias("latest"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum(F.col(value).cast("decimal(18,4)")).cast("double").alias("amount"),
    )


def deduplicated(events: DataFrame, keys, ts: str, within: str = "1 day") -> DataFrame:
    """First record of each key; state is kept for ``within`` of event time only."""
    return events.withWatermark(ts, within).dropDuplicatesWithinWatermark(list(keys))


def run_to_table(stream: DataFrame, name: str, keys=(), mode: str = "update") -> DataFrame:
    """Process all available input and return the resulting table.

    Each micro-batch overwrites its own folder, so a batch that is repeated after a failure leaves no
    duplicates. In update mode the row of the latest batch counts for each key.
    """
    spark = stream.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    out = scratch_path(spark, name)

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    run = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", scratch_path(spark, f"{name}-state"))
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )
    try:
        run.awaitTermination()
    finally:
        run.stop()
    rows = spark.read.parquet(out)
    if mode != "update" or not keys:
        return rows.drop("batch")
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row"))
    return latest.select(*keys, "_row.*")
