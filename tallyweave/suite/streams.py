"""Streaming queries over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.streaming import forms as S
from tallyweave.suite.aggregation import dec
from tallyweave.suite.ordering import WEEK_EVENTS
from tallyweave.suite.registry import query


def _events(t):
    # The glob works for a single file as well as for a folder of part files.
    return S.read_events(t.spark, f"{t.sf_dir}/event[s].parquet", t.events.schema)


@query(
    "st_weekly_totals",
    f"""SELECT event_type, strftime({WEEK_EVENTS}, '%Y-%m-%d') AS week, COUNT(*) AS n, {dec('value')} AS total
        FROM events GROUP BY 1, 2""",
)
def st_weekly_totals(t):
    stream = S.weekly_totals(_events(t), "ts", "value", ["event_type"])
    out = S.run_to_table(stream, "weekly", ["event_type", "week"])
    return out.withColumn("week", F.col("week").cast("string"))


@query(
    "st_customer_rfm",
    f"""SELECT user_id, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS latest, COUNT(*) AS frequency, {dec('value')} AS amount
        FROM events GROUP BY user_id""",
)
def st_customer_rfm(t):
    out = S.run_to_table(S.customer_figures(_events(t), "user_id", "ts", "value"), "figures", ["user_id"])
    return out.withColumn("latest", F.date_format("latest", "yyyy-MM-dd HH:mm:ss"))


@query("st_dedup", "SELECT event_id, user_id, event_type FROM events")
def st_dedup(t):
    """Every record sent twice comes out once."""
    twice = _events(t).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    once = S.deduplicated(twice, ["event_id"], "ts").select("event_id", "user_id", "event_type")
    return S.run_to_table(once, "dedup", mode="append")
