"""Claims per member within the last hour, as a sliding event-time window.

Windows are emitted, a block of them at once, when the watermark has passed their end.  When an
input is over, one closing event behind its last window moves the watermark there, so the windows
that are still open are emitted too, once, by the same query and state.  The closing event has no key; the windows it opens
lie behind the watermark it sets and never leave.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATENESS = "10 minutes"
AFTER_THE_END = "3 hours"  # more than a block of windows and the lateness


def _micros(spark: SparkSession, interval: str) -> int:
    return spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL {interval})").first()[0]


def hourly_counts(events: DataFrame, key: str, ts: str = "ts", length: str = "1 hour",
                  slide: str = "5 minutes", lateness: str = LATENESS) -> DataFrame:
    """Events per key and sliding window; rows later than the watermark are dropped.

    Windows that start within one ``length`` share a row of the state, a block with a counter for
    each of them: an event lies in at most two blocks, but in length / slide windows.  The windows of
    a block leave together, once the watermark has passed the last of them.  Spark counts within each
    task before the shuffle, so a hot key sends one row per task and block.
    """
    long, step = (_micros(events.sparkSession, x) for x in (length, slide))
    windows = max(1, long // step)
    block = F.window(ts, f"{long + (windows - 1) * step} microseconds", f"{windows * step} microseconds")
    offset = F.unix_micros(ts) - F.unix_micros("block.start")
    return (
        events.withWatermark(ts, lateness)
        .select(F.col(key), F.col(ts), block.alias("block"))
        .groupBy(key, "block").agg(*[
            F.count_if((offset >= i * step) & (offset < i * step + long)).alias(f"n{i}") for i in range(windows)])
        .select(key, F.unix_micros("block.start").alias("first"),
                F.posexplode(F.array(*[f"n{i}" for i in range(windows)])).alias("i", "n"))
        .where("n > 0").withColumn("start", F.col("first") + F.col("i").cast("long") * step)
        .select(key, F.timestamp_micros("start").alias("window_start"),
                F.timestamp_micros(F.col("start") + long).alias("window_end"), "n")
    )


def with_closing(spark: SparkSession, events: DataFrame, folder: str) -> DataFrame:
    """The events and whatever ``close_input`` puts into ``folder``, as one stream."""
    return events.unionByName(spark.readStream.schema(events.schema).parquet(folder))


def open_input(spark: SparkSession, events: DataFrame, folder: str) -> None:
    """Prepares the folder of the closing event, still empty."""
    spark.createDataFrame([], events.schema).write.mode("ignore").parquet(folder)


def close_input(spark: SparkSession, events: DataFrame, folder: str, ts: str = "ts",
                after: str = AFTER_THE_END) -> None:
    """Writes the closing event of an input whose rows, read at once, are ``events``."""
    last = events.agg((F.max(ts) + F.expr(f"INTERVAL {after}")).alias(ts)).where(F.col(ts).isNotNull())
    last.select(*[F.col(c) if c == ts else F.lit(None).cast(events.schema[c].dataType).alias(c)
                  for c in events.columns]).write.mode("append").parquet(folder)
