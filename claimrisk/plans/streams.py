"""Streaming queries run over the data folder until everything available is processed."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.plans import sqlparts as q
from claimrisk.plans.features import stage
from claimrisk.plans.lake import silver
from claimrisk.schemas import TABLES
from claimrisk.session import work_dir
from claimrisk.streaming.arrivals import score_arrivals
from claimrisk.streaming.burst import close_input, hourly_counts, open_input, with_closing
from claimrisk.streaming.scoring import append_files

THRESHOLD = 0.30
CUT = "1999-06-01"
ARRIVALS = [CUT, "2000-03-01", "2001-01-01"]  # first request day of each part


def stream_score(spark: SparkSession, root: str) -> DataFrame:
    """Claims requested from a day on, arriving one part after the other.

    Each is scored against the history before that day and against the claims that arrived before.
    """
    d = silver(spark, root)
    published = stage(spark, replace(d, claims=d.claims.filter(F.col("req_date") < CUT)))
    source, out, state, checkpoint = (
        work_dir(spark, f"stream_score-{n}") for n in ("in", "out", "state", "checkpoint"))
    for start, end in zip(ARRIVALS, [*ARRIVALS[1:], "9999-12-31"]):
        d.claims.where((F.col("req_date") >= start) & (F.col("req_date") < end)).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(d.claims.schema).parquet(source)
        score_arrivals(spark, arriving, d, published, out, state, checkpoint, F.expr(q.SCORE_SQL),
                       THRESHOLD).awaitTermination()
    return spark.read.parquet(out).drop("batch")


def stream_burst_1h(spark: SparkSession, root: str) -> DataFrame:
    """Events of every user within an hour, window by window, the last windows included."""
    def read(reader):
        return reader.schema(TABLES["events"]).option("pathGlobFilter", "events.parquet").parquet(root).select(
            "user_id", F.col("ts").cast("timestamp").alias("ts"))

    at_once = read(spark.read)
    out, state, closing = (work_dir(spark, f"stream_burst-{n}") for n in ("out", "state", "closing"))
    open_input(spark, at_once, closing)

    def run():
        counts = hourly_counts(with_closing(spark, read(spark.readStream), closing), "user_id")
        append_files(counts, out, state).awaitTermination()
        return counts.schema

    run()
    close_input(spark, at_once, closing)
    return spark.read.schema(run()).parquet(out).select(
        "user_id", F.unix_seconds("window_start").alias("starts"),
        F.unix_seconds("window_end").alias("ends"), "n")


QUERIES = {f.__name__: f for f in (stream_score, stream_burst_1h)}

ORACLE = {
    "stream_score": f"WITH {q.arriving_features(CUT)}{q.SCORED_FROM}{q.QUEUE_FROM} "
                    "SELECT claim_id, pair_claims_30d, repeated_document, score, priority, value_at_risk FROM queue",
    "stream_burst_1h": """WITH e AS (SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events),
w AS (SELECT user_id, s // 300 * 300 - unnest(range(0, 12)) * 300 AS starts FROM e)
SELECT user_id, starts, starts + 3600 AS ends, count(*) AS n FROM w GROUP BY user_id, starts""",
}
