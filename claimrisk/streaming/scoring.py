"""Scoring claims as they arrive, with the feature plan of the batch job."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimrisk.functions.columns import band, value_at_risk, vector_columns
from claimrisk.plans.features import Staged, feature_table
from claimrisk.sources.domain import Domain


def claim_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    """New parquet files below ``path`` as a stream."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path))


def scored_stream(spark: SparkSession, arriving: DataFrame, d: Domain, published: Staged,
                  score: Column | None = None, model=None, threshold: float = 0.5) -> DataFrame:
    """Each arriving claim with score, band and value at risk.

    History comes from the published tables by stream-static left joins; an arriving claim is new
    and counts together with its history.  The columns are those of ``feature_table``, so batch
    and stream cannot drift apart.  The score is an expression over the vector or a fitted pipeline.
    """
    rows = feature_table(spark, replace(d, claims=arriving), published, arriving=True)
    vectors = rows.select("claim_id", F.col("amount").alias("claimed"), *vector_columns())
    if model is not None:
        from pyspark.ml.functions import vector_to_array
        scored = model.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    else:
        scored = vectors.withColumn("score", score)
    return scored.select(
        "claim_id", "score", band(F.col("score"), threshold).alias("priority"),
        value_at_risk(F.col("score"), F.col("claimed")).alias("value_at_risk"))


def append_files(stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = None
                 ) -> StreamingQuery:
    """Everything available now, appended to files exactly once."""
    writer = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.start()


