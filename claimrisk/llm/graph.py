"""Connected components of a link table that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.session import written


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


TASK_LINKS = 200_000  # that a task takes at least: few links are not worth a task for each shuffle partition


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that has a link; links: columns u, v.

    Alternating steps hang each node's neighbours onto its smallest one, until every component
    is a star.  A node's links are never gathered: minima are taken by partial aggregation and
    joined back.
    """
    links = written(spark, links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while (now := _fingerprint(links)) != before:
        before = now
        tasks = 1 + now[0] // TASK_LINKS
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks).distinct()
        large = written(spark, large.coalesce(tasks), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        links = written(spark, small.where("u <> v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).coalesce(tasks).distinct()
            .coalesce(tasks), "links")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component"))
                             .distinct())
