"""Arriving claims that count for those that arrive after them.

What has arrived is kept as state beside the published history: claims per pair and day, and the
documents used.  Both are tables keyed for the joins of the next batch, and every batch commits its
own part under its number.  A batch reads the parts of smaller numbers only and overwrites its own,
so a batch that is run again after a failure counts once.

Claims count in order of arrival, and within a batch in order of request day and id.  How the same
arrivals are cut into batches therefore changes nothing.  The state of a busy pair is a row per day;
within a batch every claim is compared by (pair, day), so no task holds all claims of a pair.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from claimrisk.functions.columns import band, value_at_risk, vector_columns
from claimrisk.plans.features import Staged, feature_table
from claimrisk.schemas import BURST_DAYS
from claimrisk.session import written
from claimrisk.sources.domain import Domain

PAIR = ["member_id", "provider_id"]
KINDS = {"pairs": "member_id bigint, provider_id bigint, day int, n bigint, batch bigint",
         "documents": "document string, batch bigint"}


@dataclass(frozen=True)
class ArrivalState:
    """The committed parts of the state, below a folder all executors share."""

    spark: SparkSession
    path: str

    def before(self, kind: str, batch: int) -> DataFrame:
        """What the batches of smaller numbers committed."""
        self.spark.createDataFrame([], KINDS[kind]).write.mode("ignore").partitionBy("batch") \
            .parquet(f"{self.path}/{kind}")
        return self.spark.read.schema(KINDS[kind]).parquet(f"{self.path}/{kind}").where(
            F.col("batch") < batch).drop("batch")

    def commit(self, kind: str, batch: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{kind}/batch={batch}")


def pair_days(claims: DataFrame) -> DataFrame:
    """Claims per pair and day."""
    return claims.where(" AND ".join(f"{c} IS NOT NULL" for c in [*PAIR, "proc_date"])).groupBy(
        *PAIR, F.unix_date("proc_date").alias("day")).agg(F.count("*").alias("n"))


def earlier_claims(claims: DataFrame, known: DataFrame, days: int = BURST_DAYS) -> DataFrame:
    """claim_id and the claims of its pair in the last ``days`` days that arrived before it.

    Only claims of a pair that is known or occurs twice are compared.  Such a claim asks each of
    its days; questions and claims of one (pair, day) are sorted by arrival and summed up.
    """
    several = claims.groupBy(*PAIR).count().where("count > 1").select(*PAIR).unionByName(
        known.select(*PAIR)).distinct()
    some = claims.join(several, PAIR, "left_semi").select(
        *PAIR, "claim_id", "req_date", F.unix_date("proc_date").alias("day"))
    first = known.select(
        *PAIR, "day", F.lit(None).cast("date").alias("req_date"), F.lit(None).cast("bigint").alias("claim_id"),
        "n", F.lit(False).alias("asks"))
    own = some.select(*PAIR, "day", "req_date", "claim_id", F.lit(1).cast("bigint").alias("n"),
                      F.lit(False).alias("asks"))
    asked = some.withColumn("day", F.explode(F.sequence(F.col("day") - days, F.col("day")))).select(
        *PAIR, "day", "req_date", "claim_id", F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("asks"))
    # a question stands before the claim it belongs to
    upto = Window.partitionBy(*PAIR, "day").orderBy(
        F.col("req_date").asc_nulls_first(), F.col("claim_id").asc_nulls_first(), F.col("asks").desc()
    ).rowsBetween(Window.unboundedPreceding, 0)
    counted = first.join(several, PAIR, "left_semi").unionByName(own).unionByName(asked).withColumn(
        "before", F.sum("n").over(upto)).where("asks")
    return counted.groupBy("claim_id").agg(F.sum("before").alias("earlier_claims"))


def earlier_uses(claims: DataFrame, known: DataFrame) -> DataFrame:
    """claim_id of the claims whose document was used by a claim that arrived before."""
    order = F.struct("req_date", "claim_id")
    used = claims.where("document IS NOT NULL")
    first = used.groupBy("document").agg(F.min(order).alias("first"), F.count("*").alias("uses"))
    seen = known.distinct().withColumn("seen", F.lit(True))
    wanted = first.join(seen, "document", "left").where("uses > 1 OR seen")
    return used.join(wanted, "document").where(F.col("seen") | (order > F.col("first"))).select(
        "claim_id", F.lit(1).alias("earlier_uses"))


def with_earlier(claims: DataFrame, state: ArrivalState, batch: int) -> DataFrame:
    """The claims of a batch with what arrived before each of them."""
    claims = written(state.spark, claims, "arrived")
    counted = earlier_claims(claims, state.before("pairs", batch))
    used = earlier_uses(claims, state.before("documents", batch))
    state.commit("pairs", batch, pair_days(claims))
    state.commit("documents", batch, claims.where("document IS NOT NULL").select("document").distinct())
    return claims.join(counted, "claim_id", "left").join(used, "claim_id", "left").fillna(
        0, ["earlier_claims", "earlier_uses"])


def score_arrivals(spark: SparkSession, arriving: DataFrame, d: Domain, published: Staged, out: str,
                   state_path: str, checkpoint: str, score: Column, threshold: float) -> StreamingQuery:
    """Everything available now, scored with history and earlier arrivals, below ``out``."""
    state = ArrivalState(spark, state_path)

    def batch_of(claims: DataFrame, batch: int) -> None:
        rows = feature_table(spark, replace(d, claims=with_earlier(claims, state, batch)), published,
                             arriving=True)
        vectors = rows.select("claim_id", F.col("amount").alias("claimed"), *vector_columns())
        vectors.withColumn("score", score).select(
            "claim_id", F.col("pair_claims_30d").cast("bigint").alias("pair_claims_30d"),
            F.col("repeated_document").cast("int").alias("repeated_document"), "score",
            band(F.col("score"), threshold).alias("priority"),
            value_at_risk(F.col("score"), F.col("claimed")).alias("value_at_risk"),
        ).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return arriving.writeStream.foreachBatch(batch_of).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
