"""Per-entity history: providers, members and (member, provider) pairs.

Everything starts from one pre-aggregated table, a row per (member, provider, day).  Hot
providers and members are reduced before the first shuffle and stay spread by the other key,
so no task ever holds the claims of a whole entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimrisk.functions.columns import near_ceiling, whole_cents
from claimrisk.schemas import AUDIT_CEILING, BURST_DAYS

PAIR = ["member_id", "provider_id"]


def daily_pairs(claims: DataFrame, ceiling: float = AUDIT_CEILING) -> DataFrame:
    """One row per member, provider and procedure day."""
    return claims.groupBy(*PAIR, "proc_date").agg(
        F.count("claim_id").alias("n"),
        F.sum(whole_cents(F.col("amount"))).alias("cents"),
        F.sum(near_ceiling(F.col("amount"), ceiling)).alias("near"),
    )


def pair_totals(daily: DataFrame) -> DataFrame:
    return daily.groupBy(*PAIR).agg(
        F.sum("n").alias("n"), F.sum("cents").alias("cents"), F.sum("near").alias("near")
    )


def provider_features(pairs: DataFrame) -> DataFrame:
    """Claims, distinct members, mean amount and share near the ceiling per provider.

    The pairs are distinct already, so the distinct count is a plain count.
    """
    total, n = F.sum("cents") / 100.0, F.sum("n")
    return pairs.groupBy("provider_id").agg(
        n.alias("prov_claims"),
        F.count("member_id").alias("prov_members"),
        F.round(total / n, 2).alias("prov_mean_amount"),
        F.round(F.sum("near") / n, 4).alias("prov_near_ceiling_share"),
    )


def member_features(pairs: DataFrame) -> DataFrame:
    """Claims, total amount and distinct providers per member."""
    return pairs.groupBy("member_id").agg(
        F.sum("n").alias("mem_claims"),
        (F.sum("cents") / 100.0).alias("mem_total_amount"),
        F.count("provider_id").alias("mem_providers"),
    )


def once_a_pair(daily: DataFrame, entity: str) -> DataFrame:
    """Daily rows in which only the first day of a pair (``first_day``) names the pair's other entity.

    To the features of one entity, days with one name a pair are as good as pairs, without moving
    the days by their pairs once more.
    """
    return daily.withColumn(entity, F.when(F.col("first_day"), F.col(entity)))


def pair_burst(daily: DataFrame, days: int = BURST_DAYS) -> DataFrame:
    """Claims of the pair in the last ``days`` days, both ends and same-day ties included.

    The frame runs over daily rows: a pair has at most one row per calendar day, however many
    claims it has, so the partition of a hot pair is bounded by the calendar.
    """
    last_days = (
        Window.partitionBy(*PAIR).orderBy(F.unix_date("proc_date")).rangeBetween(-days, 0)
    )
    first = F.row_number().over(Window.partitionBy(*PAIR).orderBy(F.unix_date("proc_date"))) == 1
    return daily.withColumns({"pair_claims_30d": F.sum("n").over(last_days), "first_day": first})
