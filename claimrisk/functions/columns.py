"""Claim-level column expressions: one definition for batch, streaming and single claims."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimrisk.schemas import (
    AUDIT_CEILING,
    CRITICAL_SCORE,
    FEATURES,
    MEDIUM_FACTOR,
    MISSING,
    NEAR_CEILING_SHARE,
    RECENT_DAYS,
)


def flag(predicate: Column) -> Column:
    """1 where the predicate holds, 0 where it is false or null."""
    return F.when(predicate, 1).otherwise(0)


def price_ratio(amount: Column, reference: Column) -> Column:
    """Amount over the reference price; null without a price."""
    return F.round(F.try_divide(amount, reference), 4)


def near_ceiling(amount: Column, ceiling: float = AUDIT_CEILING) -> Column:
    """Above 85 % of the ceiling, up to and including the ceiling."""
    return flag((amount > ceiling * NEAR_CEILING_SHARE) & (amount <= ceiling))


def own_columns(ceiling: float = AUDIT_CEILING) -> dict[str, Column]:
    """The features one enriched claim yields by itself."""
    since = F.datediff("proc_date", "enrolled_on")
    return {
        "price_ratio": price_ratio(F.col("amount"), F.col("reference_price")),
        "days_since_enrolment": since,
        "recent_enrolment": flag(since <= RECENT_DAYS),
        "out_of_network": flag(~F.col("in_network")),
        "region_mismatch": flag(F.col("region") != F.col("provider_region")),
        "near_ceiling": near_ceiling(F.col("amount"), ceiling),
        "days_to_request": F.datediff("req_date", "proc_date"),
    }


def band(score: Column, threshold: float | Column) -> Column:
    """Queue band of a score; the critical cut is tested first."""
    cut = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return (
        F.when(score >= CRITICAL_SCORE, "CRITICA")
        .when(score >= cut, "ALTA")
        .when(score >= cut * MEDIUM_FACTOR, "MEDIA")
        .otherwise("BAIXA")
    )


def value_at_risk(score: Column, amount: Column) -> Column:
    return F.round(score * amount, 2)


def vector_columns(features: list[str] = FEATURES) -> list[Column]:
    """The model input in contract order: doubles, missing values as -1."""
    return [F.coalesce(F.col(c).cast("double"), F.lit(float(MISSING))).alias(c) for c in features]


def alert_rules() -> dict[str, Column]:
    """The rule-based reasons shown next to a score."""
    c = F.col
    return {
        "price_over_3x": c("price_ratio") > 3,
        "near_ceiling": c("near_ceiling") == 1,
        "concentrated_provider": c("prov_members") > 50,
        "pair_burst": c("pair_claims_30d") >= 3,
        "repeated_document": c("repeated_document") == 1,
        "paid_by_network": c("in_network_too") == 1,
        "site_already_removed": c("site_already_removed") == 1,
        "first_120_days": c("recent_enrolment") == 1,
    }


def alerts() -> Column:
    """Array of the names of the alert rules a row meets, in rule order."""
    named = [F.when(rule, F.lit(name)) for name, rule in alert_rules().items()]
    return F.array_compact(F.array(*named))


def approved_amount(amount: Column, rate: Column, denied: Column) -> Column:
    """Nothing when denied, else the plan's share of the amount."""
    return F.when(denied, F.lit(0.0)).otherwise(F.round(amount * rate, 2))


def cents(amount: Column) -> Column:
    """Money as an exact decimal, so sums do not depend on the order of rows."""
    return amount.cast("decimal(18,2)")


def whole_cents(amount: Column) -> Column:
    """Money as whole cents: sums per entity are exact and stay in fast integer arithmetic."""
    return F.round(amount * 100).cast("long")
