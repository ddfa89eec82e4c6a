"""Queries over claims: enrichment, flags, entity history and cross-table signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.functions.columns import flag, near_ceiling
from claimrisk.operators import entity, signals
from claimrisk.operators.joins import hot_keys, spread_left_join
from claimrisk.operators.ranking import top
from claimrisk.plans import features as plan
from claimrisk.plans import sqlparts as q
from claimrisk.plans.lake import gold, silver, staged
from claimrisk.sources.tables import read_table


def reference_price(spark: SparkSession, root: str) -> DataFrame:
    return signals.reference_prices(silver(spark, root).network)


def claim_enrichment(spark: SparkSession, root: str) -> DataFrame:
    return plan.enrich(silver(spark, root)).select(
        "claim_id", "member_id", "provider_id", "proc_code", "amount", "reference_price",
        "in_network", "region", "provider_region", "plan_id", "plan_rate", "enrolled_on")


def claim_flags(spark: SparkSession, root: str) -> DataFrame:
    return plan.own_claim_features(silver(spark, root)).select(
        "claim_id", "price_ratio", "days_since_enrolment", "recent_enrolment", "out_of_network",
        "region_mismatch", "near_ceiling", "days_to_request")


def provider_profile(spark: SparkSession, root: str) -> DataFrame:
    """History of each provider with its network flag."""
    d = silver(spark, root)
    pairs = entity.pair_totals(entity.daily_pairs(d.claims, d.ceiling))
    status = d.providers.select("provider_id", flag(~F.col("in_network")).alias("out_of_network"))
    return entity.provider_features(pairs).join(status, "provider_id", "left")


def provider_concentration(spark: SparkSession, root: str) -> DataFrame:
    """The 15 out-of-network providers with the most distinct members."""
    return top(
        provider_profile(spark, root).filter("out_of_network = 1"), 15,
        F.col("prov_members").desc(), "provider_id")


def provider_top15(spark: SparkSession, root: str) -> DataFrame:
    """The 15 providers with the most distinct members, in or out of the network."""
    return top(provider_profile(spark, root), 15, F.col("prov_members").desc(), "provider_id")


def member_profile(spark: SparkSession, root: str) -> DataFrame:
    d = silver(spark, root)
    return entity.member_features(entity.pair_totals(entity.daily_pairs(d.claims, d.ceiling)))


def pair_burst_30d(spark: SparkSession, root: str) -> DataFrame:
    s = staged(spark, root)
    slots = plan.member_slots(s)
    placed = slots.place(silver(spark, root).claims, "claim_id")
    return plan.add_burst(placed, s, slots).select(
        "claim_id", "member_id", "provider_id", "proc_date", "pair_claims_30d")


def burst_top10(spark: SparkSession, root: str) -> DataFrame:
    return top(pair_burst_30d(spark, root), 10, F.col("pair_claims_30d").desc(), "claim_id")


def duplicate_document(spark: SparkSession, root: str) -> DataFrame:
    """Each text document with 1 when another document holds the same text.

    Only a digest of the whole text is shuffled, never the text.
    """
    docs = read_table(spark, root, "documents").select("doc_id", F.md5("text").alias("digest"))
    repeated = signals.repeated_documents(docs, "digest", "doc_id")
    return spread_left_join(
        docs, repeated, ["digest"], "doc_id", hot_keys(repeated, ["digest"], "document_rows"),
    ).select("doc_id", flag(F.col("document_rows").isNotNull()).alias("repeated_document"))


def network_duplicate(spark: SparkSession, root: str) -> DataFrame:
    d, slots = silver(spark, root), plan.member_slots(staged(spark, root))
    return plan.add_network_mark(
        slots.place(d.claims, "claim_id"), signals.network_marks(d.network), slots,
    ).select("claim_id", "in_network_too")


def prior_event(spark: SparkSession, root: str) -> DataFrame:
    d, slots = silver(spark, root), plan.member_slots(staged(spark, root))
    return plan.add_prior_event(
        slots.place(d.claims, "claim_id"), signals.first_events(d.network, d.event_code), slots,
    ).select("claim_id", "site_already_removed")


def feature_table(spark: SparkSession, root: str) -> DataFrame:
    return plan.feature_table(spark, silver(spark, root), staged(spark, root))


def flag_rates(spark: SparkSession, root: str) -> DataFrame:
    """Percent of claims that carry each cross-table flag."""
    def rate(c):
        return F.round(F.sum(c) * 100.0 / F.count("*"), 2)
    return gold(spark, root).agg(
        rate("repeated_document").alias("pct_repeated_document"),
        rate("in_network_too").alias("pct_in_network_too"),
        rate("site_already_removed").alias("pct_site_already_removed"))


def near_ceiling_claims(spark: SparkSession, root: str) -> DataFrame:
    """Claims by position relative to the ceiling: the half-open range in one pass."""
    d = silver(spark, root)
    return d.claims.groupBy(near_ceiling(F.col("amount"), d.ceiling).alias("near_ceiling")).agg(
        F.count("*").alias("claims"), F.min("amount").alias("lowest"), F.max("amount").alias("highest"))


QUERIES = {
    f.__name__: f for f in (
        reference_price, claim_enrichment, claim_flags, provider_profile, provider_concentration,
        provider_top15,        member_profile, pair_burst_30d, burst_top10, duplicate_document, network_duplicate,
        prior_event, feature_table, flag_rates, near_ceiling_claims)
}

_PROFILE = "WITH " + ",".join([q.CLAIMS, q.PROVIDERS, q.PROVIDER_TABLE]) + """
SELECT provider_id, prov_claims, prov_members, prov_mean_amount, prov_near_ceiling_share,
       CASE WHEN NOT in_network THEN 1 ELSE 0 END AS out_of_network
FROM prov LEFT JOIN providers USING (provider_id)"""

ORACLE = {
    "reference_price": f"WITH {q.CLAIMS}, {q.NETWORK}, {q.PRICES} SELECT * FROM prices",
    "claim_enrichment": f"""WITH {q.ENRICHED}
SELECT claim_id, member_id, provider_id, proc_code, amount, reference_price, in_network, region,
       provider_region, plan_id, plan_rate, enrolled_on FROM enriched""",
    "claim_flags": f"""WITH {q.ENRICHED}
SELECT claim_id, price_ratio, days_since_enrolment, recent_enrolment, out_of_network,
       region_mismatch, near_ceiling, days_to_request FROM own""",
    "provider_profile": _PROFILE,
    "provider_concentration": f"""SELECT * FROM ({_PROFILE}) WHERE out_of_network = 1
ORDER BY prov_members DESC, provider_id LIMIT 15""",
    "provider_top15": f"SELECT * FROM ({_PROFILE}) ORDER BY prov_members DESC, provider_id LIMIT 15",
    "member_profile": f"WITH {q.CLAIMS}, {q.MEMBER_TABLE} SELECT * FROM mem",
    "pair_burst_30d": f"""WITH {q.CLAIMS}, {q.BURST}
SELECT claim_id, member_id, provider_id, proc_date, pair_claims_30d
FROM claims JOIN burst USING (claim_id)""",
    "burst_top10": f"""WITH {q.CLAIMS}, {q.BURST}
SELECT claim_id, member_id, provider_id, proc_date, pair_claims_30d
FROM claims JOIN burst USING (claim_id) ORDER BY pair_claims_30d DESC, claim_id LIMIT 10""",
    "duplicate_document": """SELECT doc_id,
  CASE WHEN count(*) OVER (PARTITION BY md5(text)) > 1 THEN 1 ELSE 0 END AS repeated_document
FROM documents""",
    "network_duplicate": f"""WITH {q.CLAIMS}, {q.NETWORK}, {q.MARKS}
SELECT claim_id, CASE WHEN k.member_id IS NOT NULL THEN 1 ELSE 0 END AS in_network_too
FROM claims c LEFT JOIN marks k ON k.member_id = c.member_id AND k.proc_code = c.proc_code
  AND k.site_key = coalesce(c.site, 'NA')""",
    "prior_event": f"""WITH {q.CLAIMS}, {q.NETWORK}, {q.REMOVED}
SELECT claim_id, CASE WHEN c.proc_date > x.removed_on THEN 1 ELSE 0 END AS site_already_removed
FROM claims c LEFT JOIN removed x ON x.member_id = c.member_id AND x.site = c.site""",
    "feature_table": f"WITH {q.FEATURES} SELECT * FROM features",
    "flag_rates": f"""WITH {q.FEATURES}
SELECT {q.rnd("100.0 * sum(repeated_document) / count(*)", 2)} AS pct_repeated_document,
       {q.rnd("100.0 * sum(in_network_too) / count(*)", 2)} AS pct_in_network_too,
       {q.rnd("100.0 * sum(site_already_removed) / count(*)", 2)} AS pct_site_already_removed
FROM features""",
    "near_ceiling_claims": f"""WITH {q.CLAIMS}
SELECT CASE WHEN amount > 51000 AND amount <= 60000 THEN 1 ELSE 0 END AS near_ceiling,
       count(*) AS claims, min(amount) AS lowest, max(amount) AS highest
FROM claims GROUP BY 1""",
}
