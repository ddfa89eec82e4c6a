"""The claim feature table: enrichment, entity history and cross-table signals."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.functions.columns import own_columns
from claimrisk.operators import entity, signals
from claimrisk.operators.joins import (
    KeySlots,
    fits_broadcast,
    hot_keys,
    lookup_join,
    spread_left_join,
    spread_nulls,
)
from claimrisk.schemas import BURST_DAYS, FEATURES
from claimrisk.session import release, written
from claimrisk.sources.domain import Domain

KEYS = ["claim_id", "member_id", "provider_id", "proc_code", "req_date"]


def enrich(d: Domain, s: Staged | None = None, slots: KeySlots | None = None) -> DataFrame:
    """Claims with member, plan, provider and reference price; every claim stays exactly once.

    ``slots``: the claims lie by member already, so a large member table joins them in place; the
    history of the provider then comes with the provider, so claims move by provider once.
    """
    member = lookup_join(
        d.members.select("member_id", "region", "plan_id", "enrolled_on"),
        d.plans.select("plan_id", "plan_rate"), ["plan_id"], "member_id")
    provider = d.providers.select(
        "provider_id", "in_network", F.col("region").alias("provider_region"))
    if slots is not None:
        provider = provider.join(s.providers, "provider_id", "full")
    if slots is not None and not fits_broadcast(member.select("member_id")):
        rows = slots.left_join(d.claims, member)
    else:
        rows = lookup_join(d.claims, member, ["member_id"], "claim_id", s and s.hot_members)
    rows = lookup_join(rows, provider, ["provider_id"], "claim_id", s and s.hot_providers)
    prices = s.prices if s else signals.reference_prices(d.network)
    return lookup_join(rows, prices, ["proc_code"], "claim_id")


def own_claim_features(d: Domain, s: Staged | None = None, slots: KeySlots | None = None) -> DataFrame:
    return enrich(d, s, slots).withColumns(own_columns(d.ceiling))


@dataclass(frozen=True)
class Staged:
    """Small tables computed once and joined back to the claims."""
    daily: DataFrame
    providers: DataFrame
    members: DataFrame
    documents: DataFrame
    prices: DataFrame
    marks: DataFrame
    events: DataFrame

    @property
    def repeated(self) -> DataFrame:
        return self.documents.filter("document_rows > 1")

    @property
    def pair_days(self) -> DataFrame:
        """Per pair its days with their claims: at most one entry for each day of the calendar."""
        return self.daily.groupBy("member_id", "provider_id").agg(F.collect_list(F.struct(
            F.unix_date("proc_date").alias("day"), "n")).alias("days"))

    @property
    def hot_members(self) -> DataFrame:
        return hot_keys(self.members, ["member_id"], "mem_claims")

    @property
    def hot_providers(self) -> DataFrame:
        return hot_keys(self.providers, ["provider_id"], "prov_claims")


def stage(spark: SparkSession, d: Domain) -> Staged:
    """Write the per-day, per-entity and per-document summaries to the shared folder.

    The claims are shuffled once, already reduced to (member, provider, day); the entity tables
    follow from that table, and their counts tell the joins which keys are hot.
    """
    daily = written(spark, entity.pair_burst(entity.daily_pairs(d.claims, d.ceiling)), "daily")
    release(spark)
    of_provider, of_member = entity.once_a_pair(daily, "member_id"), entity.once_a_pair(daily, "provider_id")
    staged = Staged(
        daily=daily,
        providers=written(spark, entity.provider_features(of_provider), "provider_features"),
        members=written(spark, entity.member_features(of_member), "member_features"),
        documents=written(spark, signals.document_counts(d.claims), "document_counts"),
        prices=written(spark, signals.reference_prices(d.network), "reference_prices"),
        marks=written(spark, signals.network_marks(d.network), "network_marks"),
        events=written(spark, signals.first_events(d.network, d.event_code), "first_events"),
    )
    release(spark)
    return staged


def member_slots(s: Staged) -> KeySlots:
    """Joins on the member and more columns share one exchange of the claims."""
    return KeySlots("member_id", s.hot_members)


def add_burst(placed: DataFrame, s: Staged, slots: KeySlots) -> DataFrame:
    """Attach the 30-day count of the pair to each claim by its day."""
    on = ["provider_id", "proc_date"]
    return slots.left_join(placed, s.daily.select("member_id", *on, "pair_claims_30d"), on)


def add_arriving_burst(placed: DataFrame, s: Staged, slots: KeySlots) -> DataFrame:
    """The 30-day count of the pair in the history, the arriving claim itself, and earlier arrivals.

    ``earlier_claims``, where the claims have that column, counts what arrived since the history.
    """
    day = F.unix_date("proc_date")
    recent = F.filter("days", lambda d: d["day"].between(day - BURST_DAYS, day))
    counted = F.aggregate(recent, F.lit(0).cast("long"), lambda n, d: n + d["n"])
    since = F.col("earlier_claims") if "earlier_claims" in placed.columns else F.lit(0)
    return slots.left_join(placed, s.pair_days, ["provider_id"]).withColumn(
        "pair_claims_30d", F.coalesce(counted, F.lit(0)) + 1 + since).drop("days", "earlier_claims")


def add_repeated_document(rows: DataFrame, documents: DataFrame) -> DataFrame:
    """1 for claims whose document is among the given ones, or was used by an earlier arrival."""
    since = F.col("earlier_uses") if "earlier_uses" in rows.columns else F.lit(0)
    rows, key = spread_nulls(rows, "document", "claim_id")
    repeated = documents.withColumnRenamed("document", key)
    return spread_left_join(
        rows, repeated, [key], "claim_id", hot_keys(repeated, [key], "document_rows"),
    ).withColumn(
        "repeated_document", F.when(F.col("document_rows").isNotNull() | (since > 0), 1).otherwise(0)
    ).drop("document_rows", "earlier_uses", key)


def documents_of_members(claims: DataFrame, documents: DataFrame) -> DataFrame:
    """Member and document of the claims whose document is among the given ones; pairs may repeat.

    Only these two columns move by document, and what is found comes to the members.
    """
    pairs = claims.where("member_id IS NOT NULL AND document IS NOT NULL").select("member_id", "document", "claim_id")
    return spread_left_join(
        pairs, documents, ["document"], "claim_id", hot_keys(documents, ["document"], "document_rows"),
    ).where("document_rows IS NOT NULL").select("member_id", "document", F.lit(1).alias("found"))


def add_network_mark(placed: DataFrame, marks: DataFrame, slots: KeySlots) -> DataFrame:
    """1 when the network already paid the same member, code and site (no site matches no site)."""
    return slots.left_join(
        placed.withColumn("site_key", signals.site_key()), marks,
        ["proc_code", "site_key"],
    ).withColumn("in_network_too", F.coalesce("in_network_too", F.lit(0))).drop("site_key")


def add_prior_event(placed: DataFrame, events: DataFrame, slots: KeySlots) -> DataFrame:
    """1 when the claim is dated strictly after the event on the same site; no site, no match."""
    return slots.left_join(
        placed, events, ["site"],
    ).withColumn(
        "site_already_removed",
        F.when(F.col("removed_on").isNotNull() & (F.col("proc_date") > F.col("removed_on")), 1)
        .otherwise(0),
    ).drop("removed_on")


def place_with_documents(claims: DataFrame, s: Staged, slots: KeySlots) -> DataFrame:
    """The claims by member, with the mark of a repeated document."""
    rows, no_member = claims.withColumn("repeated_document", F.lit(0)), claims.where("member_id IS NULL")
    if not no_member.isEmpty():
        rows = rows.where("member_id IS NOT NULL").unionByName(add_repeated_document(no_member, s.repeated))
    rows = slots.left_join(
        slots.place(rows, "claim_id"), documents_of_members(claims, s.repeated), ["document"], distinct=True)
    return rows.withColumn(
        "repeated_document", F.greatest("repeated_document", F.coalesce("found", F.lit(0)))).drop("found")


def feature_table(
    spark: SparkSession, d: Domain, staged: Staged | None = None, extra: tuple[str, ...] = (),
    arriving: bool = False,
) -> DataFrame:
    """Keys, the 20 contract features and the label.

    The claims move twice at most: by member for all member joins, and by provider when that table
    is too large to broadcast; arriving claims, and those without a member, move by document as well.
    Every step is a left join to a static table, so a stream of claims gets the very same columns.

    ``arriving``: the claims are not part of the staged history.  Each is counted together with
    it: one more claim of its pair, one more use of its document.
    """
    s = staged or stage(spark, d)
    slots = member_slots(s)
    if arriving or d.claims.isStreaming:
        rows = slots.place(add_repeated_document(d.claims, s.documents if arriving else s.repeated), "claim_id")
    else:
        rows = place_with_documents(d.claims, s, slots)
    rows = slots.left_join(rows, s.members)
    rows = add_arriving_burst(rows, s, slots) if arriving else add_burst(rows, s, slots)
    rows = add_network_mark(rows, s.marks, slots)
    rows = add_prior_event(rows, s.events, slots)
    rows = own_claim_features(replace(d, claims=rows), s, slots)
    return rows.select(*KEYS, *FEATURES, *extra, "label")
