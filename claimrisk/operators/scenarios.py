"""Rule detectors, one per known scenario, and how well they and the scores find them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimrisk.functions.columns import cents


def scenario_rules() -> dict[str, Column]:
    """The pattern each scenario leaves in the features."""
    c = F.col
    return {
        "assisted_claim": (c("out_of_network") == 1) & (c("prov_members") > 50)
        & (c("near_ceiling") == 1),
        "splitting": c("pair_claims_30d") >= 3,
        "network_duplicate": c("in_network_too") == 1,
        "opportunistic_enrolment": (c("recent_enrolment") == 1) & (c("price_ratio") > 1),
        "recycled_document": c("repeated_document") == 1,
        "clinical_impossibility": c("site_already_removed") == 1,
    }


def scenario_hits(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per claim and scenario it matches."""
    named = [F.when(rule, F.lit(name)) for name, rule in scenario_rules().items()]
    return rows.select(
        "claim_id", *keep, F.explode(F.array_compact(F.array(*named))).alias("scenario"))


def scenario_quality(rows: DataFrame) -> DataFrame:
    """Hits, precision and recall of every rule against the label, in one pass over the rows."""
    positive = F.col("label") == 1
    rules = scenario_rules()
    aggs = [F.count_if(positive).alias("_positives")]
    for name, rule in rules.items():
        aggs += [F.count_if(rule).alias(f"{name}__n"), F.count_if(rule & positive).alias(f"{name}__tp")]
    wide = rows.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}__n`, `{n}__tp`" for n in rules)
    long = wide.selectExpr("_positives", f"stack({len(rules)}, {stack}) AS (scenario, hits, true_hits)")
    return long.select(
        "scenario", "hits", "true_hits",
        F.coalesce(F.try_divide("true_hits", "hits"), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide("true_hits", "_positives"), F.lit(0.0)).alias("recall"),
    )


def detection_by_scenario(queue: DataFrame, answer_key: DataFrame, threshold: float) -> DataFrame:
    """How much of each known scenario the scores reach; claims without an entry count as null."""
    n = F.count("*")
    return queue.filter("label = 1").join(answer_key, "claim_id", "left").groupBy("scenario").agg(
        n.alias("claims"),
        F.round(F.avg("score"), 6).alias("mean_score"),
        F.round(F.count_if(F.col("score") >= threshold) * 100.0 / n, 1).alias("pct_detected"),
        F.sum(cents(F.col("amount"))).cast("double").alias("amount"),
    )
