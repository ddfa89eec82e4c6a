"""Queries that judge rules and scores, choose the cut and build the audit queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.functions.columns import approved_amount as approved_column
from claimrisk.functions.columns import cents
from claimrisk.operators import evaluate, queue, scenarios
from claimrisk.operators.joins import lookup_join
from claimrisk.plans import sqlparts as q
from claimrisk.plans.lake import gold, silver
from claimrisk.schemas import AFTER_DECISION
from claimrisk.sources.domain import MAPPED_CEILING, decided
from claimrisk.sources.tables import read_table

THRESHOLD = 0.30
REVIEWS_PER_DAY = 3


def scored_claims(spark: SparkSession, root: str) -> DataFrame:
    """The feature table with the fixed score, a stand-in that both engines compute alike."""
    return gold(spark, root).withColumn("score", F.expr(q.SCORE_SQL))


def scored_lines(spark: SparkSession, root: str) -> DataFrame:
    """Order lines scored by their discount: few distinct scores, so heavy ties."""
    return read_table(spark, root, "lineitem").filter("l_returnflag <> 'N'").select(
        (F.col("l_discount") * 10).alias("score"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.col("l_extendedprice").alias("amount"))


def queue_of(spark: SparkSession, root: str) -> DataFrame:
    return queue.build_queue(scored_claims(spark, root), THRESHOLD)


# --- rules and data quality --------------------------------------------------------------
def label_summary(spark: SparkSession, root: str) -> DataFrame:
    return evaluate.label_summary(silver(spark, root).claims)


def rule_confusion(spark: SparkSession, root: str) -> DataFrame:
    return evaluate.rule_confusion(
        silver(spark, root).claims, F.col("amount") > MAPPED_CEILING).orderBy("flagged", "label")


def rule_precision_recall(spark: SparkSession, root: str) -> DataFrame:
    return evaluate.rule_quality(silver(spark, root).claims, F.col("amount") > MAPPED_CEILING)


def leakage_correlation(spark: SparkSession, root: str) -> DataFrame:
    """Every column known only after the decision, against the label: none may become a feature."""
    d = silver(spark, root)
    rates = lookup_join(
        d.members.select("member_id", "plan_id"), d.plans, ["plan_id"], "member_id").select("member_id", "plan_rate")
    rows = decided(d.claims, rates)
    audit = evaluate.leakage_audit(rows, dict(zip(AFTER_DECISION, (
        F.when(F.col("status") == "denied", 1).otherwise(0), F.col("approved_amount"),
        F.when(F.col("denial_reason") == "duplicate", 1).when(F.col("denial_reason").isNotNull(), 0),
        F.datediff("review_date", "req_date")))))
    return audit.select(
        "candidate", F.round("correlation", 8).alias("correlation"), F.round("null_rate", 8).alias("null_rate"))


def dq_summary(spark: SparkSession, root: str) -> DataFrame:
    money = cents(F.col("amount"))
    return silver(spark, root).claims.agg(
        F.count("*").alias("claims"),
        F.sum("label").alias("positives"),
        F.round(F.sum("label") * 100.0 / F.count("*"), 2).alias("pct_positive"),
        F.sum(money).cast("double").alias("total_amount"),
        F.sum(F.when(F.col("label") == 1, money)).cast("double").alias("amount_at_risk"),
        F.min("req_date").alias("first_request"),
        F.max("req_date").alias("last_request"))


def status_counts(spark: SparkSession, root: str) -> DataFrame:
    """Claims per decision, split by label."""
    return silver(spark, root).claims.groupBy("decision").agg(
        F.count("*").alias("claims"),
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(F.col("label") == 0).alias("negatives"))


def time_split(spark: SparkSession, root: str) -> DataFrame:
    claims = silver(spark, root).claims
    day = evaluate.split_day(claims)
    side = F.when(F.unix_date("req_date") <= F.lit(day), "train").otherwise("test")
    return claims.groupBy(side.alias("side")).agg(
        F.count("*").alias("claims"), F.sum("label").alias("positives"),
        F.min("req_date").alias("first_day"), F.max("req_date").alias("last_day"),
    ).withColumn("cut_day", F.lit(day))


# --- scores ------------------------------------------------------------------------------
def average_precision(spark: SparkSession, root: str) -> DataFrame:
    return evaluate.ranking_quality(spark, scored_lines(spark, root)).select(
        "rows", "positives", "average_precision")


def roc_auc(spark: SparkSession, root: str) -> DataFrame:
    return evaluate.ranking_quality(spark, scored_lines(spark, root)).select(
        "rows", "positives", "roc_auc")


def amount_ranking(spark: SparkSession, root: str) -> DataFrame:
    """Quality of the bare amount as a score: nearly every score is distinct."""
    lines = scored_lines(spark, root).withColumn("score", F.col("amount"))
    return evaluate.ranking_quality(spark, lines)


def threshold_sweep(spark: SparkSession, root: str) -> DataFrame:
    return evaluate.threshold_sweep(scored_lines(spark, root))


def best_threshold(spark: SparkSession, root: str) -> DataFrame:
    return evaluate.best_threshold(threshold_sweep(spark, root))


def capacity_cut(spark: SparkSession, root: str) -> DataFrame:
    return evaluate.capacity_cut(scored_claims(spark, root), REVIEWS_PER_DAY)


# --- queue -------------------------------------------------------------------------------
def queue_bands(spark: SparkSession, root: str) -> DataFrame:
    return queue_of(spark, root).select("claim_id", "score", "priority", "value_at_risk")


def queue_summary(spark: SparkSession, root: str) -> DataFrame:
    return queue.summary(queue_of(spark, root)).orderBy(F.col("amount").desc())


def queue_top20(spark: SparkSession, root: str) -> DataFrame:
    return queue.most_urgent(queue_of(spark, root))


def value_by_cell(spark: SparkSession, root: str) -> DataFrame:
    """Amount of hits, misses and false alarms at the chosen threshold."""
    hit, positive = F.col("score") >= THRESHOLD, F.col("label") == 1
    money = cents(F.col("amount"))
    def total(cell):
        return F.coalesce(F.sum(F.when(cell, money)).cast("double"), F.lit(0.0))
    return scored_claims(spark, root).agg(
        total(hit & positive).alias("hit_amount"), total(~hit & positive).alias("missed_amount"),
        total(hit & ~positive).alias("false_alarm_amount"))


def scenario_hits(spark: SparkSession, root: str) -> DataFrame:
    return scenarios.scenario_hits(gold(spark, root))


def scenario_recall(spark: SparkSession, root: str) -> DataFrame:
    return scenarios.scenario_quality(gold(spark, root))


def detection_by_scenario(spark: SparkSession, root: str) -> DataFrame:
    """Share of each scenario among the positives that the score reaches; a claim may show several."""
    queue_rows = queue_of(spark, root)
    answer_key = scenarios.scenario_hits(queue_rows.filter("label = 1"))
    return scenarios.detection_by_scenario(queue_rows, answer_key, THRESHOLD)


def alerts(spark: SparkSession, root: str) -> DataFrame:
    return queue.with_alerts(gold(spark, root)).select(
        "claim_id", F.concat_ws(",", "alerts").alias("alerts"), F.size("alerts").alias("n_alerts"))


def alert_rows(spark: SparkSession, root: str) -> DataFrame:
    return queue.alert_rows(gold(spark, root))


def explain_long(spark: SparkSession, root: str) -> DataFrame:
    return queue.explain_long(gold(spark, root))


def approved_amount(spark: SparkSession, root: str) -> DataFrame:
    """The refund of each claim: member to plan to percentage, nothing when denied."""
    d = silver(spark, root)
    member = lookup_join(
        d.members.select("member_id", "plan_id"), d.plans, ["plan_id"], "member_id")
    rows = lookup_join(d.claims, member, ["member_id"], "claim_id")
    return rows.select("claim_id", approved_column(
        F.col("amount"), F.col("plan_rate"), F.col("decision") == "F").alias("approved_amount"))


QUERIES = {
    f.__name__: f for f in (
        label_summary, rule_confusion, rule_precision_recall, leakage_correlation, dq_summary,
        status_counts, time_split, average_precision, roc_auc, amount_ranking, threshold_sweep,
        best_threshold, capacity_cut, queue_bands, queue_summary, queue_top20, value_by_cell,
        scenario_hits, scenario_recall, detection_by_scenario, alerts, alert_rows, explain_long,
        approved_amount)
}

_LINES = """
lines AS (SELECT l_discount * 10 AS score, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
  l_extendedprice AS amount FROM lineitem WHERE l_returnflag <> 'N')"""


def _ranking(score: str) -> str:
    return f"""WITH {_LINES},
g AS (SELECT {score} AS score, count(*) AS n, CAST(sum(label) AS BIGINT) AS tp FROM lines GROUP BY 1),
c AS (SELECT *, sum(n) OVER w AS cn, sum(tp) OVER w AS ctp FROM g
  WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
t AS (SELECT CAST(sum(n) AS BIGINT) AS "rows", CAST(sum(tp) AS BIGINT) AS positives FROM g),
s AS (SELECT sum(tp * (ctp / cn)) AS ap,
  sum(CAST(tp AS DOUBLE) * ((cn - ctp - (n - tp)) + 0.5 * (n - tp))) AS inv FROM c)
SELECT "rows", positives, positives / "rows" AS prevalence,
  round(ap / positives, 10) AS average_precision,
  round(1 - inv / (CAST(positives AS DOUBLE) * ("rows" - positives)), 10) AS roc_auc FROM s, t"""


_SWEEP = f"""WITH {_LINES},
cuts AS (SELECT i, 0.05::DOUBLE + i * 0.05::DOUBLE AS cut FROM range(19) r(i)),
x AS (SELECT i, count(*) FILTER (score >= cut) AS flagged,
  count(*) FILTER (score >= cut AND label = 1) AS tp, count(*) FILTER (label = 1) AS p,
  coalesce({q.money("amount")} FILTER (score >= cut AND label = 1), 0) AS saved,
  coalesce({q.money("amount")} FILTER (score < cut AND label = 1), 0) AS lost
  FROM cuts, lines GROUP BY i)
SELECT CAST(CAST((i + 1) * 5 AS DOUBLE) / 100 AS DOUBLE) AS threshold, flagged,
  CASE WHEN flagged = 0 THEN 0 ELSE tp / flagged END AS precision, tp / p AS recall,
  saved AS value_saved, lost AS value_lost, flagged * 40.0::DOUBLE AS review_cost,
  {q.rnd("saved - flagged * 40.0::DOUBLE", 2)} AS net_benefit FROM x"""
# an aggregate FILTER has to sit inside the cast
_SWEEP = _SWEEP.replace(
    "CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) FILTER (score >= cut AND label = 1)",
    "CAST(sum(CAST(amount AS DECIMAL(18,2))) FILTER (score >= cut AND label = 1) AS DOUBLE)",
).replace(
    "CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) FILTER (score < cut AND label = 1)",
    "CAST(sum(CAST(amount AS DECIMAL(18,2))) FILTER (score < cut AND label = 1) AS DOUBLE)")

# scenario and alert rules as SQL, in rule order
_SCENARIOS = {
    "assisted_claim": "out_of_network = 1 AND prov_members > 50 AND near_ceiling = 1",
    "splitting": "pair_claims_30d >= 3",
    "network_duplicate": "in_network_too = 1",
    "opportunistic_enrolment": "recent_enrolment = 1 AND price_ratio > 1",
    "recycled_document": "repeated_document = 1",
    "clinical_impossibility": "site_already_removed = 1",
}
_ALERTS = {
    "price_over_3x": "price_ratio > 3",
    "near_ceiling": "near_ceiling = 1",
    "concentrated_provider": "prov_members > 50",
    "pair_burst": "pair_claims_30d >= 3",
    "repeated_document": "repeated_document = 1",
    "paid_by_network": "in_network_too = 1",
    "site_already_removed": "site_already_removed = 1",
    "first_120_days": "recent_enrolment = 1",
}


def _hits(rules: dict[str, str], column: str, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT claim_id, '{n}' AS {column} FROM {source} WHERE {r}" for n, r in rules.items())


_EXPLAIN = " UNION ALL ".join(
    f"SELECT claim_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, "
    f"'{'entity' if c[:5] in ('prov_', 'mem_c', 'mem_t', 'mem_p') else 'claim'}' AS origin FROM features"
    for c in (
        "amount", "price_ratio", "days_since_enrolment", "recent_enrolment", "out_of_network",
        "region_mismatch", "near_ceiling", "days_to_request", "prov_claims", "prov_members",
        "prov_mean_amount", "prov_near_ceiling_share", "mem_claims", "mem_total_amount",
        "mem_providers", "pair_claims_30d", "repeated_document", "in_network_too",
        "site_already_removed", "plan_rate"))

ORACLE = {
    "label_summary": f"""WITH {q.CLAIMS}
SELECT label, count(*) AS claims, {q.rnd(q.money("amount") + " / count(*)", 2)} AS mean_amount,
       {q.money("amount")} AS total_amount FROM claims GROUP BY label""",
    "rule_confusion": f"""WITH {q.CLAIMS}
SELECT CASE WHEN amount > 60000 THEN 1 ELSE 0 END AS flagged, label, count(*) AS n
FROM claims GROUP BY ALL""",
    "rule_precision_recall": f"""WITH {q.CLAIMS},
m AS (SELECT count(*) FILTER (amount > 60000 AND label = 1) AS tp,
  count(*) FILTER (amount > 60000 AND label = 0) AS fp,
  count(*) FILTER (amount <= 60000 AND label = 1) AS fn FROM claims)
SELECT tp, fp, fn, tp / greatest(tp + fp, 1) AS precision, tp / greatest(tp + fn, 1) AS recall FROM m""",
    "leakage_correlation": f"""WITH {q.CLAIMS}, {q.MEMBERS}, {q.PLANS},
x AS (SELECT label::DOUBLE AS label, decision = 'F' AS denied, decision <> 'F' AND claim_id % 3 = 0 AS pending,
  amount, plan_rate, claim_id FROM claims LEFT JOIN members USING (member_id) LEFT JOIN plans USING (plan_id)),
y AS (SELECT label, CASE WHEN denied THEN 1.0::DOUBLE ELSE 0 END AS status,
  CASE WHEN pending THEN NULL WHEN denied THEN 0.0::DOUBLE ELSE {q.rnd("amount * plan_rate", 2)} END AS approved_amount,
  CASE WHEN denied THEN CASE WHEN claim_id % 2 = 0 THEN 1.0::DOUBLE ELSE 0 END END AS denial_reason,
  CASE WHEN NOT pending THEN (claim_id % 10 + 1)::DOUBLE END AS review_date FROM x)
{" UNION ALL ".join(f"""SELECT '{c}' AS candidate, round(corr({c}, label), 8) AS correlation,
  round(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END), 8) AS null_rate FROM y"""
  for c in ("status", "approved_amount", "denial_reason", "review_date"))}""",
    "dq_summary": f"""WITH {q.CLAIMS}
SELECT count(*) AS claims, CAST(sum(label) AS BIGINT) AS positives,
  {q.rnd("100.0 * sum(label) / count(*)", 2)} AS pct_positive, {q.money("amount")} AS total_amount,
  {q.money("CASE WHEN label = 1 THEN amount END")} AS amount_at_risk,
  min(req_date) AS first_request, max(req_date) AS last_request FROM claims""",
    "status_counts": f"""WITH {q.CLAIMS}
SELECT decision, count(*) AS claims, count(*) FILTER (label = 1) AS positives,
  count(*) FILTER (label = 0) AS negatives FROM claims GROUP BY decision""",
    "time_split": f"""WITH {q.CLAIMS},
n AS (SELECT *, date_diff('day', DATE '1970-01-01', req_date) AS d FROM claims),
k AS (SELECT quantile_cont(CAST(d AS DOUBLE), 0.8) AS cut_day FROM n)
SELECT CASE WHEN d <= cut_day THEN 'train' ELSE 'test' END AS side, count(*) AS claims,
  CAST(sum(label) AS BIGINT) AS positives, min(req_date) AS first_day, max(req_date) AS last_day,
  cut_day FROM n, k GROUP BY ALL""",
    "average_precision": f'SELECT "rows", positives, average_precision FROM ({_ranking("score")})',
    "roc_auc": f'SELECT "rows", positives, roc_auc FROM ({_ranking("score")})',
    "amount_ranking": _ranking("amount"),
    "threshold_sweep": _SWEEP,
    "best_threshold": f"SELECT * FROM ({_SWEEP}) ORDER BY net_benefit DESC, threshold LIMIT 1",
    "capacity_cut": f"""WITH {q.SCORED},
k AS (SELECT *, row_number() OVER (PARTITION BY req_date ORDER BY score DESC, claim_id) AS rn FROM scored)
SELECT req_date, count(*) AS kept, min(score) AS implied_threshold FROM k WHERE rn <= 3 GROUP BY req_date""",
    "queue_bands": f"WITH {q.QUEUE} SELECT claim_id, score, priority, value_at_risk FROM queue",
    "queue_summary": f"""WITH {q.QUEUE}
SELECT priority, count(*) AS claims, {q.money("amount")} AS amount,
  {q.rnd("100.0 * sum(label) / count(*)", 2)} AS pct_positive FROM queue GROUP BY priority""",
    "queue_top20": f"""WITH {q.QUEUE}
SELECT claim_id, member_id, provider_id, proc_code, amount, price_ratio, prov_members,
  pair_claims_30d, repeated_document, in_network_too, site_already_removed, score, priority
FROM queue WHERE priority IN ('CRITICA', 'ALTA') ORDER BY score DESC, claim_id LIMIT 20""",
    "value_by_cell": f"""WITH {q.SCORED}
SELECT {q.money("CASE WHEN score >= 0.3 AND label = 1 THEN amount ELSE 0 END")} AS hit_amount,
  {q.money("CASE WHEN score < 0.3 AND label = 1 THEN amount ELSE 0 END")} AS missed_amount,
  {q.money("CASE WHEN score >= 0.3 AND label = 0 THEN amount ELSE 0 END")} AS false_alarm_amount
FROM scored""",
    "scenario_hits": f"WITH {q.FEATURES} " + _hits(_SCENARIOS, "scenario", "features"),
    "scenario_recall": f"WITH {q.FEATURES}, t AS (SELECT count(*) FILTER (label = 1) AS p FROM features) "
    + " UNION ALL ".join(
        f"""SELECT '{n}' AS scenario, count(*) FILTER ({r}) AS hits,
  count(*) FILTER ({r} AND label = 1) AS true_hits,
  coalesce(count(*) FILTER ({r} AND label = 1) / nullif(count(*) FILTER ({r}), 0), 0) AS precision,
  coalesce(count(*) FILTER ({r} AND label = 1) / nullif(any_value(p), 0), 0) AS recall
  FROM features, t""" for n, r in _SCENARIOS.items()),
    "detection_by_scenario": f"""WITH {q.SCORED},
hits AS ({_hits(_SCENARIOS, "scenario", "scored")})
SELECT scenario, count(*) AS claims, {q.rnd("avg(score)", 6)} AS mean_score,
  {q.rnd("100.0 * count(*) FILTER (score >= 0.3) / count(*)", 1)} AS pct_detected,
  {q.money("amount")} AS amount
FROM scored LEFT JOIN hits USING (claim_id) WHERE label = 1 GROUP BY scenario""",
    "alerts": f"""WITH {q.FEATURES},
a AS (SELECT claim_id, list_filter([{", ".join(f"CASE WHEN {r} THEN '{n}' END" for n, r in _ALERTS.items())}],
  lambda x: x IS NOT NULL) AS l FROM features)
SELECT claim_id, coalesce(array_to_string(l, ','), '') AS alerts, CAST(len(l) AS INTEGER) AS n_alerts FROM a""",
    "alert_rows": f"WITH {q.FEATURES} " + _hits(_ALERTS, "alert", "features"),
    "explain_long": f"WITH {q.FEATURES} " + _EXPLAIN,
    "approved_amount": f"""WITH {q.CLAIMS}, {q.MEMBERS}, {q.PLANS}
SELECT claim_id, CASE WHEN decision = 'F' THEN 0.0::DOUBLE
  ELSE {q.rnd("amount * plan_rate", 2)} END AS approved_amount
FROM claims LEFT JOIN members USING (member_id) LEFT JOIN plans USING (plan_id)""",
}
