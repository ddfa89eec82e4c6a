"""Queries over published features: snapshots, checks, differences, vectors and parity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.functions import payload
from claimrisk.functions.columns import vector_columns
from claimrisk.operators import entity, publish, queue
from claimrisk.operators.ranking import top
from claimrisk.plans import sqlparts as q
from claimrisk.plans.lake import gold, silver, staged
from claimrisk.schemas import FEATURES, MEMBER_FEATURES, PROVIDER_FEATURES
from claimrisk.session import written
from claimrisk.sources.tables import own_database, read_table


CUT = "1999-06-01"


def publish_provider(spark: SparkSession, root: str) -> DataFrame:
    """One row per provider, from the written summaries."""
    return staged(spark, root).providers


def publish_member(spark: SparkSession, root: str) -> DataFrame:
    """One row per member, from the written summaries."""
    return staged(spark, root).members


def published_top10(spark: SparkSession, root: str) -> DataFrame:
    return top(publish_provider(spark, root), 10, F.col("prov_members").desc(), "provider_id")


def publish_dq(spark: SparkSession, root: str) -> DataFrame:
    """Null and repeated keys of the published tables, and of the daily table by its member alone."""
    tables = [("provider", publish_provider(spark, root), "provider_id"),
              ("member", publish_member(spark, root), "member_id"),
              ("pair_day", staged(spark, root).daily, "member_id")]
    checks = [publish.key_check(df, key).withColumn("table_name", F.lit(name))
              for name, df, key in tables]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


def publish_diff(spark: SparkSession, root: str) -> DataFrame:
    """What changes in the member features between a cut day and the end of the history."""
    d = silver(spark, root)
    before = d.claims.filter(F.col("req_date") < CUT)
    old = entity.member_features(entity.pair_totals(entity.daily_pairs(before, d.ceiling)))
    return publish.changes(old, staged(spark, root).members, "member_id", MEMBER_FEATURES)


def publish_apply(spark: SparkSession, root: str) -> DataFrame:
    """The member features of the cut day, published, and brought up to date by their changes alone."""
    d = silver(spark, root)
    before = d.claims.filter(F.col("req_date") < CUT)
    old = written(spark, entity.member_features(entity.pair_totals(entity.daily_pairs(before, d.ceiling))), "old")
    new = staged(spark, root).members
    with own_database(spark, "published") as name:
        table = f"{name}.members"
        publish.publish_snapshot(old, "member_id", table)
        publish.apply_changes(
            spark, table, publish.changes(old, new, "member_id", MEMBER_FEATURES), "member_id")
        return written(spark, spark.table(table).select("member_id", *MEMBER_FEATURES), "applied")


def online_vector(spark: SparkSession, root: str) -> DataFrame:
    """The 20 model inputs per claim, history taken from the published tables."""
    s = staged(spark, root)
    own = gold(spark, root).drop(*PROVIDER_FEATURES, *MEMBER_FEATURES)
    return publish.online_vectors(own, s.providers, s.members, s.hot_providers, s.hot_members)


def score_parity(spark: SparkSession, root: str) -> DataFrame:
    """All model inputs of the batch table against the online vectors, with one planted difference.

    The claim with the smallest id gets one provider claim too many, which the check must find.
    """
    rows = gold(spark, root)
    planted = rows.agg(F.min("claim_id")).first()[0]
    online = online_vector(spark, root).withColumn("prov_claims", F.when(
        F.col("claim_id") == planted, F.col("prov_claims") + 1).otherwise(F.col("prov_claims")))
    return publish.parity(
        rows.select("claim_id", *vector_columns()), online, "claim_id", FEATURES)


def replica_parity(spark: SparkSession, root: str) -> DataFrame:
    """Published provider features against those collapsed from the feature table."""
    replica = publish.collapse(gold(spark, root), "provider_id", PROVIDER_FEATURES)
    return publish.parity(publish_provider(spark, root), replica, "provider_id", PROVIDER_FEATURES)


def request_payload(spark: SparkSession, root: str) -> DataFrame:
    """Each claim's scoring request as JSON, read back into the inputs."""
    requests = gold(spark, root).select("claim_id", payload.records_payload().alias("request"))
    return requests.select(
        "claim_id", payload.read_payload(F.col("request")).alias("record")).select("claim_id", "record.*")


def scores_joined_back(spark: SparkSession, root: str) -> DataFrame:
    """Scores returned as JSON by claim, joined back to the features and banded."""
    rows = gold(spark, root)
    answers = rows.select("claim_id", F.to_json(F.struct(F.array(
        F.expr(q.SCORE_SQL)).alias("predictions"))).alias("response"))
    scores = answers.select("claim_id", payload.first_prediction(F.col("response")).alias("score"))
    return queue.build_queue(queue.attach_scores(rows, scores), 0.30).select(
        "claim_id", "score", "priority", "value_at_risk")


def response_texts(spark: SparkSession, root: str) -> DataFrame:
    """Turns of the conversations wrapped in the three response shapes and read back."""
    text, shape = F.col("text"), F.col("turn") % 3
    part = F.struct(F.lit("output_text").alias("type"), text.alias("text"))
    said = F.struct(text.alias("content"))
    response = (
        F.when(shape == 0, F.to_json(F.struct(
            F.array(F.struct(F.array(part).alias("content"))).alias("output"))))
        .when(shape == 1, F.to_json(F.struct(F.array(F.struct(said.alias("message"))).alias("choices"))))
        .otherwise(F.to_json(F.struct(F.array(said).alias("messages"))))
    )
    return read_table(spark, root, "conversations").select(
        "conv_id", "turn", response.alias("response")).select(
        "conv_id", "turn", payload.response_text(F.col("response")).alias("text"))


QUERIES = {
    f.__name__: f for f in (
        publish_provider, publish_member, published_top10, publish_dq, publish_diff, publish_apply,
        online_vector, score_parity, replica_parity, request_payload, scores_joined_back,
        response_texts)
}

_FIRST = ",".join([q.CLAIMS, q.PROVIDER_TABLE, q.MEMBER_TABLE])


def _snapshot(condition: str) -> str:
    return f"""SELECT member_id, count(*) AS mem_claims, {q.money("amount")} AS mem_total_amount,
  count(DISTINCT provider_id) AS mem_providers FROM claims WHERE {condition} GROUP BY member_id"""


ORACLE = {
    "publish_provider": f"WITH {_FIRST} SELECT * FROM prov",
    "publish_member": f"WITH {_FIRST} SELECT * FROM mem",
    "publish_apply": f"WITH {_FIRST} SELECT * FROM mem",
    "published_top10": f"WITH {_FIRST} SELECT * FROM prov ORDER BY prov_members DESC, provider_id LIMIT 10",
    "publish_dq": f"""WITH {_FIRST},
x AS (SELECT DISTINCT member_id, provider_id, proc_date FROM claims)
SELECT 'provider' AS table_name, count(*) AS "rows", 0::BIGINT AS null_keys, 0::BIGINT AS duplicate_keys FROM prov
UNION ALL SELECT 'member', count(*), 0, 0 FROM mem
UNION ALL SELECT 'pair_day', (SELECT count(*) FROM x), 0,
  (SELECT count(*) FROM (SELECT member_id FROM x GROUP BY member_id HAVING count(*) > 1))""",
    "publish_diff": f"""WITH {q.CLAIMS}, o AS ({_snapshot(f"req_date < DATE '{CUT}'")}),
n AS ({_snapshot("TRUE")})
SELECT coalesce(n.member_id, o.member_id) AS member_id,
  CASE WHEN o.member_id IS NULL THEN 'insert' WHEN n.member_id IS NULL THEN 'delete' ELSE 'update' END AS change,
  n.mem_claims, n.mem_total_amount, n.mem_providers
FROM o FULL JOIN n ON o.member_id = n.member_id
WHERE o.member_id IS NULL OR n.member_id IS NULL OR o.mem_claims <> n.mem_claims
  OR o.mem_total_amount <> n.mem_total_amount OR o.mem_providers <> n.mem_providers""",
    "online_vector": f"WITH {q.FEATURES} SELECT claim_id, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), -1) AS {c}" for c in FEATURES) + " FROM features",
    "scores_joined_back": f"WITH {q.QUEUE} SELECT claim_id, score, priority, value_at_risk FROM queue",
    "response_texts": "SELECT conv_id, turn, text FROM conversations",
    "score_parity": f"""WITH {q.CLAIMS}
SELECT c AS column_name, CASE WHEN c = 'prov_claims' THEN 1 ELSE 0 END::DOUBLE AS max_gap,
  CASE WHEN c = 'prov_claims' THEN 1 ELSE 0 END::BIGINT AS beyond_tolerance,
  (SELECT count(*) FROM claims) AS compared, 0::BIGINT AS left_only, 0::BIGINT AS right_only
FROM (VALUES {", ".join(f"('{c}')" for c in FEATURES)}) v(c)""",
    "replica_parity": f"""WITH {_FIRST}
SELECT c AS column_name, 0::DOUBLE AS max_gap, 0::BIGINT AS beyond_tolerance,
  (SELECT count(*) FROM prov) AS compared, 0::BIGINT AS left_only, 0::BIGINT AS right_only
FROM (VALUES {", ".join(f"('{c}')" for c in PROVIDER_FEATURES)}) v(c)""",
}
ORACLE["request_payload"] = ORACLE["online_vector"]
