"""Published snapshots, their checks and differences, the queue and the scenarios."""

import os

import pytest
from pyspark.sql import functions as F

from claimrisk.operators import publish, queue, scenarios
from claimrisk.plans import lake
from claimrisk.plans.sqlparts import SCORE_SQL
from claimrisk.schemas import FEATURES, PROVIDER_FEATURES


def kv(spark, rows):
    return spark.createDataFrame(rows, "k long, v double")


def test_key_check(spark):
    r = publish.key_check(kv(spark, [(1, 1.0), (1, 2.0), (None, 1.0), (2, 1.0)]), "k").first()
    assert (r["rows"], r["null_keys"], r["duplicate_keys"]) == (4, 1, 1)


def test_publish_refuses_bad_keys_and_replaces_the_snapshot(spark):
    with pytest.raises(ValueError):
        publish.publish_snapshot(kv(spark, [(1, 1.0), (1, 2.0)]), "k", "published_kv")
    publish.publish_snapshot(kv(spark, [(1, 1.0), (2, 2.0)]), "k", "published_kv")
    publish.publish_snapshot(kv(spark, [(3, 3.0)]), "k", "published_kv")
    with pytest.raises(ValueError):
        publish.publish_snapshot(kv(spark, [(None, 1.0)]), "k", "published_kv")
    assert [tuple(r) for r in spark.table("published_kv").select("k", "v").collect()] == [(3, 3.0)]
    spark.sql("DROP TABLE published_kv")


def test_changes_are_applied_to_their_buckets_only(spark):
    old = kv(spark, [(i, float(i)) for i in range(200)])
    new = old.where("k <> 7 AND k < 190").withColumn("v", F.when(F.col("k") == 3, -1.0).otherwise(F.col("v"))).unionByName(
        kv(spark, [(1000, 1.0)]))
    publish.publish_snapshot(old, "k", "changed_kv", 64)
    path = spark.sql("DESCRIBE EXTENDED changed_kv").where("col_name = 'Location'").first()["data_type"].removeprefix("file:")

    def files():
        return {f for d in os.listdir(path) if d.startswith("bucket=") for f in os.listdir(f"{path}/{d}") if "parquet" in f}
    before = files()
    delta = publish.changes(old, new, "k", ["v"])
    touched = publish.apply_changes(spark, "changed_kv", delta, "k", 64)
    assert 0 < touched < 20 and len(before & files()) >= len(before) - touched
    got = sorted(tuple(r) for r in spark.table("changed_kv").select("k", "v").collect())
    assert got == sorted(tuple(r) for r in new.collect())
    assert publish.apply_changes(spark, "changed_kv", publish.changes(new, new, "k", ["v"]), "k", 64) == 0
    everything = publish.changes(new, new.where("false"), "k", ["v"])
    publish.apply_changes(spark, "changed_kv", everything, "k", 64)
    assert spark.table("changed_kv").count() == 0
    spark.sql("DROP TABLE changed_kv")


def test_changes(spark):
    old, new = kv(spark, [(1, 1.0), (2, 2.0), (3, None)]), kv(spark, [(2, 2.5), (3, None), (4, 4.0)])
    got = {r["k"]: (r["change"], r["v"]) for r in publish.changes(old, new, "k", ["v"]).collect()}
    assert got == {1: ("delete", None), 2: ("update", 2.5), 4: ("insert", 4.0)}


def test_parity(spark):
    left, right = kv(spark, [(1, 1.0), (2, 2.0), (5, None), (6, 1.0)]), kv(spark, [(1, 1.0 + 1e-9), (2, 2.1), (5, 1.0), (7, 0.0)])
    r = publish.parity(left, right, "k", ["v"]).first()
    assert (r["compared"], r["left_only"], r["right_only"], r["beyond_tolerance"]) == (3, 1, 1, 2)
    assert r["max_gap"] == pytest.approx(0.1)


def test_online_vectors_equal_batch_and_new_entities_get_minus_one(spark, root):
    s, gold = lake.staged(spark, root), lake.gold(spark, root)
    own = gold.drop(*PROVIDER_FEATURES, "mem_claims", "mem_total_amount", "mem_providers")
    online = publish.online_vectors(own, s.providers, s.members, s.hot_providers, s.hot_members)
    report = publish.parity(gold.na.fill(-1), online, "claim_id", FEATURES)
    assert report.agg(F.sum("beyond_tolerance"), F.sum("left_only"), F.sum("right_only")).first()[:] == (0, 0, 0)
    nobody = publish.online_vectors(
        own, s.providers.filter("false"), s.members, s.hot_providers, s.hot_members)
    assert nobody.agg(*[F.max(c).alias(c) for c in PROVIDER_FEATURES]).first()[:] == (-1.0,) * 4


def test_queue_columns_and_order(spark, root):
    q = queue.build_queue(lake.gold(spark, root).withColumn("score", F.expr(SCORE_SQL)), 0.3)
    top = queue.most_urgent(q)
    assert len(top.columns) == 13
    scores = [r["score"] for r in top.collect()]
    assert scores == sorted(scores, reverse=True) and len(scores) <= 20
    assert queue.explain_long(lake.gold(spark, root)).count() == 20 * q.count()


def test_scenarios_mark_each_pattern(spark):
    names = ("claim_id out_of_network prov_members near_ceiling pair_claims_30d in_network_too "
             "recent_enrolment price_ratio repeated_document site_already_removed label").split()
    rows = [(1, 1, 51, 1, 1, 0, 0, 1.0, 0, 0, 1), (2, 0, 99, 1, 3, 1, 1, 1.5, 1, 1, 0),
            (3, 0, 0, 0, 0, 0, 1, None, 0, 0, 1)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'double' if n == 'price_ratio' else 'int'}" for n in names))
    hits = {(r["claim_id"], r["scenario"]) for r in scenarios.scenario_hits(df).collect()}
    assert hits == {(1, "assisted_claim"), (2, "splitting"), (2, "network_duplicate"),
                    (2, "opportunistic_enrolment"), (2, "recycled_document"), (2, "clinical_impossibility")}
    quality = {r["scenario"]: (r["hits"], r["precision"], r["recall"]) for r in scenarios.scenario_quality(df).collect()}
    assert quality["assisted_claim"] == (1, 1.0, 0.5) and quality["splitting"] == (1, 0.0, 0.0)
