"""Entity history and cross-table signals on hand-written rows and against window forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimrisk.operators import entity, joins
from claimrisk.plans import features, lake
from claimrisk.sources import domain

D0 = dt.date(2025, 1, 1)
CLAIM = ("claim_id long, member_id long, provider_id long, proc_code string, site string, "
         "proc_date date, req_date date, amount double, document string, label int")
NET = ("procedure_id long, member_id long, provider_id long, proc_code string, site string, "
       "proc_date date, amount double")


def claim(i, member=1, provider=1, code="A", site="11", day=0, amount=100.0, document=None):
    d = D0 + dt.timedelta(days=day)
    return (i, member, provider, code, site, d, d, amount, document or f"N{i}", 0)


def net(i, member=1, code="A", site="11", day=0, amount=50.0):
    return (i, member, 1, code, site, D0 + dt.timedelta(days=day), amount)


def table(spark, claims, network=()):
    d = domain.Domain(
        claims=spark.createDataFrame(claims, CLAIM),
        network=spark.createDataFrame(list(network), NET),
        members=spark.createDataFrame(
            [(1, "SP", 7, D0), (2, "AM", 8, None)], "member_id long, region string, plan_id long, enrolled_on date"),
        providers=spark.createDataFrame(
            [(1, "SP", True)], "provider_id long, region string, in_network boolean"),
        plans=spark.createDataFrame([(7, 0.7)], "plan_id long, plan_rate double"),
        event_code="X")
    return {r["claim_id"]: r for r in features.feature_table(spark, d).collect()}


def test_burst_counts_both_ends(spark):
    rows = table(spark, [claim(1, day=0), claim(2, day=30), claim(3, day=31), claim(4, provider=2, day=31)])
    assert [rows[i]["pair_claims_30d"] for i in (1, 2, 3, 4)] == [1, 2, 2, 1]


def test_burst_counts_same_day_ties(spark):
    rows = table(spark, [claim(1), claim(2)])
    assert [rows[i]["pair_claims_30d"] for i in (1, 2)] == [2, 2]


def test_repeated_document(spark):
    rows = table(spark, [claim(1, document="a"), claim(2, document="a"), claim(3, document="b")])
    assert [rows[i]["repeated_document"] for i in (1, 2, 3)] == [1, 1, 0]


def test_missing_documents_never_match(spark):
    claims = [claim(i) for i in range(1, 5)]
    claims = [c[:8] + (None,) + c[9:] for c in claims]
    rows = table(spark, claims)
    assert [r["repeated_document"] for r in rows.values()] == [0] * 4


def test_network_mark_null_site_and_no_fan_out(spark):
    rows = table(
        spark, [claim(1, site=None), claim(2, site="12"), claim(3, member=2, site=None)],
        [net(1, site=None), net(2, site=None), net(3, site=None)])
    assert len(rows) == 3
    assert [rows[i]["in_network_too"] for i in (1, 2, 3)] == [1, 0, 0]


def test_prior_event_is_strict_and_needs_a_site(spark):
    rows = table(
        spark, [claim(1, day=5), claim(2, day=6), claim(3, day=9, site=None)],
        [net(1, code="X", day=5), net(2, code="X", day=8), net(3, code="X", site=None, day=1)])
    assert [rows[i]["site_already_removed"] for i in (1, 2, 3)] == [0, 1, 0]


def test_unknown_provider_and_plan_keep_the_claim(spark):
    rows = table(spark, [claim(1, member=2, provider=99)], [net(1, code="B")])
    r = rows[1]
    assert (r["out_of_network"], r["region_mismatch"], r["recent_enrolment"]) == (0, 0, 0)
    assert r["price_ratio"] is None and r["plan_rate"] is None


def random_claims(seed, n=400):
    rng = random.Random(seed)
    return [claim(i, member=rng.choice([1, 1, 1, 2, 3]), provider=rng.choice([1, 1, 2, 3]),
                  code=rng.choice("AB"), site=rng.choice([None, "11", "12"]), day=rng.randrange(200),
                  amount=rng.choice([100.0, 1300.0, 1450.55]), document=f"N{rng.randrange(300)}")
            for i in range(n)]


def test_entity_features_equal_the_window_form(spark):
    rows = spark.createDataFrame(random_claims(1), CLAIM)
    prov, mem = Window.partitionBy("provider_id"), Window.partitionBy("member_id")
    pair = (Window.partitionBy("member_id", "provider_id").orderBy(F.unix_date("proc_date"))
            .rangeBetween(-30, 0))
    near = F.when((F.col("amount") > 1275) & (F.col("amount") <= 1500), 1).otherwise(0)
    expected = rows.select(
        "claim_id",
        F.count("claim_id").over(prov).alias("prov_claims"),
        F.size(F.collect_set("member_id").over(prov)).cast("long").alias("prov_members"),
        F.round(F.avg("amount").over(prov), 2).alias("prov_mean_amount"),
        F.round(F.avg(near).over(prov), 4).alias("prov_near_ceiling_share"),
        F.count("claim_id").over(mem).alias("mem_claims"),
        F.round(F.sum("amount").over(mem), 2).alias("mem_total_amount"),
        F.size(F.collect_set("provider_id").over(mem)).cast("long").alias("mem_providers"),
        F.count("claim_id").over(pair).alias("pair_claims_30d"))
    got = table(spark, random_claims(1))
    for r in expected.collect():
        for c in expected.columns[1:]:
            assert got[r["claim_id"]][c] == r[c], c


@pytest.mark.parametrize("hot_rows", [3, 25])
def test_hot_keys_do_not_change_the_feature_table(spark, root, monkeypatch, hot_rows):
    d = lake.silver(spark, root)
    plain = features.feature_table(spark, d)
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    spread = features.feature_table(spark, d)
    assert not joins.hot_keys(features.stage(spark, d).members, ["member_id"], "mem_claims").isEmpty()
    assert plain.count() == spread.count()
    assert plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()


def test_hot_key_is_dealt_out_over_its_splits(spark):
    rows = spark.range(1000).select(F.col("id").alias("row"), F.lit(5).cast("long").alias("k"))
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    hot = joins.hot_keys(counts, ["k"], "n", hot_rows=100)
    assert hot.collect()[0]["_splits"] == 10
    slots = joins.KeySlots("k", hot)
    sizes = [r["count"] for r in slots.place(rows, "row").groupBy("_slot").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 200
    right = spark.createDataFrame([(5, "x")], "k long, v string")
    joined = joins.spread_left_join(rows, right, ["k"], "row", hot)
    assert joined.filter("v = 'x'").count() == 1000
    assert slots.left_join(slots.place(rows, "row"), right).filter("v = 'x'").count() == 1000


def test_daily_rows_bound_the_burst_window(spark):
    rows = spark.createDataFrame([claim(i, day=i % 3) for i in range(300)], CLAIM)
    assert entity.daily_pairs(rows).count() == 3


def test_network_without_rows(spark):
    rows = table(spark, [claim(1)])
    assert rows[1]["in_network_too"] == 0 and rows[1]["price_ratio"] is None


def test_lines_move_by_their_order_once(spark, root):
    from claimrisk.sources.domain import treatments
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = treatments(spark, root)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("hashpartitioning(l_orderkey") == 1
    assert plan.count("hashpartitioning(l_partkey") == 1


def test_claims_do_not_move_by_document(spark, root):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = features.feature_table(spark, lake.silver(spark, root), lake.staged(spark, root))
        plan = rows._jdf.queryExecution().executedPlan()
        exchanges, todo = [], [plan.initialPlan()]
        while todo:
            node = todo.pop()
            if node.nodeName() == "Exchange" and "hashpartitioning(document" in node.simpleString(1000):
                exchanges.append(node.output().mkString(" "))
            todo += [node.children().apply(i) for i in range(node.children().size())]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert exchanges and not any("amount" in columns for columns in exchanges)


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_repeated_documents_with_and_without_members(spark, monkeypatch, hot_rows):
    from collections import Counter
    monkeypatch.setattr(joins, "HOT_ROWS", hot_rows)
    rows = [claim(i, member=(None, 1, 2, 3)[i % 4], document=(None, "a", "b", f"own {i}", "b")[i % 5])
            for i in range(23)]
    rows += [claim(100, member=None, document="twice"), claim(101, member=9, document="twice")]
    rows += [claim(102)[:8] + (None, 0), claim(103, member=None)[:8] + (None, 0)]
    df = spark.createDataFrame(rows, CLAIM)
    counts = Counter(r.document for r in df.collect() if r.document)
    got = table(spark, rows)
    assert len(got) == len(rows)
    for r in df.collect():
        assert got[r.claim_id].repeated_document == int(counts[r.document] > 1), r


def test_entities_from_days_are_those_from_pairs(spark):
    daily = entity.daily_pairs(spark.createDataFrame(
        [*random_claims(5), claim(900, member=None), claim(901, member=None, day=3)], CLAIM))
    pairs, days = entity.pair_totals(daily), entity.pair_burst(daily)
    for of, other in ((entity.provider_features, "member_id"), (entity.member_features, "provider_id")):
        expected, got = of(pairs), of(entity.once_a_pair(days, other))
        assert expected.count() and expected.exceptAll(got).isEmpty() and got.exceptAll(expected).isEmpty()


def test_short_rows_of_numbers_are_broadcast_up_to_more_rows(spark):
    numbers = spark.range(3).selectExpr("id", "id AS a", "DATE '2020-01-01' AS b", "true AS c", "1.5D AS d")
    assert joins.broadcast_rows(numbers) == 8 * joins.BROADCAST_ROWS
    assert joins.broadcast_rows(numbers.withColumn("name", F.lit("x"))) == joins.BROADCAST_ROWS
