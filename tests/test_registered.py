"""Every registered query against its checking SQL on the smallest data folder."""

import pytest

import __spark_entry__ as entry
from tests.compare import differences, duck

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(root):
    return duck(root)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, root, con, name):
    df = QUERIES[name](spark, root)
    if name in ORACLE:
        assert differences(df, con, ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_names_match():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "provider_id" in df.columns


def test_every_order_line_is_a_treatment(spark, root):
    from claimrisk.plans.lake import silver
    d = silver(spark, root)
    ids = d.claims.select("claim_id").union(d.network.select("procedure_id"))
    lines = spark.read.parquet(f"{root}/lineitem.parquet").count()
    assert ids.count() == ids.distinct().count() == lines


@pytest.mark.parametrize("name", ["find_providers", "lookup_chain", "nearest_k", "detection_by_scenario",
                                  "publish_diff", "stream_score", "stream_burst_1h"])
def test_there_are_rows(spark, root, name):
    assert QUERIES[name](spark, root).count() > 0


def test_searches_hit_and_members_find_themselves(spark, root):
    assert max(r.hits for r in QUERIES["search_counts"](spark, root).collect()) > 0
    found = QUERIES["member_lookup"](spark, root).collect()
    assert found and all(r.asked_by == r.member_id for r in found)


def test_planted_gap_is_found(spark, root):
    gaps = {r.column_name: r.beyond_tolerance for r in QUERIES["score_parity"](spark, root).collect()}
    assert gaps.pop("prov_claims") == 1 and set(gaps.values()) == {0}
