"""Boundary rows of the claim-level expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from claimrisk.functions import columns
from claimrisk.schemas import (
    AFTER_DECISION,
    CONTRACT_NAMES,
    ENTITY_FEATURES,
    FEATURES,
    OWN_FEATURES,
)

DAY = dt.date(2025, 6, 1)
SCHEMA = ("amount double, reference_price double, proc_date date, req_date date, enrolled_on date, "
          "in_network boolean, region string, provider_region string")


def own(spark, **changes):
    row = dict(amount=100.0, reference_price=50.0, proc_date=DAY, req_date=DAY, enrolled_on=DAY,
               in_network=True, region="SP", provider_region="SP") | changes
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    df = spark.createDataFrame([tuple(row[n] for n in names)], SCHEMA)
    return df.withColumns(columns.own_columns()).first()


@pytest.mark.parametrize("amount,expected", [(1275.0, 0), (1275.01, 1), (1500.0, 1), (1500.01, 0)])
def test_near_ceiling_is_open_below_and_closed_above(spark, amount, expected):
    assert own(spark, amount=amount)["near_ceiling"] == expected


@pytest.mark.parametrize("days,expected", [(120, 1), (121, 0), (-5, 1)])
def test_recent_enrolment(spark, days, expected):
    row = own(spark, enrolled_on=DAY - dt.timedelta(days=days))
    assert row["days_since_enrolment"] == days
    assert row["recent_enrolment"] == expected


def test_missing_values_give_flag_zero(spark):
    row = own(spark, enrolled_on=None, in_network=None, provider_region=None, reference_price=None)
    assert (row["recent_enrolment"], row["out_of_network"], row["region_mismatch"]) == (0, 0, 0)
    assert row["price_ratio"] is None


def test_ratio_is_rounded_and_survives_a_zero_price(spark):
    assert own(spark, amount=100.0, reference_price=3.0)["price_ratio"] == 33.3333
    assert own(spark, reference_price=0.0)["price_ratio"] is None


@pytest.mark.parametrize("score,threshold,expected", [
    (0.80, 0.30, "CRITICA"), (0.79, 0.30, "ALTA"), (0.30, 0.30, "ALTA"), (0.29, 0.30, "MEDIA"),
    (0.15, 0.30, "MEDIA"), (0.14, 0.30, "BAIXA"), (0.85, 0.90, "CRITICA")])
def test_bands(spark, score, threshold, expected):
    df = spark.createDataFrame([(score,)], "score double")
    assert df.select(columns.band(F.col("score"), threshold)).first()[0] == expected


def test_approved_amount(spark):
    df = spark.createDataFrame([(1000.0, 0.7, False), (1000.0, 0.7, True)], "a double, r double, d boolean")
    got = [r[0] for r in df.select(columns.approved_amount(F.col("a"), F.col("r"), F.col("d"))).collect()]
    assert got == [700.0, 0.0]


def test_vector_has_contract_order_and_minus_one_for_missing(spark):
    schema = ", ".join(f"{f} double" for f in reversed(FEATURES))
    df = spark.createDataFrame([tuple(None if f in ENTITY_FEATURES else 2.0 for f in reversed(FEATURES))], schema)
    vector = df.select(*columns.vector_columns())
    assert vector.columns == FEATURES
    assert list(vector.first()) == [-1.0 if f in ENTITY_FEATURES else 2.0 for f in FEATURES]


def test_alerts_keep_rule_order(spark):
    names = ["price_ratio", "near_ceiling", "prov_members", "pair_claims_30d", "repeated_document",
             "in_network_too", "site_already_removed", "recent_enrolment"]
    df = spark.createDataFrame(
        [(3.01, 1, 51, 3, 1, 1, 1, 1), (3.0, 0, 50, 2, 0, 0, 0, 0), (None,) * 8],
        ", ".join(f"{n} double" if n == "price_ratio" else f"{n} int" for n in names))
    got = [r[0] for r in df.select(columns.alerts()).collect()]
    assert got == [list(columns.alert_rules()), [], []]


def test_contract_lists():
    assert len(FEATURES) == len(set(FEATURES)) == 20
    assert list(CONTRACT_NAMES) == FEATURES
    assert set(OWN_FEATURES) < set(FEATURES) and len(OWN_FEATURES) == 7
    assert not set(AFTER_DECISION) & set(FEATURES)


# --- fixed values: preset claims (amount, reference price, days since enrolment, members of the
# provider, claims of the pair in 30 days, repeated document, site removed) and their alerts ---
PRESETS = {
    "routine": ((210.0, 190.0, 900, 5, 1, 0, 0), []),
    "near the ceiling": ((1450.0, 190.0, 800, 5, 1, 0, 0), ["price_over_3x", "near_ceiling"]),
    "front clinic": ((1430.0, 320.0, 650, 153, 1, 0, 0), ["price_over_3x", "near_ceiling", "concentrated_provider"]),
    "splitting": ((580.0, 680.0, 700, 5, 5, 0, 0), ["pair_burst"]),
    "removed tooth": ((640.0, 680.0, 1000, 5, 1, 0, 1), ["site_already_removed"]),
    "opportunistic": ((3600.0, 3400.0, 45, 5, 2, 0, 0), ["first_120_days"]),
    "repeated invoice": ((700.0, 680.0, 850, 5, 1, 1, 0), ["repeated_document"]),
}


@pytest.mark.parametrize("name", PRESETS)
def test_preset_claims_raise_their_alerts(spark, name):
    (amount, price, days, people, burst, repeated, removed), expected = PRESETS[name]
    df = spark.createDataFrame([(
        amount, price, DAY, DAY, DAY - dt.timedelta(days=days), False, "SP", "SP")], SCHEMA)
    row = df.withColumns(columns.own_columns()).withColumns({
        "prov_members": F.lit(people), "pair_claims_30d": F.lit(burst),
        "repeated_document": F.lit(repeated), "in_network_too": F.lit(0),
        "site_already_removed": F.lit(removed)})
    assert row.select(columns.alerts()).first()[0] == expected
