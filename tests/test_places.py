"""Distances, radius search against brute force, and the table functions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from claimrisk.functions.geo import distance_km
from claimrisk.operators import joins, radius, tablefunctions
from claimrisk.plans.placement import place
from claimrisk.sources import domain

PLACE = "lat double, lon double, g string"


def km(a, b):
    f1, f2 = math.radians(a[0]), math.radians(b[0])
    c = (math.cos(f1) * math.cos(f2) * math.cos(math.radians(b[1]) - math.radians(a[1]))
         + math.sin(f1) * math.sin(f2))
    return 6371 * math.acos(min(1.0, c))


def brute(members, providers, r, k):
    out = set()
    for m, *a, g in members:
        near = sorted((round(km(a, b), 2), p) for p, *b, h in providers if g == h and km(a, b) <= r)
        out |= {(m, p, i + 1) for i, (_, p) in enumerate(near[:k])}
    return out


def search(spark, members, providers, r, k, levels):
    m = spark.createDataFrame(members, "member_id long, " + PLACE)
    p = spark.createDataFrame(providers, "provider_id long, " + PLACE)
    got = radius.nearest(m, p, ["g"], r, k, levels)
    return {(x["member_id"], x["provider_id"], x["rank"]) for x in got.collect()}


def cloud(seed, n, centre, spread, clustered=0.5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = spread / 200 if rng.random() < clustered else spread
        rows.append((i, round(centre[0] + rng.uniform(-s, s), 6),
                     (centre[1] + rng.uniform(-s, s) + 180) % 360 - 180, rng.choice("ab")))
    return rows


@pytest.mark.parametrize("levels", [0, 1, 3, None])
@pytest.mark.parametrize("centre", [(-23.5, -46.6), (64.0, 179.9), (0.0, 0.0)])
def test_nearest_matches_brute_force(spark, levels, centre):
    members, providers = cloud(1, 60, centre, 0.8), cloud(2, 80, centre, 0.8)
    assert search(spark, members, providers, 30, 3, levels) == brute(members, providers, 30, 3)


def test_a_member_is_sorted_with_its_own_nearest_only(spark, monkeypatch):
    seen, cut = [], radius.first_per_group

    def counted(df, keys, *rest, **options):
        if keys == ["member_id"]:
            seen.append(df.count())
        return cut(df, keys, *rest, **options)

    monkeypatch.setattr(radius, "first_per_group", counted)
    members, providers = cloud(1, 30, (-23.5, -46.6), 0.01), cloud(2, 120, (-23.5, -46.6), 0.01)
    assert search(spark, members, providers, 30, 3, 0) == brute(members, providers, 30, 3)
    assert seen == [len(members) * 3]


def test_far_apart_places_and_one_crowded_place(spark):
    providers = [(i, -3.1, -60.0, "a") for i in range(50)] + [(99, -3.11, -60.0, "a")]
    members = [(1, -3.1, -60.0, "a"), (2, 50.0, 10.0, "a"), (3, -3.1, -60.0, "b")]
    assert search(spark, members, providers, 15, 5, 2) == {(1, i, i + 1) for i in range(5)}


def test_radius_is_inclusive(spark):
    a, b = (-23.5614, -46.6558), (-23.5665, -46.6926)
    exact = km(a, b)
    assert search(spark, [(1, *a, "a")], [(2, *b, "a")], exact, 1, 0) == {(1, 2, 1)}
    assert search(spark, [(1, *a, "a")], [(2, *b, "a")], exact - 1e-6, 1, 0) == set()


def test_levels_follow_density(spark, monkeypatch):
    monkeypatch.setattr(radius, "LEAF_PROVIDERS", 4)
    members, providers = cloud(3, 40, (-23.5, -46.6), 0.3, 0.9), cloud(4, 90, (-23.5, -46.6), 0.3, 0.9)
    cells = spark.createDataFrame(providers, "provider_id long, " + PLACE).groupBy(
        "g", *radius.Grid(30).finest()).agg(F.count("*").alias("n"))
    assert radius._levels_needed(cells, ["g"]) > 1
    assert search(spark, members, providers, 30, 5, None) == brute(members, providers, 30, 5)


def test_crowded_member_cells_are_split_without_changing_the_result(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 5)
    members, providers = cloud(5, 60, (-23.5, -46.6), 0.3, 0.9), cloud(6, 30, (-23.5, -46.6), 0.3)
    assert search(spark, members, providers, 30, 3, 0) == brute(members, providers, 30, 3)


def test_tiers_keep_members_without_a_hit(spark):
    m = spark.createDataFrame(
        [(1, -23.5, -46.6, "a"), (2, -3.1, -60.0, "a"), (3, -23.9, -46.6, "a")], "member_id long, " + PLACE)
    p = spark.createDataFrame([(7, -23.5, -46.6, "a")], "provider_id long, " + PLACE)
    got = {r["member_id"]: (r["hits_15km"], r["hits_50km"], r["hits_200km"], r["tier_km"])
           for r in radius.radius_tiers(m, p, ["g"], (15, 50, 200)).collect()}
    assert got == {1: (1, 1, 1, 15), 2: (0, 0, 0, None), 3: (0, 1, 1, 50)}


def test_known_distance_and_equal_places(spark):
    df = spark.createDataFrame(
        [(-23.5614, -46.6558, -23.5665, -46.6926), (-23.5614, -46.6558, -23.5614, -46.6558)],
        "a double, b double, c double, d double")
    got = [r[0] for r in df.select(distance_km(*"abcd")).collect()]
    assert round(got[0], 2) == 3.79
    assert got[1] == pytest.approx(0.0, abs=1e-3) and not math.isnan(got[1])


def test_table_functions(spark):
    members = spark.createDataFrame(
        [(1, "Ana", "111.111.111-11", "P", 1, -23.5614, -46.6558), (2, "Bo", "22222222222", "Q", 1, 0.0, 0.0)],
        "member_id long, member_name string, national_id string, plan_name string, region int, lat double, lon double")
    providers = spark.createDataFrame(
        [(i, f"D{i}", "Endodontia", 1, 4.0, True, True, ["P"], -23.5614 + i * 0.01, -46.6558) for i in range(8)]
        + [(50, "far", "Endodontia", 1, 4.0, True, True, ["P"], -24.0, -46.6558),
           (51, "out", "Endodontia", 1, 4.0, True, False, ["P"], -23.5614, -46.6558)],
        "provider_id long, provider_name string, specialty string, region int, rating double, "
        "urgent boolean, in_network boolean, plans array<string>, lat double, lon double")
    tablefunctions.register(spark, members, providers)
    call = "SELECT * FROM find_providers(-23.5614D, -46.6558D, '{}', '{}', {})"
    near = spark.sql(call.format("ENDODONTIA", "P", 15)).collect()
    assert [r["provider_id"] for r in near] == [0, 1, 2, 3, 4]
    assert spark.sql("SELECT * FROM find_providers(-23.5614D, -46.6558D, 'endodontia', 'P')").count() == 5
    assert spark.sql(call.format("Dentista de canal", "P", 200)).count() == 0
    assert spark.sql(call.format("Endodontia", "Q", 200)).count() == 0
    assert spark.sql("SELECT member_name FROM find_member('11111111111')").first()[0] == "Ana"
    assert spark.sql("SELECT * FROM find_member('9')").count() == 0
    assert spark.sql("SELECT * FROM list_specialties()").collect() == [("Endodontia", 9)]
    chained = spark.sql("""SELECT f.provider_id FROM find_member('111.111.111-11') m,
        LATERAL find_providers(m.lat, m.lon, 'Endodontia', m.plan_name, 200) f""")
    assert chained.count() == 5


def test_placement_is_repeatable_and_near_a_district(spark, root):
    rows = place(domain.providers(spark, root), "provider_id")
    again = place(domain.providers(spark, root).repartition(3), "provider_id")
    assert rows.exceptAll(again).isEmpty()
    far = rows.filter(
        F.abs(F.col("lat") - (-30.0 + F.col("region") + F.col("district") * 0.05)) > 0.0091)
    assert far.isEmpty() and rows.count() == 10


def test_member_look_up_prunes_by_the_stored_digits(spark, root):
    from claimrisk.plans import places
    places._register(spark, root)
    plan = spark.sql("SELECT * FROM find_member('000.000.000-03')")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(digits,00000000003)" in plan and "LessThanOrEqual(digits,00000000003)" in plan
    assert [r.member_id for r in spark.sql("SELECT * FROM find_member('000.000.000-03')").collect()] == [3]


def test_tables_follow_the_files_of_their_folder(spark, root, tmp_path):
    import shutil

    import pyarrow.parquet as pq

    from claimrisk.plans import lake
    for name in lake.SOURCES:
        shutil.copyfile(f"{root}/{name}.parquet", tmp_path / f"{name}.parquet")
    before = lake.silver(spark, str(tmp_path)).claims.count()
    lines = pq.read_table(f"{root}/lineitem.parquet")
    pq.write_table(lines.slice(0, lines.num_rows // 2), tmp_path / "lineitem.parquet")
    assert 0 < lake.silver(spark, str(tmp_path)).claims.count() < before


def test_a_dense_town_does_not_split_the_rest_of_the_world(spark, monkeypatch):
    monkeypatch.setattr(radius, "LEAF_PROVIDERS", 8)
    rng = random.Random(11)
    spread = [(i, rng.uniform(-30, 30), rng.uniform(-60, 60), "a") for i in range(400)]
    town = [(1000 + i, 10 + rng.uniform(0, 0.02), 10 + rng.uniform(0, 0.02), "a") for i in range(400)]
    members = [(i, a + 0.05, b, g) for i, a, b, g in spread[:200]] + [(5000 + i, a, b, g) for i, a, b, g in town[:100]]
    m = spark.createDataFrame(members, "member_id long, " + PLACE)
    p = spark.createDataFrame(spread + town, "provider_id long, " + PLACE)
    compared, whole = [], []
    got = radius.nearest(m, p, ["g"], 60, 5, compared=compared)
    assert {(x.member_id, x.provider_id, x["rank"]) for x in got.collect()} == brute(members, spread + town, 60, 5)
    monkeypatch.setattr(radius, "LEAF_PROVIDERS", 0)  # every cell is split
    again = radius.nearest(m, p, ["g"], 60, 5, levels=len(compared) - 1, compared=whole)
    assert again.count() == got.count()
    assert len(compared) > 3 and compared[0] == whole[0]
    assert all(a < b for a, b in zip(compared[1:], whole[1:])) and sum(compared) < 0.7 * sum(whole)
