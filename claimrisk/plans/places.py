"""Queries over places: distances, nearest providers, coverage and member look-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from claimrisk.functions.geo import distance_km, in_box
from claimrisk.operators import tablefunctions
from claimrisk.operators.radius import nearest, radius_tiers
from claimrisk.operators.ranking import first_per_group, seeded_sample, top
from claimrisk.plans.lake import once
from claimrisk.plans.placement import place
from claimrisk.plans.sqlparts import rnd
from claimrisk.schemas import RADIUS_TIERS_KM
from claimrisk.sources import domain
from claimrisk.operators.arrays import add_to_array
from claimrisk.sources.tables import read_table

SPECIALTY = "Specialty 1"
RADIUS_KM = 50
HERE = (-23.5614, -46.6558)


def candidates(spark: SparkSession, root: str) -> DataFrame:
    """In-network providers of the wanted specialty, one row per accepted plan."""
    return (
        domain.provider_places(spark, root)
        .filter(F.col("in_network") & (F.upper("specialty") == SPECIALTY.upper()))
        .select("provider_id", "lat", "lon", F.explode("plans").alias("plan_name"))
    )


def searchers(spark: SparkSession, root: str) -> DataFrame:
    return domain.member_places(spark, root).select("member_id", "lat", "lon", "plan_name")


def distance_pairs(spark: SparkSession, root: str) -> DataFrame:
    """Distance of every provider from one place, in metres, and whether the box holds it."""
    here = [f"{v}D" for v in HERE]
    km = distance_km(*here, "lat", "lon")
    return domain.provider_places(spark, root).select(
        "provider_id", F.round(km * 1000).cast("long").alias("metres"),
        in_box("lat", "lon", *here, str(RADIUS_KM)).alias("in_box"))


def nearest_k(spark: SparkSession, root: str) -> DataFrame:
    return nearest(
        searchers(spark, root), candidates(spark, root), ["plan_name"], RADIUS_KM,
    ).select("member_id", "rank", "provider_id", "distance_km")


def radius_tier(spark: SparkSession, root: str) -> DataFrame:
    return radius_tiers(
        searchers(spark, root), candidates(spark, root), ["plan_name"], RADIUS_TIERS_KM)


def stored_members(spark: SparkSession, root: str) -> DataFrame:
    """Members by the digits of their identity number: sorted, so that a look-up reads one row group."""
    return once(spark, root, "member_places", lambda: domain.member_places(spark, root).withColumn(
        "digits", tablefunctions.digits()).repartitionByRange("digits").sortWithinPartitions("digits"))


def _register(spark, root):
    tablefunctions.register(
        spark, stored_members(spark, root), domain.provider_places(spark, root))


def an_accepting_provider(spark: SparkSession, root: str) -> Row:
    """The first in-network provider that accepts a plan: searches around it have a hit at any scale."""
    return domain.provider_places(spark, root).where(F.col("in_network") & (F.size("plans") > 0)) \
        .select("provider_id", "specialty", F.element_at("plans", 1).alias("plan_name"), "lat", "lon") \
        .orderBy("provider_id").first()


def find_providers(spark: SparkSession, root: str) -> DataFrame:
    """The table function called for one place; the box reaches the scan as plain ranges."""
    _register(spark, root)
    a = an_accepting_provider(spark, root)
    return spark.sql(f"SELECT * FROM find_providers("
                     f"{a.lat!r}D, {a.lon!r}D, '{a.specialty.upper()}', '{a.plan_name}', 200)")


def search_counts(spark: SparkSession, root: str) -> DataFrame:
    """Hits of the same search in growing radii, and of a specialty that does not exist."""
    _register(spark, root)
    a = an_accepting_provider(spark, root)
    calls = [(f"'{a.specialty}'", r) for r in RADIUS_TIERS_KM] + [("'No such specialty'", 200)]
    return spark.sql(" UNION ALL ".join(
        f"SELECT {s} AS specialty, {r} AS radius_km, count(*) AS hits "
        f"FROM find_providers({a.lat!r}D, {a.lon!r}D, {s}, '{a.plan_name}', {r})" for s, r in calls))


def lookup_chain(spark: SparkSession, root: str) -> DataFrame:
    """The identity number of a member of that provider's plan, chained into the provider search."""
    _register(spark, root)
    a = an_accepting_provider(spark, root)
    near = distance_km(f"{a.lat!r}D", f"{a.lon!r}D", "lat", "lon") <= RADIUS_TIERS_KM[-1]
    member = domain.member_places(spark, root).where((F.col("plan_name") == a.plan_name) & near) \
        .orderBy("member_id").select("national_id").first()
    return spark.sql(f"""
        SELECT m.member_id, m.plan_name, f.provider_id, f.specialty, f.distance_km
        FROM find_member('{member.national_id if member else ""}') m,
             LATERAL find_providers(m.lat, m.lon, '{a.specialty}', m.plan_name, 200) f""")


def member_lookup(spark: SparkSession, root: str) -> DataFrame:
    """Every member found again by the digits of its identity number."""
    _register(spark, root)
    return spark.sql("""
        SELECT q.member_id AS asked_by, f.member_id, f.member_name, f.plan_name, f.lat, f.lon
        FROM member_places q, LATERAL find_member(q.national_id) f""")


def specialty_list(spark: SparkSession, root: str) -> DataFrame:
    _register(spark, root)
    return spark.sql("SELECT * FROM list_specialties()")


def coverage_by_region(spark: SparkSession, root: str) -> DataFrame:
    """Providers, share in the network and specialties per nation and region."""
    nation = read_table(spark, root, "nation").withColumnRenamed("n_nationkey", "region")
    areas = read_table(spark, root, "region")
    # One row per nation and specialty first: the distinct count needs no further shuffle of rows.
    per_specialty = domain.provider_places(spark, root).groupBy("region", "specialty").agg(
        F.count("*").alias("n"), F.count_if("in_network").alias("k"))
    per_region = per_specialty.groupBy("region").agg(
        F.sum("n").alias("providers"), F.sum("k").alias("in_network"),
        F.round(F.sum("k") * 100.0 / F.sum("n"), 1).alias("pct_in_network"),
        F.count("specialty").alias("specialties"))
    return (
        per_region.join(nation, "region")
        .join(areas, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_name", "r_name", "providers", "in_network", "pct_in_network", "specialties")
        .orderBy(F.col("providers").desc(), "n_name")
    )


def first_k_per_group(spark: SparkSession, root: str) -> DataFrame:
    """The first 4 in-network providers of each specialty."""
    rows = domain.provider_places(spark, root).filter("in_network").select("specialty", "provider_id")
    return first_per_group(rows, ["specialty"], ["provider_id"], 4)


def region_top_rated(spark: SparkSession, root: str) -> DataFrame:
    """The 10 best rated in-network providers of one region."""
    rows = domain.provider_places(spark, root).filter(F.col("in_network") & (F.col("region") == 7))
    return top(
        rows.select("provider_id", "provider_name", "specialty", "region", "rating"), 10,
        F.col("rating").desc(), "provider_id")


def plan_array_union(spark: SparkSession, root: str) -> DataFrame:
    """The first 4 of each specialty accept one more plan; the others keep their list."""
    rows = domain.provider_places(spark, root).select("provider_id", "plans")
    chosen = first_k_per_group(spark, root).select("provider_id")
    return add_to_array(rows, chosen, "provider_id", "plans", "AUTOMOBILE").select(
        "provider_id", F.concat_ws(",", "plans").alias("plans"),
        F.array_contains("plans", "AUTOMOBILE").alias("accepts"))


def append_union(spark: SparkSession, root: str) -> DataFrame:
    """Members with two demonstration members appended, matched by column name."""
    rows = domain.member_places(spark, root).select("national_id", "member_id", "plan_name")
    extra = spark.createDataFrame(
        [(900001, "AUTOMOBILE", "11111111111"), (900002, "MACHINERY", "22222222222")],
        "member_id BIGINT, plan_name STRING, national_id STRING")
    return rows.unionByName(extra)


def placement(spark: SparkSession, root: str) -> DataFrame:
    """Each provider placed in a district of its region, with a repeatable jitter."""
    return place(domain.providers(spark, root), "provider_id")


def sample_of_members(spark: SparkSession, root: str) -> DataFrame:
    """A repeatable sample of 50 members."""
    return seeded_sample(domain.members(spark, root).select("member_id", "plan_id"), "member_id", 50, 42)


QUERIES = {
    f.__name__: f for f in (
        distance_pairs, nearest_k, radius_tier, find_providers, search_counts, lookup_chain,
        member_lookup, specialty_list, coverage_by_region, first_k_per_group, region_top_rated,
        plan_array_union, append_union, placement, sample_of_members)
}


def _digest(key: str, salt: int) -> str:
    return f"CAST('0x' || substr(md5({key} || '-{salt}'), 1, 8) AS BIGINT)"


def _place(key: str, lat_step: int, lon_step: int) -> str:
    town = f"{_digest(key, 12)} % 3 = 0"
    return f"""CASE WHEN {town} THEN -23.5::DOUBLE + ({key} % 97) / 5000.0::DOUBLE
    ELSE -25.5::DOUBLE + ({key} * {lat_step} % 10007) * 4.0::DOUBLE / 10007.0::DOUBLE END AS lat,
  CASE WHEN {town} THEN -46.6::DOUBLE + ({key} % 89) / 5000.0::DOUBLE
    ELSE -48.6::DOUBLE + ({key} * {lon_step} % 10009) * 4.0::DOUBLE / 10009.0::DOUBLE END AS lon"""


_PROVIDERS = f"""
pp AS (SELECT s_suppkey AS provider_id, s_name AS provider_name, 'Specialty ' || ({_digest("s_suppkey", 11)} % 3) AS specialty,
  s_nationkey AS region, s_suppkey % 5 < 3 AS in_network,
  (s_suppkey * 7 % 51) / 10.0::DOUBLE AS rating, s_suppkey % 20 < 7 AS urgent,
  CASE WHEN s_suppkey % 5 < 3 THEN list_filter([
    {", ".join(f"CASE WHEN {_digest('s_suppkey', 20 + i)} % {i + 2} = 0 THEN '{p}' END"
               for i, p in enumerate(domain.PLAN_NAMES))}], lambda x: x IS NOT NULL) ELSE [] END AS plans,
  {_place("s_suppkey", 7919, 6101)} FROM supplier)"""

_MEMBERS = f"""
d AS (SELECT *, lpad(c_custkey::VARCHAR, 11, '0') AS digits FROM customer),
mp AS (SELECT c_custkey AS member_id, c_name AS member_name,
  CASE WHEN c_custkey % 2 = 0 THEN digits[1:3] || '.' || digits[4:6] || '.' || digits[7:9] || '-' || digits[10:11]
    ELSE digits END AS national_id, digits, c_mktsegment AS plan_name, c_nationkey AS region,
  {_place("c_custkey", 5003, 8009)} FROM d)"""


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"6371 * acos(least(1.0::DOUBLE, cos(radians({lat1})) * cos(radians({lat2})) * "
            f"cos(radians({lon2}) - radians({lon1})) + sin(radians({lat1})) * sin(radians({lat2}))))")


def _search(lat: str, lon: str, wanted: str, plan: str, radius: int) -> str:
    return f"""(SELECT *, {rnd("exact_km", 2)} AS distance_km FROM (
    SELECT pp.*, {_km(lat, lon, "pp.lat", "pp.lon")} AS exact_km FROM pp
    WHERE in_network AND upper(specialty) = upper({wanted}) AND list_contains(plans, {plan}))
  WHERE exact_km <= {radius} ORDER BY distance_km, provider_id LIMIT 5)"""


_HERE = """a AS (SELECT provider_id, specialty AS wanted, 'No such specialty' AS missing, plans[1] AS plan_name, lat, lon
  FROM pp WHERE in_network AND len(plans) > 0 ORDER BY provider_id LIMIT 1)"""

_HITS = f"""hits AS (SELECT member_id, provider_id, exact_km, {rnd("exact_km", 2)} AS distance_km FROM (
  SELECT m.member_id, p.provider_id, {_km("m.lat", "m.lon", "p.lat", "p.lon")} AS exact_km
  FROM mp m JOIN (SELECT *, unnest(plans) AS plan_name FROM pp) p ON p.plan_name = m.plan_name
  WHERE p.in_network AND p.specialty = '{SPECIALTY}'))"""

ORACLE = {
    "distance_pairs": f"""WITH {_PROVIDERS}
SELECT provider_id, CAST(round({_km(str(HERE[0]) + "::DOUBLE", str(HERE[1]) + "::DOUBLE", "lat", "lon")} * 1000) AS BIGINT) AS metres,
  lat BETWEEN {HERE[0]} - 50 / 111.0 AND {HERE[0]} + 50 / 111.0 AND
  lon BETWEEN {HERE[1]} - 50 / (111.0 * cos(radians({HERE[0]}))) AND {HERE[1]} + 50 / (111.0 * cos(radians({HERE[0]}))) AS in_box
FROM pp""",
    "nearest_k": f"""WITH {_PROVIDERS}, {_MEMBERS}, {_HITS},
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY member_id ORDER BY distance_km, provider_id) AS INTEGER) AS rank
  FROM hits WHERE exact_km <= {RADIUS_KM})
SELECT member_id, rank, provider_id, distance_km FROM r WHERE rank <= 5""",
    "radius_tier": f"""WITH {_PROVIDERS}, {_MEMBERS}, {_HITS},
t AS (SELECT m.member_id, least(count(*) FILTER (exact_km <= 15), 5) AS hits_15km,
  least(count(*) FILTER (exact_km <= 50), 5) AS hits_50km,
  least(count(*) FILTER (exact_km <= 200), 5) AS hits_200km
  FROM mp m LEFT JOIN hits h ON h.member_id = m.member_id GROUP BY m.member_id)
SELECT *, CASE WHEN hits_15km > 0 THEN 15 WHEN hits_50km > 0 THEN 50 WHEN hits_200km > 0 THEN 200 END AS tier_km
FROM t""",
    "find_providers": f"""WITH {_PROVIDERS}, {_HERE}
SELECT f.provider_id, f.provider_name, f.specialty, f.region, f.rating, f.urgent, f.distance_km
FROM a, LATERAL {_search("a.lat", "a.lon", "a.wanted", "a.plan_name", 200)} f""",
    "search_counts": f"WITH {_PROVIDERS}, {_HERE} " + " UNION ALL ".join(
        f"""SELECT any_value(a.{s}) AS specialty, {r} AS radius_km, count(f.provider_id) AS hits
FROM a LEFT JOIN LATERAL {_search("a.lat", "a.lon", f"a.{s}", "a.plan_name", r)} f ON TRUE"""
        for s, r in [("wanted", t) for t in RADIUS_TIERS_KM] + [("missing", 200)]),
    "lookup_chain": f"""WITH {_PROVIDERS}, {_MEMBERS}, {_HERE}
SELECT m.member_id, m.plan_name, f.provider_id, f.specialty, f.distance_km
FROM (SELECT mp.*, a.wanted FROM mp, a WHERE mp.plan_name = a.plan_name
      AND {_km("a.lat", "a.lon", "mp.lat", "mp.lon")} <= 200 ORDER BY member_id LIMIT 1) m,
  LATERAL {_search("m.lat", "m.lon", "m.wanted", "m.plan_name", 200)} f""",
    "member_lookup": f"""WITH {_MEMBERS},
f AS (SELECT * FROM mp QUALIFY row_number() OVER (PARTITION BY digits ORDER BY member_id) = 1)
SELECT q.member_id AS asked_by, f.member_id, f.member_name, f.plan_name, f.lat, f.lon
FROM mp q JOIN f ON f.digits = q.digits""",
    "specialty_list": f"""WITH {_PROVIDERS}
SELECT specialty, CAST(count(*) AS INTEGER) AS providers FROM pp WHERE in_network GROUP BY specialty""",
    "coverage_by_region": f"""WITH {_PROVIDERS}
SELECT n_name, r_name, count(*) AS providers, count(*) FILTER (in_network) AS in_network,
  {rnd("100.0 * count(*) FILTER (in_network) / count(*)", 1)} AS pct_in_network,
  count(DISTINCT specialty) AS specialties
FROM pp JOIN nation ON n_nationkey = pp.region JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""",
    "first_k_per_group": f"""WITH {_PROVIDERS}
SELECT specialty, provider_id, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY specialty
  ORDER BY provider_id) AS INTEGER) AS rank FROM pp WHERE in_network) WHERE rank <= 4""",
    "region_top_rated": f"""WITH {_PROVIDERS}
SELECT provider_id, provider_name, specialty, region, rating FROM pp WHERE in_network AND region = 7
ORDER BY rating DESC, provider_id LIMIT 10""",
    "plan_array_union": f"""WITH {_PROVIDERS},
k AS (SELECT provider_id FROM (SELECT *, row_number() OVER (PARTITION BY specialty ORDER BY provider_id) AS rn
  FROM pp WHERE in_network) WHERE rn <= 4),
u AS (SELECT provider_id, CASE WHEN provider_id IN (SELECT provider_id FROM k)
  AND NOT list_contains(plans, 'AUTOMOBILE') THEN list_append(plans, 'AUTOMOBILE') ELSE plans END AS plans FROM pp)
SELECT provider_id, coalesce(array_to_string(plans, ','), '') AS plans, list_contains(plans, 'AUTOMOBILE') AS accepts FROM u""",
    "append_union": f"""WITH {_MEMBERS}
SELECT national_id, member_id, plan_name FROM mp
UNION ALL SELECT '11111111111', 900001, 'AUTOMOBILE' UNION ALL SELECT '22222222222', 900002, 'MACHINERY'""",
}


ORACLE["placement"] = f"""WITH p AS (SELECT s_suppkey AS provider_id, s_nationkey AS region,
  CAST({_digest("s_suppkey", 1)} % 3 AS INTEGER) AS district,
  ({_digest("s_suppkey", 2)} / 4294967296.0::DOUBLE * 2 - 1) * 0.009::DOUBLE AS dlat,
  ({_digest("s_suppkey", 3)} / 4294967296.0::DOUBLE * 2 - 1) * 0.009::DOUBLE AS dlon FROM supplier)
SELECT provider_id, region, district,
  {rnd("-30.0::DOUBLE + region + district * 0.05::DOUBLE + dlat", 6)} AS lat,
  {rnd("-60.0::DOUBLE + region * 0.8::DOUBLE + district * 0.05::DOUBLE + dlon", 6)} AS lon FROM p"""
ORACLE["sample_of_members"] = """SELECT c_custkey AS member_id, c_mktsegment AS plan_id FROM customer
ORDER BY md5(c_custkey || '-42'), c_custkey LIMIT 50"""
