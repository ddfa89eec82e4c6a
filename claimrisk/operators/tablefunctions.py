"""Parameterised searches as SQL table functions over the member and provider place tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.functions.geo import box_sql, distance_sql
from claimrisk.schemas import NEAREST

# The range prunes the stored digits by a pushed-down filter; the equality of expressions is what
# a lateral call joins on (Spark applies the limit of a lateral call per key only if the key is no
# plain column).
FIND_MEMBER = """
CREATE OR REPLACE TEMPORARY FUNCTION find_member(
  id STRING COMMENT 'Identity number, with or without punctuation')
RETURNS TABLE(member_id BIGINT, member_name STRING, plan_name STRING, region INT,
              lat DOUBLE, lon DOUBLE)
COMMENT 'The member with this identity number, at most one row.'
RETURN
  SELECT member_id, member_name, plan_name, region, lat, lon
  FROM member_places
  WHERE digits >= regexp_replace(id, '[^0-9]', '') AND digits <= regexp_replace(id, '[^0-9]', '')
    AND regexp_replace(digits, '[^0-9]', '') = regexp_replace(id, '[^0-9]', '')
  ORDER BY member_id
  LIMIT 1
"""

FIND_PROVIDERS = f"""
CREATE OR REPLACE TEMPORARY FUNCTION find_providers(
  at_lat DOUBLE COMMENT 'Latitude to search from',
  at_lon DOUBLE COMMENT 'Longitude to search from',
  wanted STRING COMMENT 'Specialty, upper or lower case',
  member_plan STRING COMMENT 'Only providers that accept this plan',
  radius_km INT DEFAULT 15 COMMENT 'Search radius in km')
RETURNS TABLE(provider_id BIGINT, provider_name STRING, specialty STRING, region INT,
              rating DOUBLE, urgent BOOLEAN, distance_km DOUBLE)
COMMENT 'The {NEAREST} nearest in-network providers inside the radius, nearest first.'
RETURN
  SELECT provider_id, provider_name, specialty, region, rating, urgent,
         round(exact_km, 2) AS distance_km
  FROM (SELECT *, {distance_sql("at_lat", "at_lon", "lat", "lon")} AS exact_km
        FROM provider_places
        WHERE {box_sql("lat", "lon", "at_lat", "at_lon", "radius_km")}
          AND in_network AND array_contains(plans, member_plan) AND upper(specialty) = upper(wanted))
  WHERE exact_km <= radius_km
  ORDER BY distance_km, provider_id
  LIMIT {NEAREST}
"""

LIST_SPECIALTIES = """
CREATE OR REPLACE TEMPORARY FUNCTION list_specialties()
RETURNS TABLE(specialty STRING, providers INT)
COMMENT 'Specialties of the network with the number of in-network providers.'
RETURN
  SELECT specialty, CAST(count(*) AS INT) AS providers
  FROM provider_places WHERE in_network
  GROUP BY specialty ORDER BY providers DESC, specialty
"""


def digits(number: str = "national_id") -> Column:
    """An identity number without its punctuation."""
    return F.regexp_replace(number, "[^0-9]", "")


def register(spark: SparkSession, members: DataFrame, providers: DataFrame) -> None:
    """Create the three functions over the given place tables.

    A member table that stores ``digits`` is searched by pushed-down equality; otherwise the
    column is computed.
    """
    if "digits" not in members.columns:
        members = members.withColumn("digits", digits())
    members.createOrReplaceTempView("member_places")
    providers.createOrReplaceTempView("provider_places")
    for ddl in (FIND_MEMBER, FIND_PROVIDERS, LIST_SPECIALTIES):
        spark.sql(ddl)
