"""Deterministic placement of entities in the districts of their region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimrisk.operators.joins import lookup_join

JITTER_DEGREES = 0.009  # about 1 km
DISTRICTS_PER_REGION = 3


def districts(regions: DataFrame) -> DataFrame:
    """Districts of each region with a centre, from a rule on the region key."""
    number = F.explode(F.sequence(F.lit(0), F.lit(DISTRICTS_PER_REGION - 1)))
    return regions.select("region").distinct().select("region", number.alias("district")).withColumns({
        "lat0": -30.0 + F.col("region") + F.col("district") * 0.05,
        "lon0": -60.0 + F.col("region") * 0.8 + F.col("district") * 0.05,
    })


def _draw(key: str, salt: int) -> Column:
    """A repeatable whole number below 2^32 from the key: the head of a salted digest."""
    digest = F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(salt))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _unit(key: str, salt: int) -> Column:
    """A repeatable number in [0, 1) from the key."""
    return _draw(key, salt) / 4294967296.0


def place(entities: DataFrame, key: str, areas: DataFrame | None = None) -> DataFrame:
    """Each entity in one district of its region, moved by up to a kilometre.

    District and jitter come from digests of the key: the same entity always gets the same place,
    in whatever order and partitioning the rows are read.
    """
    areas = districts(entities) if areas is None else areas
    listed = areas.groupBy("region").agg(
        F.array_sort(F.collect_list(F.struct("district", "lat0", "lon0"))).alias("choices"))
    pick = (_draw(key, 1) % F.size("choices") + 1).cast("int")
    chosen = lookup_join(entities, listed, ["region"], key).withColumn(
        "_d", F.try_element_at("choices", pick))

    def moved(centre, salt):
        return F.round(F.col(f"_d.{centre}") + (_unit(key, salt) * 2 - 1) * JITTER_DEGREES, 6)
    return chosen.select(
        key, "region", F.col("_d.district").alias("district"),
        moved("lat0", 2).alias("lat"), moved("lon0", 3).alias("lon"))
