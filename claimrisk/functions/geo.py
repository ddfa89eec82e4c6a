"""Distances on the sphere and bounding boxes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimrisk.schemas import EARTH_KM, KM_PER_DEGREE


def distance_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance in km by the spherical law of cosines, as SQL text.

    Rounding can push the cosine of two equal places above 1, where acos is NaN: it is capped.
    """
    a, b = f"radians({lat1})", f"radians({lat2})"
    turn = f"radians({lon2}) - radians({lon1})"
    return (f"{EARTH_KM} * acos(least(1.0D, "
            f"cos({a}) * cos({b}) * cos({turn}) + sin({a}) * sin({b})))")


def box_sql(lat: str, lon: str, lat0: str, lon0: str, radius_km: str) -> str:
    """Whether a place lies in the box around (lat0, lon0); plain ranges, so scans can prune."""
    dlat = f"{radius_km} / {KM_PER_DEGREE}D"
    dlon = f"{radius_km} / ({KM_PER_DEGREE}D * cos(radians({lat0})))"
    return (f"{lat} BETWEEN {lat0} - {dlat} AND {lat0} + {dlat} "
            f"AND {lon} BETWEEN {lon0} - {dlon} AND {lon0} + {dlon}")


def distance_km(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """The same distance as a column over named columns or literals."""
    return F.expr(distance_sql(lat1, lon1, lat2, lon2))


def in_box(lat: str, lon: str, lat0: str, lon0: str, radius_km: str) -> Column:
    return F.expr(box_sql(lat, lon, lat0, lon0, radius_km))


def _span_km(dlat: Column, dlon: Column, cos1: Column, cos2: Column) -> Column:
    """Haversine distance for given differences in degrees and cosines of the latitudes."""
    s1, s2 = F.sin(F.radians(dlat) / 2), F.sin(F.radians(dlon) / 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), s1 * s1 + cos1 * cos2 * s2 * s2)))


def span_bounds(dlat: Column, dlon: Column, lat1: Column, lat2: Column,
                slack1: float, slack2: float) -> tuple[Column, Column]:
    """Least and greatest distance of two places known up to a slack in degrees around a centre.

    ``dlat`` and ``dlon`` are the absolute differences of the centres.
    """
    slack = slack1 + slack2

    def cosine(lat, own, outward):
        edge = F.abs(lat) + own if outward else F.abs(lat) - own
        return F.cos(F.radians(F.greatest(F.least(edge, F.lit(90.0)), F.lit(0.0))))

    zero = F.lit(0.0)
    low = _span_km(
        F.greatest(dlat - slack, zero), F.greatest(dlon - slack, zero),
        cosine(lat1, slack1, True), cosine(lat2, slack2, True))
    high = _span_km(
        dlat + slack, F.least(dlon + slack, F.lit(180.0)),
        cosine(lat1, slack1, False), cosine(lat2, slack2, False))
    return low, high
