"""In-place style changes of array columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.operators.joins import lookup_join


def add_to_array(df: DataFrame, keys: DataFrame, key: str, column: str, value: str) -> DataFrame:
    """Rows whose key is listed get ``value`` added to their array, once; all rows stay.

    Parquet tables have no row updates: the result replaces the table.
    """
    listed = keys.select(key).distinct().withColumn("_listed", F.lit(True))
    changed = F.array_union(column, F.array(F.lit(value)))
    return lookup_join(df, listed, [key], key).withColumn(
        column, F.when(F.col("_listed"), changed).otherwise(F.col(column))).drop("_listed")
