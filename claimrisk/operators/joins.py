"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType

# A key with more rows than this is spread over several tasks.
HOT_ROWS = 2_000_000
# A side is broadcast by hand only when it was counted and has at most this many rows.
BROADCAST_ROWS = 100_000
# Rows of numbers alone count by their columns, as parts of a row of this many: 500,000 of 8 columns.
BROADCAST_COLUMNS = 40


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows, by a count that reads no more than its keys."""
    return df.count() <= (BROADCAST_ROWS if max_rows is None else max_rows)


def broadcast_rows(dim: DataFrame) -> int:
    """The most rows of ``dim`` that are broadcast: more than ``BROADCAST_ROWS`` of short rows of numbers."""
    if all(isinstance(f.dataType, (NumericType, DateType, BooleanType)) for f in dim.schema):
        return BROADCAST_ROWS * max(1, BROADCAST_COLUMNS // len(dim.columns))
    return BROADCAST_ROWS


def hot_keys(
    counts: DataFrame, keys: Sequence[str], weight: str, hot_rows: int | None = None
) -> DataFrame:
    """Keys too heavy for one task, with the number of tasks each should be spread over.

    ``counts`` has one row per key.  At most total_rows / hot_rows keys qualify, which bounds
    the result whatever the data look like.
    """
    limit = hot_rows or HOT_ROWS
    return counts.filter(F.col(weight) > limit).select(
        *keys, F.ceil(F.col(weight) / limit).cast("int").alias("_splits")
    )


def spread_left_join(
    rows: DataFrame, right: DataFrame, on: Sequence[str], row_id: str, hot: DataFrame
) -> DataFrame:
    """Left join in which the rows of hot keys are split over many tasks.

    ``hot`` comes from ``hot_keys``; its key may be ``on`` or a part of it.  Rows of a hot key
    get a salt below the key's number of splits, and the matching right rows are repeated once
    per salt: at most 2 * total_rows / hot_rows extra rows when the right side has one row per
    key.  Without hot keys this is a plain join.
    """
    on = list(on)
    if hot.isEmpty():
        return rows.join(right, on, "left")
    hot_on = [c for c in hot.columns if c != "_splits"]
    hot = F.broadcast(hot)
    splits = F.coalesce("_splits", F.lit(1))
    left = rows.join(hot, hot_on, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(row_id), splits).cast("int")
    ).drop("_splits")
    copies = right.join(hot, hot_on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), splits - 1))
    ).drop("_splits")
    return left.join(copies, [*on, "_salt"], "left").drop("_salt")


class KeySlots:
    """Several left joins on keys that share one column, over a single exchange of the rows.

    The rows are partitioned once by the shared key; each right side is partitioned the same
    way, so every join on (key, more columns) finds its rows in place.  A hot key is cut into
    slots: its rows are dealt out by row id and its right rows repeated per slot.
    """

    def __init__(self, key: str, hot: DataFrame):
        self.key = key
        self.hot = None if hot.isEmpty() else F.broadcast(hot)
        self.on = [key] if self.hot is None else [key, "_slot"]

    def place(self, rows: DataFrame, row_id: str) -> DataFrame:
        if self.hot is not None:
            splits = F.coalesce("_splits", F.lit(1))
            rows = rows.join(self.hot, self.key, "left").withColumn(
                "_slot", F.pmod(F.xxhash64(row_id), splits).cast("int")).drop("_splits")
        return rows.repartition(*self.on)

    def left_join(self, placed: DataFrame, right: DataFrame, on: Sequence[str] = (),
                  distinct: bool = False) -> DataFrame:
        """Left join on the key and ``on``; ``right`` is reduced before it is copied and moved.

        ``distinct``: of equal rows of ``right`` one is kept, where they lie after the move.
        """
        if self.hot is not None:
            splits = F.coalesce("_splits", F.lit(1))
            right = right.join(self.hot, self.key, "left").withColumn(
                "_slot", F.explode(F.sequence(F.lit(0), splits - 1))).drop("_splits")
        right = right.repartition(*self.on)
        return placed.join(right.distinct() if distinct else right, [*self.on, *on], "left")


def spread_nulls(rows: DataFrame, key: str, row_id: str) -> tuple[DataFrame, str]:
    """Rows with a join column in which null keys, which match nothing, are spread.

    A null string key would otherwise send all its rows to one task; here each becomes a
    value of its own that no right side holds.
    """
    spread = f"{key}_spread"
    return rows.withColumn(
        spread, F.coalesce(F.col(key), F.concat(F.lit("\u0000"), F.col(row_id).cast("string")))
    ), spread


def lookup_join(rows: DataFrame, dim: DataFrame, on: Sequence[str], row_id: str,
                hot: DataFrame | None = None) -> DataFrame:
    """Left join to a dimension: broadcast when counted small, else spread by the hot keys.

    Without given hot keys they come from the rows' own counts; a stream cannot count itself,
    so there the join is left to Spark.
    """
    on = list(on)
    if fits_broadcast(dim.select(*on), broadcast_rows(dim)):
        return rows.join(F.broadcast(dim), on, "left")
    if hot is None:
        if rows.isStreaming:
            return rows.join(dim, on, "left")
        hot = hot_keys(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), on, "_n")
    return spread_left_join(rows, dim, on, row_id, hot)
