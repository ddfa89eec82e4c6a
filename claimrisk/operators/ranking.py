"""Top-k, first rows per group, de-duplication and sampling, all with total orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows of a total order; each task keeps at most ``n``."""
    return df.orderBy(*order).limit(n)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int,
                    rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group, numbered from 1.

    The rank filter lets Spark cut every group to ``k`` rows per input task before the shuffle,
    so a hot group arrives already trimmed.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, chosen by a total order instead of at random."""
    return first_per_group(df, keys, order, 1, "_rank").drop("_rank")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A repeatable sample of ``n`` rows: the smallest seeded digests of the key."""
    return df.orderBy(F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)
