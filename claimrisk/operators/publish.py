"""Published per-entity features: checks, snapshots, differences, lookups and parity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from claimrisk.functions.columns import vector_columns
from claimrisk.operators.joins import lookup_join
from claimrisk.schemas import PARITY_TOLERANCE
from claimrisk.session import work_dir, written

BUCKETS = 32   # of a published table: what a change rewrites


def collapse(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per entity from features repeated on every claim of the entity."""
    return rows.groupBy(key).agg(*[F.max(c).alias(c) for c in columns])


def key_check(table: DataFrame, key: str) -> DataFrame:
    """One row: rows, null keys and keys that occur more than once."""
    per_key = table.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("duplicate_keys"),
    )


def observed(table: DataFrame, key: str, buckets: int) -> tuple[DataFrame, Observation]:
    """The table by buckets of its key, and the key contract counted while it is written.

    Rows are dealt out by bucket and sorted by key for the write anyway; equal keys then follow one
    another, so null and repeated keys are counted in the pass that writes.
    """
    seen = Observation()
    earlier = F.lag(key).over(Window.partitionBy("bucket").orderBy(key))
    rows = table.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).repartition(
        "bucket").withColumn("_earlier", earlier)
    return rows.observe(
        seen, F.count("*").alias("rows"), F.count_if(F.col(key).isNull()).alias("null_keys"),
        F.count_if(F.col(key) == F.col("_earlier")).alias("repeated"),
    ).drop("_earlier"), seen


def keep_contract(name: str, seen: Observation) -> None:
    """Raises if the rows that were written break the key contract."""
    found = seen.get
    if found["null_keys"] or found["repeated"]:
        raise ValueError(f"{name}: {found['null_keys']} null and {found['repeated']} repeated keys")


def publish_snapshot(table: DataFrame, key: str, name: str, buckets: int = BUCKETS) -> None:
    """Replace the published table, only if its key is unique and never null.

    The rows are written once, to a folder of their own; the table points there only afterwards.
    """
    spark = table.sparkSession
    path = work_dir(spark, f"published-{name.replace('.', '-')}")
    rows, seen = observed(table, key, buckets)
    rows.write.partitionBy("bucket").parquet(path)
    keep_contract(name, seen)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (bucket) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def apply_changes(spark: SparkSession, name: str, delta: DataFrame, key: str, buckets: int = BUCKETS) -> int:
    """Inserts, updates and deletes of ``changes`` applied to a published table.

    Only the buckets that hold a changed key are read and rewritten; they are replaced once their
    new rows are written and their keys are unique.  Returns how many were rewritten.
    """
    delta = written(spark, delta.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")), "delta")
    touched = [r.bucket for r in delta.select("bucket").distinct().collect()]  # at most ``buckets``
    if not touched:
        return 0
    columns = [c for c in spark.table(name).columns if c != "bucket"]
    old = spark.table(name).where(F.col("bucket").isin(touched)).select(columns)
    kept = old.join(delta.select(key), key, "left_anti")
    rows, seen = observed(kept.unionByName(delta.where("change <> 'delete'").select(columns)), key, buckets)
    rows = written(spark, rows, "rewritten")
    keep_contract(name, seen)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # only the partitions that rows are written for
    try:
        rows.select(*columns, "bucket").write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)
    left = {r.bucket for r in rows.select("bucket").distinct().collect()}
    for bucket in sorted(set(touched) - left):  # all rows deleted
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (bucket = {bucket})")
    return len(touched)


def changes(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows to insert, update or delete to turn one snapshot into the next."""
    def side(df, prefix):
        return df.select(F.col(key).alias(f"{prefix}key"), F.struct(*columns).alias(f"{prefix}row"))
    both = side(old, "o_").join(side(new, "n_"), F.col("o_key") == F.col("n_key"), "full_outer")
    kind = (
        F.when(F.col("o_key").isNull(), "insert")
        .when(F.col("n_key").isNull(), "delete")
        .when(~F.col("o_row").eqNullSafe(F.col("n_row")), "update")
    )
    return both.select(
        F.coalesce("n_key", "o_key").alias(key), kind.alias("change"), "n_row.*",
    ).filter("change IS NOT NULL")


def online_vectors(claims: DataFrame, providers: DataFrame, members: DataFrame,
                   hot_providers: DataFrame, hot_members: DataFrame) -> DataFrame:
    """The model input of each claim from published history; missing history becomes -1."""
    rows = lookup_join(claims, providers, ["provider_id"], "claim_id", hot_providers)
    rows = lookup_join(rows, members, ["member_id"], "claim_id", hot_members)
    return rows.select("claim_id", *vector_columns())


def parity(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str],
           tolerance: float = PARITY_TOLERANCE) -> DataFrame:
    """One row per column: compared, largest gap, gaps beyond tolerance, keys on one side only."""
    def side(df, prefix):
        return df.select(
            F.col(key).alias(f"{prefix}key"),
            *[F.col(c).cast("double").alias(f"{prefix}{c}") for c in columns])
    both = side(left, "l_").join(side(right, "r_"), F.col("l_key") == F.col("r_key"), "full_outer")
    both_keys = F.col("l_key").isNotNull() & F.col("r_key").isNotNull()
    aggs = [
        F.count_if(both_keys).alias("_compared"),
        F.count_if(F.col("r_key").isNull()).alias("_left_only"),
        F.count_if(F.col("l_key").isNull()).alias("_right_only"),
    ]
    for c in columns:
        gap = F.abs(F.col(f"l_{c}") - F.col(f"r_{c}"))
        apart = F.when(
            F.col(f"l_{c}").isNull() | F.col(f"r_{c}").isNull(),
            ~F.col(f"l_{c}").eqNullSafe(F.col(f"r_{c}"))).otherwise(gap >= tolerance)
        aggs += [F.max(gap).alias(f"{c}__gap"), F.count_if(both_keys & apart).alias(f"{c}__apart")]
    stack = ", ".join(f"'{c}', `{c}__gap`, `{c}__apart`" for c in columns)
    return both.agg(*aggs).selectExpr(
        f"stack({len(columns)}, {stack}) AS (column_name, max_gap, beyond_tolerance)",
        "_compared AS compared", "_left_only AS left_only", "_right_only AS right_only")
