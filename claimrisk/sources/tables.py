"""Scans and sinks: plain Spark readers and writers behind declared schemas."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from claimrisk.schemas import DOMAIN, SOURCE_NAMES, TABLES
from claimrisk.session import work_dir


# --- scans -------------------------------------------------------------------------------
def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One parquet table of the data folder, with its declared schema."""
    return spark.read.schema(TABLES[name]).parquet(f"{root.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows spread over all cores when the scan yields fewer partitions than there are cores.

    Large tables have many splits and pass unchanged; a table in one row group would otherwise
    run costly per-row work in one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def catalog_table(spark: SparkSession, name: str, renames: dict[str, str] | None = None) -> DataFrame:
    """A catalog table by name; source column names become the names used here."""
    df = spark.table(name)
    names = SOURCE_NAMES if renames is None else renames
    return df.withColumnsRenamed({c: names[c] for c in df.columns if c in names})


def local_rows(spark: SparkSession, rows: Iterable, kind: str) -> DataFrame:
    """Driver rows as a DataFrame under a declared domain schema."""
    return spark.createDataFrame(list(rows), DOMAIN[kind])


def binary_files(spark: SparkSession, path: str, pattern: str = "*", separator: str | None = None) -> DataFrame:
    """(path, content) of every file below ``path``.

    With a ``separator`` of one byte a row is a piece of the content, without the separator behind
    it, and a file of any size is read in splits by many tasks; empty files have no pieces.
    """
    if separator is not None:
        return (
            spark.read.format("text").option("pathGlobFilter", pattern).option("lineSep", separator)
            .load(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("content"))
        )
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern)
        .load(path).select("path", "content")
    )


def bytes_read(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(name, read) of every file that is not empty below ``path``: the bytes its content has.

    Pieces and separators add up to the content, and one more unless a separator ends it.  No file
    ends in both of two separators, so the larger sum is one too many in every case.
    """
    sums = [binary_files(spark, path, pattern, separator).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.octet_length("content").alias("n"))
        .groupBy("name").agg((F.sum("n") + F.count("*")).alias("n")) for separator in ("\n", "\0")]
    return sums[0].unionByName(sums[1]).groupBy("name").agg((F.max("n") - 1).alias("read"))


def directory_listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(name, size) of every file below ``path``; the contents are pruned away."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"))
    )


def one_row(spark: SparkSession, **exprs: str) -> DataFrame:
    """A constant one-row query from named SQL expressions."""
    return spark.sql("SELECT " + ", ".join(f"{e} AS {n}" for n, e in exprs.items()))


def functions_like(spark: SparkSession, pattern: str) -> DataFrame:
    return spark.sql(f"SHOW USER FUNCTIONS LIKE '{pattern}'")


def tables_like(spark: SparkSession, pattern: str, database: str = "default") -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").filter(F.col("tableName").like(pattern))


# --- sinks -------------------------------------------------------------------------------
def overwrite_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table together with its schema."""
    writer = df.write.mode("overwrite").option("overwriteSchema", "true").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    """Append by column name, not by position."""
    columns = df.sparkSession.table(name).columns
    df.select(*columns).write.mode("append").format("parquet").saveAsTable(name)


def create_or_replace_as(spark: SparkSession, name: str, query: str) -> None:
    """Replace a table by the result of a query."""
    overwrite_table(spark.sql(query), name)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line per file."""
    df.write.mode("overwrite").option("header", True).csv(path)


def create_database(spark: SparkSession, name: str, use: bool = True) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    if use:
        spark.sql(f"USE {name}")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql("USE default")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@contextmanager
def own_database(spark: SparkSession, name: str):
    """A new database, used inside the block and dropped with its tables behind it."""
    before, name = spark.catalog.currentDatabase(), f"{name}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_dir(spark, name)}'")
    try:
        spark.sql(f"USE {name}")
        yield name
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def preview(df: DataFrame, n: int = 10) -> list[Row]:
    """The first ``n`` rows, in no particular order."""
    return df.limit(n).collect()


def user_schema_name(mail_column: str = "current_user()") -> str:
    """SQL expression: a schema name derived from a mail-like user name."""
    return f"lower(translate(split({mail_column}, '@')[0], '.-+', '___'))"
