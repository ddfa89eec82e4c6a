"""Queries that write tables and files, and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.schemas import TABLES
from claimrisk.session import work_dir, written
from claimrisk.sources import tables

COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table_sinks(spark: SparkSession, root: str) -> DataFrame:
    """Suppliers overwritten, appended by name and summed into another table, in a database of their own."""
    with tables.own_database(spark, "sinks") as name:
        rows = tables.read_table(spark, root, "supplier")
        even = F.col("s_suppkey") % 2 == 0
        tables.overwrite_table(rows.filter(even), f"{name}.suppliers")
        tables.append_table(rows.filter(~even).select(*reversed(rows.columns)), f"{name}.suppliers")
        tables.create_or_replace_as(spark, f"{name}.per_nation", f"""
            SELECT s_nationkey AS nation, count(*) AS suppliers, min(s_name) AS first_name
            FROM {name}.suppliers GROUP BY s_nationkey""")
        return written(spark, tables.catalog_table(spark, f"{name}.per_nation", {}), "per_nation")


def catalog_listing(spark: SparkSession, root: str) -> DataFrame:
    """What a database of its own lists about itself, and that nothing of it stays behind.

    Tables and their rows by name pattern, columns, functions by name pattern, the user, a constant
    row and a preview.
    """
    with tables.own_database(spark, "listed") as name:
        rows = tables.read_table(spark, root, "supplier")
        for i, part in enumerate(("supplier_even", "supplier_odd", "other")):
            tables.overwrite_table(rows.filter(F.col("s_suppkey") % 2 == i % 2), f"{name}.{part}")
        spark.sql(f"CREATE FUNCTION {name}.double_it(x INT) RETURNS INT RETURN x * 2")
        like = tables.tables_like(spark, "supplier%", name)
        counts = [spark.table(f"{name}.{t.tableName}").agg(F.count("*").alias("n")).select(
            F.lit("table").alias("what"), F.lit(t.tableName).alias("name"), "n") for t in tables.preview(like)]
        columns = spark.createDataFrame(
            [("column", c.name, 1) for c in spark.catalog.listColumns(f"{name}.other")],
            "what string, name string, n long")
        functions = tables.functions_like(spark, "double*").where(F.col("function").contains(name)).agg(
            F.lit("function").alias("what"), F.lit("double_it").alias("name"), F.count("*").alias("n"))
        user = tables.one_row(
            spark, what="'user'", name="'set'", n="CAST(length(current_user()) > 0 AS BIGINT)")
        seen = spark.createDataFrame(
            [("preview", "other", len(tables.preview(spark.table(f"{name}.other"), 3)))],
            "what string, name string, n long")
        out = columns
        for more in (*counts, functions, user, seen):
            out = out.unionByName(more)
        out = written(spark, out, "listing")
    left = spark.sql(f"SHOW DATABASES LIKE '{name}'").agg(
        F.lit("left behind").alias("what"), F.lit("databases").alias("name"), F.count("*").alias("n"))
    return out.unionByName(left)


def csv_export(spark: SparkSession, root: str) -> DataFrame:
    """Customers written as CSV and read back under their schema."""
    path = work_dir(spark, "csv")
    tables.write_csv(tables.read_table(spark, root, "customer"), path)
    return spark.read.schema(TABLES["customer"]).option("header", True).csv(path)


def row_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the relational tables."""
    counts = [tables.read_table(spark, root, t).agg(F.count("*").alias("n_rows")).select(
        F.lit(t).alias("table_name"), "n_rows") for t in COUNTED]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def binary_scan(spark: SparkSession, root: str) -> DataFrame:
    """Files of the relational tables: listed size against the length of the content read."""
    pattern = "{" + ",".join(f"{t}.parquet" for t in COUNTED) + "}"
    listed = tables.directory_listing(spark, root, pattern)
    read = tables.bytes_read(spark, root, pattern)
    return listed.join(read, "name", "left").select(
        "name", (F.col("size") == F.coalesce("read", F.lit(0))).alias("same_size"))


QUERIES = {f.__name__: f for f in (table_sinks, catalog_listing, csv_export, row_counts, binary_scan)}

ORACLE = {
    "table_sinks": """SELECT s_nationkey AS nation, count(*) AS suppliers, min(s_name) AS first_name
FROM supplier GROUP BY s_nationkey""",
    "catalog_listing": """SELECT 'table' AS what, 'supplier_even' AS name, count(*) FILTER (s_suppkey % 2 = 0) AS n FROM supplier
UNION ALL SELECT 'table', 'supplier_odd', count(*) FILTER (s_suppkey % 2 = 1) FROM supplier
UNION ALL SELECT 'column', c, 1 FROM (VALUES ('s_suppkey'), ('s_name'), ('s_nationkey'), ('s_acctbal')) t(c)
UNION ALL SELECT 'function', 'double_it', 1 UNION ALL SELECT 'user', 'set', 1
UNION ALL SELECT 'preview', 'other', least(3, count(*) FILTER (s_suppkey % 2 = 0)) FROM supplier
UNION ALL SELECT 'left behind', 'databases', 0""",
    "csv_export": "SELECT * FROM customer",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in COUNTED),
    "binary_scan": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS name, TRUE AS same_size" for t in COUNTED),
}
