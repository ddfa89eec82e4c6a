"""Tables the registered queries share: written once per application to the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from claimrisk.plans import features
from claimrisk.session import COMPRESSION, release, work_dir
from claimrisk.sources import domain

_TABLES: dict[tuple, tuple[str, StructType]] = {}
_STAGED: dict[tuple, features.Staged] = {}
SOURCES = ("lineitem", "orders", "part", "customer", "supplier")


def source_key(spark: SparkSession, root: str) -> tuple:
    """Application, folder, and the size, number and time of the files the tables come from.

    A folder whose files changed is another source: nothing built from the old files is read.
    """
    jvm, out = spark._jvm, [spark.sparkContext.applicationId, root.rstrip("/")]
    for name in SOURCES:
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}.parquet")
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        held = system.getContentSummary(path)
        out.append((held.getLength(), held.getFileCount(), system.getFileStatus(path).getModificationTime()))
    return tuple(out)


def once(spark: SparkSession, root: str, name: str, build: Callable[[], DataFrame],
         partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The table ``name`` derived from the data folder, built on first use and read afterwards."""
    key = (*source_key(spark, root), name)
    if key not in _TABLES:
        path, df = work_dir(spark, name), build()
        df.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*partition_by).parquet(path)
        _TABLES[key] = path, df.schema
        del df
        release(spark)
    path, schema = _TABLES[key]
    return spark.read.schema(schema).parquet(path)


def location(spark: SparkSession, root: str, name: str) -> tuple[str, StructType]:
    """Folder and schema of a table built by ``once``."""
    return _TABLES[(*source_key(spark, root), name)]


def silver(spark: SparkSession, root: str) -> domain.Domain:
    """The mapped domain over written treatments, partitioned into claims and network."""
    rows = once(spark, root, "treatments", lambda: domain.treatments(spark, root), ("l_returnflag",))
    return domain.mapped_domain(spark, root, rows)


def staged(spark: SparkSession, root: str) -> features.Staged:
    """The entity, pair and document summaries of the mapped claims."""
    d = silver(spark, root)
    key = source_key(spark, root)
    if key not in _STAGED:
        _STAGED[key] = features.stage(spark, d)
    return _STAGED[key]


def gold(spark: SparkSession, root: str) -> DataFrame:
    """The written feature table, with the extra claim columns the queue and the rules need."""
    return once(
        spark, root, "features",
        lambda: features.feature_table(
            spark, silver(spark, root), staged(spark, root), extra=("proc_date", "document")))
