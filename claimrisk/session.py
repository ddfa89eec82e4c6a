"""Session settings and the shared work folder."""

from __future__ import annotations

import gc
import os
import sys
import tempfile
import threading
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Runtime settings every plan in this package relies on.  They are plain SQL settings, so
# they can be applied to a session somebody else created.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows partitioned by one key stay in place for joins on that key and more columns
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # rows handed to Python at once; texts make rows large
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}

COMPRESSION = "zstd"  # of intermediate tables, which are read once or a few times


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it.

    Functions of this package travel to the Python workers by value, so executors need no copy
    of it.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "claimrisk", **extra: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    n = os.cpu_count() or 8 if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder the session names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a folder of one
    machine is invisible to the others and is lost with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="claimrisk-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def checkpoint_folder(spark: SparkSession) -> None:
    """Give the context a folder for checkpoints; boosting cuts the lineage of its rounds there."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark, "checkpoints"))


def checkpointed(df):
    """``df`` with its rows in the shared folder and no lineage above them."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


_OPEN = threading.local()  # scopes of intermediate tables, the innermost last


def written(spark: SparkSession, df, name: str):
    """Write ``df`` to the shared folder and read it back: the lineage ends at the files."""
    path = work_dir(spark, name)
    df.write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    scopes = getattr(_OPEN, "scopes", [])
    if scopes:
        scopes[-1].paths[id(table)] = path, table
    return table


def release(spark: SparkSession) -> None:
    """Let the shuffle files go of plans that nobody holds any more."""
    gc.collect()
    spark._jvm.System.gc()


class intermediate:
    """A block whose written tables are deleted behind it, but for those it keeps.

    What leaves the block has to be a kept table, or rest on kept tables only.  Kept tables belong
    to the block around it.  Shuffle files of plans that nobody holds any more are released as well.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.kept = spark, {}, set()

    def keep(self, table):
        self.kept.add(id(table))
        return table

    def __enter__(self) -> intermediate:
        _OPEN.scopes = [*getattr(_OPEN, "scopes", []), self]
        return self

    def __exit__(self, *_) -> None:
        _OPEN.scopes = _OPEN.scopes[:-1]
        jvm = self.spark._jvm
        for key, (name, table) in self.paths.items():
            if key not in self.kept:
                path = jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            elif _OPEN.scopes:
                _OPEN.scopes[-1].paths[key] = name, table
        self.paths = {}
        release(self.spark)
