"""Helpers for operators that map Arrow batches inside Spark tasks."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows handed to Python at once; long texts make even few rows large.
BATCH_ROWS = 512
PAIR_ROWS = 32  # where every row holds two texts


def map_batches(df: DataFrame, schema: str | T.StructType,
                work: Callable[[], Callable[[dict[str, list]], dict[str, list]]],
                at_once: int = BATCH_ROWS) -> DataFrame:
    """Apply a function of column lists to every batch of at most ``at_once`` rows.

    ``work`` is called once per task and returns the function, so that models are built on the
    executor.  Output columns may hold more or fewer rows than the input.
    """
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = work()
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                out = function({n: part.column(i).to_pylist()
                                for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays(
                    [a if isinstance(a := out[f.name], pa.Array) else pa.array(a, f.type)
                     for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def kept_by_worker(name: str, key: bytes, build: Callable):
    """An object built once per Python worker and used by all its tasks.

    Only for what is costly to build and the same for equal keys, such as a tokenizer.
    """
    home = sys.modules.setdefault("claimrisk_worker", types.ModuleType("claimrisk_worker")).__dict__
    known = home.get(name)
    if known is None or known[0] != key:
        home[name] = known = key, build()
    return known[1]


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """The document id and whole text (null: empty), and further columns as they are."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def ragged(parts: list, dtype) -> pa.Array:
    """A list column from numpy arrays without a Python object per element."""
    import numpy as np
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    values = np.concatenate(parts) if parts else np.zeros(0, dtype)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(dtype, copy=False)))
