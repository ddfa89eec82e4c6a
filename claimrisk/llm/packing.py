"""Packing token ids into fixed rows: best fit decreasing with a capacity search tree.

Documents are cut into parts of at most one row, losslessly.  Parts are packed in blocks of a
bounded number of tokens, each inside one task and without a shuffle: longest part first, into
the row with the least free room that still holds it.  A segment tree over free room finds that
row in logarithmic time.  A packed row carries its ids padded to the row length, the cumulative
lengths of its segments, position ids that start again at 0 with every segment, and which
document, part and token offset each segment is.

Null and empty texts have no part and appear in no row; texts of any length are cut into as many
parts as needed; repeated rows are packed each for itself; ties go by order of arrival; empty
tables give no rows.  Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimrisk.llm.bytebpe import read_ranks
from claimrisk.llm.frames import BATCH_ROWS, kept_by_worker, ragged, texts_of

ROW_TOKENS = 2048
BLOCK_TOKENS = 2_000_000  # packed at once in a task; bounds memory, not what is packed

PACKED = (
    "doc_ids array<long>, parts array<int>, starts array<long>, cu_seqlens array<int>, "
    "input_ids array<int>, position_ids array<int>, n_tokens int")


def ordinary_encoding(rank_file: bytes, pattern: str):
    """The library's own encoder for a rank file, without special tokens."""
    import tiktoken
    return tiktoken.Encoding(
        "packing", pat_str=pattern, special_tokens={},
        mergeable_ranks={t: rank for rank, t in enumerate(read_ranks(rank_file))})


class FreeRoom:
    """Rows by free room; a segment tree tells which amounts of room occur."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.rows = np.zeros(2 * self.leaves, np.int64).tolist()  # rows below each node
        self.lists: dict[int, list[int]] = {}

    def _add(self, room: int, n: int) -> None:
        node = room + self.leaves
        while node:
            self.rows[node] += n
            node >>= 1

    def put(self, room: int, row: int) -> None:
        self.lists.setdefault(room, []).append(row)
        self._add(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The least room of at least ``length`` and the row that had it last."""
        node = length + self.leaves
        if not self.rows[node]:
            while node > 1 and (node & 1 or not self.rows[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.rows[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return room, self.lists[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Indices of the parts in each row."""
    tree, rows = FreeRoom(capacity), []
    for part in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[part])
        if found is None:
            found = capacity, len(rows)
            rows.append([])
        room, row = found
        rows[row].append(part)
        if room > lengths[part]:
            tree.put(room - lengths[part], row)
    return rows


def _matrix(parts: list[tuple[int, int, int, np.ndarray]], capacity: int,
            pad_id: int) -> dict[str, list | pa.Array]:
    """Packed rows of one block of (doc_id, part, start, ids)."""
    rows = best_fit_decreasing([len(p[3]) for p in parts], capacity)
    ids = np.full((len(rows), capacity), pad_id, np.int32)
    positions = np.zeros((len(rows), capacity), np.int32)
    ends, counting = [], np.arange(capacity, dtype=np.int32)
    for r, members in enumerate(rows):
        at = [0]
        for m in members:
            own = parts[m][3]
            ids[r, at[-1]:at[-1] + len(own)] = own
            positions[r, at[-1]:at[-1] + len(own)] = counting[:len(own)]
            at.append(at[-1] + len(own))
        ends.append(at)
    return {
        "doc_ids": [[parts[m][0] for m in row] for row in rows],
        "parts": [[parts[m][1] for m in row] for row in rows],
        "starts": [[parts[m][2] for m in row] for row in rows],
        "cu_seqlens": ends, "input_ids": ragged(list(ids), np.int32),
        "position_ids": ragged(list(positions), np.int32), "n_tokens": [e[-1] for e in ends]}


def packed(spark: SparkSession, docs: DataFrame, rank_file: str, pattern: str, pad_id: int,
           row_tokens: int = ROW_TOKENS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The packed rows of all documents (columns of ``PACKED``)."""
    with open(rank_file, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())
    arrow = to_arrow_schema(T._parse_datatype_string(PACKED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = kept_by_worker("encoding", data.value + pattern.encode(),
                                  lambda: ordinary_encoding(data.value, pattern))

        def emit(parts):
            out = _matrix(parts, row_tokens, pad_id)
            table = pa.RecordBatch.from_arrays(
                [a if isinstance(a := out[f.name], pa.Array) else pa.array(a, f.type)
                 for f in arrow], schema=arrow)
            for start in range(0, table.num_rows, BATCH_ROWS):
                yield table.slice(start, BATCH_ROWS)

        block, held = [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(first, BATCH_ROWS)
                ids = [np.array(encoding.encode_ordinary(t), np.int32)
                       for t in part.column("text").to_pylist()]
                for doc_id, own in zip(part.column("doc_id").to_pylist(), ids):
                    for n, start in enumerate(range(0, len(own), row_tokens)):
                        cut = own[start:start + row_tokens]
                        if block and held + len(cut) > block_tokens:
                            yield from emit(block)
                            block, held = [], 0
                        block.append((doc_id, n, start, cut))
                        held += len(cut)
        if block:
            yield from emit(block)

    return texts_of(docs).mapInArrow(run, PACKED)


def write_packed(rows: DataFrame, path: str) -> None:
    """Write packed rows as Parquet: the id matrix and its lengths and positions."""
    rows.write.parquet(path)


def segments(rows: DataFrame) -> DataFrame:
    """One row per segment: doc_id, part, start and ids, taken back out of the matrix."""
    one = F.posexplode(F.arrays_zip("doc_ids", "parts", "starts")).alias("n", "s")
    at = F.element_at("cu_seqlens", F.col("n") + 1)
    return (rows.select("cu_seqlens", "input_ids", one)
            .select(F.col("s.doc_ids").alias("doc_id"), F.col("s.parts").alias("part"),
                    F.col("s.starts").alias("start"),
                    F.slice("input_ids", at + 1,
                            F.element_at("cu_seqlens", F.col("n") + 2) - at).alias("ids")))
