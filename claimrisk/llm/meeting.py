"""Finding the documents in which equal hashes occur, without gathering hot hashes.

Tasks look at texts in flushes of a bounded size.  Of a hash that several documents of a flush
have, one record goes to the hash's shard; the others already know a smaller document that has it
and only pass through, dealt over all shards.  A shard thus sees a hash at most once per flush.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from claimrisk.llm.frames import BATCH_ROWS
from claimrisk.llm.hashing import mixed

FLUSH_CHARS = 16_000_000  # of the texts a task looks at together
NOBODY = -(2 ** 63)


def _column(column: pa.Array) -> list:
    """The values of a column; lists of numbers stay arrays."""
    if not pa.types.is_list(column.type) or column.null_count or column.values.null_count or not (
            pa.types.is_integer(column.type.value_type)):
        return column.to_pylist()
    values, ends = column.values.to_numpy(), column.offsets.to_numpy().tolist()
    return [values[a:b] for a, b in zip(ends, ends[1:])]


def flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows in groups of about FLUSH_CHARS of text, one row at least."""
    held, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(start, BATCH_ROWS)
            for values in zip(*map(_column, part.columns)):
                row = dict(zip(part.schema.names, values))
                if held and size + len(row["text"]) > FLUSH_CHARS:
                    yield held
                    held, size = [], 0
                held.append(row)
                size += len(row["text"])
    if held:
        yield held


def by_text(rows: list[dict]) -> list[dict]:
    """Of rows with equal text the one with the smallest id; the others are copies of it."""
    first: dict[str, dict] = {}
    for row in rows:
        known = first.get(row["text"])
        if known is None or row["doc_id"] < known["doc_id"]:
            first[row["text"]] = row
    return list(first.values())


def planes(x: np.ndarray) -> bytes:
    """Numbers by byte planes: the shuffle's compression finds the equal bytes."""
    return np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<i8").ravel()


COLUMNS = ("hash", "doc_id", "partner", "documents")


def _records(docs: DataFrame, hashes_of: Callable[[], Callable[[str], np.ndarray]],
             shards: int) -> DataFrame:
    """Per shard arrays of hashes with document, smaller document (if known) and count here."""
    def run(batches):
        function = hashes_of()
        for rows in flushes(batches):
            hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for row in by_text(rows):
                own = function(row["text"])
                hashes.append(own)
                owners.append(np.full(len(own), row["doc_id"], np.int64))
            hash_, owner = np.concatenate(hashes), np.concatenate(owners)
            if not len(hash_):
                continue
            order = np.lexsort((owner, hash_))
            hash_, owner = hash_[order], owner[order]
            new = np.r_[True, hash_[1:] != hash_[:-1]]
            fresh = np.r_[True, new[1:] | (owner[1:] != owner[:-1])]  # repeated ids count once
            starts = np.flatnonzero(new)
            count = np.zeros(len(hash_), np.int64)
            count[starts] = np.add.reduceat(fresh.astype(np.int64), starts)
            partner = np.where(new, NOBODY, owner[starts][np.cumsum(new) - 1])
            spread = np.where(new, hash_, hash_ + owner.astype(np.uint64) * np.uint64(0x9E3779B1))
            shard = (mixed(spread) % np.uint64(shards)).astype(np.int64)
            by_shard = np.argsort(shard[fresh], kind="stable")
            columns = [x[fresh][by_shard] for x in (hash_.view(np.int64), owner, partner, count)]
            sizes = np.bincount(shard[fresh], minlength=shards)
            ends = np.cumsum(sizes)
            some = np.flatnonzero(sizes)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(some, pa.int32()),
                **{c: pa.array([planes(x[ends[k] - sizes[k]:ends[k]]) for k in some], pa.binary())
                   for c, x in zip(COLUMNS, columns)}})

    return docs.select("doc_id", "text").mapInArrow(
        run, "shard int, " + ", ".join(f"{c} binary" for c in COLUMNS))


def met(docs: DataFrame, hashes_of: Callable[[], Callable[[str], np.ndarray]],
        shards: int) -> DataFrame:
    """doc_id, hash, partner and documents of hashes that occur in two documents.

    docs: doc_id and text, both not null; ``hashes_of`` gives, once per task, the function from a
    text to its distinct hashes.  Only the smallest document of equal texts of a flush takes part.
    partner: a smaller document with the hash (null for the smallest); documents: how many have
    the hash (0: counted at another record of the hash).
    """
    def run(batches):
        shards: dict[int, list] = {}
        for batch in batches:
            for r in batch.to_pylist():
                shards.setdefault(r["shard"], []).append([unplanes(r[c]) for c in COLUMNS])
        while shards:
            hash_, doc, partner, count = (np.concatenate(x) for x in zip(*shards.popitem()[1]))
            settled = count == 0
            yield _batch(hash_[settled], doc[settled], partner[settled], count[settled])
            hash_, doc, count = hash_[~settled], doc[~settled], count[~settled]
            if not len(hash_):
                continue
            order = np.lexsort((doc, hash_))
            hash_, doc, count = hash_[order], doc[order], count[order]
            starts = np.flatnonzero(np.r_[True, hash_[1:] != hash_[:-1]])
            sizes = np.diff(np.r_[starts, len(hash_)])
            last = doc[starts + sizes - 1]
            keep = np.repeat((doc[starts] != last) | (np.maximum.reduceat(count, starts) > 1), sizes)
            total = np.repeat(np.add.reduceat(count, starts), sizes)
            first = np.repeat(doc[starts], sizes)
            partner = np.where(first < doc, first, NOBODY)
            yield _batch(hash_[keep], doc[keep], partner[keep], total[keep])

    return _records(docs, hashes_of, shards).repartition(shards, "shard").mapInArrow(
        run, ", ".join(f"{c} long" for c in COLUMNS))


def _batch(hash_, doc, partner, documents) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "hash": pa.array(hash_, pa.int64()), "doc_id": pa.array(doc, pa.int64()),
        "partner": pa.array(partner, pa.int64(), mask=partner == NOBODY),
        "documents": pa.array(documents, pa.int64())})
