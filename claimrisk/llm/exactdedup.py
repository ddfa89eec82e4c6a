"""Removal of repeated byte strings, judged by suffix arrays over content shards.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a smaller
id.  Every window of LENGTH bytes has an anchor: the least of the hashed grams in it.  Equal windows
have equal anchors, so windows are brought together by anchor, and only anchors that occur in two
documents matter.  Neighbouring windows with one anchor travel as one segment; the segments of a
shard are sorted by an induced-sorting suffix array, whose permuted common prefixes tell which
windows are equal; all but those of the smallest document are removed.

Hot strings: a task keeps one document for each anchor and each segment it has several of, settles
the others on the spot, and so sends on at most one of them.  Anchors that are still very frequent
are cut into single windows, dealt by the window's own hash.  Documents of equal text are settled
by their digest.  Work is recomputed from written tables in the shared folder.

Null and empty texts lose nothing; texts of any length are treated whole.  Rows that repeat an id
count as one document and do not remove each other.  Rows with a null id are kept whole and remove
nothing.  Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.llm import meeting
from claimrisk.llm.frames import BATCH_ROWS
from claimrisk.llm.hashing import mixed, prefix_sums, stretches_of
from claimrisk.llm.meeting import flushes
from claimrisk.llm.suffixarray import permuted_common_prefixes, suffix_array
from claimrisk.session import written

LENGTH, GRAM = 50, 20
GRAMS = LENGTH - GRAM + 1  # in a window
SHARD_ANCHORS, SHARD_BYTES = 500_000, 1_000_000  # aimed at in a shard
HOT_ROWS = 20_000  # of one anchor, from which it is cut into windows


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the anchor of each window, and its position; empty for short texts."""
    n = len(data) - LENGTH + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.arange(len(data) - GRAM + 1)
    hashes = stretches_of(prefix_sums(data), GRAM)
    low = np.uint64(0xFFFFFFFF)
    least = (hashes & ~low) | at.astype(np.uint64)  # the first of equal grams
    width = 1
    while 2 * width <= GRAMS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < GRAMS:
        least = np.minimum(least[:n], least[GRAMS - width:GRAMS - width + n])
    position = (least & low).astype(np.int64)
    return hashes[position], position


def runs(anchor: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First windows and ends of the runs of windows with one anchor."""
    if not len(anchor):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.flatnonzero(np.r_[True, position[1:] != position[:-1]])
    return new, np.r_[new[1:], len(anchor)]


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def _cut(raw: bytes, begin: np.ndarray, end: np.ndarray, shard: np.ndarray, hot: np.ndarray, shards: int
         ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs with the hot ones cut into single windows, dealt by the window's own hash."""
    out = []
    for a, b, h, c in zip(begin.tolist(), end.tolist(), shard.tolist(), hot.tolist()):
        if not c:
            out.append((a, b, h))
            continue
        for w in range(a, b):
            h = int.from_bytes(hashlib.blake2b(raw[w:w + LENGTH], digest_size=8).digest(), "big")
            out.append((w, w + 1, h % shards))
    return tuple(np.array(x, np.int64) for x in zip(*out)) if out else (begin, end, shard)


def _segments(found: DataFrame, shards: int) -> DataFrame:
    """Segments to be sorted, by shard, and windows that are settled here (text null).

    Both carry doc_id, mark, start and stop: the windows of the document that begin there.
    """
    def run(batches):
        for rows in flushes(batches):
            first: dict[bytes, int] = {}
            texts: list[bytes | None] = []
            parts = [np.zeros((5, 0), np.int64)]
            for row in sorted(rows, key=lambda r: r["doc_id"]):
                data, doc = _bytes(row["text"]), row["doc_id"]
                raw = data.tobytes()
                anchor, position = anchors(data)
                start, stop = runs(anchor, position)
                wanted = np.sort(np.array(row["hashes"], np.int64).view(np.uint64))
                own = np.isin(anchor[start], wanted)
                begin, end, shard = start[own], stop[own], mixed(anchor[start[own]]) % np.uint64(shards)
                if len(row["hot"]):
                    hot = np.sort(np.array(row["hot"], np.int64).view(np.uint64))
                    begin, end, shard = _cut(raw, begin, end, shard, np.isin(anchor[start[own]], hot), shards)
                if not len(begin):
                    continue
                pieces = [raw[a:b + LENGTH - 1] for a, b in zip(begin.tolist(), end.tolist())]
                settled = np.array([first.setdefault(p, doc) < doc for p in pieces])
                # settled windows that go on to the next piece are one run
                on = settled[1:] & settled[:-1] & (begin[1:] == end[:-1])
                head, tail = np.flatnonzero(np.r_[True, ~on]), np.flatnonzero(np.r_[~on, True])
                begin, settled = begin[head], settled[head]
                texts += [None if known else pieces[k] for k, known in zip(head.tolist(), settled.tolist())]
                parts.append(np.stack([
                    np.where(settled, (doc + begin) % shards, shard[head].astype(np.int64)),
                    np.full(len(head), doc), np.full(len(head), row["mark"]), begin, end[tail]]))
            at, *columns = np.concatenate(parts, axis=1)
            batch = pa.RecordBatch.from_pydict({
                "shard": pa.array(at, pa.int32()), "text": pa.array(texts, pa.binary()),
                **{c: pa.array(v, pa.int64()) for c, v in zip(("doc_id", "mark", "start", "stop"), columns)}})
            for k in range(0, batch.num_rows, 20_000):
                yield batch.slice(k, 20_000)

    return found.mapInArrow(
        run, "shard int, text binary, doc_id long, mark long, start long, stop long")


def _joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each followed by a zero, and the lengths of the texts."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    sizes = np.diff(offsets).astype(np.int64)
    out = np.zeros(int(sizes.sum()) + len(sizes), np.uint8)
    inside = np.ones(len(out), bool)
    inside[np.cumsum(sizes + 1) - 1] = False
    out[inside] = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return out, sizes


def repeated_windows(texts: list[bytes] | pa.Array, docs: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that also start in a text of a smaller document: text, first window and end."""
    distinct = pa.array(texts, pa.binary()).dictionary_encode()
    which = distinct.indices.to_numpy()
    least = np.full(len(distinct.dictionary), np.iinfo(np.int64).max)
    np.minimum.at(least, which, docs)
    joined, sizes = _joined(distinct.dictionary)
    # separators and the end mark are smaller than every byte
    s = joined.astype(np.uint16) + np.uint16(2)
    ends = np.cumsum(sizes + 1) - 1
    s[ends] = 1
    sa = suffix_array(np.append(s, np.uint16(0)))[1:]
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    # a window begins here and ends in the same text
    whole = np.arange(len(s)) + LENGTH <= ends[owner]
    order = sa[whole[sa]]
    # between equal windows there are none but equal ones: suffixes between share as much
    shared = permuted_common_prefixes(
        np.append(joined, np.zeros(LENGTH + 16, np.uint8)), order, LENGTH)
    new = np.ones(len(order), bool)
    new[1:] = shared[order[1:]] < LENGTH
    group = np.cumsum(new) - 1
    smallest = np.minimum.reduceat(least[owner[order]], np.flatnonzero(new)) if len(order) else order
    of_window = np.zeros(len(s), np.int64)
    of_window[order] = smallest[group] if len(order) else 0
    # the windows of all texts, one text after another
    counts = np.maximum(sizes - LENGTH + 1, 0)[which]
    after = np.cumsum(counts)
    owner = np.repeat(np.arange(len(which)), counts)
    at = np.arange(len(owner)) - (after - counts)[owner]
    again = of_window[(ends - sizes)[which][owner] + at] < docs[owner]
    first = np.flatnonzero(again & ((at == 0) | ~np.r_[False, again[:-1]]))
    last = np.flatnonzero(again & ((at == counts[owner] - 1) | ~np.r_[again[1:], False]))
    return owner[first], at[first], at[last] + 1


def _sorted_shards(segments: DataFrame) -> DataFrame:
    """doc_id, mark, start, stop of the runs of repeated windows."""
    def run(batches):
        held = []
        names = ("doc_id", "mark", "start", "stop")
        for batch in batches:
            settled = batch.column("text").is_null()
            yield batch.filter(settled).select(names)
            held.append(batch.filter(pa.compute.invert(settled)))
        if not sum(b.num_rows for b in held):
            return
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        held.clear()
        shard, docs, marks, starts = (table.column(c).to_numpy() for c in ("shard", *names[:3]))
        order = np.argsort(shard, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            which, first, end = repeated_windows(table.column("text").take(pa.array(rows)), docs[rows])
            which = rows[which]
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in zip(
                names, (docs[which], marks[which], starts[which] + first, starts[which] + end))})

    return segments.mapInArrow(run, "doc_id long, mark long, start long, stop long")


def spans(windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of removed bytes from the runs of repeated windows."""
    out: list[list[int]] = []
    for start, stop in sorted(windows):
        end = stop + LENGTH - 1
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def _results(found: DataFrame) -> DataFrame:
    """doc_id, mark, spans and the bytes that stay."""
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                rows = batch.slice(start, BATCH_ROWS).to_pylist()
                cut, kept = [], []
                for r in rows:
                    data = r["text"].encode()
                    own = spans([(w["start"], w["stop"]) for w in r["windows"]])
                    at, parts = 0, []
                    for a, b in own:
                        parts.append(data[at:a])
                        at = b
                    cut.append([{"start": a, "stop": b} for a, b in own])
                    kept.append(b"".join([*parts, data[at:]]))
                span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
                yield pa.RecordBatch.from_pydict({
                    **{c: pa.array([r[c] for r in rows], pa.int64()) for c in ("doc_id", "mark")},
                    "spans": pa.array(cut, pa.list_(span)), "kept": pa.array(kept, pa.binary())})

    return found.mapInArrow(
        run, "doc_id long, mark long, spans array<struct<start:long,stop:long>>, kept binary")


def cut_documents(spark: SparkSession, docs: DataFrame,
                  of_kept: Callable[[Column], Column] = lambda kept: kept) -> DataFrame:
    """doc_id, n_bytes, sha256 of the text, spans (removed) and kept (null: the whole text).

    ``of_kept`` makes kept from the bytes that stay, before they are moved; by default they are
    the column themselves.  The pair of doc_id and mark names a text, so that rows which repeat
    an id stay apart.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "mark", F.xxhash64("text"))
    named = texts.where("doc_id is not null")
    digests = written(spark, texts.select(
        "doc_id", "mark", F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2("text", 256).alias("sha256")), "digests")
    original = digests.where("doc_id is not null").groupBy("sha256").agg(
        F.min("doc_id").alias("original"))
    standing = digests.join(original, "sha256", "left").withColumn(
        "copy", F.coalesce((F.col("original") < F.col("doc_id")) & (F.col("n_bytes") >= LENGTH),
                           F.lit(False))).drop("original")
    own = standing.where("not copy and doc_id is not null").select("doc_id", "mark").distinct()
    size = digests.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(width, size // (GRAMS + 1) * 2 // SHARD_ANCHORS)
    shared = written(spark, meeting.met(
        named, lambda: lambda text: np.unique(anchors(_bytes(text))[0]), shards), "shared")
    hot = written(spark, shared.where(F.col("documents") > HOT_ROWS).select("hash").distinct()
                  .withColumn("hot", F.lit(True)), "hot")
    wanted = (shared.join(hot, "hash", "left").groupBy("doc_id").agg(
        F.collect_set("hash").alias("hashes"),
        F.collect_set(F.when(F.col("hot"), F.col("hash"))).alias("hot"))
        .join(own, "doc_id"))
    found = named.join(wanted, ["doc_id", "mark"])
    shards = max(width, shared.count() * 70 // SHARD_BYTES)
    windows = _sorted_shards(_segments(found, shards).repartition(shards, "shard"))
    grouped = windows.groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("start", "stop")).alias("windows"))
    changed = _results(found.select("doc_id", "mark", "text").join(grouped, ["doc_id", "mark"]))
    changed = changed.select("doc_id", "mark", "spans", of_kept(F.col("kept")).alias("kept"))
    if digests.groupBy("doc_id", "mark").count().where("count > 1").limit(1).count():
        changed = changed.dropDuplicates(["doc_id", "mark"])  # of rows that repeat id and text
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    empty = F.lit([]).cast("array<struct<start:long,stop:long>>")
    return standing.join(changed, ["doc_id", "mark"], "left").select(
        "doc_id", "n_bytes", "sha256",
        F.when(F.col("copy"), whole).otherwise(F.coalesce("spans", empty)).alias("spans"),
        F.when(F.col("copy"), of_kept(F.lit(b""))).otherwise(F.col("kept")).alias("kept"))


def digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of the bytes that stay."""
    return cut_documents(spark, docs, lambda kept: F.sha2(kept, 256)).select(
        "doc_id", "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.stop - s.start)
        .alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.coalesce("kept", "sha256").alias("kept_sha256"))
