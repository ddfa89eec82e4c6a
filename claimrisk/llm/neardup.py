"""Near-duplicate documents by a multi-index Hamming join of b-bit min-hash signatures.

A document's set holds its word shingles.  ``SYMBOLS`` min-hashes of ``BITS`` bits form its
signature, cut into chunks of ``CHUNK`` symbols.  Two signatures that differ in at most
chunks * (ERRORS + 1) - 1 symbols differ, by the pigeonhole principle, in at most ``ERRORS`` symbols
of some chunk; all ways to leave out that many symbols of a chunk are enumerated as keys, so every
such pair shares a key.  At a similarity of 0.8 a pair exceeds the distance with a probability of
about two in a million.

Documents of equal sets are one node from the start.  Components are all that is asked for, so the
nodes of a key are not paired with each other.  In rounds, every key whose nodes lie in several
components names a centre, the node whose keys are most frequent, and every node of another
component is compared with the ``NEAREST`` centres it shares most keys with; rounds go on while they
find links for a share of the nodes they test.  Then the keys that are still open are searched once
for pairs of different components: sizes and a sketch of ``SKETCH`` bytes must allow the similarity,
and a pair is seen in the first key it shares only.  A key with few such pairs hands them on to be
confirmed.  In a key with many the texts themselves are fetched, by blocks of about ``BLOCK`` nodes,
each block with every other, and what is linked there is not compared again; only links leave.  No
pair of different components that shares a key stays untested.  Every link is confirmed on full sets.

Null and empty texts, or texts without words, have no shingles and no links; texts with fewer words
than a shingle have one.  Rows with a null id are returned on their own (component null, kept).
Rows that repeat an id are one document.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimrisk.llm.frames import PAIR_ROWS, map_batches, ragged, texts_of
from claimrisk.llm.graph import components
from claimrisk.llm.hashing import mixed, shingles, words_of
from claimrisk.session import intermediate, written

CHUNKS, CHUNK, ERRORS, BITS = 12, 4, 1, 16
SYMBOLS = CHUNKS * CHUNK
PERCENT = 80  # least similarity
SKETCH = 128  # bytes, the first of them from the signature
LEAST_EQUAL = 80  # of them in a pair: five deviations below what a similarity of 0.8 gives
BLOCK, NEAREST = 2048, 2
FRUITFUL = 0.02  # rounds go on while they link at least this share of the nodes they test
SMALL = 32       # nodes of a key whose pairs are looked at all at once
DENSE = 8        # pairs a node, beyond which the pairs of a key stay in the task
_RANDOM = np.random.Generator(np.random.PCG64(7))
FACTORS = _RANDOM.integers(0, 2**64, SKETCH, np.uint64) | np.uint64(1)
SHIFTS = _RANDOM.integers(0, 2**64, SKETCH, np.uint64)


def shingle_set(text: str, words: int) -> np.ndarray:
    return np.unique(shingles(words_of(text)[0], words))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of SKETCH 16-bit min-hashes for each set, none of them empty."""
    all_, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), SKETCH), np.uint16)
    for i in range(SKETCH):
        least = np.minimum.reduceat(all_ * FACTORS[i] + SHIFTS[i], starts)
        out[:, i] = (least * FACTORS[0] >> np.uint64(64 - BITS)).astype(np.uint16)
    return out


def chunk_keys(signature: np.ndarray) -> np.ndarray:
    """For each row the keys of all its chunks with ERRORS symbols left out."""
    wide, keys = signature.astype(np.int64), []
    for chunk in range(CHUNKS):
        for left in combinations(range(CHUNK), CHUNK - ERRORS):
            key = np.full(len(wide), len(keys), np.int64)
            for i in left:
                key = key << BITS | wide[:, chunk * CHUNK + i]
            keys.append(key)
    return np.stack(keys, 1)


def described(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, sketch, keys and their prints (null without shingles)."""
    def work():
        def function(rows):
            sets = [shingle_set(t, words) for t in rows["text"]]
            some = [i for i, s in enumerate(sets) if len(s)]
            signature = signatures([sets[i] for i in some]) if some else np.zeros((0, SKETCH), "u2")
            keys = [np.zeros(0, np.int64)] * len(sets)
            marks: list[bytes | None] = [None] * len(sets)
            prints: list[bytes | None] = [None] * len(sets)
            for row, i, own in zip(signature, some, chunk_keys(signature)):
                keys[i], marks[i] = own, row.astype(np.uint8).tobytes()
                prints[i] = (mixed(own.view(np.uint64)) >> np.uint64(32)).astype("<u4").tobytes()
            return {
                "doc_id": rows["doc_id"], "n_shingles": [len(s) for s in sets],
                "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                           for s in sets],
                "sketch": pa.array(marks, pa.binary()), "keys": ragged(keys, np.int64),
                "prints": pa.array(prints, pa.binary())}
        return function

    return map_batches(texts_of(docs), "doc_id long, n_shingles long, digest binary, "
                       "sketch binary, keys array<long>, prints binary", work)


def _matrix(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, SKETCH)


def _close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs u, v whose sizes and sketches allow the similarity."""
    def named(c):
        return nodes.select(F.col("node").alias(c), F.col("n_shingles").alias(f"{c}n"),
                            F.col("sketch").alias(f"{c}s"))

    both = pairs.join(named("u"), "u").join(named("v"), "v").where(
        100 * F.least("un", "vn") >= PERCENT * F.greatest("un", "vn"))

    def work():
        def function(rows):
            near = ((_matrix(rows["us"]) == _matrix(rows["vs"])).sum(1) >= LEAST_EQUAL).tolist()
            return {c: [x for x, ok in zip(rows[c], near) if ok] for c in ("u", "v")}
        return function

    return map_batches(both.select("u", "v", "us", "vs"), "u long, v long", work)


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Every row once for each pair of blocks (one, other) of its key that its own block belongs to."""
    blocks = F.ceil(F.col("count") / BLOCK)
    return rows.withColumn("block", F.pmod(F.xxhash64("node", "key"), blocks)).withColumn(
        "with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).withColumns({
            "one": F.least("block", "with"), "other": F.greatest("block", "with")}).drop("with")


GROUP = ("key", "one", "other")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole groups of equal (key, one, other), many small ones together, of rows sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = [batch.column(i).to_numpy() for i in range(3)]
        last = 0  # start of the last group of the batch
        for x in ids:
            change = np.flatnonzero(np.diff(x))
            last = max(last, int(change[-1]) + 1 if len(change) else 0)
        same = held and all(held[-1].column(i)[-1].as_py() == x[0] for i, x in enumerate(ids))
        if held and (not same or last):
            if same:
                first = min((int(c[0]) + 1 for x in ids if len(c := np.flatnonzero(np.diff(x)))), default=0)
                held.append(batch.slice(0, first))
                batch, last = batch.slice(first), last - first
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        if last:
            yield pa.Table.from_batches([batch.slice(0, last)])
        if batch.num_rows - last:
            held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class Nodes:
    """Rows of several groups: what is needed to tell which pairs can be links."""

    def __init__(self, table: pa.Table):
        self.ids = [table.column(c).to_numpy() for c in GROUP]
        self.node, self.component, self.size, self.block = (
            table.column(c).to_numpy().copy() for c in ("node", "component", "n_shingles", "block"))
        self.sketch = _matrix(table.column("sketch").to_pylist())
        new = np.zeros(len(self.node), bool)
        new[:1] = True
        for x in self.ids:
            new[1:] |= x[1:] != x[:-1]
        self.starts = np.flatnonzero(new)
        self.sizes = np.diff(np.append(self.starts, len(new)))
        self.prints = np.frombuffer(b"".join(table.column("prints").to_pylist()), "<u4").reshape(
            len(self.node), -1) if "prints" in table.column_names else None

    def possible(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Which pairs of rows lie in two components (and two blocks, if the group has two), share no
        earlier key, and have sizes and sketches that allow the similarity."""
        one, other = self.ids[1][u], self.ids[2][u]
        ok = (self.component[u] != self.component[v]) & (
            (one == other) | (self.block[u] != self.block[v])) & (
            100 * np.minimum(self.size[u], self.size[v]) >= PERCENT * np.maximum(self.size[u], self.size[v]))
        at = np.flatnonzero(ok)
        near = (self.sketch[u[at]] == self.sketch[v[at]]).sum(1, dtype=np.int16) >= LEAST_EQUAL
        ok[at[~near]] = False
        at = at[near]
        if self.prints is not None and len(at):
            place = (self.ids[0][u[at]] >> (BITS * (CHUNK - ERRORS))).astype(np.int64)
            equal = self.prints[u[at]] == self.prints[v[at]]
            ok[at[equal.argmax(1) < place]] = False
        return ok


def _pairs_within(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows (later, earlier) of each group."""
    rank = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = np.repeat(starts, sizes) + rank
    u = np.repeat(row, rank)
    first = np.repeat(np.repeat(starts, sizes), rank)
    return u, first + (np.arange(len(u)) - np.repeat(np.cumsum(rank) - rank, rank))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs u, v to be confirmed; or key, one, other of a group with too many of them (u is null)."""
    def emit(u, v, key=None):
        nothing = pa.nulls(len(u), pa.int64())
        columns = [pa.array(u), pa.array(v), nothing, nothing, nothing] if key is None else [
            nothing, nothing, *(pa.array(k) for k in key)]
        return pa.RecordBatch.from_arrays(columns, ["u", "v", *GROUP])

    for table in _groups(batches):
        rows = Nodes(table)
        small = rows.sizes <= SMALL
        pairs = rows.sizes * (rows.sizes - 1) // 2
        at = np.flatnonzero(small & (pairs > 0))
        ends = np.cumsum(pairs[at])
        for part in np.split(at, np.searchsorted(ends, np.arange(100_000, ends[-1] if len(ends) else 0, 100_000))):
            if len(part):
                u, v = _pairs_within(rows.starts[part], rows.sizes[part])
                ok = rows.possible(u, v)
                yield emit(rows.node[u[ok]], rows.node[v[ok]])
        for g in np.flatnonzero(~small):
            start, size = rows.starts[g], rows.sizes[g]
            found, many, dense = [], 0, False
            for low in range(0, size, 16):
                u = np.repeat(np.arange(low, min(low + 16, size)), size)
                v = np.tile(np.arange(size), len(u) // size)
                later = u > v
                u, v = start + u[later], start + v[later]
                ok = rows.possible(u, v)
                many += int(ok.sum())
                found.append((u[ok], v[ok]))
                if dense := many > DENSE * size:
                    break
            if dense:
                yield emit([0], [0], [x[start:start + 1] for x in rows.ids])
            else:
                u, v = (np.concatenate(x) for x in zip(*found))
                yield emit(rows.node[u], rows.node[v])


def _linked_within(words: int):
    """Links u, v within groups whose rows carry their texts; components that meet are not compared again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            rows, texts = Nodes(table), table.column("text")
            for start, size in zip(rows.starts.tolist(), rows.sizes.tolist()):
                sets: dict[int, np.ndarray] = {}

                def of(i):
                    if i not in sets:
                        sets[i] = shingle_set(texts[i].as_py(), words)
                    return sets[i]

                links_ = []
                for i in range(start + 1, start + size):
                    u, v = np.full(i - start, i), np.arange(start, i)
                    todo = v[rows.possible(u, v)]
                    while len(todo):
                        j, todo = todo[-1], todo[:-1]
                        if rows.component[i] == rows.component[j]:
                            continue
                        shared = len(np.intersect1d(of(i), of(j), assume_unique=True))
                        if 100 * shared >= PERCENT * (len(of(i)) + len(of(j)) - shared):
                            links_.append((rows.node[i], rows.node[j]))
                            own = rows.component[start:start + size]
                            own[own == rows.component[i]] = rows.component[j]
                u, v = zip(*links_) if links_ else ((), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
    return run


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """u, v and linked for each pair, by the full sets of both texts."""
    def named(id_, text):
        return texts.select(F.col("doc_id").alias(id_), F.col("text").alias(text))

    both = pairs.join(named("u", "ut"), "u").join(named("v", "vt"), "v")

    def work():
        last: list = [None, None]

        def function(rows):
            linked = []
            for ut, vt in zip(rows["ut"], rows["vt"]):
                if vt != last[0]:  # pairs of one centre come together
                    last[:] = vt, shingle_set(vt, words)
                a, b = shingle_set(ut, words), last[1]
                shared = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * shared >= PERCENT * (len(a) + len(b) - shared))
            return {"u": rows["u"], "v": rows["v"], "linked": linked}
        return function

    return map_batches(both.select("u", "v", "ut", "vt"), "u long, v long, linked boolean", work, PAIR_ROWS)


def _meeting_centres(members: DataFrame) -> DataFrame:
    """u, v: every node with the NEAREST centres, of other components, that it shares most keys with."""
    centres = members.groupBy("key").agg(
        F.max_by(F.struct("node", "component"), F.struct("density", -F.col("node"))).alias("centre")).select(
        "key", F.col("centre.node").alias("v"), F.col("centre.component").alias("of"))
    shared = members.join(centres, "key").where("component <> of").groupBy(
        F.col("node").alias("u"), "v").agg(F.count("*").alias("keys"))
    best = Window.partitionBy("u").orderBy(F.desc("keys"), "v")
    return shared.withColumn("nth", F.row_number().over(best)).where(
        F.col("nth") <= NEAREST).select("u", "v")


def links(spark: SparkSession, docs: DataFrame, described_: DataFrame, words: int) -> DataFrame:
    """node, component of the documents that stand for a set and have a link."""
    texts = texts_of(docs)
    nodes = written(spark, described_.where("digest is not null and doc_id is not null")
                    .groupBy("digest").agg(
        F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in ("n_shingles", "sketch", "keys", "prints")])
        .drop("digest"), "nodes")
    # one move of the keys serves the counts and the join to them
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    members = nodes.select("node", F.explode("keys").alias("key")).repartition(width, "key")
    counts = members.groupBy("key").count().where("count > 1")
    members = written(spark, members.join(counts, "key"), "members")
    density = written(spark, members.groupBy("node").agg(F.sum("count").alias("density")), "density")
    nodes = nodes.drop("keys")
    found = None

    def opened(rows: DataFrame) -> DataFrame:
        """Rows of the keys whose nodes lie in several components."""
        if found is not None:
            rows = rows.drop("component").join(found, "node", "left").withColumn(
                "component", F.coalesce("component", "node"))
        open_ = rows.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where(
            "least < most").select("key")
        return rows.join(open_, "key", "left_semi")

    def confirmed(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("u").alias("doc_id")).union(pairs.select("v")).distinct()
        wanted = written(spark, texts.join(ids, "doc_id", "left_semi"), "texts")
        return written(spark, _confirmed(pairs, wanted, words).where("linked").select("u", "v"), "links")

    def joined(more: DataFrame) -> DataFrame:
        # components found so far are stars: with them, not with all links, few steps are left
        if found is not None:
            more = found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more)
        return written(spark, components(spark, more), "components")

    members = members.join(density, "node").withColumn("component", F.col("node"))
    while True:
        pairs = written(spark, _close(_meeting_centres(members), nodes), "pairs")
        tested = pairs.select("u").distinct().count()
        more = confirmed(pairs)
        now = more.select("u").distinct().count()
        if now:
            found = joined(more)
        members = written(spark, opened(members), "members")
        if not now or now < FRUITFUL * tested:
            break
    # what is still open is searched once and for all
    light = _in_blocks(members.select("node", "key", "count", "component").join(nodes, "node"))
    columns = [*GROUP, "node", "component", "n_shingles", "block", "sketch", "prints"]
    seen = written(spark, light.select(columns).repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(
        _candidates, "u long, v long, key long, one long, other long"), "candidates")
    links_ = confirmed(seen.where("u IS NOT NULL").select("u", "v"))
    dense = seen.where("u IS NULL").select(*GROUP)
    if not dense.isEmpty():
        rows = light.join(dense, list(GROUP), "left_semi").select(columns).join(
            texts.select(F.col("doc_id").alias("node"), "text").dropDuplicates(["node"]), "node")
        links_ = links_.unionByName(written(spark, rows.select(*columns, "text").repartition(*GROUP)
                                            .sortWithinPartitions(*GROUP).mapInArrow(
            _linked_within(words), "u long, v long"), "links"))
    return joined(links_)


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, component_id (its smallest document) and kept of every document."""
    with intermediate(spark) as tables:
        table = tables.keep(written(spark, described(docs, words), "described"))
        found = tables.keep(links(spark, docs, table, words))
    of_set = table.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("node"))
    component = of_set.join(found, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("of_digest"))
    named = table.drop("sketch", "keys", "prints").join(component, "digest", "left")
    id_ = F.when(F.col("doc_id").isNotNull(), F.coalesce("of_digest", "doc_id"))
    return named.select("doc_id", "n_shingles", id_.alias("component_id"),
                        F.coalesce(F.col("doc_id") == id_, F.lit(True)).alias("kept"))


def first_of_each(spark: SparkSession, docs: DataFrame, words: int) -> DataFrame:
    """The documents that are kept, with their columns."""
    with intermediate(spark) as tables:
        kept = tables.keep(written(spark, near_duplicates(spark, docs, words).where("kept").select(
            F.col("doc_id").alias("_kept_id")).distinct(), "kept"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept_id"]), "left_semi")
