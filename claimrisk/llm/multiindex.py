"""Approximate nearest neighbours by largest inner product: an inverted multi-index.

Every vector is cut into two halves, each quantised by a codebook of its own; a pair of centroids
is a cell.  A query walks the cells by the sum of its two half distances with a heap, until the
cells it has passed hold ``budget`` vectors, and the entries of those cells are ranked anew by
their exact inner product.  Vectors get one more component (what their square norm lacks to the
largest one), so that the nearest vectors are those of largest inner product whatever their norms.

The codebooks are fitted on the ``SAMPLE`` rows of least id hash.  How many vectors a query has to
pass depends on the data: ``budget`` is the least number with which ``PROBES`` queries of least
hash, searched among all rows as well, find the share ``target`` of their true neighbours.  This
measured recall comes with the index.  Every row is indexed.

Queries go to tasks in blocks of at most ``BLOCK``, those of the same nearest cell together unless
they are more.  A task keeps a block of queries, the vectors of the cells that any of them reaches
stream by, each is scored for the queries that reach its cell, and the best ``k`` of each query
leave.  A hot cell is spread like any other.  Where neighbours are no nearer than chance the budget
is a share of all rows, and so is the work of a query.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows
without id.  Shorter vectors count as filled up with zeros.  Equal scores go by smaller id.  Rows
equal in id and vector count once; a query never returns its own id; queries that share an id but
not the vector are answered each.  Of equal vectors only the ``k + 1`` smallest ids can be among
anyone's nearest, so only those are indexed.  Empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimrisk.session import written

SAMPLE = 20_000    # rows the codebooks are fitted on
PROBES = 100       # queries on which recall is measured
ROUNDS = 12        # of the fit
CELL_ROWS = 64     # the codebooks grow until a cell holds about so many vectors,
MOST_CENTROIDS = 256   # or this is the size of each
BLOCK = 16_384     # queries a task keeps, at most,
LEAST_BLOCK = 128  # and at least, unless there are fewer
SEEN_ROWS = 256    # stored vectors that pass a block at once
PAIRS = 200_000    # pairs scored exactly at once
CELLS_AT_ONCE = 1024
BROADCAST_ROWS = 4_000_000  # (block, cell) pairs of 8 bytes that are sent to every task
FOUND = "asked long, query_id long, vec_id long, score double"


@dataclass
class Index:
    """Codebooks, the number of vectors of every cell, and what was measured."""

    scale: float        # vectors are divided by it
    norm: float         # largest square norm after that
    books: list         # centroids of either half
    counts: np.ndarray  # vectors of each cell
    budget: int = 0
    recall: float = 1.0

    def halves(self, vectors: np.ndarray, stored: bool) -> list[np.ndarray]:
        x = vectors / self.scale
        more = np.sqrt(np.maximum(self.norm - (x * x).sum(1), 0)) if stored else np.zeros(len(x))
        cut = (x.shape[1] + 1) // 2
        return [x[:, :cut], np.column_stack([x[:, cut:], more])]

    def distances(self, vectors: np.ndarray, stored: bool) -> list[np.ndarray]:
        """Square distances from the centroids of either half, up to a constant of the half."""
        return [(c * c).sum(1) - 2 * h @ c.T
                for h, c in zip(self.halves(vectors, stored), self.books)]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        a, b = (d.argmin(1) for d in self.distances(vectors, True))
        return a * len(self.books[1]) + b


def valid(table: DataFrame) -> DataFrame:
    """vec_id and vector (all of one length) of the rows that take part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = table.where(F.col("vec_id").isNotNull() & finite & F.exists(x, lambda v: v != 0)).select(
        F.col("vec_id").cast("long").alias("vec_id"), x.cast(_stored(table)).alias("vector"))
    sizes = rows.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if sizes[0] != sizes[1]:
        rows = rows.withColumn("vector", F.concat("vector", F.array_repeat(
            F.lit(0.0), sizes[1] - F.size("vector")).cast(_stored(table))))
    return rows


def _stored(table: DataFrame) -> str:
    """The type vectors are kept in: float where the table has it, else double."""
    given = table.schema["embedding"].dataType.simpleString()
    return given if given == "array<float>" else "array<double>"


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of rows with rows, summed in order of the components."""
    out = np.zeros(len(queries))
    for d in range(queries.shape[1]):
        out += queries[:, d] * vectors[:, d]
    return out


def codebook(sample: np.ndarray, size: int) -> np.ndarray:
    """Centroids by alternating assignment, started from distinct rows drawn at a fixed seed."""
    sample = np.unique(sample, axis=0)
    size = min(size, len(sample))
    order = np.random.default_rng(7).permutation(len(sample))
    centres = sample[np.sort(order[:size])].copy()
    for _ in range(ROUNDS):
        near = ((centres * centres).sum(1) - 2 * sample @ centres.T).argmin(1)
        n = np.bincount(near, minlength=size)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def fitted(rows: DataFrame) -> Index | None:
    """The index of the vectors of ``rows``, before the cells are counted."""
    norms = F.aggregate("vector", F.lit(0.0), lambda s, v: F.greatest(s, F.abs(v.cast("double"))))
    n, scale = rows.agg(F.count("*"), F.max(norms)).first()
    if not n:
        return None
    squares = F.aggregate("vector", F.lit(0.0), lambda s, v: s + F.pow(v / scale, 2))
    index = Index(scale, rows.agg(F.max(squares)).first()[0], [], np.zeros(0))
    sample = matrix(rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(SAMPLE)
                    .select("vector").toArrow().column("vector").combine_chunks())
    size = 1 << max(2, round(np.log2(n / CELL_ROWS) / 2)) if n > CELL_ROWS else 2
    index.books = [codebook(h, min(size, MOST_CENTROIDS)) for h in index.halves(sample, True)]
    return index


def _assigned(rows: DataFrame, index: Index) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = index.cells(matrix(b.column(1))) if b.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(cells, pa.int32())], names=["vec_id", "vector", "cell"])
    kind = rows.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id long, vector {kind}, cell int")


def _best(found: DataFrame, k: int) -> DataFrame:
    window = Window.partitionBy("asked", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _queries(rows: DataFrame, every: int) -> DataFrame:
    return rows.where(F.col("vec_id") % every == 0).select(
        F.xxhash64("vector").alias("asked"), F.col("vec_id").alias("query_id"), "vector")


def _top(ids, vectors, queries, own, allowed, k):
    """Positions (query, vector) that can be among the k best allowed ones, and exact scores."""
    rough = np.where(allowed & (own[:, None] != ids[None, :]), queries @ vectors.T, -np.inf)
    least = np.partition(rough, -k, 1)[:, -k] if rough.shape[1] > k else np.full(len(rough), -np.inf)
    # the product's rounding depends on the place in the matrix: keep what can be equal
    slack = 1e-12 * np.sqrt((queries * queries).sum(1)) * np.sqrt((vectors * vectors).sum(1).max())
    for first in range(0, len(rough), 32):
        part = slice(first, first + 32)
        q, v = np.nonzero((rough[part] >= (least - slack)[part, None]) & (rough[part] > -np.inf))
        q += first
        exact = scores(queries[q], vectors[v])
        order = np.lexsort((ids[v], -exact, q))
        q, v, exact = q[order], v[order], exact[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        yield q[nth < k], v[nth < k], exact[nth < k]


def _emit(asked, own, ids, q, v, exact) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(asked[q]), pa.array(own[q]), pa.array(ids[v]), pa.array(exact)],
        names=["asked", "query_id", "vec_id", "score"])


def measured(cells: DataFrame, queries: DataFrame, index: Index, k: int, target: float) -> Index:
    """The index with the least budget that finds ``target`` of the sample's true neighbours."""
    sample = queries.orderBy(F.xxhash64("query_id"), "query_id", "asked").limit(PROBES).toArrow()
    if not sample.num_rows:
        return index
    asked, own = (sample.column(i).to_numpy() for i in (0, 1))
    vectors = matrix(sample.column(2).combine_chunks())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 2048):
                part = b.slice(start, 2048)
                ids, x = part.column(0).to_numpy(), matrix(part.column(1))
                for q, v, exact in _top(ids, x, vectors, own, np.True_, k):
                    yield pa.RecordBatch.from_arrays(
                        [*_emit(asked, own, ids, q, v, exact).columns, part.column(2).take(pa.array(v))],
                        names=["asked", "query_id", "vec_id", "score", "cell"])

    true = _best(cells.mapInArrow(run, FOUND + ", cell int"), k).select(
        "asked", "query_id", "cell").toArrow()  # at most PROBES * k rows
    if not true.num_rows:
        return index
    key = {(a, o): i for i, (a, o) in enumerate(zip(asked.tolist(), own.tolist()))}
    rows = np.array([key[x] for x in zip(true.column(0).to_pylist(), true.column(1).to_pylist())])
    half = index.distances(vectors, False)
    needed = np.empty(len(rows), np.int64)
    for i in range(len(vectors)):
        walk = np.argsort((half[0][i][:, None] + half[1][i][None, :]).ravel(), kind="stable")
        before = np.empty(len(walk), np.int64)
        before[walk] = np.cumsum(index.counts[walk]) - index.counts[walk]
        mine = rows == i
        needed[mine] = before[true.column(2).to_numpy()[mine]] + 1
    needed.sort()
    index.budget = max(int(needed[int(np.ceil(target * len(needed))) - 1]), k + 1)
    index.recall = float((needed <= index.budget).mean())
    return index


def reach(first: np.ndarray, second: np.ndarray, counts: np.ndarray, budget: int) -> float:
    """Walks the cells by growing sum of distances until those passed hold ``budget`` vectors.

    Returns the sum of the last one: the query reaches every cell up to it.
    """
    a, b = first.argsort(kind="stable").tolist(), second.argsort(kind="stable").tolist()
    x, y, width = first[a].tolist(), second[b].tolist(), len(b)
    heap, last, passed = [(x[0] + y[0], 0, 0)], 0.0, 0
    while heap and passed < budget:
        last, i, j = heapq.heappop(heap)
        passed += counts[a[i] * width + b[j]]
        # (i, j) comes from (i, j - 1), and from (i - 1, 0) in the first column
        if j + 1 < width:
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
    return last


def blocks_of(counts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The first block of each cell and into how many it is cut, at most ``block`` rows in each."""
    first, parts = np.zeros(len(counts), np.int64), np.maximum(1, -(-counts // block))
    number, held = 0, 0
    for cell in np.flatnonzero(counts):
        n = int(counts[cell])
        if held and held + n > block:
            number, held = number + 1, 0
        first[cell] = number
        held += n
        if parts[cell] > 1:
            number, held = number + int(parts[cell]), 0
    return first, parts


class Searchers:
    """The queries of a block: the cells they reach and the best found so far."""

    def __init__(self, index: Index, asked: np.ndarray, own: np.ndarray, vectors: np.ndarray, k: int):
        self.asked, self.own, self.vectors, self.k = asked, own, vectors, k
        self.half = index.distances(vectors, False)
        counts = index.counts.tolist()
        self.limit = np.array([reach(x, y, counts, index.budget) for x, y in zip(*self.half)])
        self.width = len(index.books[1])
        self.lengths = np.sqrt((vectors * vectors).sum(1))
        self.floor = np.full(len(own), -np.inf)  # score of the k-th best
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        self.waiting = 0

    def reached(self, cells: np.ndarray) -> np.ndarray:
        """Which queries (rows) reach which cells (columns)."""
        a, b = np.divmod(cells, self.width)
        return self.half[0][:, a] + self.half[1][:, b] <= self.limit[:, None]

    def see(self, ids: np.ndarray, vectors: np.ndarray, cells: np.ndarray) -> None:
        seen, column = np.unique(cells, return_inverse=True)
        rough = self.vectors @ vectors.T
        # rounding depends on the place in the product: keep what can be equal
        slack = 1e-12 * self.lengths * np.sqrt((vectors * vectors).sum(1).max())
        q, v = np.nonzero((rough >= (self.floor - slack)[:, None]) & self.reached(seen)[:, column]
                          & (self.own[:, None] != ids[None, :]))
        for low in range(0, len(q), PAIRS):
            some, other = q[low:low + PAIRS], v[low:low + PAIRS]
            self.found.append((some, ids[other], scores(self.vectors[some], vectors[other])))
            self.waiting += len(some)
            if self.waiting > PAIRS:
                self.settle()

    def settle(self) -> None:
        """Keep the k best of each query."""
        q, ids, score = (np.concatenate(x) for x in zip(*self.found))
        order = np.lexsort((ids, -score, q))
        q, ids, score = q[order], ids[order], score[order]
        nth = np.arange(len(q)) - np.searchsorted(q, q)
        kth = nth == self.k - 1
        self.floor[q[kth]] = score[kth]
        self.found, self.waiting = [(q[nth < self.k], ids[nth < self.k], score[nth < self.k])], 0

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.settle()
        q, ids, score = self.found[0]
        for low in range(0, len(q), 16384):
            part = slice(low, low + 16384)
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.asked[q[part]]), pa.array(self.own[q[part]]), pa.array(ids[part]),
                 pa.array(score[part])], names=["asked", "query_id", "vec_id", "score"])


def searched(spark: SparkSession, cells: DataFrame, queries: DataFrame, index: Index,
             k: int, block: int = BLOCK) -> DataFrame:
    """asked, query_id, vec_id, score, rank: the k best of every query in the cells it reaches."""
    width = len(index.books[1])

    def nearest_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            near = [d.argmin(1) for d in index.distances(matrix(b.column(2)), False)] if b.num_rows else [[], []]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.array(near[0], np.int64) * width + near[1], pa.int32())],
                names=["asked", "query_id", "vector", "cell"])

    kind = queries.schema["vector"].dataType.simpleString()
    placed = written(spark, queries.mapInArrow(
        nearest_cell, f"asked long, query_id long, vector {kind}, cell int"), "queries")
    many = np.zeros(len(index.counts), np.int64)
    for cell, n in placed.groupBy("cell").count().collect():  # at most MOST_CENTROIDS ** 2 rows
        many[cell] = n
    # queries that are near each other share a block; as many blocks as tasks can run, or as are needed
    size = max(1, min(block, max(LEAST_BLOCK, -(-int(many.sum()) // spark.sparkContext.defaultParallelism))))
    first, parts = blocks_of(many, size)
    blocks = int((first + parts).max())
    arrow = pa.schema([("block", pa.int32()), ("cell", pa.int32())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, key = b.column(3).to_numpy(), b.column(0).to_numpy() ^ b.column(1).to_numpy()
            spread = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            where = first[cell] + (spread % parts[cell].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(where, pa.int32()), *b.columns[:3]],
                                             names=["block", "asked", "query_id", "vector"])

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every cell that some query of the block reaches."""
        for number, part in _by_block(batches):
            reached = np.zeros(len(index.counts), bool)
            for b in part:
                s = Searchers(index, b.column(1).to_numpy(), b.column(2).to_numpy(), matrix(b.column(3)), k)
                every = np.flatnonzero(index.counts > 0)
                for low in range(0, len(every), CELLS_AT_ONCE):
                    some = every[low:low + CELLS_AT_ONCE]
                    reached[some] |= s.reached(some).any(0)
            whose = np.flatnonzero(reached)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(whose), number), pa.int32()), pa.array(whose, pa.int32())], schema=arrow)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, searchers = [], None
        for _, part in _by_block(batches):
            for b in part:
                ours = b.column(1).to_numpy() == 0
                asking, seen = b.filter(pa.array(ours)), b.filter(pa.array(~ours))
                if asking.num_rows:
                    held.append(asking)
                if seen.num_rows:
                    if searchers is None:
                        searchers = _searchers(index, held, k)
                    for low in range(0, seen.num_rows, SEEN_ROWS):
                        some = seen.slice(low, SEEN_ROWS)
                        searchers.see(some.column(3).to_numpy(), matrix(some.column(4)), some.column(5).to_numpy())
            if searchers is not None:
                yield from searchers.rows()
            held, searchers = [], None

    dealt = written(spark, placed.mapInArrow(
        deal, f"block int, asked long, query_id long, vector {kind}"), "dealt")
    reached = written(spark, dealt.repartition(blocks, "block").sortWithinPartitions("block")
                      .mapInArrow(union, "block int, cell int"), "reached")
    if reached.count() <= BROADCAST_ROWS:
        reached = F.broadcast(reached)
    columns = ["block", "kind", "asked", "id", "vector", "cell"]
    stored = cells.join(reached, "cell").select(
        "block", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("asked"), F.col("vec_id").alias("id"),
        "vector", "cell")
    asking = dealt.select("block", F.lit(0).alias("kind"), "asked", F.col("query_id").alias("id"), "vector",
                          F.lit(0).alias("cell"))
    both = stored.select(columns).unionByName(asking.select(columns))
    found = both.repartition(blocks, "block").sortWithinPartitions("block", "kind").mapInArrow(score, FOUND)
    return _best(found, k)


def _searchers(index: Index, held: list[pa.RecordBatch], k: int) -> Searchers:
    table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    return Searchers(index, table.column(2).to_numpy(), table.column(3).to_numpy(), matrix(table.column(4)), k)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """The batches of each block (first column), of rows sorted by block."""
    def cut():
        for b in batches:
            numbers = b.column(0).to_numpy()
            ends = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for start, end in zip(ends, ends[1:]):
                if start < end:
                    yield int(numbers[start]), b.slice(start, end - start)
    for number, group in groupby(cut(), key=itemgetter(0)):
        yield number, (part for _, part in group)


def built(spark: SparkSession, table: DataFrame, every: int, k: int, target: float):
    """The written cells, the queries and the measured index; None for a table without vectors."""
    rows = written(spark, valid(table).dropDuplicates(["vec_id", "vector"]), "vectors")
    few = rows.withColumn("nth", F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))) \
        .where(F.col("nth") <= k + 1).drop("nth")
    index = fitted(rows)
    if index is None:
        return None
    cells = written(spark, _assigned(few, index), "cells")
    counts = np.zeros(len(index.books[0]) * len(index.books[1]), np.int64)
    for cell, n in cells.groupBy("cell").count().collect():  # at most MOST_CENTROIDS ** 2 rows
        counts[cell] = n
    index.counts = counts
    queries = _queries(rows, every)
    return cells, queries, measured(cells, queries, index, k, target)


def nearest(spark: SparkSession, table: DataFrame, every: int = 20, k: int = 20,
            target: float = 0.95, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest found of all rows whose id ``every`` divides.

    ``table`` has the columns vec_id and embedding.
    """
    parts = built(spark, table, every, k, target)
    if parts is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return searched(spark, *parts, k, block).select("query_id", "rank", "vec_id", "score")
