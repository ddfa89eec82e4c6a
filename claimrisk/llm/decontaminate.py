"""Benchmark decontamination by greedy string tiling.

Words (lower-cased A to Z) are tokens.  Rolling hashes of ``SEED`` tokens, as in Karp and Rabin,
join documents with benchmark items; seeds on one diagonal form a match.  For each document and
item the longest match is marked again and again, on tokens not marked before, until no match of
``SEED`` tokens is left.  A document is contaminated by an item if the tiles cover at least
``PERCENT`` per cent of the item's tokens, in whatever order its passages appear.

Where document and item share more than ``LISTED`` pairs of seeds (the same words over and over) the
seeds are not listed: the longest match of unmarked tokens is found by hashes of one length at a time,
halving the range of lengths, which takes memory in proportion to the texts.

The benchmark is collected and broadcast in blocks of a bounded number of characters; every
document meets every block, and no row is shuffled.  Items with fewer than SEED tokens contaminate
nothing; null and empty texts are clean; equal items and repeated documents are judged each for
itself; among matches of equal length the first in the item, then in the document, is marked first.
Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.llm.frames import map_batches, texts_of
from claimrisk.llm.hashing import BASE, INVERSE, _powers, mixed, shingles, words_of
from claimrisk.session import written

SEED = 5
PERCENT = 50
BLOCK_CHARS = 8_000_000
LISTED = 100_000


class Seeds:
    """Hashes of all SEED-token windows of some benchmark items, and where they are."""

    def __init__(self, texts: list[str]):
        words = [words_of(t)[0] for t in texts]
        windows = [shingles(w, SEED) if len(w) >= SEED else np.zeros(0, np.uint64) for w in words]
        self.words = words
        self.lengths = [len(w) for w in words]
        counts = [len(w) for w in windows]
        hashes = np.concatenate(windows) if windows else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.item = np.repeat(np.arange(len(texts)), counts)[order]
        self.at = np.concatenate([np.arange(c) for c in counts] or [np.zeros(0, int)])[order]

    def tiled(self, words: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """For each item that shares a seed: its tiles (start in item, start in document, length)."""
        few, many = self._matches(words)
        out = {item: tiles(found) for item, found in few.items()}
        for item in many:
            out[item] = long_tiles(self.words[item], words)
        return dict(sorted(out.items()))

    def matches(self, words: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """For each item that shares a seed, however many: (length, start in item, start in document)."""
        return self._matches(words, None)[0]

    def _matches(self, words: np.ndarray, listed: int | None = -1) -> tuple[dict, list[int]]:
        """Matches of items with at most ``listed`` pairs of seeds, and the other items."""
        listed = LISTED if listed == -1 else listed
        if len(words) < SEED or not len(self.hashes):
            return {}, []
        own = shingles(words, SEED)
        distinct, times = np.unique(own, return_counts=True)
        first = np.searchsorted(self.hashes, distinct)
        hit = self.hashes[np.minimum(first, len(self.hashes) - 1)] == distinct
        distinct, times, first = distinct[hit], times[hit], first[hit]
        if not len(distinct):
            return {}, []
        last = np.searchsorted(self.hashes, distinct, "right")
        seed = np.repeat(first - np.cumsum(last - first) + (last - first), last - first) + np.arange((last - first).sum())
        pairs = np.bincount(self.item[seed], np.repeat(times, last - first), len(self.lengths))
        many = np.flatnonzero(pairs > listed).tolist() if listed is not None else []
        if many:
            seed = seed[~np.isin(self.item[seed], many)]
        # places in the document of the hash of every seed that is left
        order = np.argsort(own, kind="stable")
        low = np.searchsorted(own[order], self.hashes[seed])
        n = np.searchsorted(own[order], self.hashes[seed], "right") - low
        item, i = np.repeat(self.item[seed], n), np.repeat(self.at[seed], n)
        j = order[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
        order = np.lexsort((i, j - i, item))
        item, i, j = item[order], i[order], j[order]
        if not len(i):
            return {}, many
        new = np.flatnonzero(np.r_[True, (np.diff(item) != 0) | (np.diff(j - i) != 0) | (np.diff(i) != 1)])
        lengths = np.diff(np.r_[new, len(i)]) + SEED - 1
        out: dict[int, list[tuple[int, int, int]]] = {}
        for n, k in zip(lengths.tolist(), new.tolist()):
            out.setdefault(int(item[k]), []).append((n, int(i[k]), int(j[k])))
        return out, many


def _windows(free: np.ndarray, length: int) -> np.ndarray:
    """Starts of the stretches of ``length`` tokens none of which is marked."""
    marked = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(marked[length:] == marked[:-length])


def long_tiles(item: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int]]:
    """The tiles of ``tiles``, without a list of matches."""
    free_item, free_doc, out = np.ones(len(item), bool), np.ones(len(doc), bool), []
    sums = [_rolled(item), _rolled(doc)]

    def common(length: int) -> tuple[int, int] | None:
        """The first free match of a length: first in the item, then in the document."""
        a, b = _windows(free_item, length), _windows(free_doc, length)
        if not len(a) or not len(b):
            return None
        ha, hb = (_stretch(s, at, length) for s, at in zip(sums, (a, b)))
        shared = np.isin(ha, hb)
        if not shared.any():
            return None
        k = int(shared.argmax())
        return int(a[k]), int(b[int((hb == ha[k]).argmax())])

    most = min(len(item), len(doc))
    while True:
        found = common(SEED)
        if found is None:
            return out
        low, high = SEED, most  # matches of ``low`` exist, of more than ``high`` do not
        while low < high:
            middle = (low + high + 1) // 2
            more = common(middle)
            if more is None:
                high = middle - 1
            else:
                low, found = middle, more
        i, j = found
        out.append((i, j, low))
        free_item[i:i + low] = False
        free_doc[j:j + low] = False
        most = low


def _rolled(words: np.ndarray) -> np.ndarray:
    """Sums from which the Karp-Rabin hash of any stretch follows."""
    out = np.zeros(len(words) + 1, np.uint64)
    out[1:] = np.cumsum(mixed(words) * _powers("base", BASE, len(words)), dtype=np.uint64)
    return out


def _stretch(sums: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    return mixed((sums[at + length] - sums[at]) * _powers("inverse", INVERSE, len(sums))[at])


def tiles(matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Non-overlapping matches, longest first: (start in item, start in document, length)."""
    heap = [(-n, i, j) for n, i, j in matches]
    heapq.heapify(heap)
    marked_item: set[int] = set()
    marked_doc: set[int] = set()
    out = []
    while heap:
        n, i, j = heapq.heappop(heap)
        free = [k for k in range(-n) if i + k not in marked_item and j + k not in marked_doc]
        if len(free) == -n:
            out.append((i, j, -n))
            marked_item.update(range(i, i - n))
            marked_doc.update(range(j, j - n))
            continue
        start = 0
        for k in range(1, len(free) + 1):  # what is left of it, in unbroken pieces
            if k == len(free) or free[k] != free[k - 1] + 1:
                if k - start >= SEED:
                    heapq.heappush(heap, (start - k, i + free[start], j + free[start]))
                start = k
    return out


def overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, item_words, covered, n_tiles, longest of pairs that share a tile."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK_CHARS) or 1
    texts, found = texts_of(docs), None
    id_type = benchmark.schema["item_id"].dataType.simpleString()
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        held = spark.sparkContext.broadcast(([r.item_id for r in rows], [r.text for r in rows]))

        def work(held=held):
            ids, item_texts = held.value
            seeds = Seeds(item_texts)

            def function(rows):
                out = {c: [] for c in ("doc_id", "item_id", "item_words", "covered", "n_tiles",
                                       "longest")}
                for doc_id, text in zip(rows["doc_id"], rows["text"]):
                    for item, found in seeds.tiled(words_of(text)[0]).items():
                        own = [n for _, _, n in found]
                        for c, v in zip(out, (doc_id, ids[item], seeds.lengths[item], sum(own),
                                              len(own), max(own))):
                            out[c].append(v)
                return out
            return function

        part = map_batches(
            texts, f"doc_id {doc_type}, item_id {id_type}, item_words long, covered long, "
            "n_tiles long, longest long", work)
        found = part if found is None else found.unionByName(part)
    return found


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame,
                 percent: int = PERCENT) -> DataFrame:
    """The pairs whose tiles cover enough of the item."""
    return overlaps(spark, docs, benchmark).where(
        100 * F.col("covered") >= percent * F.col("item_words"))


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents no item contaminates, with their columns."""
    bad = written(spark, contaminated(spark, docs, benchmark).select(
        F.col("doc_id").alias("_bad_id")).distinct(), "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad_id"]), "left_anti")
