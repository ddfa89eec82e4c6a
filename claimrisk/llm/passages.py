"""Near-duplicate passages across documents by compact windows of min-hashes.

The tokens of a document are its word shingles.  For each hash function a Cartesian tree over the
token hashes gives the compact windows: node c with range l to r says that every subsequence within
l to r that contains c has c's hash as its min-hash.  Only windows of at least ``least`` words are
made, about 2 / least per token and function.  Window hashes meet in shards; of the documents that
hold a hash each learns a smaller one.

In a first round a document is compared with the ``NEAREST`` of these partners it shares most hashes
of ``ENOUGH`` functions with.  For a pair the intervals of the shared windows are laid over one
another; where enough functions agree, stretches of shared shingles with ``least`` words or more and
a similarity of at least ``PERCENT`` per cent are the passages.

What no passage covers is searched again.  Stretches of ``least`` tokens are keyed by their whole
content, and all that occur elsewhere are compared with the smallest document that has them: words
that are repeated exactly are never left out.  Stretches on which two functions agree, with the two
hashes at least ``APART`` tokens from each other (so that a short line that many documents share makes
no key), are compared with the ``HOLDERS`` smallest documents of their key.  These limits only say
who is compared first: what is still open is keyed by every two functions with the tokens around it,
and in a key all documents whose contexts share enough tokens for a passage are compared.

Documents of equal text are passages of the smallest of them as a whole, if long enough.  Null,
empty and short texts have no passage; texts of any length are treated whole; rows that repeat an id
are one document and no passages of each other; rows with a null id take no part.  Empty tables give
empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimrisk.llm import meeting
from claimrisk.llm.frames import PAIR_ROWS, map_batches
from claimrisk.llm.hashing import BASE, INVERSE, _powers, mixed, shingles, words_of
from claimrisk.session import intermediate, written

LEAST_WORDS = 50
SHINGLE = 5
FUNCTIONS, ENOUGH = 8, 2  # FUNCTIONS: a power of two
PERCENT = 80
SHARD_RECORDS = 500_000
NEAREST = 3    # partners a document is compared with in the first round
HOLDERS = 4    # smallest documents of a key that the others are compared with, before all are
APART = LEAST_WORDS // 3  # tokens between the two hashes of a key
BLOCK = 20_000  # documents of an open key that a task compares with each other
PAIRS = 16_384  # that a task hands on at once
FEW = 16       # contexts of an open key that are compared without an index
_RANDOM = np.random.Generator(np.random.PCG64(11))
FACTORS = _RANDOM.integers(0, 2**64, FUNCTIONS, np.uint64) | np.uint64(1)
PASSAGE = ("start_word long, end_word long, start_byte long, end_byte long, "
           "match_start_word long, match_end_word long, similarity double")


def tokens_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of the text, and starts and ends of its words."""
    words, starts, ends = words_of(text)
    if len(words) < SHINGLE:
        return np.zeros(0, np.uint64), starts, ends
    return shingles(words, SHINGLE), starts, ends


def _smallest(tokens: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each function the values of all tokens, and where each stretch of ``least`` has its smallest."""
    n = len(tokens)
    values = tokens * FACTORS[:, None] ^ tokens >> np.uint64(29)
    low = np.uint64(0xFFFFFFFF)
    smallest = (values & ~low) | np.arange(n, dtype=np.uint64)
    width = 1
    while 2 * width <= least:
        smallest = np.minimum(smallest[:, :-width], smallest[:, width:])
        width *= 2
    stretches = n - least + 1
    smallest = np.minimum(smallest[:, :stretches], smallest[:, least - width:least - width + stretches])
    return values, (smallest & low).astype(np.int64)


def _hashes(own: np.ndarray, function: np.ndarray) -> np.ndarray:
    return mixed(own) & np.uint64(2**64 - FUNCTIONS) | function.astype(np.uint64)


class Stretches:
    """For every stretch of ``least`` tokens the min-hash of each function and where it stands."""

    def __init__(self, tokens: np.ndarray, least: int):
        self.least = least
        if len(tokens) < least:
            self.hashes, self.position = (np.zeros((FUNCTIONS, 0), t) for t in (np.uint64, np.int64))
            return
        values, self.position = _smallest(tokens, least)
        self.hashes = _hashes(np.take_along_axis(values, self.position, 1),
                              np.arange(FUNCTIONS, dtype=np.uint64)[:, None])

    def new(self) -> np.ndarray:
        """Stretches with another minimum than the one before: the nodes of the Cartesian tree."""
        out = np.ones(self.position.shape, bool)
        out[:, 1:] = self.position[:, 1:] != self.position[:, :-1]
        return out

    def distinct(self) -> np.ndarray:
        return np.unique(self.hashes[self.new()])


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(among):
        return np.zeros(values.shape, bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def _uncovered(stretches: int, least: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Stretches (by their first token) that no span of words covers."""
    out = np.ones(stretches, bool)
    for start, end in spans:
        out[start:max(start, end - SHINGLE + 1 - least + 1)] = False
    return out


def exact_keys(tokens: np.ndarray, least: int, shared: np.ndarray, spans: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the whole content of the uncovered stretches that may occur elsewhere, and the stretches."""
    own = Stretches(tokens, least)
    if not own.hashes.size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    open_ = _uncovered(own.hashes.shape[1], least, spans) & _member(own.hashes, shared).all(0)
    sums = np.zeros(len(tokens) + 1, np.uint64)
    sums[1:] = np.cumsum(tokens * _powers("base", BASE, len(tokens)), dtype=np.uint64)
    at = np.flatnonzero(open_)
    keys, first = np.unique(mixed((sums[at + least] - sums[at]) * _powers("inverse", INVERSE, len(tokens) + 1)[at]),
                            return_index=True)
    return keys, at[first]


def near_keys(tokens: np.ndarray, least: int, shared: np.ndarray, spans: list
              ) -> tuple[np.ndarray, np.ndarray]:
    """Keys of two shared hashes, APART from each other, of an uncovered stretch; and the stretch."""
    own = Stretches(tokens, least)
    keys, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if own.hashes.size:
        known = _member(own.hashes, shared) & _uncovered(own.hashes.shape[1], least, spans)
        for f, g in combinations(range(FUNCTIONS), ENOUGH):
            new = known[f] & known[g] & (np.abs(own.position[f] - own.position[g]) >= APART)
            new[1:] &= ((own.position[f, 1:] != own.position[f, :-1]) | (own.position[g, 1:] != own.position[g, :-1])
                        | ~(known[f, :-1] & known[g, :-1]))
            keys.append(mixed(own.hashes[f, new] * FACTORS[0] + own.hashes[g, new]))
            starts.append(np.flatnonzero(new))
    return np.concatenate(keys), np.concatenate(starts)


def compact_windows(tokens: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash (its low bits name the function), first and last token of each window.

    The nodes of the Cartesian tree whose range is long enough are just the (first) smallest tokens
    of all stretches of ``least`` tokens; the nearest smaller ones of these bound their ranges.
    """
    n = len(tokens)
    if n < least:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    values, position = _smallest(tokens, least)
    new = np.ones(position.shape, bool)
    new[:, 1:] = position[:, 1:] != position[:, :-1]
    function, at = np.nonzero(new)
    centre = position[function, at]
    own = values[function, centre]
    left, right = np.zeros(len(centre), np.int64), np.full(len(centre), n - 1)
    above: list[int] = []  # the path from the root to the last node of the tree
    numbers, places, functions = own.tolist(), centre.tolist(), function.tolist()
    for k, number in enumerate(numbers):
        if above and functions[above[-1]] != functions[k]:
            above.clear()
        while above and numbers[above[-1]] > number:
            right[above.pop()] = places[k] - 1
        if above:
            left[k] = places[above[-1]] + 1
        above.append(k)
    return _hashes(own, function), left, right


def agreed(length: int, hashes: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Tokens that windows of at least ENOUGH functions cover."""
    function = (hashes % np.uint64(FUNCTIONS)).astype(np.int64)
    steps = np.zeros((FUNCTIONS, length + 1), np.int32)
    np.add.at(steps, (function, left), 1)
    np.add.at(steps, (function, right + 1), -1)
    return (np.cumsum(steps[:, :-1], axis=1) > 0).sum(0) >= ENOUGH


def _similarity(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def stretches_of(one: np.ndarray, other: np.ndarray, allowed: np.ndarray,
                 allowed_other: np.ndarray, least: int) -> list[tuple[int, int, int, int, float]]:
    """Token ranges (first, last) of similar stretches in one and the other, and similarity.

    A token that occurs several times is paired by the order of occurrence, and with the first
    occurrence.  Stretches start and end with a shared token; a stretch that is not similar enough,
    or whose counterpart is scattered, is split where its shared tokens are farthest apart.
    """
    where = np.flatnonzero(allowed_other)
    order = where[np.argsort(other[where], kind="stable")]
    sorted_other = other[order]
    mine = np.flatnonzero(allowed)
    low = np.searchsorted(sorted_other, one[mine])
    high = np.searchsorted(sorted_other, one[mine], "right")
    hit = high > low
    at, low, high = mine[hit], low[hit], high[hit]
    if not len(at):
        return []
    by = np.argsort(low, kind="stable")
    new = np.r_[True, np.diff(low[by]) != 0]
    nth = np.empty(len(at), np.int64)
    nth[by] = np.arange(len(at)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    out = set()
    for partner in (order[np.minimum(low + nth, high - 1)], order[low]):
        out.update(_split(one, other, at, partner, least))
        if not (high > low + 1).any():
            break
    return sorted(out)


def _split(one: np.ndarray, other: np.ndarray, at: np.ndarray, partner: np.ndarray,
           least: int) -> list[tuple[int, int, int, int, float]]:
    out, todo = [], [(0, len(at))]
    while todo:
        s, e = todo.pop()
        if e <= s or at[e - 1] - at[s] + 1 < least:
            continue
        shift = partner[s:e] - at[s:e]
        near = partner[s:e][np.abs(shift - np.median(shift)) <= least]
        if len(near):
            l, r = int(near.min()), int(near.max())
            a, b = int(at[s]), int(at[e - 1])
            if r - l + 1 >= least:
                similar = _similarity(one[a:b + 1], other[l:r + 1])
                if 100 * similar >= PERCENT:
                    out.append((a, b, l, r, similar))
                    continue
        if e - s > 1:
            cut = s + 1 + int((np.diff(at[s:e]) + np.abs(np.diff(shift))).argmax())
            todo += [(s, cut), (cut, e)]
    return out


class Read:
    """A text's tokens, word places and windows."""

    def __init__(self, text: str, least: int):
        self.text = text
        self.tokens, self.starts, self.ends = tokens_of(text)
        self.windows = compact_windows(self.tokens, least)
        self.hashes = np.unique(self.windows[0])

    def agreed(self, shared: np.ndarray) -> np.ndarray:
        own = _member(self.windows[0], shared)
        return agreed(len(self.tokens), *(x[own] for x in self.windows))


def verified(one: Read, other: Read, least: int) -> list[tuple]:
    """The passages (columns of PASSAGE) of one text that near-duplicate passages of the other."""
    n = len(one.tokens)
    if one.text == other.text:
        found = [(0, n - 1, 0, n - 1, 1.0)] if n >= least else []
    else:
        shared = one.hashes[_member(one.hashes, other.hashes)]
        found = stretches_of(one.tokens, other.tokens, one.agreed(shared), other.agreed(shared), least)
    return [(s, e + SHINGLE, int(one.starts[s]), int(one.ends[e + SHINGLE - 1]), l, r + SHINGLE,
             round(similar, 6)) for s, e, l, r, similar in found]


def repeated_passages(spark: SparkSession, docs: DataFrame,
                      least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, match_doc_id (a smaller one) and the passage, one row for each passage found.

    Words and bytes are counted from 0, ends are exclusive.
    """
    with intermediate(spark) as tables:
        found = [tables.keep(x) for x in _found(spark, docs, least_words)]
    everything = found[0]
    for more in found[1:]:
        everything = everything.unionByName(more)
    return everything


def _found(spark: SparkSession, docs: DataFrame, least_words: int) -> list[DataFrame]:
    """The passages of every round, written."""
    least = least_words - SHINGLE + 1
    texts = docs.where("doc_id is not null").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digests = written(spark, texts.select(
        "doc_id", F.sha2("text", 256).alias("sha256"),
        F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    originals = digests.groupBy("sha256").agg(F.min("doc_id").alias("match_doc_id"))
    copies = written(spark, digests.join(originals, "sha256").where("match_doc_id < doc_id")
                     .select("doc_id", "match_doc_id").distinct(), "copies")

    def hashes_of():
        return lambda text: Stretches(tokens_of(text)[0], least).distinct()

    size = digests.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(width, size // 6 * 2 * FUNCTIONS // least // SHARD_RECORDS)
    originals = texts.join(copies.select("doc_id").distinct(), "doc_id", "left_anti")
    shared = written(spark, meeting.met(originals, hashes_of, shards).select("doc_id", "hash", "partner"), "shared")
    # first round: the partners that share most hashes
    function = F.expr(f"shiftleft(1, CAST(pmod(hash, {FUNCTIONS}) AS INT))")
    met = shared.where("partner IS NOT NULL").groupBy("doc_id", F.col("partner").alias("match_doc_id")).agg(
        F.count("*").alias("hashes"), F.bit_count(F.bit_or(function)).alias("functions")).where(
        F.col("functions") >= ENOUGH)
    most = Window.partitionBy("doc_id").orderBy(F.desc("hashes"), "match_doc_id")
    pairs = written(spark, met.withColumn("nth", F.row_number().over(most)).where(F.col("nth") <= NEAREST)
                    .select("doc_id", "match_doc_id"), "pairs")
    found = [_passages(spark, copies, texts, least), _passages(spark, pairs, originals, least)]
    tested = [pairs]

    def again(keys: DataFrame, most: int) -> None:
        """Compares the documents of every key with its ``most`` smallest ones."""
        least_of = Window.partitionBy("key").orderBy("doc_id")
        holders = keys.select("key", "doc_id").distinct()
        partners = holders.withColumn("nth", F.row_number().over(least_of)).where(F.col("nth") <= most).select(
            "key", F.col("doc_id").alias("match_doc_id"))
        more = holders.join(partners, "key").where("match_doc_id < doc_id").select("doc_id", "match_doc_id").distinct()
        for done in tested:
            more = more.join(done, ["doc_id", "match_doc_id"], "left_anti")
        more = written(spark, more, "pairs")
        tested.append(more)
        found.append(_passages(spark, more, originals, least))

    # texts are joined where they are read: written once more, they would be the largest table
    hashes = written(spark, shared.groupBy("doc_id").agg(F.collect_set("hash").alias("shared")), "hashes")
    own = originals.join(hashes, "doc_id")
    exact = _several(spark, _keys(_with_spans(own, found), least, exact_keys))
    again(exact, 1)
    near = _several(spark, _keys(_with_spans(own, found), least, near_keys))
    again(near, HOLDERS)
    more = _sharing_contexts(_contexts(spark, originals, _with_spans(own, found), least))
    for done in tested:
        more = more.join(done, ["doc_id", "match_doc_id"], "left_anti")
    found.append(_passages(spark, written(spark, more, "pairs"), originals, least))
    return found


def _with_spans(own: DataFrame, found: list[DataFrame]) -> DataFrame:
    """Texts with shared hashes, and the words that passages cover so far."""
    spans = found[1]
    for more in found[2:]:
        spans = spans.unionByName(more)
    spans = spans.groupBy("doc_id").agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans"))
    return own.join(spans, "doc_id", "left")


def _several(spark: SparkSession, keys: DataFrame) -> DataFrame:
    """Keys that several documents have, written."""
    with intermediate(spark) as tables:
        keys = written(spark, keys, "keys")
        several = keys.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b")
        return tables.keep(written(spark, keys.join(several.select("key"), "key", "left_semi"), "keys"))


def _keys(docs: DataFrame, least: int, keys_of: Callable) -> DataFrame:
    """key, doc_id and the first token of the stretch, of all stretches that no passage covers."""
    def work():
        def function(rows):
            doc, key, start = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for id_, text, own, spans in zip(*(rows[c] for c in ("doc_id", "text", "shared", "spans"))):
                shared = np.sort(np.array(own, np.int64).view(np.uint64))
                spans = [(x["start_word"], x["end_word"]) for x in spans or ()]
                tokens = tokens_of(text)[0]
                keys, starts = keys_of(tokens, least, shared, spans)
                doc.append(np.full(len(keys), id_))
                key.append(keys)
                start.append(starts)
            return {"key": pa.array(np.concatenate(key).view(np.int64)), "doc_id": pa.array(np.concatenate(doc)),
                    "start": pa.array(np.concatenate(start))}
        return function

    return map_batches(docs.select("doc_id", "text", "shared", "spans"), "key long, doc_id long, start long", work)


NAMES = ["doc_id", "match_doc_id", *(c.split()[0] for c in PASSAGE.split(", "))]


def open_keys(tokens: np.ndarray, least: int, shared: np.ndarray, spans: list) -> tuple[np.ndarray, np.ndarray]:
    """Keys of every two functions of uncovered stretches, and the stretches."""
    own = Stretches(tokens, least)
    keys, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if own.hashes.size:
        known = _member(own.hashes, shared) & _uncovered(own.hashes.shape[1], least, spans)
        new = own.new()
        for f, g in combinations(range(FUNCTIONS), ENOUGH):
            both = known[f] & known[g]
            both[1:] &= new[f, 1:] | new[g, 1:] | ~both[:-1]
            starts.append(np.flatnonzero(both))
            keys.append(mixed(own.hashes[f, both] * FACTORS[1] + own.hashes[g, both]))
    return np.concatenate(keys), np.concatenate(starts)


def context(tokens: np.ndarray, start: int, least: int) -> tuple[np.ndarray, int]:
    """The distinct tokens (32 bits) around a stretch, and how many a passage there shares at least.

    All stretches of ``least`` tokens that hold a token of this one lie within the context.
    """
    around = tokens[max(0, start - least):start + 2 * least].astype(np.uint32)
    distinct = np.unique(around)
    fewest = min(least, len(around))
    if len(distinct) < len(around):  # distinct tokens of each stretch: those it holds no earlier
        order = np.argsort(around, kind="stable")
        again = np.flatnonzero(around[order][1:] == around[order][:-1])
        low = np.maximum(np.arange(len(around)) - fewest + 1, 0)
        low[order[again + 1]] = np.maximum(low[order[again + 1]], order[again] + 1)
        high = np.minimum(np.arange(len(around)), len(around) - fewest) + 1
        held = low < high
        steps = np.zeros(len(around) + 1, np.int64)
        np.add.at(steps, low[held], 1)
        np.add.at(steps, high[held], -1)
        fewest = int(np.cumsum(steps)[:len(around) - fewest + 1].min())
    return distinct, -(-PERCENT * fewest // 100)


def _contexts(spark: SparkSession, docs: DataFrame, own: DataFrame, least: int) -> DataFrame:
    """key, n (stretches of the key), doc_id and context of uncovered stretches of keys that meet.

    Stretches of a document and key with the same tokens around them, as in a text that repeats a
    phrase, are one row with the least that a passage there shares: it meets whom any of them meets.
    """
    keys = _several(spark, _keys(own, least, open_keys))
    wanted = keys.join(keys.groupBy("key").agg(F.count("*").alias("n")), "key").groupBy("doc_id").agg(
        F.collect_list(F.struct("key", "n", "start")).alias("wanted"))

    def work():
        def function(rows):
            out: dict[str, list] = {"key": [], "n": [], "doc_id": [], "enough": [], "around": []}
            for id_, text, own_ in zip(*(rows[c] for c in ("doc_id", "text", "wanted"))):
                tokens, contexts, fewest = tokens_of(text)[0], {}, {}
                for x in own_:
                    if x["start"] not in contexts:
                        around, enough = context(tokens, x["start"], least)
                        contexts[x["start"]] = around.tobytes(), enough
                    around, enough = contexts[x["start"]]
                    which = x["key"], x["n"], around
                    fewest[which] = min(enough, fewest.get(which, enough))
                for (key, n, around), enough in fewest.items():
                    out["key"].append(key)
                    out["n"].append(n)
                    out["doc_id"].append(id_)
                    out["enough"].append(enough)
                    out["around"].append(around)
            return out
        return function

    return map_batches(docs.join(wanted, "doc_id").select("doc_id", "text", "wanted"),
                       "key long, n long, doc_id long, enough int, around binary", work)


def sharing(docs: list[int], around: list[np.ndarray], enough: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs (document, smaller one) whose contexts share what both have to share for a passage.

    Tokens are put in one order, those of the fewest contexts first.  Contexts that share ``enough``
    tokens meet in one that is not among the last ``enough - 1`` of either; only contexts that meet
    there are compared, and no pair is lost.  A line that all documents of a key share stands last
    and brings nobody together.
    """
    order = np.argsort(docs, kind="stable")
    ids, least = np.array(docs)[order], np.array(enough)[order]
    own = [around[i] for i in order]
    if len(own) <= FEW:
        for b in range(len(own)):
            for a in range(b):
                if ids[a] < ids[b] and len(np.intersect1d(own[a], own[b], assume_unique=True)) >= max(
                        least[a], least[b]):
                    yield int(ids[b]), int(ids[a])
        return
    sizes = np.array([len(x) for x in own])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(own)), sizes)
    _, token, holders = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    rank = np.empty(len(holders), np.int64)
    rank[np.argsort(holders, kind="stable")] = np.arange(len(holders))
    token = rank[token]
    token = token[np.lexsort((token, owner))]
    telling = np.maximum(sizes - least + 1, 0)
    first = np.arange(len(token)) - (ends - sizes)[owner] < telling[owner]

    def lists(some):  # owners of each token, in their order
        by = np.argsort(token[some], kind="stable")
        return owner[some][by], np.searchsorted(token[some][by], np.arange(len(holders) + 1)).tolist()

    (holder, bounds), (meeting_, at) = lists(np.ones(len(token), bool)), lists(first)
    for b, end in enumerate(ends):
        tokens = token[end - sizes[b]:end].tolist()
        if not any(at[t + 1] - at[t] > 1 for t in tokens[:telling[b]]):
            continue
        met = np.zeros(len(own), bool)
        for t in tokens[:telling[b]]:
            met[meeting_[at[t]:at[t + 1]]] = True
        met &= ids < ids[b]
        if met.any():
            shared = np.bincount(np.concatenate([holder[bounds[t]:bounds[t + 1]] for t in tokens]), minlength=len(own))
            for a in np.unique(ids[met & (shared >= np.maximum(least, least[b]))]).tolist():
                yield int(ids[b]), a


def _sharing_contexts(rows: DataFrame) -> DataFrame:
    """doc_id and match_doc_id of documents of one key whose contexts can hold a passage.

    Keys of more than BLOCK documents are cut into blocks, each compared with every other.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    group = ["key", "one", "other"]
    dealt = rows.withColumn(
        "block", F.pmod(F.xxhash64("doc_id", "key"), blocks)).withColumn(
        "with", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))).select(
        "key", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"),
        "doc_id", "enough", "around")

    def run(batches):
        def rows_of():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for _, some in groupby(rows_of(), key=itemgetter(0, 1, 2)):
            docs, enough, around = [], [], []
            for *_, doc, least, context in some:
                docs.append(doc)
                enough.append(least)
                around.append(np.frombuffer(context, np.uint32))
            pairs = sharing(docs, around, enough)
            while len(docs) > 1 and (part := list(islice(pairs, PAIRS))):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*part)], names=["doc_id", "match_doc_id"])

    return dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(
        run, "doc_id long, match_doc_id long").distinct()


def _passages(spark: SparkSession, pairs: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    """The passages of the pairs doc_id and match_doc_id, written."""
    with intermediate(spark) as tables:
        return tables.keep(_verified(spark, pairs, texts, least))


def _verified(spark: SparkSession, pairs: DataFrame, texts: DataFrame, least: int) -> DataFrame:
    ids = pairs.select("doc_id").union(pairs.select("match_doc_id")).distinct()
    some = written(spark, texts.join(ids, "doc_id", "left_semi").distinct(), "texts")
    both = pairs.join(some, "doc_id").join(
        some.select(F.col("doc_id").alias("match_doc_id"), F.col("text").alias("match")),
        "match_doc_id")
    def work():
        last: list[Read | None] = [None]

        def function(rows):
            out: dict[str, list] = {c: [] for c in NAMES}
            for doc, match, one, other in zip(*(rows[c] for c in (
                    "doc_id", "match_doc_id", "text", "match"))):
                if last[0] is None or last[0].text != other:  # pairs of one match come together
                    last[0] = Read(other, least)
                mine = last[0] if one == other else Read(one, least)
                for passage in verified(mine, last[0], least):
                    for c, v in zip(NAMES, (doc, match, *passage)):
                        out[c].append(v)
            return out
        return function

    return written(spark, map_batches(both.select("doc_id", "match_doc_id", "text", "match"),
                                      f"doc_id long, match_doc_id long, {PASSAGE}", work, PAIR_ROWS), "passages")


def without_passages(spark: SparkSession, docs: DataFrame,
                     least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents without the passages a smaller document has, with their columns.

    A passage goes with the white space before the word after it.  ``n_chars``, where there is such
    a column, follows the text.  Other documents stay as they are.
    """
    with intermediate(spark) as tables:
        spans = tables.keep(written(spark, repeated_passages(spark, docs, least_words).groupBy("doc_id").agg(
            F.collect_set(F.struct("start_byte", "end_byte")).alias("_spans"))
            .withColumnRenamed("doc_id", "_cut_id"), "spans"))

    @F.pandas_udf("string")
    def cut(texts, spans_):
        import pandas as pd
        out = []
        for text, own in zip(texts, spans_):
            if own is None:
                out.append(text)
                continue
            data, at, parts = text.encode(), 0, []
            for s in sorted(own, key=lambda s: (s["start_byte"], s["end_byte"])):
                if s["start_byte"] > at:
                    parts.append(data[at:s["start_byte"]])
                end = s["end_byte"]
                while end < len(data) and data[end] in b" \t\n\v\f\r":
                    end += 1
                at = max(at, end)
            out.append(b"".join([*parts, data[at:]]).decode())
        return pd.Series(out, dtype=object)

    names = docs.columns
    rows = docs.select(F.struct(*[docs[c] for c in names]).alias("row"), docs["doc_id"].alias("id"))
    joined = rows.join(spans, F.col("id") == F.col("_cut_id"), "left")
    text = F.when(F.col("_spans").isNotNull(), cut("row.text", "_spans")).otherwise(F.col("row.text"))
    edited = joined.select("row", "_spans", text.alias("text"))
    length = F.when(F.col("_spans").isNotNull(), F.length("text"))
    return edited.select(*[
        F.col("text") if c == "text"
        else F.coalesce(length, F.col("row.n_chars")).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col("row")[c].alias(c) for c in names])
