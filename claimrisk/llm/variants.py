"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Letters fall into groups (``GROUPS``; all others share the last one).  A word's path through the
trie is its length and then how many of its letters each group holds.  One edit changes the counts
by one surplus, one deficit or both (a replaced letter), so a depth-first search that may spend one
of each meets every word one edit away; the words at the leaves it reaches are verified letter by
letter.  The search descends with blocks of nodes instead of single ones.

The trie is cut into subtrees by the first levels of the path, as many as bring every subtree
below ``SUBTREE`` words.  A word stands in its own subtree and visits those that one edit of itself
can lie in, of the two directions of an edit only one, so a pair is found in one place.  Subtrees
that stay larger are cut into blocks that each get all visitors.  Tasks hold the words of one
block, visitors stream by, and what leaves is a count and the most frequent near word per word.

Words come from whole texts, counted within the task first.  Null texts have none; a null document
id counts as an empty name.  Repeated documents count each.  Equal frequencies go by code points.
Words of any length are treated alike.  Empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.llm.frames import BATCH_ROWS, texts_of
from claimrisk.session import written

RUN = re.compile("[a-zA-ZÀ-ÿ]+")  # after lower-casing A to Z
DAMAGE = 199       # hashes that it divides lose a letter
LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_TIMES = 5     # a form is at least so many times as frequent
GROUPS = ["e", "n", "i", "t", "a", "r", "s", "o", "h", "ul", "dc", "gmp", "bfkw", "vyzjqx"]
SUBTREE = 20_000   # words of a subtree a task holds
VISITORS = 2048    # words that search at once
FRONTIER = 400_000  # nodes that are open at once
PAIR_BYTES = 32_000_000  # letters compared at once
TALLY_WORDS = 400_000   # words counted before they leave a task
LONG_TEXT = 1_000_000   # characters, beyond which words are not listed at once
NEAR = "word string, n_near long, minus_n long, near string"

GROUP_OF = np.full(256, len(GROUPS), np.uint8)
for _i, _letters in enumerate(GROUPS):
    GROUP_OF[list(_letters.encode())] = _i
LEVELS = len(GROUPS) + 1


def damaged_words(doc_id, text: str) -> Iterator[tuple[str, int]]:
    """Words of a text after the rule that removes letters, with how often each occurs."""
    low = text.encode().lower().decode()  # bytes know A to Z only
    runs = Counter(RUN.findall(low) if len(low) < LONG_TEXT else (m.group() for m in RUN.finditer(low)))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= LEAST_LETTERS:
            yield run, n


def word_counts(docs: DataFrame) -> DataFrame:
    """word and n of all words that are long and frequent enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter = Counter()

        def emit():
            words = list(tally)
            out = pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(list(tally.values()), pa.int64())],
                names=["word", "n"])
            tally.clear()
            for first in range(0, out.num_rows, 16384):
                yield out.slice(first, 16384)

        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(first, BATCH_ROWS)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for word, n in damaged_words(doc_id, text):
                        tally[word] += n
                    if len(tally) > TALLY_WORDS:
                        yield from emit()
        yield from emit()

    return (texts_of(docs).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT))


def _path(levels: int) -> list:
    """Length and the counts of the first groups, as columns."""
    out = [F.length("word").alias("g0")]
    for i, letters in enumerate(GROUPS[:levels]):
        out.append((F.length("word") - F.length(F.translate("word", letters, ""))).alias(f"g{i + 1}"))
    return out


def _cut(words: DataFrame, subtree: int) -> tuple[int, DataFrame]:
    """How many groups the subtrees are told apart by, and the words of every subtree."""
    for levels in range(1, LEVELS):
        names = [f"g{i}" for i in range(levels + 1)]
        sizes = words.select(*_path(levels)).groupBy(*names).agg(F.count("*").alias("held"))
        if sizes.agg(F.max("held")).first()[0] <= subtree:
            break
    return levels, sizes


def visits(words: DataFrame, levels: int) -> DataFrame:
    """word, n and path of every subtree a word stands in (kind 0) or visits (kind 1).

    A deleted letter leads to the shorter word; a replaced one from the group of smaller number to
    the other, the letters of no told group counting as the last.
    """
    names = [f"g{i}" for i in range(levels + 1)]
    rest = levels + 1
    moves = [(0, {})] + [(1, {0: -1, i: -1}) for i in range(1, levels + 1)] + [(1, {0: -1})]
    moves += [(1, {i: -1, j: 1}) for i in range(1, rest + 1) for j in range(i + 1, rest + 1)]

    def moved(change: dict):
        return [(F.col(n) + change[i] if i in change else F.col(n)).cast("int").alias(n)
                for i, n in enumerate(names)]

    options = F.array(*[F.struct(F.lit(kind).alias("kind"), *moved(change)) for kind, change in moves])
    paths = words.select("word", "n", *_path(levels)).select(
        "word", "n", F.explode(options).alias("v"))
    return paths.select("word", "n", "v.*").where(" AND ".join(f"{n} >= 0" for n in names))


def vectors(letters: np.ndarray) -> np.ndarray:
    """Group counts of words of one length, given as rows of letters."""
    out = np.zeros((len(letters), LEVELS), np.int32)
    for column in GROUP_OF[letters].T:
        out[np.arange(len(letters)), column] += 1
    return out


def letters_of(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


class Trie:
    """Words of one length by their group counts, one level for each group."""

    def __init__(self, words: list[str], counts: np.ndarray):
        self.length = len(words[0])
        letters = letters_of(words, self.length)
        paths = vectors(letters)
        order = np.lexsort(paths.T[::-1])  # by the first level first
        self.words = [words[i] for i in order]
        self.counts, self.letters = counts[order], letters[order]
        paths = paths[order].astype(np.int64)
        self.wide = self.length + 3  # more than any count
        node = np.zeros(len(words), np.int64)  # node of each word on the level above
        self.keys = []  # of each level: node above * wide + count, ascending; its place is the node
        for level in range(LEVELS):
            key, node = np.unique(node * self.wide + paths[:, level], return_inverse=True)
            self.keys.append(key)
        self.first = np.searchsorted(node, np.arange(len(self.keys[-1]) + 1))  # words of a leaf

    def candidates(self, paths: np.ndarray, deficit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(searching word, word of the trie) whose counts differ by the allowed edit.

        With ``deficit`` the searching words are one letter longer; otherwise they are of the same
        length and may have one surplus and one deficit.
        """
        n = len(paths)
        open_nodes = [(0, np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int8), np.zeros(n, np.int8))]
        while open_nodes:
            level, who, node, more, less = open_nodes.pop()
            if not len(who):
                continue
            if len(who) > FRONTIER:
                half = len(who) // 2
                open_nodes += [(level, *(x[half:] for x in (who, node, more, less))),
                               (level, *(x[:half] for x in (who, node, more, less)))]
                continue
            if level == LEVELS:
                sizes = self.first[node + 1] - self.first[node]
                ends = np.concatenate([[0], np.cumsum(sizes)])
                low = 0
                while low < len(who):  # leaves of about FRONTIER words together
                    high = max(low + 1, int(np.searchsorted(ends, ends[low] + FRONTIER)) - 1)
                    part, size = slice(low, high), sizes[low:high]
                    inside = np.arange(ends[low], ends[high]) - np.repeat(ends[low:high], size)
                    yield np.repeat(who[part], size), np.repeat(self.first[node[part]], size) + inside
                    low = high
                continue
            keys, parts = self.keys[level], []
            value = paths[who, level]
            for change in (0, 1, -1):
                want = value + change
                can = want >= 0
                if change == 1:
                    can &= more < (0 if deficit else 1)
                elif change == -1:
                    can &= less < 1
                idx = np.flatnonzero(can)
                key = node[idx] * self.wide + want[idx]
                at = np.searchsorted(keys, key)
                hit = keys[np.minimum(at, len(keys) - 1)] == key
                idx, at = idx[hit], at[hit]
                parts.append((who[idx], at, more[idx] + (change == 1), less[idx] + (change == -1)))
            open_nodes.append((level + 1, *(np.concatenate(x) for x in zip(*parts))))

    def near(self, letters: np.ndarray, v: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Which pairs (row of letters, word of the trie) are exactly one edit apart."""
        out = np.empty(len(v), bool)
        step = max(1, PAIR_BYTES // (self.length + 1))
        for low in range(0, len(v), step):
            a, b = letters[v[low:low + step]], self.letters[h[low:low + step]]
            if a.shape[1] == self.length:
                out[low:low + step] = (a != b).sum(1) == 1
            else:
                before = np.logical_and.accumulate(a[:, :-1] == b, axis=1).sum(1)
                after = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(1)
                out[low:low + step] = before + after >= self.length
        return out


class Best:
    """Number of near words and the most frequent one (ties: least) of each of some words."""

    def __init__(self, n: int):
        self.near = np.zeros(n, np.int64)
        self.most = np.zeros(n, np.int64)
        self.word = [None] * n

    def add(self, whose: np.ndarray, counts: np.ndarray, words: list[str], which: np.ndarray) -> None:
        np.add.at(self.near, whose, 1)
        order = np.lexsort((-counts[which], whose))
        whose, which = whose[order], which[order]
        least = counts[which] >= np.maximum(self.most[whose], _first_of_each(whose, counts[which]))
        for i, j in zip(whose[least].tolist(), which[least].tolist()):
            if (-counts[j], words[j]) < (-self.most[i], self.word[i] or ""):
                self.most[i], self.word[i] = counts[j], words[j]

    def rows(self, words: list[str]) -> Iterator[pa.RecordBatch]:
        found = np.flatnonzero(self.near)
        for low in range(0, len(found), 16384):
            part = found[low:low + 16384]
            yield pa.RecordBatch.from_arrays(
                [pa.array([words[i] for i in part], pa.string()), pa.array(self.near[part]),
                 pa.array(-self.most[part]), pa.array([self.word[i] for i in part], pa.string())],
                names=["word", "n_near", "minus_n", "near"])


def _first_of_each(sorted_keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For rows in order of their key: the value of the first row of the key."""
    starts = np.flatnonzero(np.diff(sorted_keys, prepend=-1))
    return np.repeat(values[starts], np.diff(np.append(starts, len(sorted_keys))))


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tree, kind, word, n), by tree and kind: words of the tree, then its visitors."""
    tree, words, counts, trie, best = None, [], [], None, None

    def visit(names: list[str], n: np.ndarray, own: bool) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(names):
            by_length.setdefault(len(w), []).append(i)
        for length, members in by_length.items():
            for low in range(0, len(members), VISITORS):
                some = members[low:low + VISITORS]
                mine, here = [names[i] for i in some], Best(len(some))
                letters, many = letters_of(mine, length), n[some]
                for v, h in trie.candidates(vectors(letters), int(length > trie.length)):
                    if own:  # both directions meet: keep one
                        keep = v + low < h
                        v, h = v[keep], h[keep]
                    near = trie.near(letters, v, h)
                    v, h = v[near], h[near]
                    here.add(v, trie.counts, trie.words, h)
                    best.add(h, many, mine, v)
                yield from here.rows(mine)

    def planted() -> Iterator[pa.RecordBatch]:
        nonlocal trie, best
        if trie is None:
            trie, best = Trie(words, np.array(counts, np.int64)), Best(len(words))
            yield from visit(trie.words, trie.counts, True)

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        trees, kinds = columns[0], columns[1]
        start = 0
        while start < len(trees):
            end = start
            while end < len(trees) and trees[end] == trees[start] and kinds[end] == kinds[start]:
                end += 1
            if trees[start] != tree:
                if words:
                    yield from planted()
                    yield from best.rows(trie.words)
                tree, words, counts, trie, best = trees[start], [], [], None, None
            if kinds[start] == 0:
                words += columns[2][start:end]
                counts += columns[3][start:end]
            elif words:
                yield from planted()
                yield from visit(columns[2][start:end], np.array(columns[3][start:end], np.int64), False)
            start = end
    if words:
        yield from planted()
        yield from best.rows(trie.words)


def near_words(spark: SparkSession, words: DataFrame, subtree: int = SUBTREE) -> DataFrame:
    """word, n_near, minus_n and near (the most frequent near word) of words with near ones."""
    levels, sizes = _cut(words, subtree)
    names = [f"g{i}" for i in range(levels + 1)]
    placed = visits(words, levels)
    large = sizes.where(F.col("held") > subtree).select(
        *names, F.ceil(F.col("held") / subtree).cast("int").alias("blocks"))
    if large.isEmpty():
        dealt = placed.withColumn("block", F.lit(0))
    else:
        # words stand in one block and visit those before it too; visitors reach all blocks
        block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
        one = F.array(F.struct(F.lit(0).alias("kind"), block.alias("block")))
        below = F.transform(F.sequence(F.lit(0), block - 1),
                            lambda b: F.struct(F.lit(1).alias("kind"), b.alias("block")))
        every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                            lambda b: F.struct(F.lit(1).alias("kind"), b.alias("block")))
        dealt = (placed.join(large, names, "left").fillna(1, ["blocks"])
                 .withColumn("to", F.when(F.col("kind") == 1, every)
                             .when(block > 0, F.concat(one, below)).otherwise(one))
                 .select("word", "n", *names, F.explode("to").alias("to"))
                 .select("word", "n", *names, "to.*"))
    rows = dealt.select(F.concat_ws(",", *names, "block").alias("tree"), "kind", "word", "n") \
        .repartition("tree").sortWithinPartitions("tree", "kind")
    found = rows.mapInArrow(_search, NEAR)
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("minus_n", "near")).alias("best")).select(
        "word", "n_near", "best.minus_n", "best.near")


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """word and root from (word, form): paths are halved until none gets shorter."""
    now = written(spark, forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        step = now.join(onward, "root", "left")
        if step.where("onward IS NOT NULL").isEmpty():
            return now
        now = written(spark, step.select("word", F.coalesce("onward", "root").alias("root")), "roots")


def grouped(spark: SparkSession, docs: DataFrame, subtree: int = SUBTREE) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    words = written(spark, word_counts(docs), "words")
    if words.isEmpty():
        return spark.createDataFrame(
            [], "word string, form string, root string, n long, n_near long, form_n long")
    near = words.join(near_words(spark, words, subtree), "word", "left")
    is_form = -F.col("minus_n") >= FORM_TIMES * F.col("n")
    formed = written(spark, near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"),
        F.when(is_form, -F.col("minus_n")).alias("form_n")), "forms")
    rooted = formed.join(roots(spark, formed.where("form IS NOT NULL")), "word", "left")
    return rooted.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
