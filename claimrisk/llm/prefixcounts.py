"""Exact token counts of every prefix of a text, without encoding any prefix again.

Within a pre-token the last token of each prefix is found by dynamic programming: of the tokens
that end there, exactly one is stable beside the last token of the prefix before it, that is, the
byte pair merges leave the two as they are.  The count of the prefix is one more than the count
where that token starts.  Between pre-tokens counts add up.  Two cases depend on what follows and
are counted as the text would be if it ended there: a run of white space, and the opening of a
contraction.  Special strings of the vocabulary count one token once they are complete.

A prefix ends between code points.  Counts of equal pieces are remembered as differences, so a
text's counts are one running sum.  Null and empty texts have no prefix and no tokens; texts are
counted whole, whatever their length; repeated rows are counted alike; empty tables give empty
results.  Extra columns of the input are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from array import array
from itertools import accumulate
from operator import itemgetter, sub

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimrisk.llm.frames import kept_by_worker, map_batches, ragged, texts_of
from claimrisk.llm.pieces import SPACE, Generations, Memory

RUN = re.compile(f"[{SPACE}]+")
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")  # fixed values of the public pattern
REMEMBERED_PAIRS = 500_000
SHIFT = 32  # a pair of tokens as one number
LAST = 1 << 60  # rank of what never merges


class Vocabulary:
    """Merges of a byte-level BPE vocabulary in the public JSON format."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model, before = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"]:
            raise ValueError("a byte-level BPE vocabulary without prefix space is needed")
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        rest = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

        def spelled(token: str) -> bytes:
            return bytes(map(byte_of.__getitem__, token))

        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = {(spelled(a), spelled(b)): rank for rank, (a, b) in enumerate(merges)}
        self.special = [t["content"] for t in spec["added_tokens"]]
        known = set(self.special)
        self.tokens = {spelled(t) for t in model["vocab"] if t not in known}
        self.longest = max(map(len, self.tokens))
        self.spelling = [b"", *sorted(self.tokens)]  # by number; 0 is no token
        self.number = {t: i for i, t in enumerate(self.spelling) if i}
        self.halves = {a + b: (a, b) for a, b in self.merges}
        if len(self.halves) != len(self.merges):
            raise ValueError("a vocabulary in which every token has one merge is needed")
        self.spines: tuple[dict, dict] = {}, {}

    def merged(self, text: bytes) -> list[bytes]:
        """The tokens of a short byte string by the merges themselves."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, at = min((self.merges.get(pair, 1 << 60), i)
                           for i, pair in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts


    def spine(self, token: bytes, side: int) -> list[tuple[bytes, int]]:
        """What stands at one end of a token (0 left, 1 right) while it is merged, byte first.

        With each the rank of the merge by which the next one swallows it.
        """
        known = self.spines[side].get(token)
        if known is None:
            parts, known = self.halves.get(token), []
            if parts:
                known = self.spine(parts[side], side)[:-1] + [(parts[side], self.merges[parts])]
            known = self.spines[side][token] = known + [(token, LAST)]
        return known

    def apart(self, left: bytes, right: bytes) -> bool:
        """Whether the merges never join two neighbouring tokens across their seam.

        Merges happen in order of rank, the leftmost first.  While nothing joins the seam, what
        stands left and right of it climbs the spines of both tokens; it is joined if its own
        merge comes before the next step of either.
        """
        lefts, rights, merges = self.spine(left, 1), self.spine(right, 0), self.merges
        i, j = 0, 0
        while True:
            (a, up_left), (b, up_right) = lefts[i], rights[j]
            rank = merges.get((a, b), LAST)
            if rank < up_left and rank <= up_right and rank < LAST:
                return False
            if up_left == up_right == LAST:
                return True
            if up_left <= up_right:
                i += 1
            else:
                j += 1


class PrefixCounter:
    """Token counts of all prefixes, with a memory of pieces and of stable pairs."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex
        self.vocabulary = vocabulary
        self.pretokens = regex.compile(pattern).findall
        self.special = re.compile("|".join(map(re.escape, vocabulary.special)) or "(?!)")
        self.words: Generations = Generations()
        self.pairs: Generations = Generations(REMEMBERED_PAIRS)  # number of the left << SHIFT | right
        self.pieces = Memory(self._differences)

    def _stable(self, pair: int) -> bool:
        """Whether the merges leave two neighbouring tokens as they are; the left may be none."""
        known = self.pairs.recall(pair)
        if known is None:
            self.pairs.make_room()
            left, right = (self.vocabulary.spelling[i] for i in (pair >> SHIFT, pair & (1 << SHIFT) - 1))
            known = self.pairs[pair] = (
                self.vocabulary.apart(left, right) if left else self.vocabulary.merged(right) == [right])
        return known

    def _extend(self, word: bytes, last: list[int], counts: list[int]) -> None:
        """Carry last tokens (shifted numbers) and counts, known for the first prefixes of a word, to its end."""
        number, longest, known = self.vocabulary.number.get, self.vocabulary.longest, self.pairs.get
        for end in range(len(counts), len(word) + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = number(word[start:end])
                if token is not None:
                    pair = last[start] | token
                    fits = known(pair)
                    if fits or fits is None and self._stable(pair):
                        last.append(token << SHIFT)
                        counts.append(counts[start] + 1)
                        break

    def prefix_tokens(self, word: bytes) -> list[int]:
        """Token counts of the prefixes of a pre-token with 0, 1, 2 ... bytes."""
        counts = [0]
        self._extend(word, [0], counts)
        return counts

    def _learn(self, words: set[str]) -> None:
        """Remember what each code point of a pre-token adds to the count.

        In sorted order a word goes on from the prefixes it shares with the word before it.
        """
        last, counts, before = [0], [0], b""
        for word, data in sorted(((w, w.encode()) for w in words), key=itemgetter(1)):
            same, most = 0, min(len(before), len(data))
            while same < most and before[same] == data[same]:
                same += 1
            del last[same + 1:], counts[same + 1:]
            self._extend(data, last, counts)
            before, own = data, counts
            if len(data) != len(word):
                own = [counts[e] for e in accumulate((len(c.encode()) for c in word), initial=0)]
            if word in CONTRACTIONS:  # not yet one: a mark and letters
                tail = self.prefix_tokens(data[1:])
                own = [0, *(counts[1] + n for n in tail[:-1]), own[-1]]
            self.words[word] = array("h", map(sub, own[1:], own)).tobytes()

    def _differences(self, pieces: list[str]) -> list[bytes]:
        """What each code point of a piece adds to the count."""
        pretokens, search = self.pretokens, RUN.search
        cut = [[p] if p[:1] == " " and p[1:].isalpha() else pretokens(p) for p in pieces]
        # a blank in front counts alike in any text
        broken = [len(ws) > 1 and search(p, 1) is not None for p, ws in zip(pieces, cut)]
        wanted = {w for words in cut for w in words}
        wanted.update(run for p, some in zip(pieces, broken) if some for run in RUN.findall(p))
        self.words.make_room(len(wanted))
        self._learn({w for w in wanted if w not in self.words and self.words.recall(w) is None})
        step, out = self.words.__getitem__, []
        for piece, words, some in zip(pieces, cut, broken):
            steps = step(words[0]) if len(words) == 1 else b"".join(map(step, words))
            if some:
                counts = [0, *accumulate(array("h", steps))]
                after = list(counts)
                for run in RUN.finditer(piece):
                    start, end = run.span()
                    ran = accumulate(array("h", step(run.group())))
                    counts[start + 1:end + 1] = [after[start] + n for n in ran]
                steps = array("h", map(sub, counts[1:], counts)).tobytes()
            out.append(steps)
        return out

    def _ordinary(self, texts: list[str]) -> list[np.ndarray]:
        return [np.cumsum(np.frombuffer(b, np.int16), dtype=np.int32)
                for b in self.pieces.joined(texts)]

    def counts(self, texts: list[str]) -> list[np.ndarray]:
        """For every text the token counts of its prefixes with 1, 2 ... code points."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            at = 0
            for match in self.special.finditer(text) if self.special.search(text) else ():
                parts.append((text[at:match.start()], match.group()))
                owner.append(i)
                at = match.end()
            parts.append((text[at:], ""))
            owner.append(i)
        # a special string that is not yet complete is ordinary text
        found = self._ordinary([text + special[:-1] for text, special in parts])
        out: list[list[np.ndarray]] = [[] for _ in texts]
        base = [0] * len(texts)
        for i, (text, special), counts in zip(owner, parts, found):
            out[i].append(counts + base[i])
            base[i] += int(counts[len(text) - 1]) if text else 0
            if special:
                base[i] += 1
                out[i].append(np.array([base[i]], np.int32))
        return [np.concatenate(x) if len(x) > 1 else x[0] for x in out]


def prefix_counts(spark: SparkSession, docs: DataFrame, vocabulary_file: str,
                  pattern: str) -> DataFrame:
    """doc_id, n_bytes and prefix_counts (array of int, one count per code point) per document.

    The vocabulary is read once by the driver and broadcast; it does not grow with the data.
    """
    with open(vocabulary_file, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())

    def work():
        key = hashlib.sha256(data.value + pattern.encode()).digest()
        counter = kept_by_worker("prefix counter", key,
                                 lambda: PrefixCounter(Vocabulary(data.value), pattern))

        def function(rows):
            gc.disable()  # millions of remembered values, none in a cycle
            try:
                counts = ragged(counter.counts(rows["text"]), np.int32)
            finally:
                gc.enable()
            return {"doc_id": rows["doc_id"], "n_bytes": [len(t.encode()) for t in rows["text"]],
                    "prefix_counts": counts}
        return function

    return map_batches(texts_of(docs), "doc_id long, n_bytes long, prefix_counts array<int>", work)


def total(counts: Column | str = "prefix_counts") -> Column:
    """Tokens of the whole text."""
    return F.when(F.size(counts) > 0, F.element_at(counts, -1)).otherwise(0)


def longest_within(budget: int, counts: Column | str = "prefix_counts") -> Column:
    """Code points of the longest prefix that has at most ``budget`` tokens."""
    return F.coalesce(F.array_max(F.transform(
        counts, lambda n, i: F.when(n <= budget, i + 1).otherwise(0))), F.lit(0))


def summary(counted: DataFrame, limit: int) -> DataFrame:
    """Size and token count of each document, and whether it is over a limit."""
    n = total().cast("long")
    return counted.select("doc_id", "n_bytes", n.alias("n_tokens"),
                          (n > limit).alias("over_limit"))
