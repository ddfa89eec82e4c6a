"""Cutting texts at blanks, where byte-level tokenization can be done piece by piece.

The public pre-token pattern never reaches across a blank that stands between two characters
that are no white space: the token before it has ended and the blank opens the next one.  A text
can therefore be cut there, equal pieces are encoded once per worker, and the ids of the text are
the ids of its pieces in order.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

# Unicode white space, as the tokenizer libraries' \s has it.
SPACE = "\t-\r \x85\xa0  -     　"
CUT = re.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])")
BESIDE_SPACE = [pair for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c)
                for pair in (c + " ", " " + c)]

# What a worker remembers is kept in two generations of so many entries (results do not depend on it).
REMEMBERED = 450_000


class Generations(dict):
    """Remembered values, in two generations.

    When the young one is full it becomes the old one, whose values come back when they are asked
    for; what nobody asked for in between is forgotten.
    """

    def __init__(self, most: int = REMEMBERED):
        super().__init__()
        self.most, self.old = most, {}

    def recall(self, key):
        """A value that is not in the young generation, or None."""
        value = self.old.get(key)
        if value is not None:
            self[key] = value
        return value

    def make_room(self, n: int = 1) -> None:
        if len(self) + n > self.most:
            self.old = dict(self)
            self.clear()


def cut(text: str) -> list[str]:
    """The pieces of a text; all but the first had a blank before them."""
    if text[:1] == " " or text[-1:] == " " or any(pair in text for pair in BESIDE_SPACE):
        return CUT.split(text)
    return text.split(" ")


class Memory(Generations):
    """Values of pieces, computed for many unseen pieces at once.

    The key of a piece inside a text is the piece without the blank before it.
    """

    def __init__(self, compute: Callable[[list[str]], list[bytes]]):
        super().__init__()
        self.compute = compute

    def joined(self, texts: list[str]) -> Iterable[bytes]:
        """For each text the values of its pieces, one after another."""
        for start, stop in runs(texts):
            pieces = [cut(t) for t in texts[start:stop]]
            values = [list(map(self.get, ps)) for ps in pieces]
            unseen = {p for ps, vs in zip(pieces, values) if None in vs
                      for p, v in zip(ps[1:], vs[1:]) if v is None}
            learned = {p: v for p in unseen if (v := self.old.get(p)) is not None}
            unseen = [p for p in unseen if p not in learned]
            learned |= zip(unseen, self.compute([" " + p for p in unseen]))
            self.make_room(len(learned))
            self.update(learned)
            heads = self.compute([ps[0] for ps in pieces])
            for head, ps, vs in zip(heads, pieces, values):
                vs[0] = head
                yield b"".join(vs if None not in vs else
                               [v if v is not None else learned[p] for p, v in zip(ps, vs)])


def runs(texts: list[str], most: int = 1_000_000) -> Iterable[tuple[int, int]]:
    """Neighbouring texts in runs of about ``most`` characters, one text at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)
