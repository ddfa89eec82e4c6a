"""Conversation structure repair: least-cost edits by a parallel Viterbi search.

A conversation is repaired to an optional system turn and then pairs of user and assistant turns
(role initials ``(s?(ua)+)?``), by keeping (cost 0), reroling to user or assistant (1) or deleting
(2) its rows and inserting empty user or assistant turns anywhere (5).  Blank and repeated rows
must be deleted; every truncated row that stays costs 5 more.  Of the cheapest edits those win
whose initials K, R, D and I, in order, come first in ASCII; the roles follow from them.

The search runs over the four states of the pattern.  Cost vectors are computed backwards, row by
row.  Rows are sorted by conversation and turn over all tasks; what a task holds of a conversation
is a chunk, so a conversation of any size is spread.  A conversation that lies within one task is
finished there.  For the others every chunk starts from a speculative cost vector; fix-up passes
hand each chunk the vector its successor ended with and run it again, until a pass changes vectors
by constants only (their rank has converged).  The constants add up to the costs.  Chunks are then
traced forwards from every state, least initial first, and joined from the first chunk on.  The
digest of such a conversation is computed from its repaired rows streaming by in order, as it must.

The order within a conversation is turn (null first), then, where the table repeats a turn, role
and the text's digest.  Null role, text, and the null in the key that damages rows, count as one
space; a null conv_id is a conversation of its own.  An empty role has no initial and cannot be
kept.  A conversation without rows after damage has zeros and empty results.  Empty tables give no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, islice
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimrisk.session import written

CHUNK_ROWS = 20_000   # rows a task holds, about
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NEVER = 1 << 40
START, SYSTEM, USER, ASSISTANT = range(4)  # state: what the repaired rows end with so far
ENDS = (0, NEVER, NEVER, 0)  # costs after the last row: nothing, or whole pairs
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
         (ASSISTANT, "u"): USER}
# the role that reroling or inserting gives in each state, and the state after it
NEXT = (("user", USER), ("user", USER), ("assistant", ASSISTANT), ("user", USER))
LEGAL = {"su", "ua", "au"}
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
CLOSED = ".!?"
RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")
PART = "shiftright(row, 33) AS part"  # the task that sorted the row


def damaged(table: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the rows after damage."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    kind = F.crc32(F.encode(key, "utf-8")) % 20
    role, text = (F.coalesce(F.col(c), blank) for c in ("role", "text"))
    return table.withColumn("kind", kind).where("kind <> 0").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("again"),
    ).drop("again")


def sorted_rows(spark: SparkSession, rows: DataFrame, chunk_rows: int) -> DataFrame:
    """The rows with ``row``, a number that grows with their order; rows of a task share its high bits."""
    rows = rows.withColumn("digest", F.sha2("text", 256)).withColumn("nth", F.monotonically_increasing_id())
    rows = written(spark, rows, "damaged")
    tasks = max(1, -(-rows.count() // chunk_rows), spark.sparkContext.defaultParallelism)
    order = ["conv_id", "turn", "role", "digest", "nth"]
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("nth")
    return written(spark, dealt.withColumn("row", F.monotonically_increasing_id()), "sorted")


def initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "-"


def symbol(role: str, text: str, seen: bool) -> tuple[str, str]:
    """What the row means to the search, and its first fault (b, d, t or none).

    An initial (- for other roles), as a capital (_) if the row is truncated; x if it must go.
    """
    solid = text.rstrip(SPACE)
    if not solid:
        return "x", "b"
    if seen:
        return "x", "d"
    if solid[-1] in CLOSED:
        return initial(role), ""
    return initial(role).upper() if initial(role) != "-" else "_", "t"


def inserted(costs) -> tuple:
    """Costs where rows may be inserted first; going round the pattern never pays."""
    costs = list(costs)
    for _ in range(3):
        for state in range(4):
            costs[state] = min(costs[state], INSERT + costs[NEXT[state][1]])
    return tuple(costs)


def normal(costs) -> tuple[tuple, int]:
    """A cost vector up to a constant, and the constant."""
    least = min(costs)
    return tuple(c - least for c in costs), least


LAST = inserted(ENDS)      # its least value is 0
SPECULATIVE = (0, 0, 0, 0)


class Search:
    """Steps over one row, remembered: vectors are taken up to a constant, so they are few."""

    def __init__(self):
        self.known: dict = {}

    def step(self, symbol: str, after: tuple) -> tuple[tuple, int, tuple]:
        """Costs before the row, their constant, and (edits, state after them) from each state."""
        found = self.known.get((symbol, after))
        if found is None:
            more = TRUNCATED if symbol.isupper() or symbol == "_" else 0
            own = []
            for state in range(4):
                edits = [(DELETE + after[state], "D", state)]
                if symbol != "x":
                    kept = AFTER.get((state, symbol.lower()))
                    if kept is not None:
                        edits.append((more + after[kept], "K", kept))
                    onward = NEXT[state][1]
                    edits.append((more + REROLE + after[onward], "R", onward))
                own.append(edits)
            costs = inserted(min(e)[0] for e in own)
            found = self.known[symbol, after] = (
                *normal(costs), tuple(self._least(q, costs, own) for q in range(4)))
        return found

    @staticmethod
    def _least(state: int, costs: tuple, own: list) -> tuple[str, int]:
        """The ASCII-least of the cheapest edits up to the row's own."""
        out = ""
        while True:
            options = [(e, to) for cost, e, to in own[state] if cost == costs[state]]
            onward = NEXT[state][1]
            if INSERT + costs[onward] == costs[state]:
                options.append(("I", onward))
            edit, state = min(options)
            out += edit
            if edit != "I":
                return out, state

    def backward(self, symbols: str, tail: tuple) -> tuple[tuple, int]:
        """Costs before the first row up to a constant, and the constant."""
        offset = 0
        for s in reversed(symbols):
            tail, least, _ = self.step(s, tail)
            offset += least
        return tail, offset

    def fixed(self, symbols: str, old: tuple, head: tuple, offset: int, new: tuple) -> tuple[tuple, int]:
        """``backward`` from ``new``, given its result from ``old``: run until they run together."""
        before, after = 0, 0
        for s in reversed(symbols):
            if old == new:
                return head, offset - before + after
            old, least, _ = self.step(s, old)
            before += least
            new, least, _ = self.step(s, new)
            after += least
        return new, after

    def traced(self, symbols: str, tail: tuple, starts=(START,)) -> list[tuple[list[str], int]]:
        """From each start: the edits up to and with each row, and the state after the last."""
        moves = []
        for s in reversed(symbols):
            tail, _, move = self.step(s, tail)
            moves.append(move)
        moves.reverse()
        out = []
        for state in starts:
            edits = []
            for move in moves:
                some, state = move[state]
                edits.append(some)
            out.append((edits, state))
        return out


def closing(state: int) -> str:
    """Rows inserted after the last one."""
    out = ""
    while ENDS[state]:
        out, state = out + "I", NEXT[state][1]
    return out


def lines(edits: str, role: str, text: str, state: int) -> tuple[list[str], int]:
    """Repaired rows from the edits up to and with a row, and the state after them."""
    out = []
    for e in edits:
        name, onward = NEXT[state]
        if e == "I":
            out.append(name + ":")
        elif e == "K":
            onward = AFTER[state, initial(role)]
            out.append(f"{role}:{text}")
        elif e == "R":
            out.append(f"{name}:{text}")
        state = state if e == "D" else onward
    return out, state


def illegal_pairs(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:]))


def solved(search: Search, conv_id, turns: list, roles: list[str], texts: list[str]) -> tuple:
    """The result of a conversation whose rows are given in order."""
    seen, symbols, faults = set(), "", ""
    for role, text in zip(roles, texts):
        s, fault = symbol(role, text, (role, text) in seen)
        seen.add((role, text))
        symbols += s
        faults += fault
    head, offset = search.backward(symbols, LAST)
    (edits, state), = search.traced(symbols, LAST)
    edits[-1] += closing(state)
    out, state = [], START
    for e, role, text in zip(edits, roles, texts):
        some, state = lines(e, role, text, state)
        out += some
    known = [t for t in turns if t is not None]
    return (conv_id, known[-1] - known[0] + 1 - len(set(known)) if known else 0,
            faults.count("b"), faults.count("d"), faults.count("t"), illegal_pairs(roles),
            head[START] + offset, "".join(edits), hashlib.sha256("\n".join(out).encode()).hexdigest())


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list, bool]]:
    """(conv_id, part), rows and whether the run stands first or last among those of its part."""
    held, first = None, True
    for batch in batches:
        for conv_id, part, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if held is None or held[0] != (conv_id, part):
                if held is not None:
                    other = held[0][1] != part
                    yield *held, first or other
                    first = other
                held = (conv_id, part), []
            held[1].append(row)
    if held is not None:
        yield *held, True


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(T._parse_datatype_string(schema))


def _packed(rows: Iterator[tuple], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    """Rows in batches."""
    rows = iter(rows)
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def within(rows: DataFrame) -> DataFrame:
    """Results of the conversations that stand between two others in their part; of the others the id."""
    schema = _arrow(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, blank = Search(), (None,) * (len(schema) - 1)
        yield from _packed(
            ((key[0], *blank) if outer else solved(search, key[0], *map(list, zip(*held)))
             for key, held, outer in _runs(batches)), schema)

    return rows.select("conv_id", F.expr(PART), "turn", "role", "text").mapInArrow(run, RESULT)


# -- conversations that more than one task may hold

CHUNK = ("conv_id long, part long, first_row long, symbols string, blank long, duplicate long, "
         "truncated long, illegal long, first_initial string, last_initial string, least long, "
         "most long, turns long, last_turn long")
COSTS = "conv_id long, part long, symbols string, last boolean, tail array<long>, head array<long>, offset long"
STATES = "conv_id long, part long, state int"


def chunk_of(conv_id, part, rows: list) -> tuple:
    """What the search needs of a chunk; rows: (row, turn, role, text, whether seen before)."""
    symbols, faults = zip(*(symbol(role, text, seen) for _, _, role, text, seen in rows))
    turns, roles = [r[1] for r in rows], [r[2] for r in rows]
    known = [t for t in turns if t is not None] or [None]
    return (conv_id, part, rows[0][0], "".join(symbols), faults.count("b"), faults.count("d"),
            faults.count("t"), illegal_pairs(roles), roles[0][:1], roles[-1][:1], known[0], known[-1],
            len(set(known) - {None}), turns[-1])


def chunks(rows: DataFrame) -> DataFrame:
    """A row for each chunk of the conversations in ``rows``."""
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min("row").alias("row"))
    marked = rows.join(firsts.select("row", F.lit(False).alias("seen")), "row", "left").select(
        "conv_id", F.expr(PART), "row", "turn", "role", "text", F.coalesce("seen", F.lit(True)).alias("seen"))
    schema = _arrow(CHUNK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _packed((chunk_of(*key, held) for key, held, _ in _runs(batches)), schema, 16)

    return marked.repartition("conv_id", "part").sortWithinPartitions("conv_id", "part", "row") \
        .mapInArrow(run, CHUNK)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def converged(spark: SparkSession, found: DataFrame) -> tuple[DataFrame, int]:
    """The columns of ``COSTS`` with the true tail of every chunk, and the passes it took."""
    schema, order = _arrow(COSTS), Window.partitionBy("conv_id").orderBy("part")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search()
        for conv_id, part, symbols, last in _rows(batches):
            tail = LAST if last else SPECULATIVE
            head, offset = search.backward(symbols, tail)
            yield from _packed([(conv_id, part, symbols, last, tail, head, offset)], schema)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search()
        for conv_id, part, symbols, last, tail, head, offset, given in _rows(batches):
            if not last and given != tail:
                head, offset = search.fixed(symbols, tuple(tail), tuple(head), offset, tuple(given))
                tail = given
            yield from _packed([(conv_id, part, symbols, last, tail, head, offset)], schema)

    costs = written(spark, found.select("conv_id", "part", "symbols",
                                        F.lead("part").over(order).isNull().alias("last"))
                    .mapInArrow(first, COSTS), "costs")
    passes = 1
    while True:
        given = costs.select(F.col("conv_id").alias("c"), F.col("part").alias("p"),
                             F.lead("head").over(order).alias("given"))
        new = written(spark, costs.join(given, costs.conv_id.eqNullSafe(given.c) & (costs.part == given.p))
                      .drop("c", "p"), "given")
        if new.where("NOT last AND given <> tail").isEmpty():
            return costs, passes
        costs = written(spark, new.mapInArrow(again, COSTS), "costs")
        passes += 1


def stitched(spark: SparkSession, costs: DataFrame) -> DataFrame:
    """conv_id, part and state: what every chunk starts from."""
    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search()
        yield from _packed(
            ((conv_id, part, [to for _, to in search.traced(symbols, tuple(tail), range(4))])
             for conv_id, part, symbols, tail in _rows(batches)), to_schema)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def steps():
            now, state = None, None
            for conv_id, part, to in _rows(batches):
                if state is None or conv_id != now:
                    now, state = conv_id, START
                yield conv_id, part, state
                state = to[state]
        yield from _packed(steps(), state_schema)

    to = "conv_id long, part long, to array<int>"
    to_schema, state_schema = _arrow(to), _arrow(STATES)
    return costs.select("conv_id", "part", "symbols", "tail").mapInArrow(ends, to) \
        .repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(follow, STATES)


def edits_of(traces: DataFrame) -> DataFrame:
    """row and the edits up to and with it, of all rows; traces: chunks with their start state."""
    schema = _arrow("row long, edits string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search()

        def rows():
            for first_row, symbols, last, tail, state in _rows(batches):
                (edits, state), = search.traced(symbols, tuple(tail), (state,))
                if last:
                    edits[-1] += closing(state)
                yield from enumerate(edits, first_row)

        yield from _packed(rows(), schema, 16384)

    return traces.select("first_row", "symbols", "last", "tail", "state").mapInArrow(run, "row long, edits string")


def digests(rows: DataFrame) -> DataFrame:
    """conv_id, audit, repaired_sha256 from rows (conv_id, row, role, text, edits), streaming by in order."""
    schema = _arrow("c2 long, audit string, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def results():
            for (conv_id, *_), group in groupby(_rows(batches), key=itemgetter(slice(0, 1))):
                audit, state, digest, joint = [], START, hashlib.sha256(), ""
                for _, _, role, text, edits in group:
                    some, state = lines(edits, role, text, state)
                    for line in some:
                        digest.update((joint + line).encode())
                        joint = "\n"
                    audit.append(edits)
                yield conv_id, "".join(audit), digest.hexdigest()
        yield from _packed(results(), schema)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "row") \
        .select("conv_id", "row", "role", "text", "edits") \
        .mapInArrow(run, "c2 long, audit string, repaired_sha256 string")


def across(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Results of conversations by chunks (columns of ``RESULT``)."""
    found = written(spark, chunks(rows), "chunks")
    costs, _ = converged(spark, found)
    order = Window.partitionBy("conv_id").orderBy("part")
    states = stitched(spark, costs).toDF("c", "p", "state")
    starts = found.select(F.col("conv_id").alias("c0"), F.col("part").alias("p0"), "first_row")
    traces = costs.join(states, costs.conv_id.eqNullSafe(F.col("c")) & (costs.part == F.col("p"))) \
        .join(starts, costs.conv_id.eqNullSafe(F.col("c0")) & (costs.part == F.col("p0")))
    repaired = digests(rows.join(written(spark, edits_of(traces), "edits"), "row"))
    # every chunk's costs count from its tail, so the constants add up
    summed = costs.groupBy("conv_id").agg(
        (F.sum("offset") + F.get(F.min_by("head", "part"), F.lit(START))).alias("cost")) \
        .withColumnRenamed("conv_id", "c1")
    seam = (F.lag("last_turn").over(order) == F.col("least")).cast("long")
    pair = F.concat(F.lag("last_initial").over(order), "first_initial")
    counted = found.select(
        "conv_id", "blank", "duplicate", "truncated", "least", "most",
        (F.col("turns") - F.coalesce(seam, F.lit(0))).alias("turns"),
        (F.col("illegal") + F.when(~pair.isin(*LEGAL), 1).otherwise(0)).alias("illegal"),
    ).groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns")],
        F.min("least").alias("least"), F.max("most").alias("most"))
    gaps = F.when(F.col("turns") > 0, F.col("most") - F.col("least") + 1 - F.col("turns")).otherwise(0)
    return counted.join(summed, counted.conv_id.eqNullSafe(F.col("c1"))) \
        .join(repaired, counted.conv_id.eqNullSafe(F.col("c2"))).select(
        "conv_id", gaps.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal",
        "cost", "audit", "repaired_sha256")


def repair(spark: SparkSession, table: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The columns of ``RESULT`` for every conversation (columns conv_id, turn, role, text)."""
    rows = sorted_rows(spark, damaged(table), chunk_rows)
    held = written(spark, within(rows), "within")
    # at most two conversations of every part a task reads, whatever they hold
    split = held.where("audit IS NULL").select(F.col("conv_id").alias("c")).distinct()
    split_rows = written(spark, rows.join(F.broadcast(split), rows.conv_id.eqNullSafe(F.col("c")),
                                          "leftsemi"), "split")
    done = held.where("audit IS NOT NULL").unionByName(across(spark, split_rows))
    everyone = table.select(F.col("conv_id").cast("long").alias("every")).distinct()
    zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return everyone.join(done, everyone.every.eqNullSafe(done.conv_id), "left").select(
        F.col("every").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
