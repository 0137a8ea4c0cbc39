"""Conversation structure repair: cheapest edits by dynamic programming over runs of equal symbols.

A message is one of nine symbols: the initial of its role (system, user, assistant, other), whole or
truncated, or a message that has to go (blank, or a duplicate). An automaton of four states reads the initials
``(s?(ua)+)?``; a symbol's edits are a 4 by 4 min-plus matrix over its states, inserts included.
Equal consecutive symbols are one run, advanced by the cached binary powers of that
matrix. Costs to the end are carried backwards over the runs; then the choices are unrolled forwards,
halving each run by the same powers, and the least letter that keeps the cost is taken: of
the cheapest edits the audit is the ASCII-least.

Messages are laid out by ranges of (conversation, turn, role, text) and that layout is checkpointed. A
conversation with a large share of all messages lies in many ranges: its part in each is one
segment, whose product of matrices is made where the segment lies. Only conversations that cross a border
between ranges, at most one a border, meet on the driver, with one matrix a segment. Texts stay in
their tasks; the hash of a crossing conversation, sequential by nature, is streamed through one task.

Defined results. A null role or text is one space, as are a null id and turn in the damage's key. Null turns come
first. Messages of one turn are ordered by role, first 64 characters, hash and text. Equal rows stand side by
side. Roles are known by their first character; an empty role has none. Conversations without an id are one
conversation. An empty table gives an empty result. Only the four columns are read; others are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import pickle
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from roadlens.llm.common import stored
from roadlens.session import shared_dir

SPACE = " \t\n\x0b\f\r"
FAR = 1 << 60  # no way
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
DROP = 8  # the symbol of a message that has to go
ROLES = ("user", "assistant")

#: The automaton: 0 nothing read, 1 after s, 2 after u, 3 after a; the end is allowed in 0 and 3.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The one role that may be put in at each state, and where it leads.
PUT = tuple(next((r, n[r[0]]) for r in ROLES if r[0] in n) for n in NEXT)
Vector = tuple[int, ...]


def _product(a: tuple[Vector, ...], b: tuple[Vector, ...]) -> tuple[Vector, ...]:
    return tuple(tuple(min(row[k] + b[k][j] for k in range(4)) for j in range(4)) for row in a)


def _before(m: tuple[Vector, ...], after: Vector) -> Vector:
    return tuple(min(row[k] + after[k] for k in range(4)) for row in m)


def _inserts(q: int) -> list[int]:
    """The cost of reaching each state from ``q`` by inserts alone."""
    out, cost = [FAR] * 4, 0
    while out[q] > cost:
        out[q] = cost
        q, cost = PUT[q][1], cost + INSERT
    return out


#: From each state, the cost of the inserts that are needed at the end.
END: Vector = tuple(min(_inserts(q)[0], _inserts(q)[3]) for q in range(4))


def symbol(initial: str, kind: str) -> int:
    """The symbol of a message by the initial of its role and its fault."""
    return DROP if kind in ("b", "d") else ("sua".index(initial) if initial and initial in "sua" else 3) + 4 * (kind == "t")


def _steps(sym: int, q: int) -> Iterator[tuple[str, int, int]]:
    """Letter, cost and next state of the edits of one message, the least letter first."""
    yield "D", DELETE, q
    if sym != DROP:
        extra, initial = TRUNCATED * (sym >= 4), "sua?"[sym % 4]
        if initial in NEXT[q]:
            yield "K", KEEP + extra, NEXT[q][initial]
        yield "R", REROLE + extra, PUT[q][1]


@functools.cache
def power(sym: int, k: int) -> tuple[Vector, ...]:
    """The matrix of 2**k messages of one symbol."""
    if k:
        half = power(sym, k - 1)
        return _product(half, half)
    edits = tuple(tuple(min([c for _, c, n in _steps(sym, q) if n == to], default=FAR) for to in range(4)) for q in range(4))
    return _product(tuple(tuple(_inserts(q)) for q in range(4)), edits)


def _bits(n: int) -> Iterator[int]:
    return (k for k in range(n.bit_length()) if n >> k & 1)


@functools.lru_cache(100_000)
def run_back(sym: int, n: int, after: Vector) -> Vector:
    """Costs to the end before a run of ``n`` messages, from those after it."""
    for k in _bits(n):
        after = _before(power(sym, k), after)
    return after


def matrix(runs: Iterable[tuple[int, int]]) -> tuple[Vector, ...]:
    """The min-plus product of a segment's runs."""
    out = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))
    for sym, n in runs:
        for k in _bits(n):
            out = _product(out, power(sym, k))
    return tuple(tuple(min(x, FAR) for x in row) for row in out)


def _one(sym: int, q: int, after: Vector) -> tuple[str, int]:
    """The letters of one message and the state behind it: inserts, then its edit."""
    letters, costs = "", run_back(sym, 1, after)
    while True:
        found = {x: (cost + after[n] == costs[q], n) for x, cost, n in _steps(sym, q)}
        if found["D"][0]:
            return letters + "D", q
        if INSERT + costs[PUT[q][1]] == costs[q]:
            letters, q = letters + "I", PUT[q][1]
            continue
        return next((letters + x, found[x][1]) for x in "KR" if x in found and found[x][0])


def unroll(sym: int, n: int, q: int, after: Vector) -> Iterator[tuple[str, int]]:
    """For each message of a run from state ``q``, its letters and the state behind it."""
    if n == 1:
        yield _one(sym, q, after)
        return
    k = (n - 1).bit_length() - 1
    for part, behind in ((n - (1 << k), _before(power(sym, k), after)), (1 << k, after)):
        for letters, q in unroll(sym, part, q, behind):
            yield letters, q


def collapsed(symbols: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """(symbol, times) with equal neighbours as one run."""
    runs: list[tuple[int, int]] = []
    for sym, n in symbols:
        if runs and runs[-1][0] == sym:
            runs[-1] = sym, runs[-1][1] + n
        elif n:
            runs.append((sym, n))
    return runs


def walk(runs: list[tuple[int, int]], q: int, after: Vector) -> Iterator[tuple[str, int]]:
    """For each message of a segment entered in state ``q``, its letters and the state behind it."""
    behind = [after]
    for sym, n in reversed(runs[1:]):
        behind.append(run_back(sym, n, behind[-1]))
    for (sym, n), costs in zip(runs, reversed(behind)):  # noqa: B905  no runs, one vector
        for letters, q in unroll(sym, n, q, costs):
            yield letters, q


class Message(NamedTuple):
    """One distinct message: how often it stands there (0: only the conversation does), and its first fault."""

    conv: object
    turn: object
    role: str
    text: str
    n: int
    kind: str

    def symbols(self) -> list[tuple[int, int]]:
        """The first copy's symbol; what follows it is a duplicate, or blank too."""
        return [(symbol(self.role[:1], self.kind), 1), (DROP, self.n - 1)] if self.n else []


def damage(conversations: DataFrame) -> DataFrame:
    """The messages with ``copies``, damaged by a hash of conversation and turn; dropped ones have 0 copies."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")) % 20
    text = (F.when(case == 1, F.lit("")).when(case == 2, F.translate(word("text"), ".!?", "")).otherwise(word("text")))
    return conversations.select(
        "conv_id", "turn", F.when(case == 4, F.lit("user")).otherwise(word("role")).alias("role"), text.alias("text"),
        F.when(case == 0, 0).when(case == 3, 2).otherwise(1).cast("long").alias("copies"))


def messages(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` as they are, one copy each."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return conversations.select("conv_id", "turn", word("role").alias("role"), word("text").alias("text"), F.lit(1).cast("long").alias("copies"))


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct messages with their number of copies ``n`` and first fault ``kind``.

    Equal rows are added up before they are shuffled. Messages said on several turns are few; their first
    turn is joined, by broadcast if Spark finds it small, else in a join whose hot keys Spark splits.
    """
    there = F.col("copies") > 0
    rows = rows.select("conv_id", "copies", *[F.when(there, F.col(c)).alias(c) for c in ("turn", "role", "text")])
    tail = lambda c: F.rtrim(c, F.lit(SPACE))
    said = rows.filter(there & (tail(F.col("text")) != "")).withColumn("_said", F.sha2(F.col("text").cast("binary"), 256))
    first = F.when(F.max(F.col("turn").isNull()), None).otherwise(F.min("turn"))
    again = (said.groupBy("conv_id", "role", "_said")
             .agg(first.alias("_first"), F.min("turn").alias("_a"), F.max("turn").alias("_b"), F.max(F.col("turn").isNull()).alias("_null"))
             .filter("_a < _b OR _null AND _a IS NOT NULL")
             .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("_said").alias("_digest"), "_first"))
    again = stored(again, "again")
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n"))
    digest = F.when(tail(F.col("text")) != "", F.sha2(F.col("text").cast("binary"), 256))
    rows = rows.join(again, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (digest == F.col("_digest")), "left")
    kind = (F.when(tail(F.col("text")) == "", "b")
            .when(F.col("_digest").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_first")), "d")
            .when(~F.right(tail(F.col("text")), F.lit(1)).isin(*".!?"), "t").otherwise(""))
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "n", kind.alias("kind"))


def _laid(rows: DataFrame) -> DataFrame:
    """The rows in order over the partitions, which are kept as they are, with the number of each row's partition."""
    shared_dir(rows.sparkSession)
    hashed = rows.withColumns({"_head": F.substring("text", 1, 64), "_hash": F.xxhash64("text")})
    order = ["conv_id", "turn", "role", "_head", "_hash"]
    return (hashed.repartitionByRange(*order).sortWithinPartitions(*order, "text").drop("_head", "_hash")
            .withColumn("part", F.spark_partition_id()).checkpoint())


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, int, Iterator[Message]]]:
    """Conversation, partition and messages of each segment of a partition; take the messages before the next segment."""
    def rows() -> Iterator[tuple[int, Message]]:
        for batch in batches:
            columns = [batch[name].to_pylist() for name in ("part", "conv_id", "turn", "role", "text", "n", "kind")]
            for part, *message in zip(*columns, strict=True):
                yield part, Message(*message)

    for conv, mine in groupby(rows(), key=lambda x: x[1].conv):
        part, first = next(mine)
        yield conv, part, _with(first, (m for _, m in mine))


def _with(first: Message, others: Iterator[Message]) -> Iterator[Message]:
    yield first
    yield from others


class Counter:
    """What is counted over the messages of one segment."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None  # initials of the outer messages
        self.low = self.high = None  # turns
        self.runs: list[tuple[int, int]] = []

    def add(self, m: Message) -> None:
        if not m.n:
            return
        self.blank += m.n * (m.kind == "b")
        self.duplicate += (m.n - 1) * (m.kind != "b") + (m.kind == "d")
        self.truncated += m.kind == "t"
        initial = m.role[:1]
        pair = lambda a: a is not None and a + initial not in ("su", "ua", "au")
        self.illegal += pair(self.last) + (m.n - 1) * pair(initial)
        self.first = initial if self.first is None else self.first
        self.last = initial
        if m.turn is not None:
            self.turns += m.turn != self.high
            self.low, self.high = m.turn if self.low is None else self.low, m.turn
        for sym, n in m.symbols():
            if n and self.runs and self.runs[-1][0] == sym:
                self.runs[-1] = sym, self.runs[-1][1] + n
            elif n:
                self.runs.append((sym, n))

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def counts(self) -> dict[str, int]:
        return {"gaps": self.gaps(), "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}

    def follow(self, other: Counter) -> None:
        """Takes in the counts of the segment behind this one; runs are left alone."""
        if other.first is None:
            return
        self.illegal += other.illegal + (self.last is not None and self.last + other.first not in ("su", "ua", "au"))
        self.first, self.last = other.first if self.first is None else self.first, other.last
        for name in ("blank", "duplicate", "truncated"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if other.low is not None:
            self.turns += other.turns - (other.low == self.high)
            self.low, self.high = other.low if self.low is None else self.low, other.high


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_KEPT = ("blank", "duplicate", "truncated", "illegal", "turns", "first", "last", "low", "high")


class Crossing(NamedTuple):
    """A segment of a conversation that lies in several partitions."""

    entry: int  # the state on entry
    behind: Vector  # the costs to the end behind it
    last: bool


ALONE = Crossing(0, END, True)


def _crossings(laid: DataFrame) -> tuple[dict[tuple[object, int], Crossing], dict[object, dict[str, int]]]:
    """The segments of crossing conversations, and each one's counts; at most one conversation a border between partitions."""
    key = F.struct(F.col("conv_id").isNotNull().alias("a"), F.col("conv_id").alias("b"))
    bounds = laid.groupBy("part").agg(F.min(key).alias("low"), F.max(key).alias("high")).orderBy("part").collect()
    parts: dict[object, list[int]] = {}
    for r in bounds:
        for conv in {r["low"]["b"], r["high"]["b"]}:
            parts.setdefault(conv, []).append(r["part"])
    parts = {conv: ps for conv, ps in parts.items() if len(ps) > 1}
    if not parts:
        return {}, {}
    across = {(conv, p) for conv, ps in parts.items() for p in ps}
    thin = laid.withColumn("text", F.lit(""))

    def per_segment(what) -> dict[tuple[object, int], object]:
        """``what`` of the messages of each crossing segment, computed where it lies."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for conv, part, mine in _segments(batches):
                if (conv, part) in across:
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((conv, part, what(conv, part, mine)))], pa.binary())], ["state"])
        rows = thin.mapInArrow(run, "state binary").collect()
        return {(conv, part): value for conv, part, value in (pickle.loads(r["state"]) for r in rows)}

    def measured(conv, part, mine):
        c = Counter()
        for m in mine:
            c.add(m)
        product, c.runs = matrix(c.runs), []
        return c, product

    found = per_segment(measured)
    behind, totals = {}, {}
    for conv, ps in parts.items():
        total, costs = Counter(), END
        for p in reversed(ps):
            behind[conv, p] = costs
            costs = _before(found[conv, p][1], costs)
        for p in ps:
            total.follow(found[conv, p][0])
        totals[conv] = {**total.counts(), "cost": costs[0]}

    def exits(conv, part, mine):
        """Where each state of entry leads."""
        runs, out = collapsed(x for m in mine for x in m.symbols()), []
        for q in range(4):
            for _, q in walk(runs, q, behind[conv, part]):  # noqa: B007, B020  the last state
                pass
            out.append(q)
        return out

    leads, crossings = per_segment(exits), {}
    for conv, ps in parts.items():
        q = 0
        for p in ps:
            crossings[conv, p] = Crossing(q, behind[conv, p], p == ps[-1])
            q = leads[conv, p][q]
    return crossings, totals


def edited(mine: list[Message], at: Crossing = ALONE) -> Iterator[tuple[str, str, str]]:
    """Edit, role and text of a segment's cheapest edits, in order; a deleted message comes as it was."""
    q, steps = at.entry, walk(collapsed(x for m in mine for x in m.symbols()), at.entry, at.behind)
    for m in mine:
        for _ in range(m.n):
            for x in next(steps)[0]:
                if x == "D":
                    yield x, m.role, m.text
                elif x == "K":
                    yield x, m.role, m.text
                    q = NEXT[q][m.role[0]]
                else:
                    role, q = PUT[q]
                    yield x, role, m.text if x == "R" else ""
    while at.last and q not in (0, 3):
        role, q = PUT[q]
        yield "I", role, ""


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about a million characters, 5,000 rows at most."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total > 1_000_000 or len(held) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _schema(rows: DataFrame, rest: str) -> T.StructType:
    return T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *T._parse_datatype_string(rest)])


def repaired(rows: DataFrame) -> DataFrame:
    """The edits of all messages (as ``damage`` or ``messages`` gives them): conv_id, part, place, edit, role, text.

    In order of (part, place) within a conversation; without the deleted ones this is the repaired conversation.
    """
    laid = _laid(_faults(rows))
    crossings, _ = _crossings(laid)
    schema = _schema(rows, "part int, place long, edit string, role string, text string")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((conv, part, i, *edit) for conv, part, mine in _segments(batches)
                 for i, edit in enumerate(edited(list(mine), crossings.get((conv, part), ALONE))))
        return _batches(found, arrow, lambda r: len(r[5]))

    return laid.mapInArrow(run, schema)


def audits(rows: DataFrame) -> DataFrame:
    """For each conversation its counts, cost, audit and the hash of the repaired ``role:text`` lines."""
    laid = _laid(_faults(rows))
    crossings, totals = _crossings(laid)
    schema = _schema(rows, ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string, part int, piece int, lines string")
    arrow = to_arrow_schema(schema)
    none = (None,) * len(COUNTS)

    def pieces(conv, part: int, mine: list[Message], at: Crossing) -> Iterator[tuple]:
        """A crossing segment's letters and lines, each with its line break before it, in small pieces."""
        i, letters, lines = 0, [], []
        for edit, role, text in edited(mine, at):
            letters.append(edit)
            if edit != "D":
                lines.append(f"\n{role}:{text}")
            if len(letters) >= 500:
                yield conv, *none, "".join(letters), None, part, i, "".join(lines)
                i, letters, lines = i + 1, [], []
        yield conv, *none, "".join(letters), None, part, i, "".join(lines)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for conv, part, mine in _segments(batches):
                mine = list(mine)
                if (conv, part) in crossings:
                    yield from pieces(conv, part, mine, crossings[conv, part])
                    continue
                c, letters, lines = Counter(), [], []
                for m in mine:
                    c.add(m)
                for edit, role, text in edited(mine):
                    letters.append(edit)
                    if edit != "D":
                        lines.append(f"{role}:{text}")
                cost, runs = END, c.runs
                for sym, n in reversed(runs):
                    cost = run_back(sym, n, cost)
                yield conv, *c.counts().values(), cost[0], "".join(letters), _sha("\n".join(lines)), part, None, None
        return _batches(found(), arrow, lambda r: len(r[-5]) + len(r[-1] or ""))

    wanted = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    out = stored(laid.mapInArrow(run, schema), "audits")
    if not crossings:
        return out.select(wanted)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pieces of a conversation, in order, as one row."""
        rows = (r for b in batches for r in zip(*[b[c].to_pylist() for c in ("conv_id", "audit", "lines")], strict=True))

        def found() -> Iterator[tuple]:
            for conv, mine in groupby(rows, key=lambda r: r[0]):
                letters, digest, begun = [], hashlib.sha256(), False
                for _, audit, lines in mine:
                    letters.append(audit)
                    digest.update(_bytes(lines if begun else lines[1:]))
                    begun = begun or bool(lines)
                yield conv, *[totals[conv][c] for c in COUNTS], "".join(letters), digest.hexdigest()
        return _batches(found(), pa.schema([arrow.field(c) for c in wanted]), lambda r: len(r[-2]))

    crossing = (out.filter("piece IS NOT NULL").repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece")
                .mapInArrow(joined, T.StructType([schema[c] for c in wanted])))
    return out.filter("piece IS NULL").select(wanted).unionByName(crossing)


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "replace")


def _sha(text: str) -> str:
    return hashlib.sha256(_bytes(text)).hexdigest()
