"""Repair of the role order of conversations by generalised LR parsing (operator 13).

A conversation is an optional system row and then turns of a user row and an assistant row, or nothing. Its rows are the
input of an LR parser over that grammar which may, besides shifting a row as it is (keep), shift it under another role
(rerole), skip it (delete) or shift a row that is not there (insert), each at a cost. All ways are followed at once in a
graph-structured stack; where two ways come to the same state on top, what can follow is the same, and only the one with
the smaller (cost, audit) stays, the audit being the edits' initials. So there are at most as many tops as the table has
states, a row takes a constant number of steps, and the way that is left at the end is the cheapest, ties going to the
least audit. Each top carries the digest, or the rows, of what it has repaired so far, so that a conversation is read once,
in order, whatever its length: a task holds a few states and their audits, never a conversation's rows. (The digest of one
conversation is a chain from its first row to its last, so its rows pass through one task; they are not held there.)

Faults of single rows are found before, with built-in functions: a blank row; a row whose role and text were seen earlier
(the first turn of each text is found by an aggregation, so equal rows of a large conversation collapse before they
move); a row that ends in the middle of a sentence. Blank and duplicate rows can only be deleted.

Rows are ordered by turn, nulls first, then by role and text. A null role or text counts as one space, also in the key of
the damage; rows with a null conversation are one conversation. A role that does not begin with s, u or a can be reroled or
deleted but not kept. A conversation without rows after the damage is repaired as it is, empty. Long texts stay whole, an
empty table gives an empty result, extra columns are left behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from millrace.llm.common import ship, written

#: conversation -> (nothing) | turns | s turns;  turns -> pair | turns pair;  pair -> u a
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (5, "u"): 2, (2, "a"): 6}
#: state -> (symbol, length of its rule); these states reduce at once, the grammar needs no look-ahead for them
REDUCE = {4: ("turns", 1), 6: ("pair", 2), 7: ("turns", 2)}
GOTO = {(0, "turns"): 3, (0, "pair"): 4, (1, "turns"): 5, (1, "pair"): 4, (3, "pair"): 7, (5, "pair"): 7}
ACCEPT = (0, 3, 5)
ROLES = {"u": "user", "a": "assistant"}

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANK_ROW, DUPLICATE_ROW, TRUNCATED_ROW = 1, 2, 3
#: Letters of an audit in one piece.
TRAIL_LETTERS = 256


@dataclass(frozen=True, slots=True)
class Node:
    """A state on the stack and the node below it."""

    state: int
    below: Node | None

    def shift(self, symbol: str) -> Node | None:
        """The stack after a symbol and the reductions it allows; None if it does not fit."""
        if (to := SHIFT.get((self.state, symbol))) is None:
            return None
        top = Node(to, self)
        while top.state in REDUCE:
            name, size = REDUCE[top.state]
            for _ in range(size):
                top = top.below
            top = Node(GOTO[top.state, name], top)
        return top


class Trail:
    """Letters of an audit; ways that part share what they have in common."""

    __slots__ = ("before", "tail")

    def __init__(self, tail: str = "", before: Trail | None = None):
        self.tail, self.before = tail, before

    def plus(self, letter: str) -> Trail:
        return Trail(self.tail + letter, self.before) if len(self.tail) < TRAIL_LETTERS else Trail(letter, self)

    def result(self) -> str:
        out, at = [], self
        while at is not None:
            out.append(at.tail)
            at = at.before
        return "".join(reversed(out))


@dataclass(slots=True)
class Top:
    """One way through the rows so far. `order` compares audits: the place among all tops when the last row was done, and
    the letters since. The edit itself is made only if the way stays."""

    cost: int
    order: tuple[int, str]
    stack: Node
    parent: Top | None = None
    letter: str = ""
    row: bytes | None = None
    made: object = None
    trail: Trail | None = None

    def then(self, letter: str, cost: int, stack: Node, row: bytes | None = None) -> Top:
        return Top(self.cost + cost, (self.order[0], self.order[1] + letter), stack, self, letter, row)


class Digest:
    """Repaired rows as the SHA-256 of `role:text` joined by newlines."""

    def __init__(self):
        self.hash, self.empty = hashlib.sha256(), True

    def plus(self, row: bytes) -> Digest:
        out = Digest.__new__(Digest)
        out.hash, out.empty = self.hash.copy(), False
        out.hash.update(row if self.empty else b"\n" + row)
        return out

    def result(self):
        return self.hash.hexdigest()


class Rows:
    """Repaired rows as such, each linked to the one before."""

    def __init__(self, row: bytes | None = None, before: Rows | None = None):
        self.row, self.before = row, before

    def plus(self, row: bytes) -> Rows:
        return Rows(row, self)

    def result(self):
        out, at = [], self
        while at.before is not None:
            out.append(at.row.decode())
            at = at.before
        return out[::-1]


class Repair:
    """The graph-structured stack of one conversation."""

    def __init__(self, made):
        self.tops = self._closed({0: Top(0, (0, ""), Node(0, None), made=made, trail=Trail())})

    @staticmethod
    def _put(tops: dict[int, Top], top: Top) -> bool:
        """Merges a top with an equal one: the smaller (cost, audit) stays."""
        held = tops.get(top.stack.state)
        if held is not None and (held.cost, held.order) <= (top.cost, top.order):
            return False
        tops[top.stack.state] = top
        return True

    def _closed(self, tops: dict[int, Top]) -> dict[int, Top]:
        """The tops with all rows inserted that help, and their edits made.

        Audits that end with a row's letter are never the beginning of one another, so their places decide from here on.
        """
        for place, top in enumerate(sorted(tops.values(), key=lambda t: t.order)):
            top.order = (place, "")
        todo = sorted(tops.values(), key=lambda t: t.cost)
        while todo:
            top = todo.pop(0)
            if tops.get(top.stack.state) is not top:
                continue
            for symbol, role in ROLES.items():
                if (stack := top.stack.shift(symbol)) is not None:
                    new = top.then("I", INSERT, stack, f"{role}:".encode())
                    if self._put(tops, new):
                        todo.append(new)
        for top in tops.values():
            self._make(top)
        return tops

    def _make(self, top: Top) -> Top:
        if top.trail is None:
            before = self._make(top.parent)
            top.made = before.made if top.row is None else before.made.plus(top.row)
            top.trail = before.trail.plus(top.letter)
        top.parent = None
        return top

    def append(self, role: str, text: str, fault: int) -> None:
        tops: dict[int, Top] = {}
        extra = TRUNCATED if fault == TRUNCATED_ROW else 0
        for top in self.tops.values():
            self._put(tops, top.then("D", DELETE, top.stack))
            if fault in (BLANK_ROW, DUPLICATE_ROW):
                continue
            if (stack := top.stack.shift(role[:1])) is not None:
                self._put(tops, top.then("K", extra, stack, f"{role}:{text}".encode()))
            for symbol, name in ROLES.items():
                if (stack := top.stack.shift(symbol)) is not None:
                    self._put(tops, top.then("R", REROLE + extra, stack, f"{name}:{text}".encode()))
        self.tops = self._closed(tops)

    def best(self) -> tuple[int, str, object]:
        """(cost, audit, repaired rows) of the cheapest way."""
        top = min((self.tops[s] for s in ACCEPT if s in self.tops), key=lambda t: (t.cost, t.order))
        return top.cost, top.trail.result(), top.made.result()


@dataclass(slots=True)
class Conversation:
    """What is counted while the rows of one conversation pass."""

    key: int | None
    repair: Repair
    counts: list[int] = field(default_factory=lambda: [0, 0, 0, 0])
    low: int | None = None
    high: int | None = None
    turns: int = 0
    illegal: int = 0
    last: str | None = None

    def append(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        self.counts[fault] += 1
        self.illegal += self.last is not None and self.last + role[:1] not in ("su", "ua", "au")
        self.last = role[:1]
        self.repair.append(role, text, fault)

    def row(self) -> dict:
        cost, audit, made = self.repair.best()
        out = {"conv_id": self.key, "gaps": self.high - self.low + 1 - self.turns if self.turns else 0}
        out |= {"blank": self.counts[BLANK_ROW], "duplicate": self.counts[DUPLICATE_ROW], "truncated": self.counts[TRUNCATED_ROW]}
        return out | {"illegal": self.illegal, "cost": cost, "audit": audit, "repaired": made}


def _null_as_space(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(" "))


def rows_of(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), null roles and texts as one space."""
    return df.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _null_as_space("role").alias("role"),
        _null_as_space("text").alias("text"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults put in by a checksum of conversation and turn; `gone` marks those that are dropped."""
    kind = F.pmod(F.crc32(F.concat_ws(":", _null_as_space("conv_id"), _null_as_space("turn")).cast("binary")), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.when(kind == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("n"), (kind == 0).alias("gone"))


def faults(rows: DataFrame) -> DataFrame:
    """Equal rows (of `n` copies each) as one, with the fault of its first copy and whether more copies follow."""
    once = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    # what is left when white space goes; only the ends matter
    bare = F.rtrim(F.translate("text", "\t\n\v\f\r", "     "))
    end = F.substring(bare, -1, 1)
    marked = once.withColumns({"blank": bare == "", "ended": end.isin(".", "!", "?"), "content": F.sha2("text", 256)})
    whole = marked.where("NOT blank")
    known = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    least = whole.groupBy(F.col("conv_id").alias("of"), F.col("role").alias("by"), F.col("content").alias("what")).agg(F.min(known).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("role") == F.col("by")) & (F.col("content") == F.col("what"))
    seen = ~F.col("turn").eqNullSafe(F.col("first.turn"))
    fault = F.when(F.col("blank"), BLANK_ROW).when(seen, DUPLICATE_ROW).when(~F.col("ended"), TRUNCATED_ROW).otherwise(0)
    return marked.join(least, same, "left").select("conv_id", "turn", "role", "text", "n", fault.alias("fault"))


def repaired(rows: DataFrame, made=Rows) -> DataFrame:
    """A row for each conversation of `rows` (conv_id, turn, role, text, n): its faults, the cheapest repair, and its rows."""
    ship(rows.sparkSession)
    kind = pa.string() if made is Digest else pa.list_(pa.string())
    numbers = [(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    schema = pa.schema([*numbers, ("audit", pa.string()), ("repaired", kind)])

    def run(batches):
        out: list[dict] = []
        now: Conversation | None = None
        for conv, turn, role, text, n, fault in _each(batches):
            if now is None or now.key != conv:
                if now is not None:
                    out.append(now.row())
                now = Conversation(conv, Repair(made()))
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
            now.append(turn, role, text, fault)
            for _ in range(n - 1):  # a blank row stays blank; a copy of any other is a duplicate
                now.append(turn, role, text, fault if fault == BLANK_ROW else DUPLICATE_ROW)
        if now is not None:
            out.append(now.row())
        yield pa.RecordBatch.from_pylist(out, schema=schema)

    in_order = faults(rows).repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text")
    return in_order.mapInArrow(run, from_arrow_schema(schema))


def _each(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "fault")), strict=True)


def repair(df: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired): `repaired` is the list of `role:text`."""
    return repaired(rows_of(df).withColumn("n", F.lit(1)))


def repair_digests(df: DataFrame) -> DataFrame:
    """The repair of damaged conversations, a row for each original one, its rows as a digest."""
    rows = written(damaged(rows_of(df)), "damaged")
    found = repaired(rows.where("NOT gone").drop("gone"), Digest).withColumnRenamed("repaired", "repaired_sha256")
    empty = rows.groupBy("conv_id").agg(F.min("gone").alias("gone")).where("gone").select("conv_id")
    zero = [F.lit(0).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit("").cast("binary"), 256).alias("repaired_sha256")
    return found.union(empty.select("conv_id", *zero, F.lit("").alias("audit"), nothing))
