"""Conversation structure repair: weighted interval parsing with a repair grammar in Chomsky normal form.

Role initials should read (s?(ua)+)?. The grammar's nonterminals are the pairs of states of that pattern: X(p, q) spans
rows that lead from p to q. X(p, q) -> X(p, r) X(r, q) joins two spans; a single row is kept, rerolled or deleted; and
insertion closure lets any span begin and end with inserted rows. A cell holds, for each nonterminal, the least
(cost, audit), audit being the initials of the edits: of two edit strings of a span that cost the same, none is the
beginning of the other (the longer one would have more insertions and cost more), so that least cells of two spans
give the least cell of both. As every nonterminal may be split anywhere, all ways to cut a span give the same cell;
so the chart is filled bottom-up by span length, 1, 2, 4 and so on, and not for all spans.

Rows are put in order of conversation, turn (nulls first), role and SHA-256 of the text, by ranges, so that a long
conversation lies on several tasks; each task parses its part of it, and parts are joined. Equal rows are counted
before they are ordered. Texts are read only to write the repaired conversation; its digest has to see them one after
the other, as a sorted stream.

Defined results: a null counts as one space, in the key of damage, too; a null conv_id is a conversation of its own; a
role without one of the initials s, u, a can't be kept, and breaks what is next to it; rows of one turn are ordered as
above; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.session import stage

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3

# States: nothing yet, after s, after u, after a.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {("s", BEGIN): SYSTEM, ("a", USER): ASSISTANT} | {("u", p): USER for p in (BEGIN, SYSTEM, ASSISTANT)}
ACCEPTED = (BEGIN, ASSISTANT)
LEGAL = {"su", "ua", "au"}

# What a row is: its initial, then "" for a sound one, "!" for a truncated one, "-" for one that has to go.
SOUND, TRUNCATED, GONE = "", "!", "-"

Cell = dict[tuple[int, int], tuple[int, str]]


def join(left: Cell, right: Cell) -> Cell:
    """The cell of a span from the cells of its two parts."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for (r2, q), (more, then) in right.items():
            if r == r2:
                found = (cost + more, audit + then)
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


def _closure() -> Cell:
    """The cell of no rows: nothing, or insertions of u and a."""
    closed: Cell = {(p, p): (0, "") for p in range(4)}
    single = closed | {(p, q): (INSERT, "I") for (c, p), q in STEPS.items() if c != "s"}
    while (further := join(closed, single)) != closed:
        closed = further
    return closed


EMPTY = _closure()


@lru_cache(None)
def _row(row: str) -> Cell:
    """The cell of one row: its edits, with insertions on both sides."""
    initial, state = row[0], row[1:]
    edits: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if state != GONE:
        more = CUT if state == TRUNCATED else 0
        for (c, p), q in STEPS.items():
            if c == initial:
                edits[p, q] = (KEEP + more, "K")
            elif c != "s":
                edits[p, q] = min(edits.get((p, q), (REROLE + more, "R")), (REROLE + more, "R"))
    return join(join(EMPTY, edits), EMPTY)


def times(cell: Cell, n: int) -> Cell:
    """The cell of n equal spans, by doubling."""
    out = EMPTY
    while n:
        if n & 1:
            out = join(out, cell)
        cell, n = join(cell, cell) if n > 1 else cell, n >> 1
    return out


# Short spans are parsed once for all conversations that have them.
SHORT = 8


@lru_cache(1 << 14)
def _short(rows: tuple[str, ...]) -> Cell:
    if len(rows) == 1:
        return _row(rows[0])
    half = 1 << (len(rows) - 1).bit_length() - 1
    return join(_short(rows[:half]), _short(rows[half:]))


@dataclass
class Span:
    """Consecutive rows of a conversation: cells of growing spans, and what is counted of the rows."""

    cells: list[tuple[int, Cell]] = field(default_factory=list)
    waiting: list[str] = field(default_factory=list)
    first: str | None = None
    last: str | None = None
    illegal: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    least_turn: int | None = None
    most_turn: int | None = None
    turns: int = 0

    def add(self, turn: int | None, initial: str, kind: str, copies: int) -> None:
        """A row and its copies, which are duplicates of it unless they are blank."""
        self._beside(initial, initial)
        self.illegal += (copies - 1) * (initial * 2 not in LEGAL)
        if kind == "blank":
            self.blank += copies
        else:
            self.duplicate += copies - 1 + (kind == "duplicate")
            self.truncated += kind == "truncated"
        if turn is not None and turn != self.most_turn:
            self.least_turn = turn if self.least_turn is None else self.least_turn
            self.most_turn = turn
            self.turns += 1
        self.waiting.append(initial + {"sound": SOUND, "truncated": TRUNCATED}.get(kind, GONE))
        if copies > 1:
            self._push(copies - 1, times(_row(initial + GONE), copies - 1))
        elif len(self.waiting) == SHORT:
            self._flush()

    def _beside(self, first: str, last: str) -> None:
        if self.last is not None:
            self.illegal += self.last + first not in LEGAL
        self.first = first if self.first is None else self.first
        self.last = last

    def _flush(self) -> None:
        if self.waiting:
            rows, self.waiting = tuple(self.waiting), []
            self._push(len(rows), _short(rows))

    def _push(self, length: int, cell: Cell) -> None:
        """Neighbouring spans are joined when the right one has grown to the length of the left one."""
        self._flush()
        self.cells.append((length, cell))
        while len(self.cells) > 1 and self.cells[-1][0] >= self.cells[-2][0]:
            (n, left), (m, right) = self.cells[-2:]
            self.cells[-2:] = [(n + m, join(left, right))]

    def cell(self) -> tuple[int, Cell]:
        self._flush()
        length, out = 0, EMPTY
        for n, right in reversed(self.cells):
            length, out = length + n, join(right, out) if length else right
        return length, out

    def after(self, other: Span) -> None:
        """The rows that follow these."""
        self._beside(other.first, other.last)
        self.illegal += other.illegal
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.turns += other.turns - (other.turns > 0 and other.least_turn == self.most_turn)
        self.least_turn = other.least_turn if self.least_turn is None else self.least_turn
        self.most_turn = self.most_turn if other.most_turn is None else other.most_turn
        self._push(*other.cell())

    def result(self) -> dict:
        _, cell = self.cell()
        cost, audit = min(cell[BEGIN, q] for q in ACCEPTED if (BEGIN, q) in cell)
        gaps = 0 if self.least_turn is None else self.most_turn - self.least_turn + 1 - self.turns
        counts = {name: getattr(self, name) for name in ("blank", "duplicate", "truncated", "illegal")}
        return {"gaps": gaps} | counts | {"cost": cost, "audit": audit}


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows are dropped, emptied, cut, repeated or given another role by a hash."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.where("fault <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).cast("bigint").alias("copies"),
    )


def _as_is(conversations: DataFrame) -> DataFrame:
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select("conv_id", "turn", name("role"), name("text"), F.lit(1).cast("bigint").alias("copies"))


def _blank(text: Column) -> Column:
    return ~F.rlike(text, F.lit(r"[^\x20\x09-\x0D]"))


def _whole(text: Column) -> Column:
    return F.rlike(text, F.lit(r"[.!?][\x20\x09-\x0D]*\z"))


ORDER = ["conv_id", "turn", "role", "digest"]


def classified(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, copies, kind): one row for equal rows; kind is the first fault of the first copy."""
    text = F.col("text")
    kind = F.when(_blank(text), "blank").when(_whole(text), "sound").otherwise("truncated")
    narrow = rows.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "copies", kind.alias("kind"))
    equal = narrow.groupBy(ORDER).agg(F.sum("copies").alias("copies"), F.min("kind").alias("kind"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    seen = equal.groupBy("conv_id", "role", "digest").agg(F.min(turn)["turn"].alias("turn"))
    seen = seen.select(*[F.col(c).alias(f"seen_{c}") for c in ORDER])
    # both sides hold a key once: no key is hot
    same = [F.col(c).eqNullSafe(F.col(f"seen_{c}")) for c in ORDER]
    first = F.col("seen_digest").isNotNull()
    return equal.join(seen, same, "left").select(
        *ORDER, "copies", F.when(first | (F.col("kind") == "blank"), F.col("kind")).otherwise("duplicate").alias("kind")
    )


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
_INNER = ["first", "last", "illegal", "blank", "duplicate", "truncated", "least_turn", "most_turn", "turns"]
_LISTS = {"froms": pa.list_(pa.int32()), "tos": pa.list_(pa.int32()), "costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string())}
_TYPES = {name: pa.int64() for name in [*COUNTS, "part", *_INNER, "length"]}
_TYPES |= {"audit": pa.string(), "first": pa.string(), "last": pa.string()} | _LISTS
_SQL = {pa.int64(): "bigint", pa.string(): "string", _LISTS["froms"]: "array<int>", _LISTS["costs"]: "array<bigint>"}
_SCHEMA = ", ".join(f"{name} {_SQL.get(kind, 'array<string>')}" for name, kind in _TYPES.items())


def _part(number: int, span: Span) -> dict:
    """A span that may go on in another task."""
    length, cell = span.cell()
    lists = zip(*[(p, q, cost, audit) for (p, q), (cost, audit) in cell.items()])
    inner = {name: getattr(span, name) for name in _INNER}
    return {"part": number, "length": length} | inner | dict(zip(_LISTS, map(list, lists)))


def _span(part: dict) -> Span:
    cell = {(p, q): (cost, audit) for p, q, cost, audit in zip(*[part[name] for name in _LISTS])}
    return Span(cells=[(part["length"], cell)], **{name: part[name] for name in _INNER})


def parsed(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation that has rows."""
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("?")
    ordered = classified(rows).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    ordered = ordered.select("conv_id", F.col("turn").cast("bigint").alias("turn"), initial.alias("initial"), "kind", "copies")
    key = ordered.schema["conv_id"].dataType.simpleString()

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Conversations inside the task are done; of its first and its last one, parts are handed on."""
        number, current, span, opened = TaskContext.get().partitionId(), None, None, 0
        ended: list[tuple[object, dict]] = []
        kind = pa.null()

        def out() -> pa.RecordBatch:
            columns = [pa.array([c for c, _ in ended], kind)]
            columns += [pa.array([r.get(name) for _, r in ended], t) for name, t in _TYPES.items()]
            ended.clear()
            return pa.record_batch(columns, ["conv_id", *_TYPES])

        for batch in batches:
            kind = batch["conv_id"].type
            columns = [batch[c].to_pylist() for c in ("conv_id", "turn", "initial", "kind", "copies")]
            for conv, *row in zip(*columns):
                if span is None or conv != current:
                    if span is not None:
                        ended.append((current, _part(number, span) if opened == 1 else span.result()))
                    current, span, opened = conv, Span(), opened + 1
                span.add(*row)
            if ended:
                yield out()
        if span is not None:
            ended.append((current, _part(number, span)))
            yield out()

    def joined(parts: pa.Table) -> pa.Table:
        rows = sorted(parts.to_pylist(), key=lambda r: r["part"])
        whole = _span(rows[0])
        for row in rows[1:]:
            whole.after(_span(row))
        result = whole.result()
        columns = [parts["conv_id"].combine_chunks()[:1], *[pa.array([result[c]], _TYPES[c]) for c in COUNTS]]
        return pa.table(columns, names=["conv_id", *COUNTS])

    found = stage(ordered.mapInArrow(spans, f"conv_id {key}, {_SCHEMA}"), "spans")
    counts = ", ".join(f"{name} {_SQL[_TYPES[name]]}" for name in COUNTS)
    # two parts a task at most
    parts = found.where(F.col("part").isNotNull()).groupBy("conv_id").applyInArrow(joined, f"conv_id {key}, {counts}")
    return found.where(F.col("part").isNull()).select("conv_id", *COUNTS).unionByName(parts)


def _edited(audit: str, rows: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str]]:
    """The repaired (role, text) of a conversation, from its edits and its ordered rows with their copies."""
    edits, before = iter(audit), None

    def next_role() -> str:
        return "assistant" if before == "user" else "user"

    edit = next(edits, None)
    for role, text, copies in rows:
        for _ in range(copies):
            while edit == "I":
                yield (role_ := next_role(), "")
                before, edit = role_, next(edits, None)
            if edit != "D":
                role_ = role if edit == "K" else next_role()
                yield role_, text
                before = {"s": "system", "u": "user", "a": "assistant"}[role_[0]]
            edit = next(edits, None)
    while edit == "I":
        yield (role_ := next_role(), "")
        before, edit = role_, next(edits, None)


_STREAM = ["conv_id", "step", "turn", "role", "digest", "text", "copies", *COUNTS]
NOTHING = dict.fromkeys(COUNTS, 0) | {"audit": ""}


def _streamed(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """For each conversation its id, its result if it has rows, and its rows in order: one sorted stream."""
    marks = conversations.select("conv_id").distinct().withColumn("step", F.lit(0))
    results = parsed(rows).withColumn("step", F.lit(1))
    texts = rows.withColumns({"digest": F.unhex(F.sha2("text", 256)), "step": F.lit(2)})
    all_ = marks.unionByName(results, allowMissingColumns=True).unionByName(texts, allowMissingColumns=True)
    return all_.select(_STREAM).repartition("conv_id").sortWithinPartitions("conv_id", "step", "turn", "role", "digest")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, pa.DataType, dict, Iterator]]:
    """(conv_id, its type, result, rows) of each conversation; its rows are read before the next one is asked for."""

    def flat():
        for batch in batches:
            kind, columns = batch["conv_id"].type, [batch[c] for c in _STREAM]
            for i in range(len(batch)):
                yield kind, columns, i

    rows, ahead = flat(), None

    def following():
        nonlocal ahead
        ahead = next(rows, None)
        return ahead

    def of(names: list[str]) -> list:
        _, columns, i = ahead
        return [columns[_STREAM.index(name)][i].as_py() for name in names]

    following()
    while ahead:
        (conv,), kind, result = of(["conv_id"]), ahead[0], NOTHING
        following()
        if ahead and of(["step"]) == [1]:
            result = dict(zip(COUNTS, of(COUNTS)))
            following()

        def own():
            while ahead and of(["step"]) == [2]:
                yield tuple(of(["role", "text", "copies"]))
                following()

        yield conv, kind, result, own()


def repaired(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, role, text): the repaired rows of all conversations, positions from 0."""
    stream = _streamed(conversations, _as_is(conversations))
    key = stream.schema["conv_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "position", "role", "text"]
        for conv, kind, result, own in _conversations(batches):
            held: list[tuple] = []
            for position, (role, text) in enumerate(_edited(result["audit"], own)):
                held.append((position, role, text))
                if len(held) == 1000:
                    yield _batch(conv, kind, held, names)
                    held = []
            if held:
                yield _batch(conv, kind, held, names)

    return stream.mapInArrow(rows, f"conv_id {key}, position bigint, role string, text string")


def _batch(conv: object, kind: pa.DataType, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([conv] * len(rows), kind), *[pa.array(c) for c in zip(*rows)]], names)


def report(conversations: DataFrame) -> DataFrame:
    """conv_id, the counts of faults, cost, audit and repaired_sha256 of each conversation, after it was damaged."""
    stream = _streamed(conversations, damaged(conversations))
    key = stream.schema["conv_id"].dataType.simpleString()
    counts = ", ".join(f"{name} {_SQL[_TYPES[name]]}" for name in COUNTS)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        kind = pa.null()

        def out() -> pa.RecordBatch:
            types = [kind, *[_TYPES[c] for c in COUNTS], pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*held), types)]
            held.clear()
            return pa.record_batch(columns, ["conv_id", *COUNTS, "repaired_sha256"])

        for conv, kind, result, own in _conversations(batches):
            digest = hashlib.sha256()
            for i, (role, text) in enumerate(_edited(result["audit"], own)):
                digest.update(("\n" * (i > 0) + role + ":").encode())
                digest.update(text.encode())
            held.append((conv, *[result[c] for c in COUNTS], digest.hexdigest()))
            if len(held) == 1000:
                yield out()
        if held:
            yield out()

    return stream.mapInArrow(digests, f"conv_id {key}, {counts}, repaired_sha256 string")
