"""Conversation structure repair by a generalised LR automaton over role initials.

A repaired conversation reads ``(s?(ua)+)?``. Rows are read in order. The graph-structured stack
has one top for each state of the automaton; every action (keep, rerole, delete, insert) leads from
a top to another one, and equal tops merge to the one with the smaller (cost, audit). Equal tops
have equal futures, and no audit of equal cost and equally many rows is a prefix of another, so
merging loses no best repair.

A long conversation is read in pieces, each from all states at once: what a piece does is a table
of (cost, audit) by entry and exit state, and the tables of adjoining pieces are put together in
order. So no task reads a whole conversation to repair it. Only the hash of a conversation of
several pieces goes through its rows in one stream, because SHA-256 takes its bytes in order; the
stream holds one row and the audit at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from patronage.llm.common import store

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
ROLES = {"u": "user", "a": "assistant"}

#: States: nothing yet, after the system row, within a pair, after a pair. Shifts by initial.
START, SYSTEM, OPEN, CLOSED = range(4)
SHIFTS = {START: {"s": SYSTEM, "u": OPEN}, SYSTEM: {"u": OPEN}, OPEN: {"a": CLOSED}, CLOSED: {"u": OPEN}}
ACCEPTING = (START, CLOSED)
LEGAL_NEIGHBOURS = ("su", "ua", "au")

#: A piece ends at this many rows or code points; results do not depend on it.
PIECE_ROWS, PIECE_CHARS = 512, 1_000_000

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
_SEEN = re.compile(r"[^\x20\x09-\x0D]")


class Row(NamedTuple):
    turn: int | None
    role: str
    text: str
    fault: str | None


def fault_of(text: str, repeated: bool) -> str | None:
    """The first fault that a row has."""
    end = len(text.rstrip("\x20\t\n\v\f\r"))
    if not end:
        return BLANK
    if repeated:
        return DUPLICATE
    return None if text[end - 1] in ".!?" else TRUNCATED


Tops = dict[int, tuple[int, str]]


def _merge(tops: Tops, state: int, cost: int, audit: str) -> bool:
    if state in tops and tops[state] <= (cost, audit):
        return False
    tops[state] = (cost, audit)
    return True


def with_inserts(tops: Tops) -> Tops:
    """The tops and all that inserted rows lead to, until none gets better."""
    tops, todo = dict(tops), list(tops)
    while todo:
        state = todo.pop()
        cost, audit = tops[state]
        for initial, reached in SHIFTS[state].items():
            if initial in ROLES and _merge(tops, reached, cost + COST[INSERT], audit + INSERT):
                todo.append(reached)
    return tops


def after_row(tops: Tops, row: Row) -> Tops:
    """Tops behind a row, without inserts after it."""
    new: Tops = {}
    faulty = row.fault in (BLANK, DUPLICATE)
    stays = TRUNCATED_COST if row.fault == TRUNCATED else 0
    for state, (cost, audit) in tops.items():
        _merge(new, state, cost + COST[DELETE], audit + DELETE)
        if faulty:
            continue
        for initial, reached in SHIFTS[state].items():
            if row.role[:1] == initial:
                _merge(new, reached, cost + COST[KEEP] + stays, audit + KEEP)
            if initial in ROLES:
                _merge(new, reached, cost + COST[REROLE] + stays, audit + REROLE)
    return new


def tables_of(rows: Iterable[Row], entries: Iterable[int]) -> dict[int, Tops]:
    """For each entry state the tops behind all rows, inserts before every row included."""
    tables = {entry: {entry: (0, "")} for entry in entries}
    for row in rows:
        tables = {entry: after_row(with_inserts(tops), row) for entry, tops in tables.items()}
    return tables


def joined(tops: Tops, tables: dict[int, Tops]) -> Tops:
    """Tops behind a further piece."""
    new: Tops = {}
    for state, (cost, audit) in tops.items():
        for reached, (more, edits) in tables[state].items():
            _merge(new, reached, cost + more, audit + edits)
    return new


def best_end(tops: Tops) -> tuple[int, str]:
    ends = with_inserts(tops)
    return min(ends[state] for state in ACCEPTING if state in ends)


class Repairer:
    """Applies an audit to rows that come one by one; the state tells the role of what is new."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _new_role(self) -> str:
        initial = next(i for i in SHIFTS[self.state] if i in ROLES)
        self.state = SHIFTS[self.state][initial]
        return ROLES[initial]

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == INSERT:
            self.at += 1
            yield self._new_role(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == KEEP:
            self.state = SHIFTS[self.state][role[:1]]
            yield role, text
        elif edit == REROLE:
            yield self._new_role(), text


class RowHash:
    """SHA-256 of repaired rows as they come."""

    def __init__(self):
        self.digest, self.rows = hashlib.sha256(), 0

    def add(self, rows: Iterable[tuple[str, str]]) -> None:
        for role, text in rows:
            line = f"{role}:{text}".encode("utf-8", "replace")
            self.digest.update(b"\n" + line if self.rows else line)
            self.rows += 1

    def value(self) -> str:
        return self.digest.hexdigest()


def repaired_hash(rows: Iterable[Row], audit: str) -> str:
    repairer, digest = Repairer(audit), RowHash()
    for row in rows:
        digest.add(repairer.row(row.role, row.text))
    digest.add(repairer.inserted())
    return digest.value()


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` and ``copies`` of the damaged rows. Rows that
    agree in all columns are one with the number of their copies; dropped rows leave an empty row
    with no copies, so that their conversation is known.

    The remainder of crc32("<conv_id>:<turn>") by 20 drops the row (0), empties its text (1), takes
    away its ``.!?`` (2), repeats it (3) or sets its role to user (4). A null counts as one space,
    but a null conv_id or turn stays null in the result.
    """

    def or_space(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"), kind.alias("kind"))
    kind, text = F.col("kind"), F.col("text")
    rows = rows.select(
        "conv_id",
        F.when(kind != 0, F.col("turn")).alias("turn"),
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


def with_first(rows: DataFrame) -> DataFrame:
    """Adds ``first``: whether no row of an earlier turn has the same role and text.

    Earliest turns are aggregated by hashes of role and text and joined on the turn as well, so one
    text repeated all over a conversation is no hot key. A null turn is the earliest.
    """
    said = F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256)
    keyed = rows.withColumn("said", said)
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = keyed.groupBy("conv_id", "said").agg(F.min(turn).alias("at"))
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("said").alias("s"), F.col("at.turn").alias("t"), F.lit(True).alias("met"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("said") == F.col("s")) & F.col("turn").eqNullSafe(F.col("t"))
    first = F.coalesce("met", F.lit(False)).alias("first")
    return keyed.join(firsts, same, "left").select("conv_id", "turn", "role", "text", "copies", first)


_COUNTED = ("rows", BLANK, DUPLICATE, TRUNCATED, "illegal", "turns")
_PIECE = (
    "part int, number bigint, opens string, closes string, least bigint, most bigint, "
    + ", ".join(f"{name} bigint" for name in _COUNTED)
    + ", ways array<struct<entry: int, reached: int, cost: bigint, audit: string>>, hash string"
)
_REPAIRED = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, hash string"
_EMIT = 256


def _schema(rows: DataFrame, columns: str) -> StructType:
    """``conv_id`` of its own type, and further columns."""
    return StructType([StructField("conv_id", rows.schema["conv_id"].dataType), *StructType.fromDDL(columns).fields])


def summarise(rows: list[Row], from_start: bool, whole: bool) -> dict:
    """What a piece adds to its conversation; its hash, if it may be the ``whole`` of it."""
    initials = [row.role[:1] for row in rows]
    turns = [row.turn for row in rows if row.turn is not None]
    tables = tables_of(rows, (START,) if from_start else SHIFTS)
    return {
        "opens": initials[0] if rows else None,
        "closes": initials[-1] if rows else None,
        "least": turns[0] if turns else None,
        "most": turns[-1] if turns else None,
        "rows": len(rows),
        **{fault: sum(row.fault == fault for row in rows) for fault in (BLANK, DUPLICATE, TRUNCATED)},
        "illegal": sum(a + b not in LEGAL_NEIGHBOURS for a, b in zip(initials, initials[1:], strict=False)),
        "turns": len(set(turns)),
        "ways": [
            {"entry": entry, "reached": reached, "cost": cost, "audit": audit}
            for entry, tops in tables.items()
            for reached, (cost, audit) in tops.items()
        ],
        "hash": repaired_hash(rows, best_end(tables[START])[1]) if whole else None,
    }


def merged(a: dict, b: dict) -> dict:
    """Two adjoining pieces as one: ``tops`` of the first go on through the ways of the second."""
    tables: dict[int, Tops] = {}
    for way in b["ways"]:
        tables.setdefault(way["entry"], {})[way["reached"]] = (way["cost"], way["audit"])
    both = {name: a[name] + b[name] for name in _COUNTED}
    if a["closes"] is not None and b["opens"] is not None:
        both["illegal"] += a["closes"] + b["opens"] not in LEGAL_NEIGHBOURS
    if a["most"] is not None and a["most"] == b["least"]:
        both["turns"] -= 1
    return both | {
        "conv_id": a["conv_id"],
        "opens": a["opens"] if a["opens"] is not None else b["opens"],
        "closes": b["closes"] if b["closes"] is not None else a["closes"],
        "least": a["least"] if a["least"] is not None else b["least"],
        "most": b["most"] if b["most"] is not None else a["most"],
        "tops": joined(a["tops"], tables),
        "hash": None,
    }


def _started(piece: dict) -> dict:
    return piece | {"tops": {w["reached"]: (w["cost"], w["audit"]) for w in piece["ways"] if w["entry"] == START}}


def _finished(total: dict) -> dict:
    cost, audit = best_end(total["tops"])
    gaps = 0 if total["least"] is None else total["most"] - total["least"] + 1 - total["turns"]
    kept = {name: total[name] for name in ("conv_id", BLANK, DUPLICATE, TRUNCATED, "illegal", "hash")}
    return kept | {"gaps": gaps, "cost": cost, "audit": audit}


def _cut(schema: pa.Schema, piece_rows: int, piece_chars: int):
    """Summaries of pieces of one conversation each, from the sorted rows of a partition."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        held: list[Row] = []
        # the first conversation of a partition may have begun in the one before
        conv, seen, from_start, split, size, number = None, False, False, False, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if not seen or row["conv_id"] != conv:
                    if seen:
                        yield {"conv_id": conv, "part": part, "number": number} | summarise(held, from_start, not split)
                        number += 1
                    conv, from_start, split, held, size = row["conv_id"], seen, False, [], 0
                    seen = True
                for copy in range(row["copies"]):
                    if len(held) >= piece_rows or size >= piece_chars:
                        yield {"conv_id": conv, "part": part, "number": number} | summarise(held, from_start, False)
                        number += 1
                        from_start, split, held, size = False, True, [], 0
                    fault = fault_of(row["text"], copy > 0 or not row["first"])
                    held.append(Row(row["turn"], row["role"], row["text"], fault))
                    size += len(row["text"])
        if seen:
            yield {"conv_id": conv, "part": part, "number": number} | summarise(held, from_start, not split)

    return _in_batches(pieces, schema)


def _put_together(schema: pa.Schema):
    """One row for each conversation, from its pieces in order; one piece is held at a time."""

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total: dict | None = None
        for batch in batches:
            for piece in batch.to_pylist():
                if total is not None and total["conv_id"] == piece["conv_id"]:
                    total = merged(total, piece)
                    continue
                if total is not None:
                    yield _finished(total)
                total = _started(piece)
        if total is not None:
            yield _finished(total)

    return _in_batches(conversations, schema)


def _hash_in_order(schema: pa.Schema):
    """The repaired hash of each conversation from its audit, which comes first, and its rows."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        current: tuple | None = None

        def value() -> dict:
            conv, repairer, digest = current
            digest.add(repairer.inserted())
            return {"conv_id": conv, "hash": digest.value()}

        for batch in batches:
            for row in batch.to_pylist():
                if row["is_row"]:
                    for _ in range(row["copies"]):
                        current[2].add(current[1].row(row["role"], row["text"]))
                    continue
                if current:
                    yield value()
                current = (row["conv_id"], Repairer(row["text"]), RowHash())
        if current:
            yield value()

    return _in_batches(hashes, schema)


def _in_batches(rows, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        for row in rows(batches):
            done.append(row)
            if len(done) >= _EMIT:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        yield pa.RecordBatch.from_pylist(done, schema)

    return run


def repair(conversations: DataFrame, piece_rows: int = PIECE_ROWS, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``,
    ``audit`` and ``hash`` for each conversation in ``conversations`` (conv_id, turn, role, text,
    copies), as ``damage`` returns them.

    Rows go by turn (nulls first), then role and text. Rows without a conv_id are one conversation.
    A conversation without rows (no copies) has zeros, an empty audit and the hash of nothing; an
    empty table gives an empty one. A row costs one pass of the automaton, however long its text.
    A task that repairs holds one piece of at most ``piece_rows`` rows (a piece ends at
    ``piece_chars`` code points, so one very long text is a piece by itself). Conversations of
    several pieces are hashed in one stream each, as SHA-256 needs.
    """
    order = ("conv_id", "turn", "role", "text")
    rows, _ = store(with_first(conversations), "repair-rows")
    # the start of a text sorts as the text does, and keeps long texts out of the range bounds
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions(*order)
    piece = _schema(rows, _PIECE)
    pieces, _ = store(dealt.mapInArrow(_cut(to_arrow_schema(piece), piece_rows, piece_chars), piece), "repair-pieces")
    result = _schema(rows, _REPAIRED)
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number")
    found, _ = store(ordered.mapInArrow(_put_together(to_arrow_schema(result)), result), "repair-found")
    open_ends = found.where("hash is null")
    long = rows.join(open_ends.select("conv_id"), rows["conv_id"].eqNullSafe(open_ends["conv_id"]), "left_semi")
    audits = open_ends.select("conv_id", F.lit(False).alias("is_row"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
                              F.col("audit").alias("text"), F.lit(1).cast("long").alias("copies"))
    stream = audits.unionByName(long.select("conv_id", F.lit(True).alias("is_row"), "turn", "role", "text", "copies"))
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *order[1:])
    hashed = _schema(rows, "hash string")
    late = stream.mapInArrow(_hash_in_order(to_arrow_schema(hashed)), hashed)
    late = late.select(F.col("conv_id").alias("c"), F.col("hash").alias("late"))
    done = found.join(late, found["conv_id"].eqNullSafe(late["c"]), "left")
    columns = [F.col(c) for c in result.fieldNames() if c != "hash"]
    return done.select(*columns, F.coalesce("hash", "late").alias("hash"))
