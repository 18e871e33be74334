"""Conversation repair: turns are aligned to the strings of an alternating grammar, the cheapest edits are the audit."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.llm.shared import quoted, written
from receiptflow.session import ship_package

_INITIALS = "sua"
_TRUNCATED, _GONE = 4, 8
_DELETE, _CHANGE = 3, 2
_FAR = 1 << 29
#: Where a conversation stands: before its first turn, or after a turn of the system, the user, the assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: What it costs to end in each place: only nothing and whole exchanges are strings of the grammar ``(s?(ua)+)?``.
_END = (0, _FAR, _FAR, 0)
#: Turns in a table. Longer conversations are cut, and the tables joined by what the rest costs from each place.
_BLOCK = 512
_STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


class _Table:
    """Wagner-Fischer table of turns against the target that goes on from ``entry``, in Ukkonen's band.

    ``cell(i, j)`` is the least cost of the turns from ``i`` on when ``j`` letters of the target are there, over all
    feasible lengths at once: the targets of all lengths are beginnings of one string, and ``end`` says what it costs to
    stop after a letter. An insertion costs 2 and a deletion 3, so alignments within ``limit`` stay between the diagonals
    ``-limit / 3`` and ``limit / 2``, and only these are stored.
    """

    def __init__(self, codes: bytes, entry: int, system_first: bool, end: tuple[int, ...], limit: int):
        n = len(codes)
        self.up, self.down = limit // _CHANGE, limit // _DELETE
        width = self.up + self.down + 1
        place, target = entry, []
        for j in range(n + self.up + 1):
            place = SYSTEM if system_first and j == 0 else _NEXT[place]
            target.append(place)
        self.places = [entry, *target]  # where one is after j letters
        self.target = np.array(target)
        self.cells = np.full((n + 1, width), _FAR, np.int64)
        slope = _CHANGE * np.arange(width)
        letters = np.concatenate([np.zeros(self.down, np.int64), self.target])  # [i + b]: the letter wanted in column b
        after = np.concatenate([np.full(self.down, _FAR), np.array([end[p] for p in self.places])])
        for i in range(n, -1, -1):
            row = self.cells[i]
            if i == n:
                row[:] = after[i : i + width]
            else:
                below = self.cells[i + 1]
                row[1:] = below[:-1] + _DELETE
                code = codes[i]
                if not code & _GONE:
                    want = letters[i : i + width]
                    change = np.where(want == (code & 3) + 1, 0, np.where(want >= USER, _CHANGE, _FAR))
                    np.minimum(row, below + change + bool(code & _TRUNCATED), out=row)
                row[: max(0, self.down - i)] = _FAR  # before the target begins
            alone = row.copy() if system_first and i <= self.down else None
            row += slope  # insertions: a minimum over all cells to the right, two for each step
            row[:] = np.minimum.accumulate(row[::-1])[::-1]
            row -= slope
            if alone is not None:  # a turn of the system is never inserted
                row[self.down - i] = alone[self.down - i]
            np.minimum(row, _FAR, out=row)

    def cell(self, i: int, j: int) -> int:
        b = j - i + self.down
        return int(self.cells[i, b]) if 0 <= b <= self.up + self.down and j >= 0 else _FAR


def _some_cost(codes: bytes, entry: int, end: tuple[int, ...]) -> int:
    """The cost of edits that do, taken turn by turn: the first incumbent."""
    place, cost = entry, 0
    for code in codes:
        if code & _GONE:
            cost += _DELETE
            continue
        own, want = (code & 3) + 1, _NEXT[place]
        if own == SYSTEM and place == START:
            want = SYSTEM
        elif own != want:
            cost += _CHANGE  # a missing turn is put in, or a turn of another role takes the role
            want = own if own in (USER, ASSISTANT) else want
        place = want
        cost += bool(code & _TRUNCATED)
    rest = end[place]
    for k in (1, 2):
        place = _NEXT[place]
        rest = min(rest, k * _CHANGE + end[place])
    return cost + rest


def _tables(codes: bytes, entries: list[int], end: tuple[int, ...]) -> list[_Table]:
    """A table for each target, each within the cost of the best found before it; those of greater cost go."""
    limit = min(_some_cost(codes, entry, end) for entry in entries)
    tables = []
    for entry in entries:
        for system_first in (False, True) if entry == START else (False,):
            tables.append(_Table(codes, entry, system_first, end, limit))
            limit = min(limit, tables[-1].cell(0, 0))
    return [t for t in tables if t.cell(0, 0) == limit]


def _audit(codes: bytes, tables: list[_Table], end: tuple[int, ...], last: bool) -> tuple[str, list[int]]:
    """The least of the cheapest audits of all tables, traced in all at once, and where it may end.

    The letters so far say how many turns and letters of the target are behind, so every table is at the same cell, and
    those in which the least letter is not on a cheapest way drop out.
    """
    n, i, j, rest, out = len(codes), 0, 0, tables[0].cell(0, 0), []
    while True:
        if i == n:
            ended = [t for t in tables if end[t.places[j]] == rest]
            if ended or not last:
                return "".join(out), sorted({t.places[j] for t in ended})
        code = codes[i] if i < n else _GONE
        cut = bool(code & _TRUNCATED)
        for letter in "DIKR":
            if letter == "D":
                went, cost = (i + 1, j), _DELETE
                fit = tables if i < n else []
            elif letter == "I":
                went, cost = (i, j + 1), _CHANGE
                fit = [t for t in tables if t.target[j] != SYSTEM]
            elif letter == "K":
                went, cost = (i + 1, j + 1), cut
                fit = [t for t in tables if t.target[j] == (code & 3) + 1] if not code & _GONE else []
            else:
                went, cost = (i + 1, j + 1), _CHANGE + cut
                fit = [t for t in tables if t.target[j] != SYSTEM] if not code & _GONE else []
            fit = [t for t in fit if t.cell(*went) + cost == rest]
            if fit:
                break
        else:
            raise AssertionError("no cheapest edit leads on")
        out.append(letter)
        (i, j), rest, tables = went, rest - cost, fit


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and audit of the cheapest edits, the least audit in ASCII order where several cost the same.

    A byte for each turn: 0, 1, 2 for a role that begins with s, u, a, 3 for another, plus 4 if the text is truncated,
    plus 8 if the turn has to go. Time is turns times the band, which ``_BLOCK`` bounds for conversations of any length.
    """
    parts = [codes[k : k + _BLOCK] for k in range(0, len(codes), _BLOCK)] or [b""]
    ends = [_END]
    for part in parts[:0:-1]:
        ends.append(tuple(_tables(part, [p], ends[-1])[0].cell(0, 0) for p in range(4)))
    places, cost, audit = [START], None, []
    for part, end in zip(parts, reversed(ends), strict=True):
        tables = _tables(part, places, end)
        cost = tables[0].cell(0, 0) if cost is None else cost
        letters, places = _audit(part, tables, end, end is _END)
        audit.append(letters)
    return cost, "".join(audit)


_short_edits = lru_cache(1 << 16)(cheapest_edits)


def _marked(turns: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """Turns under plain names with their text's digest and what is wrong with it."""
    text, role = (F.coalesce(c.cast("string"), F.lit(" ")) for c in (text, role))
    out = turns.select(conv.alias("conv"), turn.cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    return out.withColumns(
        {
            "digest": F.unhex(F.sha2("text", 256)),
            "blank": ~F.col("text").rlike(r"[^\x20\x09-\x0D]"),
            "cut": ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"),
        }
    )


def _in_order(rows: DataFrame, *more: str) -> DataFrame:
    """Whole conversations in each partition, their rows in order."""
    order = ["conv", *more, F.col("turn").asc_nulls_first(), "role", "digest"]
    return rows.repartition("conv").sortWithinPartitions(*order)


def _audited(rows: DataFrame) -> DataFrame:
    """(conv, stats) of each conversation of ``_marked`` rows, without their texts.

    Equal rows of a turn are counted where they are read, and the first turn of each role and text is a grouped minimum,
    so repeated turns are known without a conversation's texts in a task; what is left streams through in order, a byte
    a turn.
    """
    key = ["conv", "role", "digest"]
    lean = rows.groupBy(*key, "turn").agg(F.count(F.lit(1)).alias("n"), F.max("blank").alias("blank"), F.max("cut").alias("cut"))
    place = F.struct(F.col("turn").isNotNull(), "turn")
    firsts = lean.groupBy(*key).agg(F.min(place).alias("first"))
    firsts = firsts.select(*[F.col(k).alias(f"{k}_1") for k in key], "first")
    same = [F.col(k).eqNullSafe(F.col(f"{k}_1")) for k in key]
    lean = lean.join(firsts, same, "left").withColumn("early", place == F.col("first"))
    lean = lean.select("conv", "turn", "role", "digest", "n", "blank", "cut", "early")
    kind = rows.schema["conv"].dataType
    schema = T.StructType([T.StructField("conv", kind), *T.StructType.fromDDL(_STATS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        one = None

        def flush() -> Iterator[pa.RecordBatch]:
            if done:
                columns = list(zip(*done, strict=True))
                types = [id_type, *[pa.int64()] * 6, pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.fieldNames())
                done.clear()

        for batch in batches:
            id_type = batch.schema.field("conv").type
            for conv, turn, role, n, blank, cut, early in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "role", "n", "blank", "cut", "early")], strict=True):
                if one is None or conv != one.conv:
                    if one is not None:
                        done.append(one.row())
                    one = _Conversation(conv)
                one.add(turn, role, n, blank, cut, early)
            if len(done) >= 1000:
                yield from flush()
        if one is not None:
            done.append(one.row())
        yield from flush()

    return _in_order(lean).mapInArrow(run, schema)


class _Conversation:
    def __init__(self, conv):
        self.conv, self.codes, self.before, self.turn, self.first = conv, bytearray(), None, None, None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, n: int, blank: bool, cut: bool, early: bool) -> None:
        """``n`` equal rows of a turn; ``early``: none like them in a turn before."""
        if turn is not None and (self.first is None or turn != self.turn):
            self.turns += 1
            self.turn, self.first = turn, turn if self.first is None else self.first
        initial = role[:1]
        self.illegal += len(self.codes) > 0 and self.before + initial not in ("su", "ua", "au")
        self.illegal += n - 1  # no role may follow itself
        self.before = initial
        code = _INITIALS.index(initial) if initial and initial in _INITIALS else 3
        fresh = 0 if blank else int(early)
        self.blank += n if blank else 0
        self.duplicate += 0 if blank else n - fresh
        self.truncated += cut and fresh
        if fresh:
            self.codes.append(code | (_TRUNCATED if cut else 0))
        self.codes += bytes([code | _GONE]) * (n - fresh)

    def row(self) -> tuple:
        codes = bytes(self.codes)
        cost, audit = (_short_edits if len(codes) <= 16 else cheapest_edits)(codes)
        gaps = self.turn - self.first + 1 - self.turns if self.first is not None else 0
        return self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


class _Repair:
    """Plays an audit over the turns of a conversation: gives (edit, role) for each turn and each inserted one."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, START

    def inserted(self) -> Iterator[str]:
        while self.audit.startswith("I", self.at):
            self.at += 1
            yield self._wanted()

    def turn(self, role: str) -> tuple[str, str | None]:
        letter = self.audit[self.at]
        self.at += 1
        if letter == "D":
            return letter, None
        if letter == "R":
            return letter, self._wanted()
        self.place = _INITIALS.index(role[0]) + 1
        return letter, role

    def _wanted(self) -> str:
        self.place = _NEXT[self.place]
        return "user" if self.place == USER else "assistant"


class _Sums:
    """Per conversation: its audit's figures, and the SHA-256 of what it leaves."""

    fields = [T.StructField("repaired_sha256", T.StringType())]

    def __init__(self, conv, stats: dict):
        self.stats, self.sum, self.any = (conv, *stats.values()), hashlib.sha256(), False

    def take(self, edit: str, role: str | None, text: str | None, turn: int | None) -> list[tuple]:
        if role is not None:
            self.sum.update((("\n" if self.any else "") + f"{role}:{text}").encode())
            self.any = True
        return []

    def end(self) -> list[tuple]:
        return [(*self.stats, self.sum.hexdigest())]


class _Turns:
    """Per conversation: its turns after repair."""

    def __init__(self, conv, stats: dict):
        self.conv, self.position = conv, 0

    def take(self, edit: str, role: str | None, text: str | None, turn: int | None) -> list[tuple]:
        if role is None:
            return []
        self.position += 1
        return [(self.conv, self.position - 1, turn, role, text, edit)]

    def end(self) -> list[tuple]:
        return []


def _played(rows: DataFrame, audits: DataFrame, schema: T.StructType, make: type) -> DataFrame:
    """What ``make`` makes of the conversations' turns and edits, streamed in order, a batch of turns in memory.

    A conversation's audit travels as a row before its turns: nothing is joined.
    """
    stats = F.struct(*[c for c in audits.columns if c != "conv"])
    head = audits.select("conv", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("digest"), stats.alias("stats"))
    body = rows.select("conv", "turn", "role", "text", "digest", F.lit(None).cast(head.schema["stats"].dataType).alias("stats"))
    both = _in_order(head.unionByName(body).withColumn("head", F.col("stats").isNull()), "head")
    names = ["conv", "turn", "role", "text", "stats"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        one = repair = types = None
        size = 0

        def close() -> None:
            for role in repair.inserted():
                out.extend(one.take("I", role, "", None))
            out.extend(one.end())

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.fieldNames())

        for batch in batches:
            types = [batch.schema.field("conv").type, *[pa.string() if isinstance(f.dataType, T.StringType) else pa.int64() for f in schema.fields[1:]]]
            for conv, turn, role, text, stats in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                if stats is not None:
                    if one is not None:
                        close()
                    one, repair = make(conv, stats), _Repair(stats["audit"])
                    continue
                for new in repair.inserted():
                    out.extend(one.take("I", new, "", None))
                edit, role = repair.turn(role)
                out.extend(one.take(edit, role, text, turn))
                size += len(text)
                if len(out) >= 1000 or size > 1 << 22:
                    size = 0
                    if out:
                        yield flush()
        if one is not None:
            close()
        if out:
            yield flush()

    return both.select(*names).mapInArrow(run, schema)


def _prepared(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    ship_package(turns.sparkSession)
    rows = _marked(turns, *[F.col(quoted(c)) for c in (conv, turn, role, text)])
    return rows, written(_audited(rows), "audits")


def audit_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row for each conversation: what is wrong with it and the cheapest edits that mend it.

    Turns are taken by number (nulls first; equal numbers by role and the text's SHA-256). A turn's first fault counts:
    ``blank`` (no character but white space), ``duplicate`` (role and text of an earlier turn), ``truncated`` (its last
    such character is none of ``.!?``). ``gaps`` are the missing numbers between the least and the greatest, ``illegal``
    the neighbours whose roles do not begin with su, ua or au. Edits: Keep (0), Rerole to user or assistant (2),
    Delete (3; blank and duplicate turns have to go), Insert an empty turn of user or assistant (2); a truncated turn
    that stays adds 1. ``audit`` holds the initials of the cheapest edits after which the roles' initials are a string of
    ``(s?(ua)+)?``, the least in ASCII order if several cost ``cost``; ``repaired_sha256`` is of the turns left, as
    ``role:text`` with line feeds between. The identifier keeps its name and type.

    Null roles and texts are one space; a null identifier is a conversation of its own; an empty role begins with none
    of the letters. Repeated rows are duplicates. Other columns are not read. Very long texts only pass through a batch, very
    long conversations through one task, in order, as one hash over all their turns asks; neither is held: a turn
    leaves a byte for the alignment, which is cut at every 512 turns. An empty table gives an empty one.
    """
    rows, audits = _prepared(turns, conv, turn, role, text)
    schema = T.StructType([*audits.schema.fields, *_Sums.fields])
    out = _played(rows, audits, schema, _Sums)
    return out.withColumnRenamed("conv", conv)


def repair_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns left by the edits of ``audit_conversations``: (identifier, position from 0, turn, role, text, edit).

    ``turn`` is the number a turn had, null for an inserted one. Other columns do not come along; cases are as there.
    """
    rows, audits = _prepared(turns, conv, turn, role, text)
    schema = T.StructType([audits.schema["conv"], *T.StructType.fromDDL("position long, turn long, role string, text string, edit string").fields])
    return _played(rows, audits, schema, _Turns).withColumnRenamed("conv", conv)
