"""Repair of the structure of conversations by depth-first branch-and-bound.

A conversation is sound if its roles read ``s?(ua)+`` (or it has no turns). Turns are kept, given another
role, deleted or inserted at a cost each; the cheapest edits are wanted, and of those the ones whose initials
come first in ASCII order.

A node of the search is (turns done, state of the role pattern). Children are tried in ASCII order from an
explicit stack, so any later path to a node spells a later string: it is worth following only if it is
cheaper than every path that came to that node before (the dominance table), and only if its cost and a lower
bound of what the rest must cost stay below the incumbent. The incumbent starts as the cost of one greedy dive.
The bounds of all suffixes come from a relaxed pattern, in which a conversation may end anywhere; they are never
too high, and too low by the turns that an unfinished end lacks at most. When the stack is empty, the incumbent is
proved to be the optimum.

The search sees two bytes per turn. Everything else is joins and windows on (conversation, position): texts are
never gathered, and a repaired conversation leaves as rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.llm.common import map_batches
from moodtide.session import durable

#: Costs of the edits; a truncated turn that is not deleted costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
#: Faults of a turn, as the search sees them.
SOUND, MUST_GO, CUT_OFF = 0, 1, 2

#: States of the pattern: nothing yet, after a system turn, after a user turn, after an assistant turn.
_BEGIN, _SYSTEM, _USER, _ASSISTANT = range(4)
_WANTED = {_BEGIN: "u", _SYSTEM: "u", _USER: "a", _ASSISTANT: "u"}
_AFTER = {"u": _USER, "a": _ASSISTANT}
_NO_PATH = 1 << 60


def suffix_bounds(initials: str, faults: bytes) -> list[tuple[int, int, int, int]]:
    """For each number of turns done, the least cost of the rest from each state in the relaxed pattern."""
    begin, user_due, assistant_due = 0, 0, 0
    bounds = [(0, 0, 0, 0)]
    for initial, fault in zip(reversed(initials), reversed(faults)):
        drops = (DELETE + begin, DELETE + user_due, DELETE + assistant_due)
        if fault == MUST_GO:
            begin, user_due, assistant_due = drops
        else:
            extra = TRUNCATED if fault == CUT_OFF else 0
            as_user = extra + REROLE * (initial != "u") + assistant_due
            as_assistant = extra + REROLE * (initial != "a") + user_due
            as_system = extra + user_due if initial == "s" else as_user
            begin, user_due, assistant_due = min(drops[0], as_user, as_system), min(drops[1], as_user), min(drops[2], as_assistant)
        user_due, assistant_due = min(user_due, INSERT + assistant_due), min(assistant_due, INSERT + user_due)
        begin = min(begin, INSERT + assistant_due)
        bounds.append((begin, user_due, assistant_due, user_due))
    bounds.reverse()
    return bounds


def _children(at: int, state: int, initials: str, faults: bytes) -> list[tuple[str, int, int, int]]:
    """(edit, cost, turns done, state) of each edit, in ASCII order of the edits: D, I, K, R."""
    wanted, found = _WANTED[state], []
    inserted = ("I", INSERT, at, _AFTER[wanted])
    if at == len(initials):
        return [inserted]
    initial, fault = initials[at], faults[at]
    found = [("D", DELETE, at + 1, state), inserted]
    if fault != MUST_GO:
        extra = TRUNCATED if fault == CUT_OFF else 0
        if initial == wanted:
            found.append(("K", extra, at + 1, _AFTER[wanted]))
        else:
            if initial == "s" and state == _BEGIN:
                found.append(("K", extra, at + 1, _SYSTEM))
            found.append(("R", REROLE + extra, at + 1, _AFTER[wanted]))
    return found


def _is_end(at: int, state: int, n: int) -> bool:
    return at == n and state in (_BEGIN, _ASSISTANT)


def _dive(initials: str, faults: bytes, bounds: list[tuple[int, int, int, int]]) -> int:
    """The cost of the path that always takes the edit with the least bound."""
    at, state, spent = 0, _BEGIN, 0
    while not _is_end(at, state, len(initials)):
        _, cost, at, state = min(_children(at, state, initials, faults), key=lambda c: c[1] + bounds[c[2]][c[3]])
        spent += cost
    return spent


def cheapest_edits(initials: str, faults: bytes) -> tuple[int, str]:
    """(cost, edits) of a conversation given by its turns' role initials ("?" for none) and faults."""
    n, bounds = len(initials), suffix_bounds(initials, faults)
    best, audit = _dive(initials, faults, bounds) + 1, ""
    reached = [[_NO_PATH] * 4 for _ in range(n + 1)]
    path: list[str] = []
    stack = [("", 0, 0, _BEGIN, 0)]  # edit, depth, turns done, state, cost
    while stack:
        edit, depth, at, state, spent = stack.pop()
        if spent >= reached[at][state] or spent + bounds[at][state] >= best:
            continue
        reached[at][state] = spent
        del path[max(depth - 1, 0) :]
        if depth:
            path.append(edit)
        if _is_end(at, state, n):
            best, audit = spent, "".join(path)
            continue
        for edit, cost, to, after in reversed(_children(at, state, initials, faults)):
            if spent + cost + bounds[to][after] < best and spent + cost < reached[to][after]:
                stack.append((edit, depth + 1, to, after, spent + cost))
    return best, audit


#: Conversations of up to so many turns are remembered by a worker.
_SHORT = 16
_remembered = lru_cache(maxsize=1 << 16)(cheapest_edits)


def edits_of(initials: str, faults: bytes) -> tuple[int, str]:
    return (_remembered if len(initials) <= _SHORT else cheapest_edits)(initials, faults)


def steps(initials: str, audit: str) -> Iterator[tuple[str, int | None, str | None]]:
    """(edit, turn or None if inserted, new role or None if kept) of each edit."""
    at, state = 0, _BEGIN
    for edit in audit:
        wanted = _WANTED[state]
        if edit == "K":
            state = _SYSTEM if initials[at] == "s" else _AFTER[initials[at]]
        elif edit != "D":
            state = _AFTER[wanted]
        yield edit, (None if edit == "I" else at), (ROLES[wanted] if edit in "IR" else None)
        at += edit != "I"


# --- Spark -----------------------------------------------------------------------------------------------------


def _own(column: str, rows: DataFrame) -> str:
    return rows.schema[column].dataType.simpleString()


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): rows damaged by the CRC-32 of ``conv_id:turn`` modulo 20. 0 drops the
    row (``present`` is false), 1 empties its text, 2 removes its full stops, exclamation and question marks, 3
    repeats it, 4 makes its role user. Nulls count as one space."""

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") != 0).alias("present"), F.explode(times).alias("_time")
    ).drop("_time")


_NOT_SPACE = r"[^\x20\x09-\x0D]"


def placed_turns(turns: DataFrame) -> DataFrame:
    """The turns of each conversation that are present, in order of turn (nulls first), written: conv_id, turn,
    role, text, ``pos`` from 0, ``initial`` of the role ("?" if it has none), ``fault``, and ``follows``, whether
    it may follow the turn before it. Turns of one number stand in the order of role and text, so equal ones
    are neighbours."""
    initial = F.when(F.col("role") == "", "?").otherwise(F.substring("role", 1, 1))
    digest = F.unhex(F.md5(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text").cast("binary")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = turns.filter("present").select("conv_id", "turn", "role", "text", initial.alias("initial"), digest.alias("_digest"))
    placed = rows.select(
        "*", (F.row_number().over(order) - 1).cast("long").alias("pos"), F.lag("initial").over(order).alias("_before"),
        F.lag("turn").over(order).alias("_turn_before"),
    )
    written = durable(placed)
    # equal turns of a conversation: only the first is none; its copies may be very many, so they are not put together
    firsts = written.groupBy("conv_id", "_digest").agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    copies = durable(firsts.select(F.col("conv_id").alias("_conv"), F.col("_digest").alias("_of"), "_first"))
    marked = written.join(copies, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_digest") == F.col("_of")), "left")
    last = F.substring(F.rtrim("text", F.lit("\x20\t\n\x0b\x0c\r")), -1, 1)
    fault = (
        F.when(~F.col("text").rlike(_NOT_SPACE), "blank").when(F.col("pos") > F.col("_first"), "duplicate")
        .when(~last.isin(".", "!", "?"), "truncated")
    )
    return durable(
        marked.select(
            "conv_id", "turn", "role", "text", "pos", "initial", fault.alias("fault"),
            F.concat("_before", "initial").isin("su", "ua", "au").alias("follows"),
            (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_turn_before"))).alias("new_turn"),
        )
    )


def _gaps() -> Column:
    span = F.try_subtract(F.max("turn"), F.min("turn"))
    return F.coalesce(F.try_subtract(F.try_add(span, F.lit(1)), F.count_if("new_turn")), F.lit(0)).cast("long")


def fault_counts(placed: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal; one aggregate, reduced on the map side."""
    faults = [F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")]
    return placed.groupBy("conv_id").agg(_gaps().alias("gaps"), *faults, F.count_if(~F.col("follows")).alias("illegal"))


def edits(placed: DataFrame) -> DataFrame:
    """One row per edit, written: conv_id, ``step`` from 0, ``edit`` (K, R, D or I), ``pos`` of the turn (null if
    inserted) and its new ``role`` (null if kept); and one with step -1, whose ``edit`` is all edits' initials and
    whose ``pos`` is the cost. A conversation passes its task as two bytes per turn."""
    code = F.when(F.col("fault").isNull(), SOUND).when(F.col("fault") == "truncated", CUT_OFF).otherwise(MUST_GO)
    narrow = placed.select("conv_id", "pos", "initial", code.cast("int").alias("code"))
    dealt = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "pos")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv, initials, faults in _conversations(batches):
            cost, audit = edits_of(initials, faults)
            rows = [(conv, -1, audit, cost, None), *((conv, i, *step) for i, step in enumerate(steps(initials, audit)))]
            for start in range(0, len(rows), _ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[start : start + _ROWS]), kinds)], names=names)

    conv_type = pa.int64() if _own("conv_id", placed) in ("bigint", "int") else pa.string()
    names = ["conv_id", "step", "edit", "pos", "role"]
    kinds = [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string()]
    conv = "bigint" if conv_type == pa.int64() else "string"
    return durable(map_batches(dealt, search, f"conv_id {conv}, step bigint, edit string, pos bigint, role string"))


_ROWS = 1 << 14


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, bytes]]:
    """(conv_id, initials, faults) of one conversation after the other, from sorted batches."""
    conv, initials, faults, begun = None, [], bytearray(), False
    for batch in batches:
        for key, initial, code in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if not begun or key != conv:
                if begun:
                    yield conv, "".join(initials), bytes(faults)
                conv, initials, faults, begun = key, [], bytearray(), True
            initials.append(initial)
            faults.append(code)
    if begun:
        yield conv, "".join(initials), bytes(faults)


def apply_edits(placed: DataFrame, edited: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, ``step`` (their order), role, text. Inserted turns have empty text."""
    kept = edited.filter((F.col("step") >= 0) & (F.col("edit") != "D")).alias("e")
    same = F.col("e.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("e.pos") == F.col("t.pos"))
    joined = kept.join(placed.select("conv_id", "pos", "role", "text").alias("t"), same, "left")
    return joined.select(
        "e.conv_id", "step", F.coalesce("e.role", "t.role").alias("role"), F.coalesce("t.text", F.lit("")).alias("text")
    )


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables of the conversations of ``turns`` (conv_id, turn, role, text, present): a report with one row per
    conv_id, even of conversations without a row that is present (conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit), and the repaired turns (conv_id, step, role, text).

    Null conv_ids are one conversation; null turns come first; null roles and texts count as one space. A text
    without anything but white space, a turn seen earlier, and a role with another initial than s, u or a are
    faults that the edits mend. Very long texts are not gathered, and very long conversations pass a task as two
    bytes per turn. Rows of one turn stand in the order of role and text. An empty table gives no rows; other
    columns are ignored.
    """
    filled = turns.select(
        "conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], "present"
    )
    placed = placed_turns(filled)
    edited = edits(placed)
    plans = edited.filter("step = -1").select(F.col("conv_id").alias("_c"), F.col("pos").alias("cost"), F.col("edit").alias("audit"))
    every = turns.select("conv_id").distinct()
    counts = fault_counts(placed).withColumnRenamed("conv_id", "_d")
    joined = every.join(counts, F.col("conv_id").eqNullSafe(F.col("_d")), "left").join(plans, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    report = joined.select("conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in names], F.coalesce("audit", F.lit("")).alias("audit"))
    return report, apply_edits(placed, edited)


def conversation_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): lowercase SHA-256 of a conversation's lines ``role:text``, joined by newlines.
    The lines stream through a task in order and are not held."""
    dealt = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "step").select("conv_id", "role", "text")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, running, done = None, None, []
        for batch in batches:
            for key, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if running is None or key != conv:
                    if running is not None:
                        done.append((conv, running.hexdigest()))
                    conv, running = key, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode("utf-8", "replace"))
            if done:
                yield _digest_batch(done, batch.schema.field(0).type)
                done = []
        if running is not None:
            yield _digest_batch([(conv, running.hexdigest())], batch.schema.field(0).type)

    conv_type = _own("conv_id", repaired)
    return map_batches(dealt, digest, f"conv_id {conv_type}, repaired_sha256 string")


def _digest_batch(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    conv, digest = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(conv, conv_type), pa.array(digest, pa.string())], names=["conv_id", "repaired_sha256"])
