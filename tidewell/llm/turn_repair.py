"""Conversations whose turns are repaired at the least cost, by weighted interval parsing.

A repaired conversation's role initials are nothing or `s?(ua)+`. Its grammar is in Chomsky normal form with pairs of
phases as symbols: [p, r] -> [p, q] [q, r], and [p, q] -> a turn with an edit that leads from phase p to phase q; phases
are what has been read: 0 nothing, 1 the system turn, 2 a user turn, 3 an assistant turn. The cell of a span holds for each
symbol the least (cost, audit) that derives it. A leaf's cell is closed under insertion on either side. Cells are combined
bottom-up by span length, which doubles from level to level: a cell has all pairs of phases, so all ways to cut a span give
the same cell, and one is enough; time is linear, and a conversation may be parsed in parts.

That is how one that holds a third of all rows is dealt with: turns are sorted over all partitions, each task makes chunks
with their cells, and per conversation only cells come together, then the chunks' texts pass by one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidewell.llm.common import table

#: What edits cost, and what a truncated turn adds that isn't deleted.
RETYPE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Fixed value: white space.
SPACE = " \t\n\x0b\x0c\r"
#: phase -> role initial -> next phase; phases that a conversation may end in.
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ENDS = (0, 3)
TRIPLES = [(p, q, r) for p in NEXT for q in NEXT for r in NEXT if not (q == 0 and p or r == 0 and q or q == 1 and p > 1 or r == 1 and q > 1)]
#: A chunk's turns and bytes at most (one turn may be longer); spans remembered are as long as this at most.
CHUNK, CACHED = (1024, 1 << 20), 16

Cell = dict[tuple[int, int], tuple]  # (phase before, phase after) -> (cost, audit, ...)


def combine(left: Cell, right: Cell) -> Cell:
    out: Cell = {}
    for p, q, r in TRIPLES:
        if (a := left.get((p, q))) and (b := right.get((q, r))):
            made = tuple(x + y for x, y in zip(a, b))
            if (p, r) not in out or made < out[p, r]:
                out[p, r] = made
    return out


def inserted() -> Cell:
    """Of an empty span: insertions that lead from phase to phase, none at all included."""
    out: Cell = {(p, p): (0, "") for p in NEXT}
    for _ in NEXT:
        step = {(p, r): (c + INSERT, audit + "I") for (p, q), (c, audit) in out.items() for x, r in NEXT[q].items() if x != "s"}
        out = {k: min(x[k] for x in (out, step) if k in x) for k in out | step}
    return out


EMPTY = inserted()


@lru_cache(None)
def leaf(symbol: str) -> Cell:
    """symbol: s, u, a or x (another role); a capital where the turn is truncated; d where it has to be deleted."""
    out: Cell = {(p, p): (DELETE, "D") for p in NEXT}
    if symbol != "d":
        more = TRUNCATED * symbol.isupper()
        for p, to in NEXT.items():
            for x, q in to.items():
                if x != "s":
                    out[p, q] = (RETYPE + more, "R")
                if x == symbol.lower():
                    out[p, q] = (more, "K")
    return combine(combine(EMPTY, out), EMPTY)


@lru_cache(1 << 15)
def short(symbols: str) -> Cell:
    return leaf(symbols) if len(symbols) == 1 else combine(short(symbols[: (at := 1 << (len(symbols) - 1).bit_length() - 1)]), short(symbols[at:]))


def bottom_up(cells: list[Cell]) -> Cell:
    while len(cells) > 1:
        cells = [combine(*cells[i : i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


def parse(symbols: str) -> Cell:
    """The cell of a whole span; short spans are remembered, since conversations are much alike."""
    return bottom_up([short(symbols[i : i + CACHED]) for i in range(0, len(symbols), CACHED)]) if symbols else EMPTY


def choose(cells: list[Cell]) -> tuple[int, list[tuple[int, str]]]:
    """Least cost of consecutive spans, and for each the phase before it and its audit."""
    stamped = [{k: (*v, (k[1],)) for k, v in cell.items()} for cell in cells]
    whole = bottom_up(stamped)
    cost, _, after = min(whole[0, q] for q in ENDS if (0, q) in whole)
    before = (0, *after[:-1])
    return cost, [(p, cell[p, q][1]) for p, q, cell in zip(before, after, cells, strict=True)]


def apply(phase: int, audit: str, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of what is there after the edits."""
    at = -1
    for edit in audit:
        at += edit != "I"
        if edit == "D":
            continue
        new = "assistant" if phase == 2 else "user"
        role, text = (new, "") if edit == "I" else (new if edit == "R" else roles[at], texts[at])
        phase = NEXT[phase][role[:1]]
        yield edit, role, text


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, lost: turns damaged by crc32 of conv_id:turn, modulo 20. 0 marks the row as lost, 1
    empties the text, 2 takes `.`, `!` and `?` out of it, 3 repeats the row, 4 makes it the user's. A null is one space,
    but a null turn stays where the turn counts as a number; other columns aren't read; an empty table gives no rows."""
    shown = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn"))) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    again = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("lost"), again.alias("again")).drop("again")


def alike_once(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a batch that are the same in every key become one, with their number: before anything is shuffled."""
    for batch in batches:
        if batch.num_rows:
            keys = pa.Table.from_batches([batch]).select(["conv_id", "turn", "role", "digest", "kind"]).append_column("row", pa.array(range(batch.num_rows)))
            found = keys.group_by(["conv_id", "turn", "role", "digest", "kind"], use_threads=False).aggregate([("row", "min"), ("row", "count")]).sort_by("row_min")
            kept = batch.take(found.column("row_min").combine_chunks())
            yield pa.RecordBatch.from_arrays([*kept.columns, found.column("row_count").combine_chunks()], names=[*kept.schema.names, "times"])


class Chunk(NamedTuple):
    """Consecutive turns of a conversation; the first and last turn numbers and role initials tie it to its neighbours."""

    conv_id: object
    part: int
    number: int
    low: int | None
    high: int | None
    turns: int
    first: str | None
    last: str | None
    blank: int
    duplicate: int
    truncated: int
    illegal: int


LEGAL = ("su", "ua", "au")
KEY = ("conv_id", "turn", "role", "digest")
SORTED = (*KEY, "kind", "text", "blank", "truncated", "times")
FACTS = "part int, number long, low long, high long, turns long, first string, last string, blank long, duplicate long, truncated long, illegal long"


def chunks(batches: Iterable[pa.RecordBatch], schema: pa.Schema, most: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Of sorted turns, chunks: their cell and facts in one row (kind 0), their turns in another (kind 1)."""
    part, number, begun = TaskContext.get().partitionId(), 0, False
    conv, marked, before, run, size = None, None, None, [], 0

    def flush() -> pa.RecordBatch:
        nonlocal number, run, size
        turns = [t for t, *_ in run if t is not None]
        initials = [role[:1] for _, role, *_ in run]
        faults = [f for *_, f, _ in run]
        fact = Chunk(
            conv, part, number, turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), initials[0] if run else None, initials[-1] if run else None,
            faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        )._asdict()
        cell = [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in parse("".join(s for *_, s in run)).items()]
        rows = [fact | {"kind": 0, "cells": cell}, fact | {"kind": 1, "roles": [r for _, r, *_ in run], "texts": [t for _, _, t, *_ in run]}]
        number, run, size = number + 1, [], 0
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    for batch in batches:
        for c, *key, k, text, blank, truncated, times in zip(*(batch.column(n).to_pylist() for n in SORTED), strict=True):
            if not begun or c != conv:
                if begun:
                    yield flush()
                begun, conv, marked, before = True, c, None, None
            if k == 0:  # the turns of this key repeat an earlier one
                marked = key
            if k != 1:
                continue
            turn, role, _ = key
            for _ in range(times):
                fault = "blank" if blank else "duplicate" if key in (marked, before) else "truncated" if truncated else ""
                symbol, before = role[:1] if role[:1] in ("s", "u", "a") else "x", key
                gone = fault in ("blank", "duplicate")
                run.append((turn, role, "" if gone else text, fault, "d" if gone else symbol.upper() if fault else symbol))
                size += len(run[-1][2])
                if len(run) >= most[0] or size >= most[1]:
                    yield flush()
    if begun:
        yield flush()


def chunk_schema(kind: pa.DataType) -> pa.Schema:
    cell = pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    facts = [(n, pa.int32() if n == "part" else pa.string() if n in ("first", "last") else pa.int64()) for n in Chunk._fields[1:]]
    return pa.schema([("conv_id", kind), ("kind", pa.int32()), *facts, ("cells", pa.list_(cell)), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))])


class Conversation:
    """Facts and cells of one conversation as its chunks come by in order; then its texts."""

    def __init__(self, conv_id: object):
        self.conv_id, self.cells, self.low, self.high, self.turns, self.last = conv_id, [], None, None, 0, None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.cost, self.plan, self.at, self.sha, self.any = 0, None, 0, hashlib.sha256(), False

    def add(self, row: dict) -> None:
        for name in self.faults:
            self.faults[name] += row[name]
        if row["first"] is not None:
            self.faults["illegal"] += self.last is not None and self.last + row["first"] not in LEGAL
            self.last = row["last"]
        if row["low"] is not None:
            self.turns += row["turns"] - (self.high == row["low"])
            self.low, self.high = row["low"] if self.low is None else self.low, row["high"]
        self.cells.append({(x["p"], x["q"]): (x["cost"], x["audit"]) for x in row["cells"]})

    def repaired(self, roles: list[str], texts: list[str]) -> list[tuple[str, str, str]]:
        if self.plan is None:
            self.cost, self.plan = choose(self.cells)
            self.cells = []
        phase, audit = self.plan[self.at]
        self.at += 1
        made = [*apply(phase, audit, roles, texts)]
        for _, role, text in made:
            self.sha.update(("\n" * self.any + role + ":" + text).encode())
            self.any = True
        return made

    def report(self) -> dict:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return {"conv_id": self.conv_id, "gaps": gaps, **self.faults, "cost": self.cost, "audit": "".join(a for _, a in self.plan), "repaired_sha256": self.sha.hexdigest()}


def rebuilt(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Conversation, list[tuple[str, str, str]] | None]]:
    """For each chunk (conversation, repaired turns), and (conversation, None) at its end."""
    now: Conversation | None = None
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
            if now is None or row["conv_id"] != now.conv_id:
                if now:
                    yield now, None
                now = Conversation(row["conv_id"])
            if row["kind"] == 0:
                now.add(row)
            else:
                yield now, now.repaired(row["roles"], row["texts"])
    if now:
        yield now, None


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def chunked(conversations: DataFrame, most: tuple[int, int]) -> DataFrame:
    """Chunks by conversation, cells before texts, in order."""
    lost = F.coalesce(F.col("lost"), F.lit(False)) if "lost" in conversations.columns else F.lit(False)
    shown = lambda name: F.when(~lost, F.coalesce(F.col(name), F.lit(" "))).alias(name)
    rows = conversations.select("conv_id", F.when(~lost, F.col("turn").cast("long")).alias("turn"), shown("role"), shown("text"), F.when(lost, 2).otherwise(1).alias("kind"))
    bare = F.rtrim(F.col("text"), F.lit(SPACE))
    facts = {"digest": F.md5("text"), "blank": bare == "", "truncated": ~F.right(bare, F.lit(1)).isin(".", "!", "?")}
    rows = rows.withColumns(facts).select(*SORTED[:-1])
    # Where a role and text stand at several turns, those behind the first get a mark, which sorts before them.
    slim = rows.filter("kind = 1").select(*KEY)
    first = slim.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"), F.max(F.struct("turn")).alias("latest")).filter("first <> latest")
    later = F.expr("a.conv_id <=> b.conv_id and a.role = b.role and a.digest = b.digest and struct(a.turn) > b.first")
    marks = slim.alias("a").join(first.alias("b"), later, "left_semi").withColumns({"kind": F.lit(0), "text": F.lit(None).cast("string"), "blank": F.lit(None).cast("boolean"), "truncated": F.lit(None).cast("boolean"), "times": F.lit(1).cast("long")})
    id_type = rows.schema["conv_id"].dataType
    kind, schema = id_type.simpleString(), chunk_schema(to_arrow_type(id_type))
    once = rows.mapInArrow(alike_once, f"conv_id {kind}, turn long, role string, digest string, kind int, text string, blank boolean, truncated boolean, times long")
    in_order = once.unionByName(marks).repartitionByRange(*KEY).sortWithinPartitions(*KEY, "kind")
    found = in_order.mapInArrow(lambda batches: chunks(batches, schema, most), f"conv_id {kind}, kind int, {FACTS}, cells array<struct<p int, q int, cost long, audit string>>, roles array<string>, texts array<string>")
    return found.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "part", "number")


def in_batches(rows: Iterable[dict], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def repair(conversations: DataFrame, chunk: tuple[int, int] = CHUNK) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per conversation.

    conversations: conv_id, turn, role, text and, if it is there, lost (boolean: the row is gone, but its conversation is
    reported). Turns stand by number, nulls first; turns of one number by role, then by their text's digest. Null roles
    and texts are one space; a null conv_id is a conversation of its own; an empty table gives no rows; other columns
    aren't read. An audit is one value: a conversation of more than 2 ** 31 edits can't be reported.
    """
    id_type = conversations.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(id_type)), *((n, pa.int64()) for n in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches((c.report() for c, turns in rebuilt(batches) if turns is None), schema)

    return chunked(conversations, chunk).mapInArrow(run, f"conv_id {id_type.simpleString()}, {', '.join(f'{n} long' for n in COUNTS)}, audit string, repaired_sha256 string")


def repaired_turns(conversations: DataFrame, chunk: tuple[int, int] = CHUNK) -> DataFrame:
    """conv_id, position (from 0), edit (K, R or I), role, text: the conversations that `repair` reports on, repaired. What
    it says of nulls, ties and empty tables holds here too."""
    id_type = conversations.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(id_type)), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        at = 0
        for conversation, turns in rebuilt(batches):
            for i, (edit, role, text) in enumerate(turns or ()):
                yield {"conv_id": conversation.conv_id, "position": at + i, "edit": edit, "role": role, "text": text}
            at = 0 if turns is None else at + len(turns)

    return chunked(conversations, chunk).mapInArrow(lambda batches: in_batches(numbered(batches), schema, 200), f"conv_id {id_type.simpleString()}, position long, edit string, role string, text string")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations")))
