"""Operator 13: the cheapest edits that give a conversation its structure back, in linear space.

A conversation's roles have to read (s?(ua)+)?, by their initials. Four states say what may come
next. A step, be it a row, a block of rows or a whole conversation, is described by what it costs
to get from each state to each other one, and by the order of the audits that do so. Steps are
joined by Hirschberg's scheme: cost vectors from the front and from the back meet in the middle,
the crossing with the least audit among the cheapest is fixed, and both halves are solved alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from itertools import groupby
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonmart.llm.common import bound_batches
from seasonmart.llm.ordering import BLOCK, joined_sha256, positions
from seasonmart.sources.sinks import Scratch

# What edits cost, and what is no blank character.
RETITLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NO_BLANK = r"[^\x20\x09-\x0D]"

#: States by the last role: none yet, system, user, assistant.
STATES = range(4)
#: The role that an inserted or retitled turn gets in a state, and the state it leads to.
DUE = ("user", "user", "assistant", "user")
NEXT = (2, 2, 3, 2)
FAR = 1 << 60

SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)

Step = tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]
Front = tuple[list[int], list[int]]


def _ranks(values: list) -> list[int]:
    """Each value's place in the order of all; None comes last."""
    order = sorted({v for v in values if v is not None})
    return [len(order) if v is None else order.index(v) for v in values]


def _kept(state: int, initial: str) -> int | None:
    """The state after a turn that stays as it is."""
    if initial == "s" and state == 0:
        return 1
    return NEXT[state] if initial == DUE[state][0] else None


@cache
def letters(initial: str, fault: int) -> tuple[tuple[str | None, ...], ...]:
    """The cheapest edits of one row between each two states, as an audit; of equals the least."""
    return tuple(tuple(found and found[1] for found in row) for row in _row(initial, fault))


@cache
def row_step(initial: str, fault: int) -> Step:
    """A row as a step."""
    row = _row(initial, fault)
    costs = tuple(tuple(found[0] if found else FAR for found in line) for line in row)
    return costs, tuple(tuple(_ranks([found and found[1] for found in line])) for line in row)


@cache
def _row(initial: str, fault: int) -> list[list[tuple[int, str] | None]]:
    extra = TRUNCATED if fault == CUT_OFF else 0
    best: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in STATES]
    for start in STATES:
        state = start
        # No way needs three insertions: two already lead back to where a user's turn is due.
        for inserted in range(3):
            ways = [(state, DELETE, "D")]
            if fault not in (BLANK, DUPLICATE):
                ways.append((NEXT[state], RETITLE + extra, "R"))
                if (kept := _kept(state, initial)) is not None:
                    ways.append((kept, extra, "K"))
            for end, cost, letter in ways:
                way = (cost + INSERT * inserted, "I" * inserted + letter)
                if best[start][end] is None or way < best[start][end]:
                    best[start][end] = way
            state = NEXT[state]
    return best


#: What insertions complete a conversation from each state, and the step that stands for them.
COMPLETE = ("", "II", "I", "")
END: Step = (
    tuple((INSERT * len(c), FAR, FAR, FAR) for c in COMPLETE),
    tuple((0, 1, 1, 1) for _ in COMPLETE),
)


def from_state(state: int) -> Front:
    return [0 if s == state else FAR for s in STATES], [0 if s == state else 1 for s in STATES]


def forward(front: Front, step: Step) -> Front:
    """Costs of reaching each state one step further on, and the order of the audits that do.

    Two audits up to the same border never begin one another, as each ends with the edit of the
    last row. So the order of two that differ before a step is not changed by what the step adds.
    """
    (costs, order), (ways, ranks) = front, step
    reached, keys = [FAR] * 4, [None] * 4
    for end in STATES:
        total, rank, start = min((costs[s] + ways[s][end], order[s], s) for s in STATES)
        if total < FAR:
            reached[end], keys[end] = total, (rank, ranks[start][end])
    return reached, _ranks(keys)


def backward(back: list[int], step: Step) -> list[int]:
    ways = step[0]
    return [min(FAR, min(ways[s][end] + back[end] for end in STATES)) for s in STATES]


def joined(steps: list[Step]) -> Step:
    """Several steps as one."""
    fronts = []
    for state in STATES:
        front = from_state(state)
        for step in steps:
            front = forward(front, step)
        fronts.append(front)
    return tuple(tuple(f[0]) for f in fronts), tuple(tuple(f[1]) for f in fronts)


def crossings(steps: list[Step], start: int, end: int) -> list[int]:
    """The states between steps on the cheapest way from ``start`` to ``end``; of equals the audit-least."""
    found: list[int] = []
    open_parts = [(0, len(steps), start, end)]
    while open_parts:
        first, beyond, start, end = open_parts.pop()
        if beyond - first < 2:
            if beyond < len(steps):
                found.append(end)
            continue
        middle = (first + beyond) // 2
        front, back = from_state(start), [0 if s == end else FAR for s in STATES]
        for i in range(first, middle):
            front = forward(front, steps[i])
        for i in reversed(range(middle, beyond)):
            back = backward(back, steps[i])
        at = min(STATES, key=lambda s: (front[0][s] + back[s], front[1][s]))
        open_parts += [(middle, beyond, at, end), (first, middle, start, at)]
    return found


BLOCKS = (
    "conv_id long, block long, costs array<long>, ranks array<long>, first string, last string, "
    "blank long, duplicate long, truncated long, illegal long"
)
BORDERS = (
    "conv_id long, block long, start int, end int, final boolean, "
    "blank long, duplicate long, truncated long, illegal long, cost long"
)
EDITS = "conv_id long, block long, letters array<string>, states array<int>, tail string"
LEGAL = {"su", "ua", "au"}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batches(rows: Iterator[tuple], ddl: str) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
        "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string()),
    }
    fields = [part.split(" ") for part in ddl.split(", ")]
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == BLOCK:
            yield batch()
            held = []
    if held:
        yield batch()


def _block_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, block, initial, fault), sorted: each block as one step, with its counts."""

    def found() -> Iterator[tuple]:
        for (conv, block), rows in groupby(_rows(batches), key=lambda r: r[:2]):
            rows = [(initial, fault) for _, _, initial, fault in rows]
            costs, ranks = joined([row_step(*row) for row in rows])
            initials, faults = [r[0] for r in rows], [r[1] for r in rows]
            illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            flat = [[x for line in m for x in line] for m in (costs, ranks)]
            yield conv, block, *flat, initials[0], initials[-1], *map(faults.count, (BLANK, DUPLICATE, CUT_OFF)), illegal

    return _batches(found(), BLOCKS)


def _matrix(flat: list[int]) -> tuple[tuple[int, ...], ...]:
    return tuple(tuple(flat[i : i + 4]) for i in range(0, 16, 4))


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states at each block's borders; with its last block, what a conversation comes to."""

    def found() -> Iterator[tuple]:
        for _, blocks in groupby(_rows(batches), key=lambda r: r[0]):
            blocks = list(blocks)
            steps = [(_matrix(b[2]), _matrix(b[3])) for b in blocks] + [END]
            states = [0, *crossings(steps, 0, 0), 0]
            sums = [sum(b[i] for b in blocks) for i in range(6, 10)]
            sums[-1] += sum(a[5] + b[4] not in LEGAL for a, b in zip(blocks, blocks[1:]))
            sums.append(sum(step[0][a][b] for step, a, b in zip(steps, states, states[1:])))
            for i, block in enumerate(blocks):
                final = i == len(blocks) - 1
                yield *block[:2], states[i], states[i + 1], final, *(sums if final else [None] * 5)

    return _batches(found(), BORDERS)


def _block_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, block, initial, fault, start, end, final), sorted: the edits of each block's rows."""

    def found() -> Iterator[tuple]:
        for (conv, block), rows in groupby(_rows(batches), key=lambda r: r[:2]):
            rows = list(rows)
            start, end, final = rows[0][4:]
            states = [start, *crossings([row_step(*r[2:4]) for r in rows], start, end), end]
            edits = [letters(*r[2:4])[a][b] for r, a, b in zip(rows, states, states[1:])]
            yield conv, block, edits, states[:-1], COMPLETE[end] if final else ""

    return _batches(found(), EDITS)


@dataclass(frozen=True)
class Repair:
    """``report``: a row per conversation, with what was found and the audit of edits. ``turns``: the
    repaired conversations, in order of block, place and number."""

    report: DataFrame
    turns: DataFrame


def repair(
    scratch: Scratch, turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> Repair:
    """Find faults in conversations and the cheapest edits that make their roles (system?(user assistant)+)?.

    A row's first fault counts: blank (nothing but blanks), duplicate (role and text stood
    earlier in the conversation), truncated (does not end with . ! or ?). A kept row costs 0, one
    retitled to user or assistant 1, a deleted one 2, an inserted empty turn 5; blank and
    duplicate rows have to go, truncated ones that stay cost 5 more. Of the cheapest ways the one
    with the least audit (K, R, D and I in order) is taken.

    Columns of ``report``: conv_id, gaps (turn numbers missing between the least and the
    largest), blank, duplicate, truncated, illegal (neighbours whose roles may not follow one
    another), cost, audit. Columns of ``turns``: conv_id, block, place, number, role, text.

    Conversations of any length are cut into blocks of ``BLOCK`` rows, whose costs between states
    are found side by side. One task reads a conversation's blocks, 32 numbers each, and fixes the
    states at their borders; then each block is solved alone.

    Defined results: rows are taken by turn, nulls first, rows of equal turn by role and text. A
    null role or text counts as one space. A null conv_id is a conversation of its own. Texts of
    any length and repeated rows are taken as they are (a repeated row is a duplicate). An empty
    table gives empty results. Other columns are left out.
    """
    spark = turns.sparkSession
    bound_batches(spark)
    one_space = F.lit(" ")
    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), one_space).alias("role"),
        F.coalesce(F.col(text).cast("string"), one_space).alias("text"),
    )
    placed = positions(scratch, rows, "conv_id", ["turn", "role", "text"], "place")
    placed = placed.withColumn("block", F.floor(F.col("place") / BLOCK))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    thin = scratch.stage(
        placed.select(
            "conv_id", "turn", "block", "place",
            F.substring("role", 1, 1).alias("initial"),
            F.unhex(said).alias("said"),
            (~F.col("text").rlike(NO_BLANK)).alias("blank"),
            (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("open"),
        ),
        "thin",
    )
    faults = scratch.stage(_faults(thin), "faults")
    in_blocks = faults.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
    steps = in_blocks.select("conv_id", "block", "initial", "fault").mapInArrow(_block_steps, BLOCKS)
    steps = steps.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    borders = scratch.stage(steps.mapInArrow(_borders, BORDERS), "borders")

    known = attach(faults, borders.select("conv_id", "block", "start", "end", "final"), "conv_id", "block")
    known = known.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "place")
    known = known.select("conv_id", "block", "initial", "fault", "start", "end", "final")
    edits = scratch.stage(known.mapInArrow(_block_edits, EDITS), "edits")

    audits = edits.select("conv_id", "block", F.concat(F.array_join("letters", ""), "tail").alias("part"))
    audits = audits.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "part"))).alias("parts"))
    audits = audits.select("conv_id", F.array_join("parts.part", "").alias("audit"))
    spans = thin.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    )
    sums = borders.where("final").select("conv_id", "blank", "duplicate", "truncated", "illegal", "cost")
    report = attach(attach(spans, sums, "conv_id"), audits, "conv_id")
    return Repair(report, _repaired(placed, edits))


def attach(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Left join on keys of the same names, null equal to null."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys))
    return left.join(renamed, same, "left").drop(*(f"_right_{k}" for k in keys))


def _faults(thin: DataFrame) -> DataFrame:
    """Each row's first fault. A row is no duplicate if it is the first of its conversation that says so.

    First rows are found by partial aggregation and joined back by place, which no two rows of a
    conversation share: what a third of all rows repeat is no hot key.
    """
    firsts = thin.groupBy("conv_id", "said").agg(F.min("place").alias("place")).drop("said")
    marked = attach(thin.drop("said", "turn"), firsts.withColumn("first", F.lit(True)), "conv_id", "place")
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("first").isNull(), DUPLICATE)
        .when(F.col("open"), CUT_OFF)
        .otherwise(SOUND)
    )
    return marked.select("conv_id", "block", "place", "initial", fault.alias("fault"))


def _due(state: Column, inserted: Column) -> Column:
    """The role due in a state after some insertions."""
    table = [[DUE[s], DUE[NEXT[s]], DUE[NEXT[NEXT[s]]]] for s in STATES]
    listed = F.array(*(F.lit(role) for line in table for role in line))
    return F.element_at(listed, (state * 3 + inserted + 1).cast("int"))


def _repaired(placed: DataFrame, edits: DataFrame) -> DataFrame:
    """The turns that the edits leave and insert."""
    single = edits.select("conv_id", "block", F.posexplode(F.arrays_zip("letters", "states")).alias("at", "edit"))
    single = single.select(
        "conv_id",
        (F.col("block") * BLOCK + F.col("at")).alias("place"),
        F.length("edit.letters").alias("size"),
        F.substring("edit.letters", -1, 1).alias("letter"),
        F.col("edit.states").alias("state"),
    )
    inserted = F.col("size") - 1
    own_role = F.when(F.col("letter") == "K", F.col("role")).otherwise(_due(F.col("state"), inserted))
    new = F.transform(
        F.filter(F.array(F.lit(0), F.lit(1)), lambda i: i < inserted),
        lambda i: F.struct(i.alias("number"), _due(F.col("state"), i).alias("role"), F.lit("").alias("text")),
    )
    own = F.when(
        F.col("letter") != "D",
        F.array(F.struct(inserted.alias("number"), own_role.alias("role"), F.col("text").alias("text"))),
    ).otherwise(F.array().cast("array<struct<number:int,role:string,text:string>>"))
    rows = attach(placed, single, "conv_id", "place")
    rows = rows.select("conv_id", "block", "place", F.explode(F.concat(new, own)).alias("said"))
    ends = edits.where("tail <> ''").select(
        "conv_id", "block", (F.col("block") * BLOCK + F.size("letters")).alias("place"),
        F.explode(F.sequence(F.lit(1), F.length("tail"))).alias("number"),
        F.length("tail").alias("size"),
    )
    # The last insertion completes with an assistant's turn; one before it is a user's.
    ends = ends.select(
        "conv_id", "block", "place", "number",
        F.when(F.col("number") < F.col("size"), "user").otherwise("assistant").alias("role"), F.lit("").alias("text"),
    )
    return rows.select("conv_id", "block", "place", "said.*").unionByName(ends)


def repaired_sha256(turns: DataFrame) -> DataFrame:
    """(key, sha256) of each repaired conversation, one line ``role:text`` a turn."""
    lines = turns.withColumn("line", F.concat("role", F.lit(":"), "text"))
    return joined_sha256(lines, "conv_id", F.col("block"), ["place", "number"], "line", "\n")
