"""Operator 11: the prefix trie of conversations; only prefixes that may be shared are shuffled.

A prefix of d turns is known by a digest: sums of hashes of its (place, turn) pairs, which blocks
of a long conversation can add up side by side. A count-min sketch of all digests says how many
conversations have a prefix at most. At one, the prefix is proven to be alone, and so is all that
follows it: that tail needs no shuffle. The rest is grouped exactly.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonmart.llm.common import bound_batches
from seasonmart.llm.conversation_repair import attach
from seasonmart.llm.ordering import BLOCK, joined_sha256, positions, running_sums
from seasonmart.sources.sinks import Scratch

#: Hashes that make up a prefix digest, and the bits of each. Sums of up to 2^23 of them fit a long.
LANES, LANE_BITS = 5, 40
#: Rows of the sketch, cells of a row for each prefix, and the bounds of a row. With more prefixes
#: than the largest sketch is made for, more of them are shuffled; the result is the same.
SKETCH_ROWS, CELLS_PER_PREFIX = 4, 4
MIN_CELLS, MAX_CELLS = 1 << 14, 1 << 24
#: Cells of the pieces in which sketches travel and are merged.
PIECE = 1 << 16

WORD = r"[^\x20\x09-\x0D]+"
SKETCH = "piece long, cells binary"


def sketch_cells(prefixes: int) -> int:
    """Cells of a sketch row: a power of two, so that a digest's bits give a cell without bias."""
    return min(MAX_CELLS, max(MIN_CELLS, 1 << (CELLS_PER_PREFIX * max(prefixes, 1) - 1).bit_length()))


def _cells(digests: pa.Array, cells: int) -> np.ndarray:
    """A digest's cell in each row of the sketch, one line per row; rows lie one after the other."""
    flat = np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 4)
    return (flat & np.uint64(cells - 1)).astype(np.int64).T + cells * np.arange(SKETCH_ROWS)[:, None]


def _count(cells: int):
    """Per task: a sketch of its prefixes. Cells stop at two, as only 'one' and 'more' matter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH_ROWS * cells, np.uint8)
        for batch in batches:
            if batch.num_rows:
                at, times = np.unique(_cells(batch.column(0), cells), return_counts=True)
                sketch[at] = np.minimum(sketch[at] + np.minimum(times, 2), 2)
        for piece, part in enumerate(np.split(sketch, max(1, len(sketch) // PIECE))):
            if part.any():
                yield _piece(piece, part)

    return count


def _piece(number: int, part: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["piece", "cells"]
    )


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, number = None, 0
    for batch in batches:
        for number, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(zlib.decompress(packed), np.uint8)
            total = part if total is None else np.minimum(total + part, 2)
    yield _piece(number, total)


def crowded_cells(digests: DataFrame, cells: int) -> np.ndarray:
    """The sketch's cells that count more than one prefix, as packed bits: cells / 2 bytes."""
    parts = digests.mapInArrow(_count(cells), SKETCH).groupBy("piece").applyInArrow(_add_up, SKETCH)
    width = min(PIECE, SKETCH_ROWS * cells)
    packed = np.zeros(SKETCH_ROWS * cells // 8, np.uint8)
    for row in parts.toLocalIterator():
        part = np.frombuffer(zlib.decompress(bytes(row.cells)), np.uint8)
        packed[row.piece * width // 8 : (row.piece + 1) * width // 8] = np.packbits(part > 1)
    return packed


def _screen(crowded, cells: int):
    """Add whether the estimate for a prefix, and for the prefix before it, is one."""

    def alone(digests: pa.Array) -> np.ndarray:
        at = _cells(digests, cells)
        return ~((crowded.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool).all(axis=0)

    def screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name) for name in ("node", "parent")]
            flags = [pa.array(alone(c) if batch.num_rows else [], pa.bool_()) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *flags], [*batch.schema.names, "alone", "parent_alone"]
            )

    return screen


def _digest(depth: Column, lanes: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat_ws(",", depth.cast("string"), *(c.cast("string") for c in lanes)), 256))


def prefixes(scratch: Scratch, turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Every prefix of every conversation: conv_id, depth, node, parent (digests), words, is_end.

    ``turns`` has conv_id, depth (1, 2, ...), role and text, ``convs`` each conv_id once. Depth 0
    is the root, which all conversations have, those without a turn too.
    """
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    placed = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), said), 256)
    digits, size = LANE_BITS // 4, 1 << LANE_BITS
    lanes = [f"lane{i}" for i in range(LANES)]
    thin = turns.select(
        "conv_id", F.col("depth").cast("long").alias("depth"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"), placed.alias("placed"),
    )
    thin = thin.select(
        "conv_id", "depth", "words",
        *(F.conv(F.substring("placed", 1 + digits * i, digits), 16, 10).cast("long").alias(c) for i, c in enumerate(lanes)),
        *(F.conv(F.substring("placed", 1 + digits * i, digits), 16, 10).cast("long").alias(f"own_{c}")
          for i, c in enumerate(lanes)),
    )
    summed = running_sums(scratch, thin, "conv_id", "depth", lanes, size)
    before = [(F.col(c) - F.col(f"own_{c}") + size) % size for c in lanes]
    root = _digest(F.lit(0), [F.lit(0)] * LANES)
    rows = summed.select(
        "conv_id", "depth",
        _digest(F.col("depth"), [F.col(c) for c in lanes]).alias("node"),
        _digest(F.col("depth") - 1, before).alias("parent"),
        "words",
    )
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), root.alias("node"), root.alias("parent"), zero.alias("words"))
    rows = rows.unionByName(roots)
    # A conversation's last prefix is joined back by conversation and depth, which is no hot key.
    rows = scratch.stage(rows, "prefix_rows")
    ends = rows.groupBy("conv_id").agg(F.max("depth").alias("depth")).withColumn("end", F.lit(True))
    rows = attach(rows, ends, "conv_id", "depth").withColumn("is_end", F.coalesce("end", F.lit(False))).drop("end")
    return scratch.stage(rows, "prefixes")


@dataclass(frozen=True)
class Trie:
    """``nodes``: a row per node. ``ends``: (node, conv_id), where each conversation that shares its
    last node with others, or might have, ends; node rows that are alone carry it as ``is_end``."""

    nodes: DataFrame
    ends: DataFrame


def trie(scratch: Scratch, turns: DataFrame, convs: DataFrame) -> Trie:
    """The prefix trie of numbered turns; see ``prefixes`` for what goes in, ``prefix_trie`` for what comes out."""
    spark = turns.sparkSession
    bound_batches(spark)
    rows = prefixes(scratch, turns, convs)
    deep = rows.where("depth > 0").select("node")
    cells = sketch_cells(deep.count())
    crowded = spark.sparkContext.broadcast(crowded_cells(deep, cells))
    # The root is never alone: it is where the counts of all conversations meet.
    screened = rows.mapInArrow(
        _screen(crowded, cells),
        "conv_id long, depth long, node binary, parent binary, words long, is_end boolean, "
        "alone boolean, parent_alone boolean",
    ).select(
        "conv_id", "depth", "node", "parent", "words", "is_end",
        (F.col("alone") & (F.col("depth") > 0)).alias("alone"),
        (F.col("parent_alone") & (F.col("depth") > 1)).alias("parent_alone"),
    )
    screened = scratch.stage(screened, "screened")
    # What follows a proven single is alone too, also where the cells of the sketch happen to be
    # crowded. So a conversation has one tail at most, from its first proven single to its end.
    heads = screened.where("alone and not parent_alone").groupBy("conv_id")
    tails = heads.agg(F.min("depth").alias("depth"), F.min_by("parent", "depth").alias("parent"))
    tails = scratch.stage(tails, "tails")
    begun = tails.select(F.col("conv_id").alias("_tail"), F.col("depth").alias("_from"))
    others = screened.where("not alone").join(begun, F.col("conv_id") == F.col("_tail"), "left")
    others = scratch.stage(others.drop("_tail"), "others")
    shared = others.where("_from is null or depth < _from")
    single = screened.where("alone").unionByName(others.where("depth > _from").drop("_from"))
    grouped = scratch.stage(
        shared.groupBy("node").agg(
            F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent").alias("parent"),
            F.max("words").alias("words"), F.count("*").alias("n_convs"),
        ),
        "grouped",
    )
    # Every node below a shared one: shared itself, or the head of a tail.
    below = grouped.where("depth > 0").select("conv_id", "depth", "parent").unionByName(tails)
    below = scratch.stage(below, "below")
    children = below.groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "node")
    nodes = attach(grouped, children, "node").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = scratch.stage(nodes, "nodes")

    # A node's leaf and saving are booked once, with its smallest member at the node's depth; a
    # tail's leaf at the last shared prefix before it. Summed along a conversation from its end,
    # then over the members of a node, they are the sums over the node's subtree.
    booked = nodes.select(
        "conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    ).unionByName(tails.select(
        "conv_id", (F.col("depth") - 1).alias("depth"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
    ))
    sums = ["n_leaves", "saved_tokens"]
    booked = booked.groupBy("conv_id", "depth").agg(*(F.sum(c).alias(c) for c in sums))
    along = attach(shared.select("conv_id", "depth", "node"), booked, "conv_id", "depth")
    along = along.withColumns({c: F.coalesce(c, F.lit(0)) for c in sums})
    along = running_sums(scratch, along, "conv_id", "depth", sums, up=False)
    subtrees = along.groupBy("node").agg(*(F.sum(c).alias(c) for c in sums))

    above = nodes.select(F.col("node").alias("_above"), F.col("conv_id").alias("parent_conv_id"))
    named = below.join(above, below.parent == F.col("_above")).select("conv_id", "depth", "parent_conv_id")
    named = scratch.stage(named, "named")
    inner = attach(attach(nodes, subtrees, "node"), named, "conv_id", "depth").select(
        "node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.lit(False).alias("alone"), F.lit(None).cast("boolean").alias("is_end"),
    )
    # A proven single is a node as it stands: its members, children and leaves are its own conversation.
    singles = attach(single, named, "conv_id", "depth")
    one = F.lit(1).cast("long")
    singles = singles.select(
        "node", "conv_id", "depth", F.coalesce("parent_conv_id", "conv_id").alias("parent_conv_id"),
        one.alias("n_convs"), F.when(F.col("is_end"), 0).otherwise(1).cast("long").alias("n_children"),
        one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.lit(True).alias("alone"), "is_end",
    )
    return Trie(inner.unionByName(singles), shared.where("is_end").select("node", "conv_id"))


def numbered_turns(
    scratch: Scratch, turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, depth (1, 2, ... by turn), role and text; nulls in role and text are empty."""
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    placed = positions(scratch, rows, "conv_id", ["turn", "role", "text"], "place")
    return placed.select("conv_id", (F.col("place") + 1).alias("depth"), "role", "text")


def prefix_trie(
    scratch: Scratch, turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> Trie:
    """The prefix trie of conversations: what could be computed once for all that begin alike.

    Columns of ``nodes``: node (digest), conv_id (smallest member), depth, parent_conv_id (the
    parent's smallest member; null at the root), n_convs (members), n_children, n_leaves (nodes
    without children in the subtree), saved_tokens (over the subtree, members but one times words
    of the last turn), alone (proven so by the sketch), is_end (of those, whether the
    conversation ends there).

    Defined results: turns are taken in order, nulls first, turns of equal number by role and
    text. A null role or text counts as empty. Rows without a conv_id are left out. Repeated rows
    are further turns. Texts may be of any length; they are read once. An empty table gives an
    empty trie, without a root. Other columns are left out.
    """
    numbered = scratch.stage(numbered_turns(scratch, turns, conv_id, turn, role, text), "numbered")
    return trie(scratch, numbered, numbered.where("depth = 1").select("conv_id"))


def ends_sha256(scratch: Scratch, ends: DataFrame) -> DataFrame:
    """(key, sha256): the conversations that end in a node, ascending, joined by commas."""
    placed = positions(scratch, ends, "node", ["conv_id"], "place").withColumn("id", F.col("conv_id").cast("string"))
    return joined_sha256(placed, "node", F.floor(F.col("place") / BLOCK), ["place"], "id", ",")
