"""Places, running sums and digests in the order of a group's rows, whatever the size of a group."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonmart.llm.common import bound_batches, fresh, with_columns
from seasonmart.sources.sinks import Scratch

#: Rows of a group that are handled together. Larger groups are cut into blocks of this many rows.
BLOCK = 512
#: Bytes after which a piece of joined texts is handed on.
PIECE_BYTES = 1 << 20


def _count_runs(key: int):
    """Add to each row of a sorted range the range's number and the row's place among equal keys."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, place = TaskContext.get().partitionId(), object(), -1
        for batch in batches:
            places = []
            for value in batch.column(key).to_pylist():
                place = place + 1 if value == last else 0
                last = value
                places.append(place)
            more = [pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *_names(batch.schema.names)])

    return count


def _names(taken: list[str]) -> tuple[str, str]:
    return fresh(taken, "_range"), fresh(taken, "_place")


def _own(name: str, what: str) -> str:
    return f"{name}_{what}_{uuid.uuid4().hex}"


def positions(scratch: Scratch, df: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: each row's place, from 0, among the rows of its ``key`` by ascending ``order``.

    The whole table is sorted by ranges of key and order, so a hot key lies in many ranges. Each
    range counts on its own; of the ranges that begin inside a key, at most one per range, it is
    then added what earlier ones hold of that key. Nulls come first, a null key is a key of its
    own, and equal rows get their places in any order.
    """
    spark = df.sparkSession
    bound_batches(spark)
    ranges, tie = int(spark.conf.get("spark.sql.shuffle.partitions")), fresh(df.columns, "_tie")
    part, place = _names(df.columns)
    by = [key, *order, tie]
    ordered = df.withColumn(tie, F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(ranges, *by).sortWithinPartitions(*by).drop(tie)
    schema = with_columns(ordered, {part: "int", place: "long"})
    counted = scratch.stage(ordered.mapInArrow(_count_runs(df.columns.index(key)), schema), _own(name, "ranges"))
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = counted.groupBy(F.col(key).alias("_key"), F.col(part).alias("_part")).agg(F.count("*").alias("_n"))
    before = held.withColumn("_before", F.sum("_n").over(earlier)).where("_before is not null").drop("_n")
    before = scratch.stage(before, _own(name, "before"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(part) == F.col("_part"))
    return (
        counted.join(before, same, "left")
        .withColumn(name, F.col(place) + F.coalesce("_before", F.lit(0)))
        .drop(part, place, "_key", "_part", "_before")
    )


def running_sums(
    scratch: Scratch, df: DataFrame, key: str, position: str, sums: list[str], modulus: int | None = None, up: bool = True
) -> DataFrame:
    """``df`` with each column of ``sums`` replaced by its sum over the key's rows up to the row itself.

    With ``up`` false the sum is over the row itself and those of larger ``position``. Positions
    of a key differ and are cut into blocks, each summed by itself; the blocks' totals are summed
    in turn. A key with a third of all rows is as many blocks as it needs.
    """
    block = fresh(df.columns, "_block")
    blocked = scratch.stage(df.withColumn(block, F.floor(F.col(position) / BLOCK)), _own(position, "blocks"))

    def wrapped(total: Column) -> Column:
        return total % modulus if modulus else total

    totals = blocked.groupBy(F.col(key).alias("_key"), F.col(block).alias("_at")).agg(
        *(wrapped(F.sum(c)).alias(f"_total_{c}") for c in sums)
    )
    toward = F.col("_at") if up else F.col("_at").desc()
    others = Window.partitionBy("_key").orderBy(toward).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "_key", "_at", *(wrapped(F.sum(f"_total_{c}").over(others)).alias(f"_total_{c}") for c in sums)
    ).where(F.col(f"_total_{sums[0]}").isNotNull())
    before = scratch.stage(before, _own(position, "before"))
    inside = Window.partitionBy(key, block).orderBy(F.col(position) if up else F.col(position).desc())
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = blocked.withColumns({c: F.sum(c).over(inside) for c in sums})
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(block) == F.col("_at"))
    joined = summed.join(before, same, "left")
    full = {c: wrapped(F.col(c) + F.coalesce(F.col(f"_total_{c}"), F.lit(0))) for c in sums}
    return joined.withColumns(full).drop(block, "_key", "_at", *(f"_total_{c}" for c in sums))


def _pieces(separator: bytes):
    """Join the values of each (key, block) to pieces of about ``PIECE_BYTES``."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, number, parts, size = None, 0, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"key": group[0], "block": group[1], "piece": number, "joined": separator.join(parts)}],
                pa.schema({"key": key_type, "block": pa.int64(), "piece": pa.int64(), "joined": pa.binary()}),
            )

        for batch in batches:
            key_type = batch.column(0).type
            for key, block, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if group != (key, block) or size >= PIECE_BYTES:
                    if parts:
                        yield piece()
                    number = number + 1 if group == (key, block) else 0
                    group, parts, size = (key, block), [], 0
                value = value.encode()
                parts.append(value)
                size += len(value) + len(separator)
        if parts:
            yield piece()

    return pieces


def _digests(separator: bytes):
    """Read each key's pieces one after the other into a hash."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, found = None, None, []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in found], key_type), pa.array([d for _, d in found], pa.string())],
                ["key", "sha256"],
            )

        for batch in batches:
            key_type = batch.column(0).type
            for key, joined in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if state is None or key != last:
                    if state is not None:
                        found.append((last, state.hexdigest()))
                    last, state = key, hashlib.sha256()
                else:
                    state.update(separator)
                state.update(joined)
            if len(found) > 1000:
                yield done()
                found = []
        if state is not None:
            found.append((last, state.hexdigest()))
            yield done()

    return digests


def joined_sha256(df: DataFrame, key: str, block: Column, order: list[str], value: str, separator: str) -> DataFrame:
    """The SHA-256 of each key's values, in order and joined, as rows (key, sha256).

    ``block`` grows with ``order`` and holds a bounded number of rows. Blocks are joined where
    they lie, in pieces of bounded size. A hash has to read them in turn, so the pieces of a key
    come to one task, which reads each once and keeps none.
    """
    bound_batches(df.sparkSession)
    kind, mark = df.schema[key].dataType.simpleString(), separator.encode()
    rows = df.select(F.col(key).alias("key"), block.cast("long").alias("block"), F.col(value).alias("value"), *order)
    rows = rows.repartition("key", "block").sortWithinPartitions("key", "block", *order)
    pieces = rows.select("key", "block", "value").mapInArrow(
        _pieces(mark), f"key {kind}, block long, piece long, joined binary"
    )
    pieces = pieces.repartition("key").sortWithinPartitions("key", "block", "piece")
    return pieces.select("key", "joined").mapInArrow(_digests(mark), f"key {kind}, sha256 string")
