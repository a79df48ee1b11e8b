"""Helpers that several of the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterable, Iterator, Mapping
from pathlib import Path
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from seasonmart.sources.sinks import Scratch

BATCH_BYTES = 4 << 20
#: Bytes of batches after which a task gives back what it has freed; small pieces scatter over the heap meanwhile.
GIVE_BACK_BYTES = 4 * BATCH_BYTES

T = TypeVar("T")


def bound_batches(spark: SparkSession) -> None:
    """Prepare a session for functions on Arrow batches.

    Batches stay small, also where rows hold very long texts, and workers on this machine find the
    package where the driver found it. On a cluster it has to be installed or sent along.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    environment, here = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([here, *paths])


def give_back() -> None:
    """Return what this worker has freed to the system: idle workers would keep it for the next task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries than glibc
        ctypes.CDLL(None).malloc_trim(0)


@contextlib.contextmanager
def uncollected() -> Iterator[None]:
    """Work on many small objects without cycles: the collector would go through them again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def frugal(run: Callable[[Iterator], Iterator], keep: bool = False) -> Callable[[Iterator], Iterator]:
    """A function on Arrow batches that gives memory back as it goes on and at the end of its task.

    What is ``held`` goes too, unless ``keep``: workers that are idle in later stages have no use for it.
    """

    def sparing(batches: Iterator) -> Iterator:
        seen = 0
        for batch in batches:
            seen += batch.nbytes
            yield batch
            if seen >= GIVE_BACK_BYTES:
                del batch
                give_back()
                seen = 0

    def mapped(batches: Iterator) -> Iterator:
        try:
            yield from run(sparing(batches))
        finally:
            if not keep:
                let_go()
            give_back()

    return mapped


_held: tuple[object, object] = (None, None)


def let_go() -> None:
    global _held
    _held = (None, None)


def held(key: object, make: Callable[[], T]) -> T:
    """What ``make`` gives, kept in this worker until another key is asked for or it is let go.

    Workers live on from task to task and from operator to operator. Tables of known words are
    worth keeping as long as one operator runs, but there must not be one for each.
    """
    global _held
    if _held[0] != key:
        _held = (None, None)
        give_back()
        _held = (key, make())
    return _held[1]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores in front until no column in ``taken`` is called so."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def with_columns(df: DataFrame, kinds: Mapping[str, str]) -> StructType:
    """The schema of ``df`` with more columns behind, for functions that add them to Arrow batches."""
    added = [StructField(name, DataType.fromDDL(kind)) for name, kind in kinds.items()]
    return StructType([*df.schema.fields, *added])


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def digest(text: Column) -> Column:
    """The text's SHA-256 as 32 bytes: equal for equal texts only."""
    return F.unhex(F.sha2(text, 256))


def numbered(
    scratch: Scratch, df: DataFrame, key: str, order: list[str], name: str, rows_per_bucket: int = 100_000
) -> DataFrame:
    """Number the rows of each ``key`` from 0 without gaps, whatever the size of a key.

    Rows are dealt over buckets by a hash of ``order``, so a hot key is spread evenly. A window
    numbers a key's rows in one bucket, and the key's rows in the buckets before it are added.
    ``name`` becomes the number's column; equal rows get their numbers in any order.
    """
    spark = df.sparkSession
    df = scratch.stage(df, f"{name}_rows")
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * slots, -(-df.count() // rows_per_bucket))
    bucket, before = fresh(df.columns, f"{name}_bucket"), fresh(df.columns, f"{name}_before")
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy(key, bucket).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sizes = scratch.stage(
        sizes.select(
            F.col(key).alias("_key"),
            F.col(bucket).alias("_bucket"),
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(before),
        ),
        f"{name}_sizes",
    )
    own = Window.partitionBy(bucket, key).orderBy(*order)
    at = F.col(key).eqNullSafe(F.col("_key")) & (F.col(bucket) == F.col("_bucket"))
    return (
        dealt.repartition(bucket)
        .withColumn(name, F.row_number().over(own).cast("long") - 1)
        .join(sizes, at)
        .withColumn(name, F.col(name) + F.col(before))
        .drop(bucket, before, "_key", "_bucket")
    )
