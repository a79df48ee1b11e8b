"""Exact distinct counts that roll up: stored bitmaps of dense numbers.

A count of distinct players per year says nothing about the distinct players of all years. A
bitmap of their numbers does: bitmaps of groups are merged by OR, whatever the groups, and counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonmart.sources.sinks import Materialize

NUMBER, BUCKET, BITS = "number", "bucket", "bits"


def numbered_values(df: DataFrame, column: str, materialize: Materialize, ranges: int | None = None) -> DataFrame:
    """The distinct values of a column, nulls left out, with numbers from 0 without gaps: (column, number).

    Values are sorted by ranges and numbered in each; a range's first number is the size of those
    before it, a sum over one row per range. No task sees more than a range.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    dealt = values.repartitionByRange(ranges, column).withColumn("_range", F.spark_partition_id())
    # Written first: where a range begins and ends must not change between its two uses.
    dealt = materialize(dealt, f"{column}_ranges")
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(column))
    numbers = dealt.withColumn("_within", within).join(before, "_range")
    return numbers.select(column, (F.col("_before") + F.col("_within") - 1).alias(NUMBER))


def value_bitmaps(df: DataFrame, keys: Sequence[str], number: str = NUMBER) -> DataFrame:
    """One row per group and bucket of numbers: the keys, bucket, and which numbers of it occur (null: none)."""
    value = F.col(number).cast("long")
    placed = df.where(value.isNotNull()).select(
        *keys, F.bitmap_bucket_number(value).alias(BUCKET), F.bitmap_bit_position(value).alias("_position")
    )
    return placed.groupBy(*keys, BUCKET).agg(F.bitmap_construct_agg("_position").alias(BITS))


def rolled_up(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups, merged from finer ones."""
    return bitmaps.groupBy(*keys, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many different values each group has, from bitmaps of finer groups."""
    merged = rolled_up(bitmaps, keys).select(*keys, F.bitmap_count(BITS).alias("_n"))
    return merged.groupBy(*keys).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(name))
