"""Operator 5: shards of near-equal size that keep copies of a text together."""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonmart.llm.common import digest, numbered, text_or_empty
from seasonmart.sources.sinks import Scratch, stage

SHARDS = 24
#: Bytes that a row takes besides its text.
ROW_BYTES = 8


class Runs:
    """Ordered group sizes as (size, number of groups of that size), largest size first."""

    def __init__(self, runs: list[tuple[int, int]]):
        self.sizes = [size for size, _ in runs]
        self.starts = list(accumulate((n for _, n in runs), initial=0))
        self.bytes_before = list(accumulate((size * n for size, n in runs), initial=0))

    @property
    def groups(self) -> int:
        return self.starts[-1]

    def place(self, group: int) -> tuple[int, int]:
        """Size of a group's run, and the group's number in that run."""
        run = bisect_right(self.starts, group) - 1
        return self.sizes[run], group - self.starts[run]

    def before(self, group: int) -> int:
        """Bytes of all groups before this one."""
        if group == self.groups:
            return self.bytes_before[-1]
        size, rank = self.place(group)
        return self.bytes_before[bisect_right(self.starts, group) - 1] + size * rank

    def reach(self, group: int, capacity: int) -> int:
        """The group that no longer fits into ``capacity`` if one starts with ``group``."""
        limit = self.before(group) + capacity
        run = bisect_right(self.bytes_before, limit) - 1
        if run == len(self.sizes):
            return self.groups
        return self.starts[run] + (limit - self.bytes_before[run]) // self.sizes[run]

    def fits(self, group: int, shards: int, capacity: int) -> bool:
        """Whether filling shard after shard gets to the end."""
        for _ in range(shards):
            group = self.reach(group, capacity)
        return group == self.groups


def smallest_capacity(runs: Runs, group: int, shards: int) -> int:
    """The smallest capacity with which all groups from ``group`` on fit into ``shards`` shards."""
    rest = runs.before(runs.groups) - runs.before(group)
    low, high = max(-(-rest // shards), runs.place(group)[0]), rest
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if runs.fits(group, shards, middle) else (middle + 1, high)
    return low


def cuts(runs: Runs, shards: int) -> list[int]:
    """The first group of each shard but the first.

    A shard is filled to the smallest capacity feasible for what is left, which is searched anew
    after each cut: a group too large to be matched by others fills the first shard alone and
    leaves the others even.
    """
    found, group = [], 0
    for left in range(shards, 1, -1):
        if group < runs.groups:
            group = runs.reach(group, smallest_capacity(runs, group, left))
        found.append(group)
    return found


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its shard, and its place there.

    Columns: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null), copies.
    Groups are the documents of equal text, ordered by their total size, largest first, groups of
    equal size by digest. Shards are stretches of that order with the smallest possible largest
    size. The driver sees how many groups have each size; with B bytes in all, that is at most
    sqrt(2 B) numbers, whatever the number of documents.

    Defined results: a null text counts as empty, also as a copy of empty texts. Repeated rows
    are copies, each with a slot of its own. A null doc_id stays null. With fewer groups than
    shards the last shards stay empty. A text of any length is one row of its size, and may fill a
    shard alone. An empty table gives an empty result. Other columns are left out.
    """
    spark = docs.sparkSession
    with Scratch(spark, "sharding") as scratch:
        value = text_or_empty(text)
        rows = docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            digest(value).alias("digest"),
            (F.octet_length(value) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(value).alias("text_crc32"),
        )
        rows = scratch.stage(rows, "rows")
        groups = rows.groupBy("digest").agg(F.count("*").alias("copies"), F.sum("size").alias("bytes"))
        groups = scratch.stage(groups, "groups")
        sizes = groups.groupBy("bytes").agg(F.count("*").alias("n")).orderBy(F.desc("bytes"))
        runs = Runs([(r.bytes, r.n) for r in sizes.collect()])
        starts = [runs.place(c) if c < runs.groups else (-1, 0) for c in cuts(runs, shards)]

        # Only where a cut falls among groups of equal size does their order matter.
        divided = sorted({size for size, rank in starts if rank})
        ranked = numbered(scratch, groups.where(F.col("bytes").isin(divided)), "bytes", ["digest"], "rank")
        whole = groups.where(~F.col("bytes").isin(divided)).withColumn("rank", F.lit(0).cast("long"))
        beyond = [
            ((F.col("bytes") < size) | ((F.col("bytes") == size) & (F.col("rank") >= rank))).cast("int")
            for size, rank in starts
        ]
        number = reduce(lambda a, b: a + b, beyond, F.lit(0))
        placed = whole.unionByName(ranked).select("digest", "copies", number.alias("shard"))
        placed = scratch.stage(placed, "placed")
        result = numbered(
            scratch, rows.join(placed, "digest"), "shard", ["doc_id", "digest"], "slot"
        ).select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
            F.lit(None).cast("int").alias("grown_shard"), "copies",
        )
        return stage(result, "sharding")
