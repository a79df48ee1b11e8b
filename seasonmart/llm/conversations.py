"""The queries on conversations: prefix trie and repair, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonmart.llm.common import table
from seasonmart.llm.conversation_repair import attach, repair, repaired_sha256
from seasonmart.llm.conversations_sql import REPAIR, TRIE
from seasonmart.llm.prefix_trie import ends_sha256, numbered_turns, trie
from seasonmart.sources.sinks import Scratch, stage


def _or_space(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """The turns with faults put in by a hash of conversation and turn, as the repair's query wants them."""
    draw = F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn"))) % 20
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("draw") == 4, "user").otherwise(F.col("role"))
    rows = turns.select(
        "conv_id", "turn", _or_space("role").alias("role"), _or_space("text").alias("text"), draw.alias("draw")
    ).where("draw <> 0")
    twice = F.array_repeat(F.lit(0), F.when(F.col("draw") == 3, 2).otherwise(1))
    return rows.withColumn("copy", F.explode(twice)).select("conv_id", "turn", role.alias("role"), text.alias("text"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Damaged conversations, what is wrong with each, and the cheapest repair."""
    turns = table(spark, folder, "conversations")
    with Scratch(spark, "conversation_repair") as scratch:
        found = repair(scratch, damaged(turns))
        digests = repaired_sha256(found.turns).withColumnRenamed("key", "conv_id")
        whole = attach(attach(turns.select("conv_id").distinct(), found.report, "conv_id"), digests, "conv_id")
        counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        result = whole.select(
            "conv_id",
            *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
        return stage(result, "conversation_repair")


#: A conversation's first turns are taken from the first conversation of its group of this size.
GROUP = 20
#: At most so many turns, less one, are taken.
HEADS = 4


def rebuilt(scratch: Scratch, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of another one, as the trie's query wants them.

    Of numbered ``turns``, the first h of each conversation are replaced by the first h of the
    conversation that its group of ``GROUP`` begins with, h from a hash of its number. Returns
    turns and conversations; with nothing to take and nothing left, a conversation has no turn.
    """
    drawn = F.crc32(F.col("conv_id").cast("string")) % HEADS
    convs = turns.where("depth = 1").select("conv_id", drawn.alias("h"))
    heads = turns.where((F.col("conv_id") % GROUP == 0) & (F.col("depth") < HEADS))
    heads = scratch.stage(heads, "heads")
    of_group = heads.withColumnRenamed("conv_id", "first")
    first = F.col("conv_id") - F.col("conv_id") % GROUP
    taken = convs.join(of_group, (first == F.col("first")) & (F.col("depth") <= F.col("h"))).drop("first", "h")
    # Staged, so that the join below shuffles both sides anew and a hot conversation can be split.
    sizes = heads.groupBy(F.col("conv_id").alias("first")).agg(F.max("depth").alias("size"))
    sizes = scratch.stage(sizes, "sizes")
    rest = turns.withColumn("h", drawn).where("depth > h").join(sizes, first == F.col("first"), "left")
    moved = F.col("depth") - F.col("h") + F.least("h", F.coalesce("size", F.lit(0)))
    rest = rest.select("conv_id", moved.alias("depth"), "role", "text")
    return taken.select(*rest.columns).unionByName(rest), convs.select("conv_id")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The prefix trie of rebuilt conversations."""
    turns = table(spark, folder, "conversations")
    with Scratch(spark, "prefix_trie") as scratch:
        numbered = scratch.stage(numbered_turns(scratch, turns), "numbered")
        found = trie(scratch, *rebuilt(scratch, numbered))
        digests = ends_sha256(scratch, found.ends).withColumnRenamed("key", "node")
        alone = F.sha2(F.when(F.col("is_end"), F.col("conv_id").cast("string")).otherwise(""), 256)
        nodes = attach(found.nodes, digests, "node")
        result = nodes.select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.when(F.col("alone"), alone).otherwise(F.coalesce("sha256", F.sha2(F.lit(""), 256))).alias("ends_sha256"),
        )
        return stage(result, "prefix_trie")


QUERIES = {"op11_prefix_trie": op11_prefix_trie, "op13_conversation_repair": op13_conversation_repair}
SQL = {"op11_prefix_trie": TRIE, "op13_conversation_repair": REPAIR}
