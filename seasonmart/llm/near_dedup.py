"""Operator 10: groups of near copies by SuperMinHash, banding, verification and union-find."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonmart.llm.common import bound_batches, fresh, frugal, held, text_or_empty
from seasonmart.llm.components import EDGES, UnionFind, components
from seasonmart.llm.superminhash import (
    BANDS,
    SHINGLE,
    SLOTS,
    WordHashes,
    band_keys,
    compact,
    shingle_set,
    signatures,
)
from seasonmart.sources.sinks import Scratch, stage

#: Two texts are linked if their shingles' Jaccard similarity is at least this many per cent.
PERCENT = 80
#: Equal slots of a pair that is worth checking in full. Of 128, a pair of similarity 0.8 has 102
#: on average, with a deviation of 4.5 at most: fewer than 78 happen once in 10 million pairs.
MIN_EQUAL_SLOTS = 78
#: Members of a bucket that are compared with each other in one step, and their shingles in all.
CHUNK, CHUNK_SHINGLES = 512, 100_000


def _hashes() -> WordHashes:
    """One per worker, so that known words outlive a task."""
    return held("word hashes", WordHashes)


def _fingerprint(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").to_pylist()]


SIGNED = "doc_id long, n_shingles long, node binary, signature binary, bands array<long>"


def _sign(size: int):
    """Per document: size and fingerprint of its shingle set, signature and band keys."""

    def run(batches):
        hashes = _hashes()
        for batch in batches:
            sets = [shingle_set(text, hashes, size) for text in _texts(batch)]
            if not sets:
                continue
            found = signatures(sets)
            there = [len(s) > 0 for s in sets]
            marks = compact(found)
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(band_keys(found).ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_fingerprint(s) if t else None for s, t in zip(sets, there)], pa.binary()),
                    pa.array([m.tobytes() for m in marks], pa.binary()),
                    bands,
                ],
                ["doc_id", "n_shingles", "node", "signature", "bands"],
            )

    return run


def _full_sets(size: int):
    """Per document: the fingerprint of its shingle set, and the sorted set."""

    def run(batches):
        hashes = _hashes()
        for batch in batches:
            sets = [shingle_set(text, hashes, size) for text in _texts(batch)]
            columns = [
                pa.array([_fingerprint(s) for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["node", "shingles"])

    return run


def _linked(percent: int):
    """The pairs whose full sets are similar enough."""

    def run(batches):
        for batch in batches:
            a, b, left, right = (batch.column(c).to_pylist() for c in ("a", "b", "set_a", "set_b"))
            kept = [i for i in range(batch.num_rows) if _similar(left[i], right[i], percent)]
            columns = [pa.array([x[i] for i in kept], pa.binary()) for x in (a, b)]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return run


def _similar(a: bytes, b: bytes, percent: int) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _sets(scratch: Scratch, wanted: DataFrame, texts: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """The full sets of the wanted nodes, made again from the text of one document of each."""
    ids = scratch.stage(nodes.join(wanted, "node").select("first_id"), "wanted")
    chosen = texts.join(ids, texts.doc_id.eqNullSafe(ids.first_id), "left_semi")
    sets = chosen.select(F.col("text").cast("binary").alias("text")).mapInArrow(
        _full_sets(size), "node binary, shingles binary"
    )
    # A doc_id can occur with several texts; what nobody wants falls out in later joins.
    return scratch.stage(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")


def _cross_links(percent: int):
    """Links between a bucket's members that are still in different components.

    A row holds a chunk of members and a chunk to compare it with (none: with itself). Signatures
    tell which pairs are worth a look at their full sets. A pair that shares several buckets is
    looked at in the first of their bands only, and not at all if links found in the same row
    already connect it.
    """

    def run(batches):
        for batch in batches:
            found = ([], [])
            for row in batch.to_pylist():
                for a, b in _links(row["members"], row["others"], row["band_key"], percent):
                    found[0].append(a)
                    found[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in found], ["a", "b"])

    return run


def _links(members: list[dict], others: list[dict] | None, key: int, percent: int):
    left, right = members, members if others is None else others
    marks = np.frombuffer(b"".join(m["signature"] for m in right), "<u2").reshape(-1, SLOTS)
    sizes = np.array([m["n_shingles"] for m in right])
    bands = np.array([m["bands"] for m in right], np.int64)
    # The center has been compared with all of its bucket before.
    usable = np.array([not m["center"] for m in right])
    number = {root: i for i, root in enumerate({m["root"] for m in (*left, *right)})}
    root = np.array([number[m["root"]] for m in right])
    united = UnionFind()
    for i, member in enumerate(left):
        if member["center"]:
            continue
        n, own = member["n_shingles"], number[member["root"]]
        alike = 100 * np.minimum(n, sizes) >= percent * np.maximum(n, sizes)
        use = alike & usable & (root != own)
        if others is None:
            use[: i + 1] = False
        at = np.flatnonzero(use)
        mark = np.frombuffer(member["signature"], "<u2")
        at = at[(marks[at] == mark).sum(axis=1) >= MIN_EQUAL_SLOTS]
        if not len(at):
            continue
        band = np.array(member["bands"], np.int64)
        at = at[band[(bands[at] == band).argmax(axis=1)] == key]
        for j in at:
            if united.find(own) == united.find(int(root[j])):
                continue
            if _similar(member["shingles"], right[j]["shingles"], percent):
                united.join(own, int(root[j]))
                yield member["node"], right[j]["node"]


def _unsettled(
    scratch: Scratch, members: DataFrame, roots: DataFrame, nodes: DataFrame, sets: DataFrame
) -> DataFrame:
    """Chunks of bucket members that are still in different components, paired for comparison.

    A small bucket is one chunk. In a larger one each member outside the largest component is
    compared with all members; members of the largest component are not compared with each other.
    A chunk holds about ``CHUNK`` members and ``CHUNK_SHINGLES`` shingles at most, so no task holds
    a whole large bucket.
    """
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = scratch.stage(placed, "placed")
    by_root = placed.groupBy("band_key", "root").agg(
        F.count("*").alias("n"), F.sum("n_shingles").alias("shingles")
    )
    buckets = by_root.groupBy("band_key").agg(
        F.max(F.struct("n", "root", "shingles")).alias("largest"), F.sum("n").alias("n"),
        F.sum("shingles").alias("shingles"), F.count("*").alias("roots"),
    )

    def chunks_for(n, shingles):
        return F.greatest(F.ceil(n / CHUNK), F.ceil(shingles / CHUNK_SHINGLES)).cast("int")

    n, shingles = F.col("largest.n"), F.col("largest.shingles")
    small = (F.col("n") <= CHUNK) & (F.col("shingles") <= CHUNK_SHINGLES)
    minor_chunks = chunks_for(F.col("n") - n, F.col("shingles") - shingles)
    # Of two members one is the center, so they have been compared already.
    mixed = buckets.where("roots > 1 and n > 2").select(
        "band_key",
        F.when(~small, F.col("largest.root")).alias("largest"),
        F.when(small, 1).otherwise(minor_chunks).alias("minor_chunks"),
        chunks_for(n, shingles).alias("major_chunks"),
    )
    mixed = scratch.stage(mixed, "mixed")
    detail = nodes.select("node", "signature", "bands").join(sets, "node")
    open_members = placed.join(mixed, "band_key").join(detail, "node")
    minor = F.col("largest").isNull() | (F.col("root") != F.col("largest"))
    chunks = F.when(minor, F.col("minor_chunks")).otherwise(F.col("major_chunks"))
    member = F.struct("node", "root", "center", "n_shingles", "signature", "bands", "shingles")
    packed = (
        open_members.withColumn("minor", minor)
        .withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
        .groupBy("band_key", "minor", "chunk", "minor_chunks")
        .agg(F.collect_list(member).alias("members"))
    )
    packed = scratch.stage(packed, "packed")
    minors = packed.where("minor")
    itself = minors.select("band_key", "members", F.lit(None).cast(dict(packed.dtypes)["members"]).alias("others"))
    # Every other chunk goes to each of the minor chunks it is compared with: later ones, if minor.
    target = F.sequence(F.lit(0), F.col("minor_chunks") - 1)
    target = F.when(F.col("minor"), F.filter(target, lambda t: t > F.col("chunk"))).otherwise(target)
    sent = packed.select("band_key", F.explode(target).alias("chunk"), F.col("members").alias("others"))
    crossed = minors.select("band_key", "chunk", "members").join(sent, ["band_key", "chunk"])
    return itself.union(crossed.select("band_key", "members", "others"))


def near_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Texts whose sets of ``size``-word shingles have a Jaccard similarity of ``percent`` or more are
    linked; component_id is the smallest doc_id that can be reached over links, and the document
    of that id is kept.

    Texts with equal sets are one node from the start, however many they are. Nodes that agree in
    a band of their signatures share a bucket. Pairs within a bucket are not all listed:

    * Each member is compared with the bucket's smallest node on the full sets, and the links are
      united to components.
    * Where a bucket still has several components, each member outside the largest is compared
      with all others there, chunk by chunk: by signature, and on the full sets if they may be
      similar. So every pair that shares a band is either in one component or compared, and only
      links that connect components are handed on.

    Defined results: null and empty texts, and texts of white space, have no shingles, and are a
    component of their own; a text with fewer words than a shingle has its words as one shingle.
    Rows that repeat a text are linked. A null doc_id counts as no id: it is never the smallest,
    and a component without ids has component_id null and keeps all its rows. A doc_id that occurs
    with several texts stands for each of them separately. Texts of any length are taken whole. An
    empty table gives an empty result. Other columns are left out.

    Two steps rest on chance, with bounds for a pair of similarity 0.8 (more similar pairs fare
    better): it shares no band with probability 5e-8, and of 128 slots fewer than ``MIN_EQUAL_SLOTS``
    agree, so that the full sets are not looked at, with probability 1e-7.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    with Scratch(spark, "near_dedup") as scratch:
        signed = texts.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(frugal(_sign(size)), SIGNED)
        signed = scratch.stage(signed, "signed")
        nodes = signed.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"), F.first("bands").alias("bands"),
        )
        nodes = scratch.stage(nodes, "nodes")
        owners = scratch.stage(signed.select("doc_id", "n_shingles", "node"), "owners")
        scratch.drop("signed")

        banded = nodes.select("node", "n_shingles", F.explode("bands").alias("band_key"))
        buckets = banded.groupBy("band_key").agg(
            F.min(F.struct("node", "n_shingles")).alias("center"), F.count("*").alias("n")
        )
        buckets = scratch.stage(buckets.where("n > 1").drop("n"), "buckets")
        members = banded.join(buckets, "band_key").select(
            "band_key", "node", "n_shingles", F.col("center.node").alias("center_node"),
            F.col("center.n_shingles").alias("center_size"),
        )
        members = scratch.stage(members, "members")
        like = 100 * F.least("n_shingles", "center_size") >= percent * F.greatest("n_shingles", "center_size")
        stars = (
            members.where("node <> center_node").where(like)
            .select(F.col("center_node").alias("a"), F.col("node").alias("b")).distinct()
        )
        sets = _sets(scratch, members.select("node").distinct(), texts, nodes, size)
        with_b = stars.join(sets.toDF("b", "set_b"), "b")
        pairs = with_b.join(sets.toDF("a", "set_a"), "a").select("a", "b", "set_a", "set_b")
        links = scratch.stage(pairs.mapInArrow(frugal(_linked(percent)), EDGES), "star_links")
        roots = components(scratch, links, "stars")

        flagged = members.select(
            "band_key", "node", "n_shingles", (F.col("node") == F.col("center_node")).alias("center")
        )
        chunks = _unsettled(scratch, flagged, roots, nodes, sets)
        more = scratch.stage(chunks.mapInArrow(frugal(_cross_links(percent)), EDGES), "cross_links")
        for done in ("packed", "placed", "members", "sets"):
            scratch.drop(done)
        roots = components(scratch, links.union(more), "all")

        grouped = nodes.select("node", "first_id").join(roots, "node", "left").withColumn(
            "root", F.coalesce("root", "node")
        )
        grouped = scratch.stage(grouped, "grouped")
        smallest = scratch.stage(grouped.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
        ids = scratch.stage(grouped.join(smallest, "root").select("node", "component_id"), "ids")
        result = owners.join(ids, "node", "left")
        component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return stage(
            result.select(
                "doc_id", "n_shingles", component.alias("component_id"),
                F.col("doc_id").eqNullSafe(component).alias("kept"),
            ),
            "near_dedup",
        )


def without_near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; columns unchanged.

    Of rows that repeat a kept id all stay. Documents without an id stay.
    """
    groups = near_groups(docs, doc_id, text, size, percent)
    key = fresh(docs.columns, "_dropped")
    kept = groups.where("kept").select(F.col("doc_id").alias(key)).distinct()
    dropped = groups.where("not kept").select(F.col("doc_id").alias(key)).distinct()
    # An id with several texts may be kept for one of them and dropped for another; it stays.
    dropped = stage(dropped.join(kept, key, "left_anti"), "near_copies")
    return docs.join(dropped, F.col(f"`{doc_id}`") == F.col(key), "left_anti")
