"""Operator 3: exact nearest neighbours by inner product, in three phases with a uniform threshold."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonmart.llm.common import bound_batches, frugal
from seasonmart.sources.sinks import Scratch, stage

#: Vectors in a block, for either side of a block product. Blocks of long vectors have fewer.
QUERY_BLOCK, CANDIDATE_BLOCK = 256, 2048
BLOCK_BYTES = 8 << 20
#: Candidate blocks that meet a query block in one product.
BLOCKS_AT_ONCE = 4
#: Bytes that a task's packer keeps while it waits for blocks to fill: there may be one for each width.
PACK_BYTES = 16 << 20
#: Bytes of candidates in a group, the least and the most. A task keeps a group while all queries pass by.
GROUP_BYTES = 256 << 10, 32 << 20
#: Parts into which components are split; each part gives a score list per query.
LISTS = 2
#: Every LANES-th column of a product is one lane. The k-th best lane bounds the k-th best score.
LANES = 64
#: Entries of a row above that bound from which they are selected one row at a time: there are ties.
CROWD = 64
EXACT_FLOAT, EXACT_DOUBLE = 1 << 24, 1 << 53
DIGEST = 32
#: Stands for the score of an entry that is not there.
NOTHING = 1 - (1 << 63)


def quantized(vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null if the vector is null or holds no plain number."""
    as_double = F.transform(vector, lambda x: x.cast("double"))
    odd = F.exists(as_double, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(as_double, lambda x: F.floor(x * scale).cast("long"))
    return F.when(F.col(vector).isNotNull() & ~F.coalesce(odd, F.lit(False)), whole)


def _reach(x: np.ndarray) -> int:
    """The largest absolute value."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def _exact_kind(largest: int) -> type:
    """The fastest type in which sums that stay below ``largest`` are exact."""
    if largest >= 1 << 63:
        raise OverflowError("an inner product may not fit into a long")
    return np.float32 if largest < EXACT_FLOAT else np.float64 if largest < EXACT_DOUBLE else np.int64


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``."""
    kind = _exact_kind(_reach(a) * _reach(b) * a.shape[1])
    return a.astype(kind) @ b.astype(kind).T


def _scores(q: np.ndarray, c: np.ndarray, of: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Exact inner products of single pairs: of the rows ``of`` of ``q`` with the rows ``at`` of ``c``."""
    result, width = np.empty(len(of), np.int64), q.shape[1]
    step = _at_once(1 << 16, width)
    for start in range(0, len(of), step):
        a, b = q[of[start : start + step]], c[at[start : start + step]]
        largest = _reach(a) * _reach(b) * width
        if largest >= 1 << 63:  # by vectors that need not meet
            largest = max(_reach(x) * _reach(y) * width for x, y in zip(a, b))
        kind = _exact_kind(largest)
        result[start : start + step] = np.einsum("ij,ij->i", a.astype(kind), b.astype(kind))
    return result


def _parts(width: int, lists: int) -> list[slice]:
    edges = np.linspace(0, width, min(lists, max(1, width)) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def _at_once(most: int, width: int) -> int:
    """Vectors of a block: ``most``, or fewer long ones."""
    return max(1, min(most, BLOCK_BYTES // max(1, 8 * width)))


def _binary(digests: np.ndarray) -> pa.Array:
    data = pa.py_buffer(np.ascontiguousarray(digests).tobytes())
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(DIGEST), len(digests), [None, data]).cast(pa.binary())


def _packed(size: int):
    """Pack vectors of a width into blocks of ``size``, their numbers as short as they can be."""

    def block(width: int, pieces: list) -> pa.RecordBatch:
        keys, ids, vectors = (np.concatenate(x) for x in zip(*pieces))
        reach = _reach(vectors)
        digits = 2 if reach < 1 << 15 else 4 if reach < 1 << 31 else 8
        vectors = vectors.astype(f"i{digits}")
        row = [width, digits, keys.tobytes(), ids.tobytes(), vectors.tobytes()]
        types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=list(BLOCK_COLUMNS))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {}
        held = 0
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), f"V{DIGEST}")
            ids, lists = batch.column("first_id").to_numpy(), batch.column("vector")
            widths = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat, starts = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(widths) - widths
            for width in np.unique(widths).tolist():
                rows = np.flatnonzero(widths == width)
                vectors = flat[starts[rows][:, None] + np.arange(width)]
                step = _at_once(size, width)
                while len(rows):
                    pieces = kept.setdefault(width, [])
                    n = min(len(rows), step - sum(len(x[1]) for x in pieces))
                    pieces.append((keys[rows[:n]], ids[rows[:n]], vectors[:n]))
                    held += n * (DIGEST + 8 + 8 * width)
                    rows, vectors = rows[n:], vectors[n:]
                    if sum(len(x[1]) for x in pieces) == step:
                        held -= step * (DIGEST + 8 + 8 * width)
                        yield block(width, kept.pop(width))
            if held > PACK_BYTES:
                yield from (block(width, pieces) for width, pieces in kept.items())
                kept, held = {}, 0
        yield from (block(width, pieces) for width, pieces in kept.items())

    return run


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, smallest ids and vectors of a block."""
    keys, ids = np.frombuffer(row["keys"], f"V{DIGEST}"), np.frombuffer(row["ids"], np.int64)
    vectors = np.frombuffer(row["vectors"], f"i{row['digits']}") if row["width"] else np.empty(0, np.int64)
    return keys, ids, vectors.reshape(len(ids), row["width"])


def _meetings(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[dict, tuple, tuple]]:
    """Each query block's row and content, and the candidates of its group and width, which come before it."""
    place, kept = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if place != (place := (row["group"], row["width"])):
                kept = []
            if not row["is_query"]:
                kept.append(_unpacked(row))
            elif kept:
                if len(kept) > 1:
                    kept = [tuple(np.concatenate(x) for x in zip(*kept))]
                yield row, _unpacked(row), kept[0]


def _nothing(rows: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of the ``k`` best entries of each row, best first: score, what decides ties, place. None so far."""
    return np.full((rows, k), NOTHING), np.full((rows, k), -NOTHING), np.full((rows, k), -1)


def _enter(best: tuple, of: np.ndarray, score: np.ndarray, tie: np.ndarray, at: np.ndarray) -> None:
    """Enter entries of the rows ``of`` into their lists."""
    if not len(of):
        return
    rows, k = np.unique(of), best[0].shape[1]
    of = np.concatenate([of, np.repeat(rows, k)])
    entries = [np.concatenate([new, old[rows].ravel()]) for new, old in zip((score, tie, at), best)]
    order = np.lexsort((entries[1], -entries[0], of))
    chosen = order[(np.searchsorted(of[order], rows)[:, None] + np.arange(k)).ravel()]
    for lists, values in zip(best, entries):
        lists[rows] = values[chosen].reshape(-1, k)


def _enter_best(best: tuple, partial: np.ndarray, start: int) -> None:
    """Enter the best entries of each row of ``partial``, the columns from ``start`` on; of ties any will do."""
    k, width = best[0].shape[1], partial.shape[1]
    bound = (best[0][:, -1] + 1).astype(partial.dtype)
    if k <= LANES < width:
        lanes = partial[:, : width // LANES * LANES].reshape(len(partial), -1, LANES).max(axis=1)
        bound = np.maximum(bound, np.partition(lanes, LANES - k, axis=1)[:, LANES - k])
    of, at = np.divmod(np.flatnonzero(partial >= bound[:, None]), width)
    crowded = np.bincount(of, minlength=len(partial)) > max(CROWD, k)
    if crowded.any():
        few, rows = ~crowded[of], np.flatnonzero(crowded)
        top = np.argpartition(partial[rows], width - k, axis=1)[:, width - k :]
        of, at = np.concatenate([of[few], np.repeat(rows, k)]), np.concatenate([at[few], top.ravel()])
    _enter(best, of, partial[of, at].astype(np.int64), at + start, at + start)


def _local_lists(k: int, lists: int, size: int):
    """Phase 1: of each group and each part of the components, every query's best ``k``.

    The groups give the ``k`` best exact scores of what these lists hold, best first.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, (_, _, q), (_, _, c) in _meetings(batches):
            parts, step = _parts(q.shape[1], lists), _at_once(size, q.shape[1])
            best = [_nothing(len(q), k) for _ in parts]
            for start in range(0, len(c), step):
                for part, entries in zip(parts, best):
                    _enter_best(entries, _product(q[:, part], c[start : start + step, part]), start)
            tried = np.sort(np.concatenate([at for _, _, at in best], axis=1), axis=1)
            fresh = tried >= 0
            fresh[:, 1:] &= tried[:, 1:] != tried[:, :-1]
            of, place = np.nonzero(fresh)
            exact = _nothing(len(q), k)
            _enter(exact, of, _scores(q, c, of, tried[of, place]), tried[of, place], tried[of, place])
            values = [[row["keys"][:DIGEST]], [exact[0].tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in values], ["block", "scores"])

    return run


def _cutoffs(k: int):
    """The ``k``-th best exact score of each query of a block; rows of a block lie side by side."""

    def made(block: bytes, best: np.ndarray) -> pa.RecordBatch:
        values = [[block], [np.ascontiguousarray(best[:, -1]).tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in values], ["block", "cutoffs"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best = None, None
        for batch in batches:
            for row in batch.to_pylist():
                scores = np.frombuffer(row["scores"], np.int64).reshape(-1, k)
                if row["block"] == block:
                    best = -np.sort(-np.concatenate([best, scores], axis=1), axis=1)[:, :k]
                else:
                    if block is not None:
                        yield made(block, best)
                    block, best = row["block"], scores
        if block is not None:
            yield made(block, best)

    return run


def _above_cutoff(k: int, lists: int, size: int):
    """Phases 2 and 3: entries at or above a query's share of the cutoff, and their exact scores.

    If every part of an inner product lies below cutoff / parts, the product lies below the
    cutoff, so no other entry can matter. Of equal scores the smaller id is the better one.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, (q_keys, _, q), (c_keys, ids, c) in _meetings(batches):
            parts, step = _parts(q.shape[1], lists), _at_once(size, q.shape[1])
            cutoff = np.frombuffer(row["cutoffs"], np.int64)
            share = (cutoff // len(parts) + (cutoff % len(parts) > 0))[:, None]
            best = _nothing(len(q), k)
            for start in range(0, len(c), step):
                partial = [_product(q[:, part], c[start : start + step, part]) for part in parts]
                enough = reduce(np.logical_or, [x >= share.astype(x.dtype) for x in partial])
                found = np.flatnonzero(enough)
                of, at = np.divmod(found, enough.shape[1])
                at += start
                if any(x.dtype == np.int64 for x in partial):
                    score = _scores(q, c, of, at)
                else:
                    score = sum(x.ravel()[found].astype(np.int64) for x in partial)
                last, last_id = best[0][of, -1], best[1][of, -1]
                better = (score > last) | (score == last) & (ids[at] < last_id)
                of, at, score = (x[better & (score >= cutoff[of])] for x in (of, at, score))
                _enter(best, of, score, ids[at], at)
            of, place = np.nonzero(best[2] >= 0)
            found = [_binary(q_keys[of]), _binary(c_keys[best[2][of, place]]), pa.array(best[0][of, place])]
            yield pa.RecordBatch.from_arrays(found, ["query", "candidate", "score"])

    return run


BLOCK_COLUMNS = {"width": "int", "digits": "int", "keys": "binary", "ids": "binary", "vectors": "binary"}
BLOCKS = ", ".join(f"{name} {kind}" for name, kind in BLOCK_COLUMNS.items())
SCORES = "query binary, candidate binary, score long"


def _group_count(candidates: DataFrame) -> int:
    """Groups of candidate blocks: some for each slot, unless they would be larger or smaller than they may be."""
    size = F.coalesce(F.sum(F.length("keys") + F.length("ids") + F.length("vectors")), F.lit(0))
    blocks, held = candidates.agg(F.count("*"), size).first()
    least, most = GROUP_BYTES
    slots = candidates.sparkSession.sparkContext.defaultParallelism
    return max(1, min(blocks, max(-(-held // most), min(-(-held // least), 4 * slots))))


def _gathered(candidates: DataFrame, asked: DataFrame, groups: int) -> DataFrame:
    """Each group's candidate blocks with copies of all query blocks behind them, a task for each group."""
    kept = candidates.select(
        *BLOCK_COLUMNS, F.lit(None).cast("binary").alias("cutoffs"), F.lit(False).alias("is_query"),
        F.pmod(F.xxhash64("keys"), F.lit(groups)).cast("int").alias("group"),
    )
    sent = asked.select(
        *BLOCK_COLUMNS, "cutoffs", F.lit(True).alias("is_query"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
    )
    dealt = kept.unionByName(sent).repartitionById(groups, F.col("group"))
    return dealt.sortWithinPartitions("group", "width", "is_query")


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    lists: int = LISTS,
) -> DataFrame:
    """Each query's ``k`` best other rows: query_id, rank, vec_id, score.

    Scores are inner products of components floor(256 * x); ties go to the smaller vec_id. Rows
    of equal vectors are searched for once, so a vector that is very common costs no more: only
    its k + 1 smallest ids can be among the best. Distinct queries and distinct vectors are packed
    into blocks, and candidate blocks are dealt into groups. A task keeps one group while all query
    blocks pass by; these are shuffled, not joined, so none of them go through the driver.

    1. Each group gives every query's local list of best partial scores for each part of the
       components. The exact scores of what these lists hold have a k-th best: a safe cutoff.
    2. The cutoffs go to the groups (one number per query), which collect all entries with a
       partial score of at least cutoff / parts.
    3. Their remaining partial scores are resolved in the same place, where both vectors are;
       what reaches the cutoff is returned and ranked.

    Defined results: rows with a null id, and vectors that are null or hold null, NaN or infinite
    components take no part. Rows that repeat id and vector count once; a query never finds rows
    with its own id. Vectors are compared with those of the same length only. A score that could
    exceed a long raises. A query without candidates, or an empty table, gives no rows. Other columns
    are left out, whatever their names. Texts play no part.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    wanted = k + 1  # one of them may be the query itself
    with Scratch(spark, "top_k") as scratch:
        rows = vectors.select(
            F.col(vec_id).cast("long").alias("id"), quantized(vector).alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        ).where("id is not null and vector is not null")
        rows = rows.withColumn("key", F.unhex(F.sha2(F.to_json("vector"), 256)))
        rows = scratch.stage(
            rows.groupBy("key", "id").agg(F.first("vector").alias("vector"), F.max("is_query").alias("is_query")),
            "rows",
        )
        ranked = F.row_number().over(Window.partitionBy("key").orderBy("id"))
        distinct = (
            rows.select("key", "id", "vector").withColumn("rank", ranked).where(F.col("rank") <= wanted)
            .groupBy("key")
            .agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("vector").alias("vector"))
            .select("key", "ids", F.col("ids")[0].alias("first_id"), "vector")
        )
        distinct = scratch.stage(distinct, "distinct")
        queries = scratch.stage(rows.where("is_query").select("id", "key"), "queries")

        content = distinct.select("key", "first_id", "vector")
        candidates = scratch.stage(content.mapInArrow(frugal(_packed(CANDIDATE_BLOCK)), BLOCKS), "candidates")
        asked = content.join(queries, "key", "left_semi").mapInArrow(frugal(_packed(QUERY_BLOCK)), BLOCKS)
        # Keys are distinct, so a block's first key is its name.
        asked = scratch.stage(asked.withColumn("block", F.substring("keys", 1, DIGEST)), "asked")
        groups, size = _group_count(candidates), BLOCKS_AT_ONCE * CANDIDATE_BLOCK

        # Phase 1
        met = _gathered(candidates, asked.withColumn("cutoffs", F.lit(None).cast("binary")), groups)
        local = met.mapInArrow(frugal(_local_lists(wanted, lists, size)), "block binary, scores binary")
        local = local.repartition("block").sortWithinPartitions("block")
        cutoffs = scratch.stage(local.mapInArrow(_cutoffs(wanted), "block binary, cutoffs binary"), "cutoffs")

        # Phases 2 and 3
        met = _gathered(candidates, asked.join(cutoffs, "block"), groups)
        found = met.mapInArrow(frugal(_above_cutoff(wanted, lists, size)), SCORES)
        rank = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        top = (
            found.join(distinct.select(F.col("key").alias("candidate"), "ids"), "candidate")
            .select("query", "score", F.explode("ids").alias("id"))
            .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= wanted)
            .groupBy("query").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("best"))
        )
        top = scratch.stage(top.withColumnRenamed("query", "key"), "top")
        others = F.slice(F.filter("best", lambda x: x["id"] != F.col("query_id")), 1, k)
        result = (
            queries.select(F.col("id").alias("query_id"), "key").join(top, "key")
            .select("query_id", F.posexplode(others).alias("at", "hit"))
            .select(
                "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("vec_id"),
                F.col("hit.score").alias("score"),
            )
        )
        return stage(result, "top_k")
