"""Operator 6: exact copies, found with a Bloom filter so that only possible copies are shuffled."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonmart.llm.common import bound_batches, text_or_empty
from seasonmart.sources.sinks import Scratch, stage

#: Filter bits per document, and the bounds of a filter. With more documents than the largest
#: filter is made for, more of them are shuffled in vain; the result is the same.
BITS_PER_DOC = 16
MIN_BITS, MAX_BITS = 1 << 16, 1 << 29
#: Each hash sets this many bits.
PROBES = 3
#: Bits of the pieces in which filters travel and are merged.
SEGMENT_BITS = 1 << 16

FILTER_SCHEMA = "segment int, once binary, twice binary"


def filter_bits(docs: int) -> int:
    """A power of two, so that a digest's bits give a place without bias."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (BITS_PER_DOC * docs - 1).bit_length()))


def _places(digests: pa.Array, bits: int) -> np.ndarray:
    """The filter's bits for each 32-byte digest, one row per probe."""
    flat = np.frombuffer(b"".join(digests.to_pylist()), "<u8").reshape(-1, 4)
    return (flat[:, :PROBES] & np.uint64(bits - 1)).astype(np.int64).T


def _unpack(piece: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(piece), np.uint8)


def _pack(bits: np.ndarray) -> bytes:
    return zlib.compress(bits.tobytes(), 1)


def _fill(bits: int):
    """Per task: which bits its digests set once at least, and twice at least."""

    def fill(batches):
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for place in _places(batch.column(0), bits) if batch.num_rows else ():
                # One batch can set a bit several times.
                at, times = np.unique(place, return_counts=True)
                byte, bit = at >> 3, (128 >> (at & 7)).astype(np.uint8)
                again = (times > 1) | (once[byte] & bit > 0)
                np.bitwise_or.at(twice, byte[again], bit[again])
                np.bitwise_or.at(once, byte, bit)
        width, rows = SEGMENT_BITS // 8, []
        for segment in range(bits // SEGMENT_BITS):
            part = slice(segment * width, (segment + 1) * width)
            if once[part].any():
                rows.append((segment, _pack(once[part]), _pack(twice[part])))
        for start in range(0, len(rows), 64):
            yield _filter_batch(rows[start : start + 64])

    return fill


def _filter_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], ["segment", "once", "twice"]
    )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up a segment's filters, one after the other: a bit that two of them set is set twice."""
    segment, once = 0, np.zeros(SEGMENT_BITS // 8, np.uint8)
    twice = once.copy()
    for batch in batches:
        for segment, a, b in zip(*(column.to_pylist() for column in batch.columns)):
            a, b = _unpack(a), _unpack(b)
            twice |= b | (once & a)
            once |= a
    yield _filter_batch([(segment, _pack(once), _pack(twice))])


def repeated_bits(digests: DataFrame, bits: int) -> np.ndarray:
    """First pass: the bits that two digests or more set, as a packed array of bits / 8 bytes."""
    parts = digests.mapInArrow(_fill(bits), FILTER_SCHEMA)
    merged = parts.groupBy("segment").applyInArrow(_merge, FILTER_SCHEMA)
    packed = np.zeros(bits // 8, np.uint8)
    width = SEGMENT_BITS // 8
    for row in merged.select("segment", "twice").toLocalIterator():
        packed[row.segment * width : (row.segment + 1) * width] = _unpack(bytes(row.twice))
    return packed


def _suspects(packed, bits: int):
    """Second pass: add to each row whether all bits of its digest are set twice."""

    def suspects(batches):
        twice = packed.value
        for batch in batches:
            maybe = np.ones(batch.num_rows, bool)
            if batch.num_rows:
                for place in _places(batch.column(0), bits):
                    maybe &= (twice[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(maybe)], [*batch.schema.names, "maybe"]
            )

    return suspects


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of documents with identical texts the one with the largest doc_id is kept. The first pass
    fills a Bloom filter per task with the digests' bits and merges them piece by piece; the
    second looks every digest up. Digests that some bit shows to be unique go straight to the
    result, and only the others are shuffled and compared in full. The filter sent to the
    executors has at most ``MAX_BITS`` bits.

    Defined results: a null text counts as empty. Rows that repeat doc_id and text are one
    document listed several times: all of them count, and all are marked alike. A null doc_id is
    smaller than any number; if a group has nothing else, keep_id is null and its rows are kept.
    Texts of any length are compared whole, by their SHA-256. An empty table gives an empty result.
    Other columns are left out.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    with Scratch(spark, "exact_dedup") as scratch:
        thin = docs.select(
            F.unhex(F.sha2(text_or_empty(text), 256)).alias("digest"),
            F.col(doc_id).cast("long").alias("doc_id"),
        )
        thin = scratch.stage(thin, "thin")
        bits = filter_bits(thin.count())
        packed = spark.sparkContext.broadcast(repeated_bits(thin.select("digest"), bits))
        looked_up = thin.mapInArrow(
            _suspects(packed, bits), "digest binary, doc_id long, maybe boolean"
        )
        suspects = scratch.stage(looked_up.where("maybe").drop("maybe"), "suspects")
        groups = suspects.groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        )
        groups = scratch.stage(groups, "groups")
        alone = looked_up.where("not maybe").select(
            "digest", "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")
        )
        grouped = suspects.join(groups, "digest").select("digest", "doc_id", "keep_id", "group_size")
        result = alone.union(grouped).select(
            "doc_id", "keep_id", "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
        return stage(result, "exact_dedup")
