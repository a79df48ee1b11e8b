"""Operator 9: token ids in compressed files of wavelet matrices, one per shard of documents."""

from __future__ import annotations

import json
import os
import re
import struct
from array import array
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from seasonmart.llm.bpe import packed_ids, read_definition
from seasonmart.llm.common import bound_batches, frugal, held, text_or_empty, uncollected
from seasonmart.llm.pieces import KEPT_CHARS, groups, slices, spaced_pieces, spaces_touch, strings
from seasonmart.sources.sinks import Scratch, stage

#: Tokens after which a shard is closed; a document is never divided.
SHARD_TOKENS = 1 << 20
END_ID = 0
#: Bytes of each of the two generations of known pieces: the library takes long over a new one.
TABLE_BYTES = 32 << 20
#: New pieces joined to one text for the library, and such texts handed to it at once.
LINE_PIECES, LINES = 64, 256
#: Different words joined to one text; up to this many words the model is asked for each.
LINE_WORDS, FEW_WORDS = 512, 64
#: Characters of the texts that are cut and looked up together; a longer text is handled alone.
CHARS_AT_ONCE = 1 << 24
#: Bits per entry of the rank directory, bits of a plane compressed together, the file's first bytes.
RANK_BITS, BLOCK_BITS, MAGIC = 4096, 1 << 18, b"WMX2"

_ones = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_head = struct.Struct("<4sQB")
#: A single space and what does not begin or end with white space.
_joins = re.compile(r" \S(?:.*\S)?", re.DOTALL).fullmatch
#: Words of Latin letters with ASCII marks behind, on one or more lines, and the end of a piece: what a byte-level pattern
#: cuts them into is plain. Its words are runs of one kind of bytes; a space is of its word's kind.
_LETTERS, _MARKS = "A-Za-zÀ-ÖØ-öø-ɏ", r"!-/:-@\[-`{-~"
PLAIN = f"^ ?[{_LETTERS}]+[{_MARKS}]*(?:\\n[{_LETTERS}]+[{_MARKS}]*)*\\x00$"
_kinds = np.zeros(256, np.uint8)
_kinds[[i for i in range(33, 127) if not chr(i).isalnum()]] = 1
_kinds[[10, 0]] = 2, 3
_unpacker = zstandard.ZstdDecompressor()


class Plane:
    """One bit of all numbers, in compressed blocks that are unpacked when they are asked for.

    ``before`` is the rank directory: 1 bits before each stretch of ``RANK_BITS``, and in all.
    """

    def __init__(self, before: np.ndarray, ends: np.ndarray, packed: memoryview):
        self.before, self.ends, self.packed = before, ends, packed
        self.unpacked: dict[int, np.ndarray] = {}

    def block(self, number: int) -> np.ndarray:
        found = self.unpacked.get(number)
        if found is None:
            start = int(self.ends[number - 1]) if number else 0
            data = _unpacker.decompress(self.packed[start : int(self.ends[number])], max_output_size=BLOCK_BITS // 8)
            found = self.unpacked[number] = np.frombuffer(data, np.uint8)
        return found

    def bits(self, stretch: int) -> np.ndarray:
        """The bytes of one stretch of the directory."""
        block, at = divmod(stretch * RANK_BITS, BLOCK_BITS)
        return self.block(block)[at // 8 : at // 8 + RANK_BITS // 8]

    def whole(self) -> np.ndarray:
        return np.concatenate([self.block(i) for i in range(len(self.ends))])

    def bit(self, at: int) -> int:
        return int(self.bits(at // RANK_BITS)[at % RANK_BITS // 8]) >> (7 - at % 8) & 1

    def rank(self, at: int) -> int:
        """1 bits before place ``at``."""
        stretch, inside = divmod(at, RANK_BITS)
        found = int(self.before[stretch])
        if inside:
            bits = self.bits(stretch)
            found += int(_ones[bits[: inside // 8]].sum())
            if inside % 8:
                found += (int(bits[inside // 8]) >> (8 - inside % 8)).bit_count()
        return found

    def select(self, one: int, nth: int) -> int:
        """The place of 1 bit (or 0 bit) ``nth``."""
        before = self.before if one else np.arange(len(self.before)) * RANK_BITS - self.before
        stretch = int(np.searchsorted(before, nth, "right")) - 1
        bits = np.unpackbits(self.bits(stretch))
        return stretch * RANK_BITS + int(np.flatnonzero(bits == one)[nth - int(before[stretch])])


class WaveletMatrix:
    """A sequence of numbers as bit planes, highest bit first, read from one compressed file.

    Each plane holds one bit of all numbers, and orders them for the next plane: those with a 0
    bit first, both halves in the order they had. A number's place in the next plane follows from
    the count of 1 bits before it (rank), which the file's directory of counts and one popcount
    give. Looking something up unpacks one block or two of each plane, never a whole plane.
    """

    def __init__(self, data: bytes):
        magic, self.length, levels = _head.unpack_from(data) if len(data) >= _head.size else (b"", 0, 0)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        stretches, blocks = _sizes(self.length)
        before = np.frombuffer(data, "<u4", levels * (stretches + 1), _head.size).reshape(levels, -1)
        at = _head.size + before.nbytes
        ends = np.frombuffer(data, "<u4", levels * blocks, at).reshape(levels, -1)
        at += ends.nbytes
        view = memoryview(data)
        self.planes = []
        for counts, stops in zip(before, ends):
            self.planes.append(Plane(counts.astype(np.int64), stops, view[at : at + int(stops[-1])]))
            at += int(stops[-1])
        self.zeros = [self.length - int(plane.before[-1]) for plane in self.planes]

    @staticmethod
    def pack(numbers: np.ndarray) -> bytes:
        """The file of a sequence: head, rank directory of all planes, ends of all blocks, blocks.

        Counts and ends are 32-bit numbers: a sequence has at most 2^32 - 1 numbers.
        """
        levels = max(1, int(numbers.max(initial=0)).bit_length())
        stretches, blocks = _sizes(len(numbers))
        compressor, rest = zstandard.ZstdCompressor(level=1), numbers
        directory, ends, packed = [], [], []
        for level in reversed(range(levels)):
            bit = (rest & (1 << level)) != 0
            plane = np.zeros(stretches * RANK_BITS // 8, np.uint8)
            bits = np.packbits(bit)
            plane[: len(bits)] = bits
            counts = _ones[plane].reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.int64)
            directory.append(np.concatenate([[0], np.cumsum(counts)]))
            width = BLOCK_BITS // 8
            parts = [compressor.compress(plane[i * width : (i + 1) * width].tobytes()) for i in range(blocks)]
            ends.append(np.cumsum([len(p) for p in parts]))
            packed += parts
            rest = np.concatenate([np.compress(~bit, rest), np.compress(bit, rest)])
        head = _head.pack(MAGIC, len(numbers), levels)
        return head + np.stack(directory).astype("<u4").tobytes() + np.stack(ends).astype("<u4").tobytes() + b"".join(packed)

    def access(self, at: int) -> int:
        """The number at a place."""
        if not 0 <= at < self.length:
            raise IndexError(at)
        found = 0
        for plane, zeros in zip(self.planes, self.zeros):
            bit, ones = plane.bit(at), plane.rank(at)
            at = zeros + ones if bit else at - ones
            found = found << 1 | bit
        return found

    def _span(self, number: int, end: int) -> tuple[int, int]:
        """Where the occurrences before place ``end`` lie after the last plane."""
        if number < 0 or number >> len(self.planes):
            return 0, 0
        start, shift = 0, len(self.planes) - 1
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            first, last = plane.rank(start), plane.rank(end)
            if number >> (shift - level) & 1:
                start, end = zeros + first, zeros + last
            else:
                start, end = start - first, end - last
        return start, end

    def count(self, number: int, end: int | None = None) -> int:
        """Occurrences before place ``end``; in the whole sequence by default."""
        start, stop = self._span(number, self.length if end is None else min(end, self.length))
        return stop - start

    def find(self, number: int, nth: int) -> int:
        """The place of occurrence ``nth``, counted from 0."""
        start, end = self._span(number, self.length)
        if not 0 <= nth < end - start:
            raise IndexError(nth)
        at = start + nth
        for shift, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            one = number >> shift & 1
            at = plane.select(one, at - zeros if one else at)
        return at

    def numbers(self) -> np.ndarray:
        """The whole sequence, put together from the last plane up."""
        found = np.zeros(self.length, np.uint32 if len(self.planes) > 16 else np.uint16)
        for shift, plane in enumerate(reversed(self.planes)):
            bit = np.unpackbits(plane.whole(), count=self.length).view(bool)
            above, ones = np.empty_like(found), np.flatnonzero(bit)
            zeros = self.length - len(ones)
            found[zeros:] |= found.dtype.type(1 << shift)
            above[ones] = found[zeros:]
            above[np.flatnonzero(~bit)] = found[:zeros]
            found = above
        return found


def _sizes(length: int) -> tuple[int, int]:
    """Stretches of the directory and blocks of a plane."""
    stretches = -(-max(1, length) // RANK_BITS)
    return stretches, -(-stretches * RANK_BITS // BLOCK_BITS)


def _spans(kind: pa.DataType, ends: np.ndarray, data: np.ndarray) -> pa.Array:
    """The column of values that lie one behind the other and end at these bytes."""
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def _content(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and the bytes of a column of large values without nulls."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    return at - at[0], np.frombuffer(data, np.uint8)[at[0] : at[-1]]


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself, or one from 256 up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in own]
    return {**{byte: chr(byte) for byte in own}, **{byte: chr(256 + i) for i, byte in enumerate(others)}}


BYTE_LETTERS = _byte_letters()
#: The same as numbers; the end of a piece is a space, which stands for no byte.
_letter_codes = np.array([32, *(ord(BYTE_LETTERS[byte]) for byte in range(1, 256))], "<u2")


class KnownColumn:
    """Encoded pieces as columns, in two generations bounded by bytes, as ``KnownPieces`` has them in tables.

    A piece takes its characters, its ids and two offsets, and no Python objects. A generation is
    searched by a hash table that is made for each list of pieces, so lists should be long.
    """

    def __init__(self, encode_many: Callable[[pa.LargeStringArray], pa.LargeBinaryArray], table_bytes: int):
        self.encode_many, self.table_bytes = encode_many, table_bytes
        self.forget()

    def values_of(self, pieces: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """What each of these different pieces is encoded as; those not known are encoded together."""
        names, values = (pa.concat_arrays(both) for both in zip(self.young, self.old))
        at = pc.index_in(pieces, value_set=names)
        unknown = pc.is_null(at)
        new = pieces.filter(unknown)
        values = pa.concat_arrays([values, self.encode_many(new)])
        at = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        at[at < 0] = np.arange(len(names), len(values))
        found = values.take(pa.array(at))
        # A piece of the old generation that is met again moves up; long ones are not worth keeping.
        kept = pc.and_(pa.array(at >= len(self.young[0])), pc.less_equal(pc.utf8_length(pieces), KEPT_CHARS))
        added = pieces.filter(kept), found.filter(kept)
        if sum(column.nbytes for column in (*self.young, *added)) > self.table_bytes:
            self.old, self.young = self.young, added
        else:
            self.young = tuple(pa.concat_arrays(both) for both in zip(self.young, added))
        return found

    def forget(self) -> None:
        self.old = self.young = (pa.array([], pa.large_string()), pa.array([], pa.large_binary()))


class LibraryEncoder:
    """Encodes texts with the tokenizers library; pieces met before are looked up, new ones go to it together.

    Texts are cut at single spaces and their different pieces numbered as Arrow columns, so that
    Python handles a piece once in a group of texts. New words with marks behind are cut as columns
    too, and the different ones go to the library's model, which takes what its pattern would cut:
    one by one where they are few, else joined to lines that the library cuts at spaces only. Other
    new pieces are given to the library joined to lines, as it takes long over each text. A piece
    begins with a space between other characters, so no token spans two of them, and the bytes of
    the tokens tell whose they are.
    """

    def __init__(self, definition: str):
        # Spark runs a task per core, so the library's own threads would only get in the way.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.by_spaces = Tokenizer(self.model)
        self.by_spaces.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        found = json.loads(definition)
        # Only byte-level files without a normalizer may be cut before single spaces.
        rule = found["pre_tokenizer"] or {}
        self.cut = found["normalizer"] is None and rule.get("type") == "ByteLevel" and not rule["add_prefix_space"]
        self.by_words = self.cut and rule.get("use_regex", True)
        self.special = [t["content"] for t in found["added_tokens"]]
        self.has_special = re.compile("|".join(map(re.escape, self.special))).search if self.special else None
        sizes = {i: len(token) for token, i in self.tokenizer.get_vocab().items()}
        self.sizes = np.array([sizes.get(i, 0) for i in range(max(sizes, default=-1) + 1)], np.int64)
        # Only pieces behind a space are kept, without it.
        self.known = KnownColumn(lambda pieces: self._pieces(pieces, " "), TABLE_BYTES)

    def _pieces(self, pieces: pa.LargeStringArray, before: str = "") -> pa.LargeBinaryArray:
        """Packed ids of pieces with ``before`` in front: plain words by the model, others that may be joined in lines, the rest alone."""
        pieces = pc.binary_join_element_wise(_text(before), pieces, _text("")) if before else pieces
        if not self.by_words or not len(pieces):
            return pa.array(self._lines(strings(pieces)), pa.large_binary())
        ended = pc.binary_join_element_wise(pieces, _text("\0"), _text(""))
        plain = pc.match_substring_regex(ended, PLAIN)
        others = pa.array(self._lines(strings(pieces.filter(pc.invert(plain)))), pa.large_binary())
        ids, places = pa.concat_arrays([self._plain(ended.filter(plain)), others]), plain.to_numpy(zero_copy_only=False)
        order = np.empty(len(pieces), np.int64)
        order[np.concatenate([np.flatnonzero(places), np.flatnonzero(~places)])] = np.arange(len(pieces))
        return ids.take(pa.array(order)) if len(others) else ids

    def _plain(self, ended: pa.LargeStringArray) -> pa.LargeBinaryArray:
        """Packed ids of plain words with their ends; each different word is encoded once."""
        if not len(ended):
            return pa.array([], pa.large_binary())
        data = _content(ended)[1]
        kinds = _kinds[data]
        changes = np.flatnonzero(kinds[1:] != kinds[:-1]) + 1
        words = _spans(pa.large_binary(), np.append(changes, len(data)), data).dictionary_encode()
        ids = self._model(words.dictionary).take(words.indices)
        stops = np.flatnonzero(kinds[np.append(0, changes)] == _kinds[0]) + 1
        offsets, data = _content(ids)
        return _spans(pa.large_binary(), offsets[stops], data)

    def _model(self, words: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """Packed ids of words, which the library's pattern would not cut further; of an end of a piece, none."""
        offsets, data = _content(words)
        if len(words) > FEW_WORDS:
            letters = np.insert(_letter_codes[data], offsets[1:-1], 32)
            edges = [*(offsets[:-1] + np.arange(len(words)))[::LINE_WORDS].tolist(), len(letters)]
            ids = array("I")
            for part in (edges[i : i + LINES + 1] for i in range(0, len(edges) - 1, LINES)):
                lines = [letters[a:b].tobytes().decode("utf-16-le") for a, b in zip(part, part[1:])]
                for line in self.by_spaces.encode_batch_fast(lines, add_special_tokens=False):
                    ids.extend(line.ids)
            ids = np.array(ids, "<u4")
            ends = np.concatenate([[0], np.cumsum(self.sizes[ids])])
            stops = offsets[1:] - np.cumsum(data[offsets[:-1]] == 0)
            at = np.searchsorted(ends, stops)
            if ends[-1] == stops[-1] and (ends[np.minimum(at, len(ids))] == stops).all():
                return _spans(pa.large_binary(), 4 * at, ids)
        found = [
            [token.id for token in self.model.tokenize(word.rstrip(b"\0").decode("latin-1").translate(BYTE_LETTERS))]
            for word in words.to_pylist()
        ]
        return pa.array(map(packed_ids, found), pa.large_binary())

    def _lines(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of pieces; those that begin with a single space and end with none go to the library joined."""
        found: list[bytes | None] = [None] * len(pieces)
        apart = []
        for part in (range(at, min(at + LINE_PIECES * LINES, len(pieces))) for at in range(0, len(pieces), LINE_PIECES * LINES)):
            some = [i for i in part if _joins(pieces[i])]
            packed = self._joined([pieces[i] for i in some])
            for i, ids in zip(some, packed or ()):
                found[i] = ids
            apart += [i for i in part if found[i] is None]
        for i, ids in zip(apart, self._library([pieces[i] for i in apart])):
            found[i] = ids
        return found

    def _joined(self, pieces: list[str]) -> list[bytes] | None:
        """Packed ids of pieces that were joined; None if tokens do not end where pieces end."""
        lines = ["".join(pieces[at : at + LINE_PIECES]) for at in range(0, len(pieces), LINE_PIECES)]
        if any(name in line for name in self.special for line in lines):
            return None
        encoded = self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.array(list(chain.from_iterable(line.ids for line in encoded)), "<u4")
        ends = np.concatenate([[0], np.cumsum(self.sizes[ids])])
        stops = np.cumsum([len(piece.encode()) for piece in pieces], dtype=np.int64)
        at = np.searchsorted(ends, stops)
        if len(pieces) and (ends[-1] != stops[-1] or (ends[at] != stops).any()):
            return None
        packed, stops = ids.tobytes(), (4 * at).tolist()
        return [packed[a:b] for a, b in zip([0, *stops], stops)]

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [packed_ids(encoding.ids) for encoding in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids, packed as little-endian unsigned 32-bit integers."""
        with uncollected():
            return self._cut(texts) if self.cut else self._library(texts)

    def _cut(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts of a byte-level file."""
        found: list[bytes | None] = [None] * len(texts)
        for part in groups([len(text) for text in texts], CHARS_AT_ONCE):
            apart = [i for i in part if self.has_special and self.has_special(texts[i])]
            for i, ids in zip(apart, self._library([texts[i] for i in apart])):
                found[i] = ids
            plain = [i for i in part if found[i] is None]
            for i, ids in zip(plain, self._spaced([texts[i] for i in plain])):
                found[i] = ids
        return found

    def _spaced(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts without special names, each different piece behind a space looked up once."""
        if not texts:
            return []
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        wide = [i for i, text in enumerate(texts) if spaces_touch(text)]
        if wide:  # Spaces beside others stay in their piece.
            lists, rest = [spaced_pieces(texts[i]) for i in wide], np.setdiff1d(np.arange(len(texts)), wide)
            order = np.argsort(np.concatenate([rest, wide]), kind="stable")
            cut = pa.concat_arrays([cut.take(pa.array(rest)), pa.array(lists, cut.type)]).take(pa.array(order))
        sizes, pieces = pc.list_value_length(cut).to_numpy(), cut.flatten()
        ends = np.cumsum(sizes)
        behind = np.ones(len(pieces), bool)
        behind[ends - sizes] = False
        firsts = self._pieces(pieces.take(pa.array(ends - sizes)))
        numbered = pieces.filter(pa.array(behind)).dictionary_encode()
        ids = self.known.values_of(numbered.dictionary).take(numbered.indices)
        ends -= np.arange(1, len(texts) + 1)
        return [a + b for a, b in zip(firsts.to_pylist(), slices(ids, ends - sizes + 1, ends))]


def _encoder(definition: str) -> LibraryEncoder:
    return held(("library", definition), lambda: LibraryEncoder(definition))


SHARDS = "part int, shard int, start_in_part long, n_tokens long, doc_ids array<long>, lengths array<long>, matrix binary"


def _gathered(batches):
    """Ids and texts of batches, about ``CHARS_AT_ONCE`` together."""
    given, texts, size = [], [], 0
    for batch in batches:
        given += batch.column(0).to_pylist()
        texts += batch.column(1).to_pylist()
        size += batch.nbytes
        if size >= CHARS_AT_ONCE:
            yield given, texts
            given, texts, size = [], [], 0
    yield given, texts


def _write_shards(definition, shard_tokens: int):
    def run(batches):
        encoder = _encoder(definition.value)
        end = np.array([END_ID], "<u4").tobytes()
        part, shard, start = TaskContext.get().partitionId(), 0, 0
        doc_ids, lengths, ids, held = [], [], [], 0

        def close():
            numbers = np.frombuffer(b"".join(ids), "<u4")
            if numbers.max(initial=0) < 1 << 16:
                numbers = numbers.astype(np.uint16)
            row = [part, shard, start, len(numbers), doc_ids, lengths, WaveletMatrix.pack(numbers)]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "shard", "start_in_part", "n_tokens", "doc_ids", "lengths", "matrix"]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names)

        for given, texts in _gathered(batches):
            for doc_id, found in zip(given, encoder.encode(texts)):
                found += end
                doc_ids.append(doc_id)
                lengths.append(len(found) // 4)
                ids.append(found)
                held += lengths[-1]
                if held >= shard_tokens:
                    yield close()
                    shard, start = shard + 1, start + held
                    doc_ids, lengths, ids, held = [], [], [], 0
        if doc_ids:
            yield close()

    return run


def write_tokens(
    docs: DataFrame, path: str, folder: str, doc_id: str = "doc_id", text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Write the texts' token ids, with ``END_ID`` after each, as shards in ascending doc_id order.

    Documents are divided by ranges of doc_id and a hash of the text, so that many rows of one id,
    or without one, are several ranges; each is sorted, encoded and cut into shards as it streams by. A shard is one row with its documents and its wavelet matrix as one
    compressed value, written by Spark, so that a repeated task leaves no half-written files and
    any store that Spark writes to will do.

    Defined results: null texts are empty and have the end id only. Null ids come first. Rows that
    repeat an id follow each other in the order of that hash. Texts of any length are encoded
    whole, a document is never divided. An empty table gives no shards. Other columns are left out.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    definition = spark.sparkContext.broadcast(read_definition(path))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    by = ["doc_id", F.xxhash64("text")]
    ordered = texts.repartitionByRange(*by).sortWithinPartitions(*by, "text")
    ordered.mapInArrow(frugal(_write_shards(definition, shard_tokens), keep=True), SHARDS).write.parquet(folder)


def _read_shards(batches):
    names = ["doc_id", "start", "n_tokens", "ids"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for row in batch.to_pylist():
            ids = WaveletMatrix(row["matrix"]).numbers().astype("<u4")
            ends = np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            columns = [
                row["doc_ids"], starts + row["start"], row["lengths"],
                [ids[a:b].tobytes() for a, b in zip(starts, ends)],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def read_tokens(shards: DataFrame) -> DataFrame:
    """Documents from shards as ``write_tokens`` wrote them: doc_id, start, n_tokens, ids.

    ``start`` counts the ids of all documents before; only the number of tokens per range of
    doc_ids is added up in one place.
    """
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("offset"))
    # Staged, so that Spark knows how small it is before it plans to shuffle the shards.
    placed = shards.join(stage(offsets, "token_offsets"), "part").select(
        (F.col("start_in_part") + F.col("offset")).alias("start"), "doc_ids", "lengths", "matrix"
    )
    return placed.mapInArrow(_read_shards, "doc_id long, start long, n_tokens long, ids binary")


def token_index(docs: DataFrame, path: str, folder: str | None = None, **options) -> DataFrame:
    """Per document, read back from the files: doc_id, start, n_tokens, ids_crc32.

    Defined results: as ``write_tokens`` and ``read_tokens`` have them. A null text has the end id
    only, a null doc_id stays null and comes first, repeated rows follow each other, an empty table
    gives an empty result, and other columns are left out.
    """
    spark = docs.sparkSession
    with Scratch(spark, "token_files") as scratch:
        place = folder or f"{scratch.folder}/shards"
        write_tokens(docs, path, place, **options)
        read = read_tokens(spark.read.parquet(place))
        return stage(read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")), "token_index")
