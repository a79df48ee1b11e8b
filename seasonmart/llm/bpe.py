"""Operator 7: byte-level BPE, encoding and decoding with the vocabulary of a tokenizer file."""

from __future__ import annotations

import heapq
import json
import re
import sys
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonmart.llm.common import bound_batches, fresh, frugal, held, text_or_empty, with_columns
from seasonmart.llm.pieces import CHARS_AT_ONCE, BatchEncoder, groups, slices

#: Fixed value: the pattern that splits text before merging, as byte-level tokenizer files mean it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words up to this many bytes are merged by repeated scans, longer ones with a heap.
SHORT_WORD = 96
#: Words whose parts lie side by side at once.
WORDS_AT_ONCE = 4_096
#: Bytes of texts, or of ids, that are handled and sent back together; a longer value is handled alone.
PART_BYTES = 1 << 19
#: No merge: larger than any rank.
NEVER = 1 << 30


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Visible bytes stand for themselves; the rest, in order, for the characters from 256 on.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b if b in visible else 256 + hidden.index(b)) for b in range(256)]


def ids_of(packed: bytes) -> list[int]:
    """Token ids from little-endian unsigned 32-bit integers."""
    found = array("I", packed)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tolist()


def packed_ids(ids: list[int]) -> bytes:
    found = array("I", ids)
    if sys.byteorder == "big":
        found.byteswap()
    return found.tobytes()


class Vocabulary:
    """Tokens and merges of a byte-level BPE file, as its JSON text."""

    def __init__(self, definition: str):
        found = json.loads(definition)
        model = found["model"]
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        id_of = model["vocab"]
        self.special = {t["content"]: t["id"] for t in found["added_tokens"]}
        bytes_of = {
            i: bytes(byte_of[c] for c in token) for token, i in id_of.items() if token not in self.special
        } | {i: content.encode() for content, i in self.special.items()}
        self._table = pa.array([bytes_of.get(i, b"") for i in range(max(bytes_of) + 1)], pa.large_binary())
        self.byte_ids = [id_of[c] for c in byte_characters()]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([id_of[a] << 32 | id_of[b] for a, b in merges], np.int64)
        # By rank what a merge gives, and by pair its rank: sorted for many look-ups, a table for single ones.
        self._merged_at = np.array([id_of[a + b] for a, b in merges], np.int32)
        order = np.argsort(pairs, kind="stable")
        self._pairs = np.append(pairs[order], np.int64(1) << 62)
        self._pair_ranks = np.append(order, NEVER).astype(np.int32)
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(names) + ")") if names else None
        self.pattern = regex.compile(PATTERN)
        self.spaced = BatchEncoder(self.pieces, self._with_special, self.special)
        self._byte_ids = np.array(self.byte_ids, np.int32)
        # Ranks of all pairs of single bytes, where each word begins.
        self._byte_ranks = self._ranks(np.repeat(self._byte_ids, 256), np.tile(self._byte_ids, 256))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of many pairs; NEVER where two parts do not merge."""
        pairs = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self._pairs, pairs)
        return np.where(self._pairs[at] == pairs, self._pair_ranks[at], np.int32(NEVER))

    @cached_property
    def ranks(self) -> dict[int, int]:
        """The rank of a pair, for single look-ups: made when the first long word is met."""
        return dict(zip(self._pairs[:-1].tolist(), self._pair_ranks[:-1].tolist()))

    def word_ids(self, words: list[bytes]) -> list[bytes]:
        """Packed token ids of words: the adjacent parts of lowest rank are joined, leftmost first."""
        found: list[bytes] = [b""] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        short = np.flatnonzero(sizes <= SHORT_WORD)
        # Words of like lengths together, so that rows of parts are about as long as their words.
        for chunk in np.array_split(short[np.argsort(sizes[short], kind="stable")], len(short) // WORDS_AT_ONCE + 1):
            for i, ids in zip(chunk.tolist(), self._scan([words[i] for i in chunk], sizes[chunk])):
                found[i] = ids
        for i in np.flatnonzero(sizes > SHORT_WORD).tolist():
            found[i] = packed_ids(self._heap(words[i]))
        return found

    def _scan(self, words: list[bytes], sizes: np.ndarray) -> list[bytes]:
        """Each word is a row of parts, and a row of the ranks of the borders between them.

        In each round every row that still has a border to delete finds its smallest rank, joins
        the parts on both sides, closes the gap, and looks up the ranks left and right of it anew.
        """
        width = int(sizes.max(initial=0))
        if not width:
            return [b""] * len(words)
        places = np.arange(width)
        data = np.zeros((len(words), width), np.uint8)
        data[places < sizes[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        ids = self._byte_ids[data]
        ranks = np.full((len(words), width), NEVER, np.int32)
        pairs = (data[:, :-1].astype(np.int32) << 8) + data[:, 1:]
        ranks[:, :-1] = np.where(places[1:] < sizes[:, None], self._byte_ranks[pairs], np.int32(NEVER))
        done, left = np.zeros_like(ids), sizes.copy()
        rows = np.arange(len(words))
        while True:
            at = ranks.argmin(axis=1)
            lowest = ranks[np.arange(len(rows)), at]
            going = lowest < NEVER
            if not going.all():
                done[rows[~going]] = ids[~going]
                rows, ids, ranks, at, lowest = rows[going], ids[going], ranks[going], at[going], lowest[going]
            if not len(rows):
                break
            each = np.arange(len(rows))
            ids[each, at] = self._merged_at[lowest]
            beyond = np.minimum(places + (places > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, beyond, axis=1)
            ranks = np.take_along_axis(ranks, np.minimum(places + (places >= at[:, None]), width - 1), axis=1)
            left[rows] -= 1
            ranks[:, -1] = NEVER
            has_left, has_right = np.flatnonzero(at > 0), np.flatnonzero(at + 1 < left[rows])
            border = at[has_left]
            ranks[has_left, border - 1] = self._ranks(ids[has_left, border - 1], ids[has_left, border])
            border = at[has_right]
            ranks[has_right, border] = self._ranks(ids[has_right, border], ids[has_right, border + 1])
        packed, step = done.astype("<u4").tobytes(), 4 * width
        return [packed[i * step : i * step + 4 * n] for i, n in enumerate(left.tolist())]

    def _heap(self, word: bytes) -> list[int]:
        """The same for a long word: borders wait in a heap, by rank and place."""
        ids = [self.byte_ids[b] for b in word]
        end = len(ids)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap: list[tuple[int, int, int, int]] = []
        merged = self._merged_at.tolist() if end > len(self._merged_at) else self._merged_at

        def offer(left: int, right: int) -> None:
            rank = self.ranks.get(ids[left] << 32 | ids[right])
            if rank is not None:
                heapq.heappush(heap, (rank, left, ids[left], ids[right]))

        for left in range(end - 1):
            offer(left, left + 1)
        while heap:
            rank, left, a, b = heapq.heappop(heap)
            right = after[left]
            if ids[left] != a or right >= end or ids[right] != b:
                continue
            ids[left], ids[right] = int(merged[rank]), -1
            after[left] = after[right]
            if after[left] < end:
                before[after[left]] = left
                offer(left, after[left])
            if before[left] >= 0:
                offer(before[left], left)
        return [i for i in ids if i >= 0]

    def _words(self, piece: str) -> list[str]:
        """A piece cut by the pattern; most are a space, letters, and perhaps a mark, which is plain to see."""
        if piece[:1] == " ":
            if piece[1:].isalpha():
                return [piece]
            if piece[-1] in ".,;:!?" and piece[1:-1].isalpha():
                return [piece[:-1], piece[-1]]
        return self.pattern.findall(piece)

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of pieces without special tokens, each cut into words by the pattern."""
        cut = [self._words(piece) for piece in pieces]
        words = list(dict.fromkeys(word for found in cut for word in found))
        ids = dict(zip(words, self.word_ids([word.encode() for word in words])))
        return [ids[found[0]] if len(found) == 1 else b"".join([ids[word] for word in found]) for found in cut]

    def _with_special(self, text: str) -> bytes:
        return b"".join(
            packed_ids([self.special[part]]) if part in self.special else self.spaced.encode([part])[0]
            for part in self.special_pattern.split(text) if part
        )

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's token ids, packed; the names of special tokens become their ids."""
        return self.spaced.encode(texts)

    def decode(self, packed: list[bytes]) -> list[str]:
        """The texts of packed ids; bytes that are no UTF-8 become U+FFFD."""
        found: list[str] = []
        for part in groups([len(p) for p in packed], CHARS_AT_ONCE):
            some = [packed[i] for i in part]
            ends = np.cumsum([len(p) // 4 for p in some], dtype=np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            tokens = self._table.take(pa.array(np.frombuffer(b"".join(some), "<u4")))
            found += [text.decode("utf-8", "replace") for text in slices(tokens, starts, ends)]
        return found


def vocabulary(definition: str) -> Vocabulary:
    """One per worker, so that its tables outlive a task."""
    return held(("bpe", definition), lambda: Vocabulary(definition))


def _parts(batches, column: str):
    """Batches in slices of ``PART_BYTES`` of a column, or of single rows: what is made of one is gone before the next."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for part in groups(sizes, PART_BYTES):
            yield batch.slice(part.start, len(part))


def _mapped(batches, column: str, values, name: str, kind: pa.DataType):
    for batch in batches:
        given = batch.column(column).to_pylist()
        known = [i for i, x in enumerate(given) if x is not None]
        found: list = [None] * len(given)
        for i, value in zip(known, values([given[i] for i in known]) if known else ()):
            found[i] = value
        yield batch.append_column(name, pa.array(found, kind))


def _add(df: DataFrame, definition: str, steps) -> DataFrame:
    """Add columns made by the vocabulary, each from one that is there: (name, type, from, method)."""
    spark = df.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(definition)
    arrow = {"binary": pa.binary(), "string": pa.string()}

    def run(batches):
        found = vocabulary(shared.value)
        batches = _parts(batches, steps[0][2])
        for name, kind, source, method in steps:
            batches = _mapped(batches, source, getattr(found, method), name, arrow[kind])
        try:
            yield from batches
        finally:
            found.spaced.known.forget()

    return df.mapInArrow(frugal(run, keep=True), with_columns(df, {name: kind for name, kind, _, _ in steps}))


def read_definition(path: str) -> str:
    """A tokenizer file of the driver; a few MB at most, so it can be sent to all tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids``: each text's token ids as little-endian unsigned 32-bit integers.

    Ids are those of the tokenizers library without post-processing. A batch of texts is cut before
    single spaces; of its different pieces those met before are looked up, new ones are split by
    the pattern into words. A short word keeps its parts and the ranks of the borders between them
    in two rows, with the other new words of the batch below it: the smallest rank is searched, its
    border deleted, and the ranks next to it looked up again. Words over ``SHORT_WORD`` bytes take
    a heap instead, so a text without spaces costs n log n.

    Defined results: null gives null; an empty text gives no ids (an empty binary). Repeated rows
    and other columns stay as they are; where a name is taken, the new column's gets an underscore
    in front. An empty table stays empty.
    """
    return _add(docs, read_definition(path), [(fresh(docs.columns, ids), "binary", text, "encode")])


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``: what the ids stand for, special tokens by name. Null gives null."""
    return _add(encoded, read_definition(path), [(fresh(encoded.columns, text), "string", ids, "decode")])


def encode_and_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``encode`` followed by ``decode``, in one pass over the rows; columns ``ids``, ``decoded``."""
    ids, decoded = (fresh(docs.columns, name) for name in ("ids", "decoded"))
    steps = [(ids, "binary", text, "encode"), (decoded, "string", ids, "decode")]
    return _add(docs, read_definition(path), steps)


def token_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, and digests of its ids and of the decoded text.

    Defined results: a null text counts as empty and has 0 tokens. Texts of any length are encoded
    whole. Repeated rows stay, each with its digests, and a null doc_id stays null. An empty table
    gives an empty result. Other columns are left out.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    return encode_and_decode(texts, path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
