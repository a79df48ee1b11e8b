"""Encoding many texts at once: cut at spaces, each different piece looked up or encoded once."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

#: Bytes that each of the two generations of known pieces may take, and the longest piece kept.
TABLE_BYTES, KEPT_CHARS = 24 << 20, 48
#: Characters of the texts that are handled together; a longer text is handled alone.
CHARS_AT_ONCE = 1 << 19
#: What a kept piece takes besides its characters and its ids: two objects and a place in a table.
ENTRY_BYTES = 170

_two_spaces = re.compile(r"\s\s")
_between_words = re.compile(r"(?<=\S) (?=\S)")
#: White space besides the space itself; all of it lies below this bound.
_others = [chr(c) for c in range(0x3001) if c != 32 and chr(c).isspace()]


def spaced_pieces(text: str) -> list[str]:
    """The text cut at single spaces between other characters; a space belongs to the piece behind.

    No token of a byte-level pattern spans such a place: a space there always starts a new word.
    """
    return _between_words.split(text) if _two_spaces.search(text) else text.split(" ")


def spaces_touch(text: str) -> bool:
    """Whether a space lies beside other white space, so that the text may not be cut at every space."""
    return "  " in text or any(c in text and (f" {c}" in text or f"{c} " in text) for c in _others)


def groups(sizes: list[int], most: int) -> Iterator[range]:
    """Neighbours that are not larger than ``most`` together, or alone."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield range(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield range(start, len(sizes))


class KnownPieces:
    """Encoded pieces by piece, in two generations bounded by bytes.

    When the young generation is full it becomes the old one. A piece that is met again moves up,
    so frequent pieces stay. A generation exceeds its bound by the new pieces of one list at most.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], table_bytes: int | None = None):
        self.encode_many, self.table_bytes = encode_many, table_bytes or TABLE_BYTES
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def values_of(self, pieces: list[str], different: bool = False) -> list[bytes]:
        """What each of these pieces is encoded as; those not known are encoded together, once.

        ``different`` tells that no piece is there twice.
        """
        if self.held > self.table_bytes:
            self.old, self.young, self.held = self.young, {}, 0
        found = list(map(self.young.get, pieces))
        missing = [i for i, value in enumerate(found) if value is None]
        if not missing:
            return found
        names = [pieces[i] for i in missing]
        if not different:
            names = list(dict.fromkeys(names))
        values = list(map(self.old.get, names))
        new = [i for i, value in enumerate(values) if value is None]
        if new:
            for i, value in zip(new, self.encode_many([names[i] for i in new])):
                values[i] = value
        self.held += ENTRY_BYTES * len(names) + sum(map(len, names)) + sum(map(len, values))
        young = self.young
        young.update(zip(names, values))
        for i, value in zip(missing, values if different else [young[pieces[i]] for i in missing]):
            found[i] = value
        if max(map(len, names)) > KEPT_CHARS:
            self.drop_long(names)
        return found

    def all_of(self, pieces: list[str]) -> dict[str, bytes]:
        """A table with all of these pieces."""
        return dict(zip(pieces, self.values_of(pieces)))

    def forget(self) -> None:
        """Give up both generations: an idle worker has no use for them."""
        self.young, self.old, self.held = {}, {}, 0

    def drop_long(self, pieces: Iterable[str]) -> None:
        """Forget pieces that are too long to be worth keeping."""
        for piece in pieces:
            if len(piece) > KEPT_CHARS:
                self.young.pop(piece, None)


class BatchEncoder:
    """Encodes lists of texts, as ``slow`` encodes one, if pieces cut by ``spaced_pieces`` may be encoded apart.

    ``encode_many`` encodes pieces together; those that follow a space are given with it, and kept.
    The names in ``special`` may hold spaces and stand for themselves: texts with one go to ``slow``.
    """

    def __init__(
        self, encode_many: Callable[[list[str]], list[bytes]], slow: Callable[[str], bytes], special: Iterable[str],
        table_bytes: int | None = None,
    ):
        self.encode_many, self.slow = encode_many, slow
        self.known = KnownPieces(lambda pieces: encode_many([" " + piece for piece in pieces]), table_bytes)
        names = "|".join(map(re.escape, special))
        self.special = re.compile(names) if names else None

    def encode(self, texts: list[str]) -> list[bytes]:
        found: list[bytes | None] = [None] * len(texts)
        for part in groups([len(text) for text in texts], CHARS_AT_ONCE):
            special = [i for i in part if self.special and self.special.search(texts[i])]
            for i in special:
                found[i] = self.slow(texts[i])
            plain = [i for i in part if i not in special] if special else list(part)
            cut = [spaced_pieces(texts[i]) for i in plain]
            if not cut:
                continue
            firsts = self.encode_many([pieces[0] for pieces in cut])
            ids = self.known.values_of(list(chain.from_iterable([pieces[1:] for pieces in cut])))
            at = 0
            for i, first, pieces in zip(plain, firsts, cut):
                found[i] = first + b"".join(ids[at : at + len(pieces) - 1])
                at += len(pieces) - 1
        return found


def strings(values: pa.Array) -> list[str]:
    """A column's strings; ``to_pylist`` takes several times as long."""
    return values.to_numpy(zero_copy_only=False).tolist()


def slices(values: pa.LargeBinaryArray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The values of each span of places, joined: they lie one behind the other."""
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    view = memoryview(data) if data is not None else memoryview(b"")
    return [bytes(view[a:b]) for a, b in zip(at[starts].tolist(), at[ends].tolist())]
