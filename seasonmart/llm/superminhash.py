"""Word shingles and their SuperMinHash signatures, for many texts at once in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

#: Signature length, and the bands it is cut into: 32 bands of 4 miss a pair of similarity 0.8 with
#: probability (1 - 0.8 ** 4) ** 32 = 5e-8 at most.
SLOTS, BANDS = 128, 32
ROWS = SLOTS // BANDS
#: Words of a shingle.
SHINGLE = 5
#: Elements whose permutations are held at once.
CHUNK = 1 << 15
#: Words kept with their hash; beyond that the table starts anew.
CACHE_ENTRIES, CACHE_BYTES = 150_000, 48

_U = np.uint64
def mixed(x: np.ndarray) -> np.ndarray:
    """Spread each number's bits over all 64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Odd factors without a pattern, one per place of a word in a shingle or a slot in a band.
_ODD = mixed(np.arange(1, 17, dtype=np.uint64)) | _U(1)


class WordHashes(dict):
    """A 64-bit hash for each word, which is a byte string."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHE_BYTES:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = found
        return found


def shingle_set(text: bytes, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingles of a text in UTF-8, as 64-bit hashes.

    Only A to Z are put in lower case, and only ASCII white space (9 to 13 and 32) ends a word. A
    text with fewer words than a shingle is one shingle, a text without words has none.
    """
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter((hashes[w] for w in words), np.uint64, len(words))
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total += each[i : len(words) - size + 1 + i] * _ODD[i]
    return np.unique(mixed(total + _U(size)))


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures, one row per set; rows of empty sets hold the largest number.

    Each element visits all slots in an order of its own, a random permutation, and offers slot
    number j of that order a value between j and j + 1; a slot keeps the smallest offer. Values
    of an element are thus spread evenly over the slots, which lowers the variance. Once all slots
    of a set are below j, later offers cannot count, and the set is done.
    """
    found = np.full((len(sets), slots), ~_U(0))
    start = 0
    while start < len(sets):
        end, held = start, 0
        while end < len(sets) and (held == 0 or held + len(sets[end]) <= CHUNK):
            held += len(sets[end])
            end += 1
        if end - start == 1:
            for at in range(0, len(sets[start]), CHUNK):
                found[start] = np.minimum(found[start], _signed([sets[start][at : at + CHUNK]], slots)[0])
        else:
            found[start:end] = _signed(sets[start:end], slots)
        start = end
    return found


def _signed(sets: list[np.ndarray], slots: int) -> np.ndarray:
    found = np.full((len(sets), slots), ~_U(0))
    flat = found.reshape(-1)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order: np.ndarray | None = None
    for step in range(slots):
        if step:
            # Sets with a slot that a later offer may still lower.
            open_sets = (found >= _U(step << 48)).any(axis=1)
            use = open_sets[owner]
            if not use.any():
                break
            if not use.all():
                elements, owner = elements[use], owner[use]
                order = order[use]
        random = mixed(elements + _U((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        pick = step + ((random & _U(0xFFFF)) * _U(slots - step) >> _U(16)).astype(np.int64)
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint8), (len(elements), 1))
        rows = np.arange(len(elements))
        slot = order[rows, pick]
        order[rows, pick] = order[:, step]
        order[:, step] = slot
        np.minimum.at(flat, owner * slots + slot, (random >> _U(16)) | _U(step << 48))
    return found


def band_keys(found: np.ndarray) -> np.ndarray:
    """For each set and band a hash of the band's slots, as signed 64-bit numbers."""
    grouped = found.reshape(len(found), BANDS, -1)
    total = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD[0], grouped.shape[:2]).copy()
    for i in range(grouped.shape[2]):
        total = mixed(total + grouped[:, :, i] * _ODD[i + 1])
    return total.view(np.int64)


def compact(found: np.ndarray) -> np.ndarray:
    """The last 16 bits of each slot: enough to estimate a similarity from."""
    return (found & _U(0xFFFF)).astype("<u2")
