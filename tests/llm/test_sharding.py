import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

from seasonmart.llm.sharding import Runs, cuts, shard, smallest_capacity
from tests.llm.conftest import ODD_ROWS


def brute_capacity(sizes, shards):
    best = sum(sizes)
    for at in combinations(range(1, len(sizes)), min(shards, len(sizes)) - 1):
        parts = [sum(sizes[a:b]) for a, b in zip([0, *at], [*at, len(sizes)])]
        best = min(best, max(parts))
    return best


def test_capacity_is_the_smallest():
    rng = random.Random(3)
    for _ in range(60):
        sizes = sorted((rng.randint(1, 30) for _ in range(rng.randint(1, 9))), reverse=True)
        runs = Runs(sorted(Counter(sizes).items(), reverse=True))
        for shards in (1, 2, 3):
            assert smallest_capacity(runs, 0, shards) == brute_capacity(sizes, shards)
            starts = [0, *cuts(runs, shards), len(sizes)]
            parts = [sum(sizes[a:b]) for a, b in zip(starts, starts[1:])]
            assert max(parts) == brute_capacity(sizes, shards) and sum(parts) == sum(sizes)


def test_a_giant_group_leaves_the_others_even():
    runs = Runs([(1000, 1), (10, 60), (1, 100)])
    starts = [0, *cuts(runs, 8), runs.groups]
    parts = [runs.before(b) - runs.before(a) for a, b in zip(starts, starts[1:])]
    assert parts[0] == 1000 and max(parts[1:]) - min(parts[1:]) <= 10


def check(docs, rows, shards):
    found = shard(docs, shards).collect()
    assert len(found) == len(rows)
    slots, places, size = defaultdict(list), defaultdict(set), Counter()
    crc = {(i, zlib.crc32((t or "").encode())): t or "" for i, t in rows}
    for r in found:
        text = crc[r.doc_id, r.text_crc32]
        assert r["size"] == len(text.encode()) + 8 and r.law == "bytes" and r.grown_shard is None
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        places[text].add(r.shard)
        size[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(p) == 1 for p in places.values())
    return size


def test_copies_stay_together_and_sizes_are_even(documents, prose):
    rows = [(i, prose(20 + i % 7)) for i in range(300)] + [(1000 + i, "same text") for i in range(120)]
    size = check(documents(rows), rows, 8)
    assert max(size.values()) - min(size.values()) < 400


def test_odd_rows(documents):
    check(documents(ODD_ROWS), ODD_ROWS, 24)
    assert shard(documents([])).collect() == []


def test_texts_of_equal_length_are_divided(documents):
    rows = [(i, f"{i:05d}") for i in range(240)]
    size = check(documents(rows), rows, 24)
    assert set(size.values()) == {130}
