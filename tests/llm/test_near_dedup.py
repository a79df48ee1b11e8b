from collections import Counter

import numpy as np
import pytest

from seasonmart.llm import near_dedup
from seasonmart.llm.components import UnionFind, components
from seasonmart.llm.near_dedup import near_groups, without_near_copies
from seasonmart.llm.superminhash import SLOTS, WordHashes, mixed, shingle_set, signatures
from seasonmart.sources.sinks import Scratch
from tests.llm.conftest import ODD_ROWS


def plain_sets(rows, size):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(words[j : j + size]) for j in range(max(1, len(words) - size + 1))) if words else frozenset())
    return sets


def brute(rows, size, percent=80):
    """Size of the set and smallest reachable id of each row, by comparing all pairs."""
    sets, united = plain_sets(rows, size), UnionFind()
    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                united.join(i, j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(united.find(i), []).append(doc_id)
    for i, (doc_id, _) in enumerate(rows):
        ids = [x for x in groups[united.find(i)] if x is not None]
        component = min(ids, default=None)
        yield doc_id, len(sets[i]), component, doc_id == component


def check(docs, rows, size):
    found = sorted(map(tuple, near_groups(docs, size=size).collect()), key=str)
    assert found == sorted(brute(rows, size), key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[int(rng.integers(0, len(words)))] = f"edit{rng.integers(0, 10**9)}"
    return " ".join(words)


def near_copies(prose, n=120):
    rng = np.random.default_rng(3)
    base = prose(150).split()
    rows = [(i, edited(rng, base, int(rng.integers(0, 12)))) for i in range(n)]
    rows += [(1000 + i, prose(int(rng.integers(1, 80)))) for i in range(60)]
    for i in range(20):
        words = prose(60).split()
        rows += [(2000 + 3 * i + k, edited(rng, words, k)) for k in range(3)]
    return rows + [(3000 + i, rows[i][1].upper()) for i in range(30)]


def test_groups_equal_all_pairs(documents, prose):
    rows = near_copies(prose)
    check(documents(rows).repartition(5), rows, 4)


def test_small_chunks_lose_no_link(documents, prose, monkeypatch):
    monkeypatch.setattr(near_dedup, "CHUNK", 4)
    monkeypatch.setattr(near_dedup, "CHUNK_SHINGLES", 700)
    rows = near_copies(prose, 60)
    check(documents(rows), rows, 4)


def test_chains_are_followed(documents, prose):
    words, rows = prose(120).split(), []
    for i in range(25):
        rows.append(((i * 7) % 25, " ".join(words)))
        words[i * 4] = f"changed{i}"
    check(documents(rows), rows, 5)


def test_odd_rows(documents):
    check(documents(ODD_ROWS), ODD_ROWS, 4)
    assert near_groups(documents([])).collect() == []


def test_only_ascii_is_put_in_lower_case(documents):
    rows = [(1, "ÄA b c d"), (2, "Äa B c d"), (3, "äa b c d"), (4, "äa\x1cb c d"), (5, "äa b c\x0bd")]
    check(documents(rows), rows, 4)


def test_word_order_matters():
    words = WordHashes()
    sets = [shingle_set(t, words, 4).tolist() for t in (b"x y y x", b"y x x y", b"x x y y", b"a b", b"b a", b"a b a b")]
    assert len({tuple(s) for s in sets}) == 6


def test_signatures_equal_the_definition():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 400):
        elements = rng.integers(0, 1 << 63, n).astype(np.uint64)
        slots = [(1 << 64) - 1] * SLOTS
        for e in elements:
            order = list(range(SLOTS))
            for step in range(SLOTS):
                seed = np.array([e], np.uint64) + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
                random = int(mixed(seed)[0])
                pick = step + ((random & 0xFFFF) * (SLOTS - step) >> 16)
                order[step], order[pick] = order[pick], order[step]
                slots[order[step]] = min(slots[order[step]], random >> 16 | step << 48)
        other = rng.integers(0, 1 << 63, 7).astype(np.uint64)
        assert signatures([other, elements, np.zeros(0, np.uint64)])[1].tolist() == slots


def test_estimates_are_unbiased():
    rng, errors = np.random.default_rng(2), []
    for _ in range(200):
        a, common = rng.integers(0, 1 << 63, 300).astype(np.uint64), int(rng.integers(0, 300))
        b = np.concatenate([a[:common], rng.integers(0, 1 << 63, 300 - common).astype(np.uint64)])
        found = signatures([a, b])
        errors.append((found[0] == found[1]).mean() - common / (600 - common))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.045


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    rng = np.random.default_rng(6)
    n = 300
    edges = {
        "path": [(i, i + 1) for i in range(n)],
        "star": [(0, i) for i in range(1, n)],
        "random": [tuple(map(int, rng.integers(0, n, 2))) for _ in range(n * 2 // 3)],
    }[shape]
    name = {i: mixed(np.array([i + 1], np.uint64)).tobytes() for i in range(n + 1)}
    united = UnionFind()
    for a, b in edges:
        united.join(a, b)
    rows = [(name[a], name[b]) for a, b in edges]
    df = spark.createDataFrame(rows, "a binary, b binary").repartition(6)
    with Scratch(spark, "components") as scratch:
        found = {bytes(r.node): bytes(r.root) for r in components(scratch, df, "x").collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert set(found) == {name[i] for i in nodes}
    sets = Counter((united.find(i), found[name[i]]) for i in nodes)
    assert len(sets) == len({a for a, _ in sets}) == len({b for _, b in sets})


def test_one_of_each_group_stays(documents, prose):
    text = prose(100)
    rows = [(3, text), (2, text + " more"), (9, text), (5, prose(50)), (None, text), (4, None), (6, "")]
    docs = documents(rows)
    kept = without_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [2, 4, 5, 6, None]
