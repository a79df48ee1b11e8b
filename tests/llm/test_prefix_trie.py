"""The prefix trie against plain dictionaries."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from seasonmart.llm import conversations, ordering, prefix_trie
from seasonmart.sources.sinks import Scratch

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth string, words string"


def remainder(value, size):
    """As in SQL: the sign is the dividend's."""
    return value % size if value >= 0 else -(-value % size)


def rebuilt(rows):
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(found)] for c, found in turns.items()}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        yield c, turns.get(c - remainder(c, 20), [])[:h] + own[h:]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(convs):
    members = {}
    for c, turns in convs:
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append((c, len(turns) == d))
    children, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, found in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] = saved.get(node[:d], 0) + (len(found) - 1) * words
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
    return [
        (
            min(found)[0], len(node), min(members[node[:-1]])[0] if node else None, len(found),
            children.get(node, 0), leaves[node], saved[node],
            sha(",".join(str(c) for c, ends in sorted(found) if ends)),
        )
        for node, found in members.items()
    ]


def invented(rng, convs, longest):
    rows = []
    for conv in [*rng.sample(range(-50, 300), convs), None]:
        for _ in range(rng.randint(1, longest)):
            text = rng.choice(["So be it.", "a  b\tc", "", None, " ", "x", f"{rng.random()} y"])
            rows.append((conv, rng.choice([None, *range(longest)]), rng.choice(["user", "assistant", "", None]), text))
    return rows


def results(spark, path, rows):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    frame.write.parquet(f"{path}/conversations.parquet")
    found = conversations.op11_prefix_trie(spark, str(path))
    assert found.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    ]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_random_conversations(spark, tmp_path):
    rows = invented(random.Random(5), 120, 5)
    assert results(spark, tmp_path, rows) == sorted(plain(rebuilt(rows)), key=str)


@pytest.mark.parametrize("block", [2, 512])
def test_hot_conversations_and_crowded_sketch(spark, tmp_path, monkeypatch, block):
    """Long copies of one conversation, many ends of one node, and a sketch too small to prove much."""
    monkeypatch.setattr(ordering, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "MIN_CELLS", 16)
    monkeypatch.setattr(prefix_trie, "MAX_CELLS", 16)
    rng = random.Random(6)
    rows = invented(rng, 40, 4)
    rows += [(c, i, "user", f"turn {i}") for c in (1000, 1020, 1040) for i in range(300)]
    rows += [(c, i, "user", "hello") for c in range(2000, 2400) for i in range(4)]
    assert results(spark, tmp_path, rows) == sorted(plain(rebuilt(rows)), key=str)


@pytest.mark.parametrize("cells", [64, 128, 256])
def test_crowded_cells_after_a_proven_single(spark, tmp_path, monkeypatch, cells):
    """Some prefixes of a tail meet crowded cells by chance: they are alone all the same."""
    monkeypatch.setattr(prefix_trie, "MIN_CELLS", cells)
    monkeypatch.setattr(prefix_trie, "MAX_CELLS", cells)
    rng = random.Random(7)
    rows = [(c, i, "user", rng.choice(["yes", "no", f"{c} {i}"])) for c in range(60) for i in range(8)]
    assert results(spark, tmp_path, rows) == sorted(plain(rebuilt(rows)), key=str)


def test_empty_and_long(spark, tmp_path):
    assert results(spark, tmp_path / "none", []) == []
    rows = [(1, 0, "user", "word " * 400_000), (2, 0, "user", "word " * 400_000), (2, 1, "user", "word " * 400_000 + "x")]
    assert results(spark, tmp_path / "long", rows) == sorted(plain(rebuilt(rows)), key=str)


def test_trie_without_rebuilding(spark):
    rows = [(1, 0, "u", "a"), (1, 1, "a", "b"), (2, 0, "u", "a"), (3, 0, "u", "c"), (3, 0, "u", "c"), (None, 1, "u", "c")]
    convs = [(1, [("u", "a"), ("a", "b")]), (2, [("u", "a")]), (3, [("u", "c"), ("u", "c")])]
    with Scratch(spark, "trie") as scratch:
        found = prefix_trie.prefix_trie(scratch, spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA))
        nodes = [tuple(r)[1:8] for r in found.nodes.collect()]
    assert sorted(nodes, key=str) == sorted((r[:-1] for r in plain(convs)), key=str)


def test_sketch_never_takes_shared_for_alone():
    rng = np.random.default_rng(1)
    digests = [rng.bytes(32) for _ in range(500)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(digests + digests[:100], pa.binary())], ["node"])
    for cells in (16, 1024, 1 << 16):
        parts = list(prefix_trie._count(cells)(iter([batch.slice(0, 300), batch.slice(300)])))
        sketch = np.concatenate([
            np.frombuffer(prefix_trie.zlib.decompress(p.column(1)[0].as_py()), np.uint8) for p in parts
        ])
        if len(sketch) == 4 * cells:
            at = prefix_trie._cells(batch.column(0), cells)
            alone = (sketch[at] < 2).any(axis=0)
            assert not alone[:100].any() and not alone[500:].any()
            assert cells < 1 << 16 or alone[100:500].all()
