import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from seasonmart.llm import topk_search
from seasonmart.llm.topk_search import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, score string, `key` string"


def brute(rows, k=5):
    rows = {
        (i, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    for q, qv in rows:
        if q % 50 == 0:
            found = [
                (-sum(a * b for a, b in zip(qv, v)), i) for i, v in rows if i != q and len(v) == len(qv)
            ]
            for rank, (score, i) in enumerate(sorted(found)[:k], 1):
                yield q, rank, i, -score


def check(spark, rows):
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA).repartition(3)
    found = exact_top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows))


def test_random_vectors_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", 64)
    rng = np.random.default_rng(1)
    check(spark, [(i, rng.normal(0, 0.2, 16).tolist()) for i in range(600)])


def test_copies_ties_nulls_and_lengths(spark):
    rng = np.random.default_rng(2)
    hot = rng.normal(0, 0.2, 8).tolist()
    rows = [(i, hot) for i in range(150)] + [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(150, 300)]
    rows += [
        (400, [0.0] * 8), (450, None), (500, [None] + [0.1] * 7), (550, [float("nan")] * 8),
        (600, [float("inf")] * 8), (650, [0.5, 0.5]), (651, [0.25, -0.5]), (700, []), (701, []),
        (None, hot), (0, hot), (750, [1.0]),
    ]
    check(spark, rows)


def test_empty(spark):
    check(spark, [])
    check(spark, [(1, [0.5])])


def test_large_components(spark):
    df = spark.createDataFrame([(0, [3e6, 1.0], "", ""), (1, [3e6, -1.0], "", "")], SCHEMA)
    assert exact_top_k(df, F.col("vec_id") == 0).first().score == (256 * 3_000_000) ** 2 - 256**2
    with pytest.raises(Exception, match="may not fit"):
        wide = spark.createDataFrame([(0, [3e14], "", ""), (1, [3e14], "", "")], SCHEMA)
        exact_top_k(wide, F.col("vec_id") == 0).collect()


def joined_copies(plan, below_join=False):
    """Rows that a join's input makes several of, by a Generate that no function on batches follows."""
    name, children = plan.nodeName(), plan.children()
    below_join = (below_join or name == "Join") and not name.startswith("MapInArrow")
    return (below_join and name == "Generate") + sum(
        joined_copies(children.apply(i), below_join) for i in range(children.size())
    )


def test_blocks_meet_without_copies_in_joins_or_tables(spark, monkeypatch):
    """A join of copied query blocks may be broadcast, all copies through the driver; staged pairs fill the disk."""
    staged, stage = [], topk_search.Scratch.stage

    def measured(self, df, name):
        result = stage(self, df, name)
        size = sum(os.path.getsize(f.removeprefix("file://")) for f in result.inputFiles())
        staged.append((size, joined_copies(df._jdf.queryExecution().optimizedPlan())))
        return result

    monkeypatch.setattr(topk_search.Scratch, "stage", measured)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 8)
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", 8)
    rng = np.random.default_rng(3)
    rows = [(i * 25, rng.normal(0, 0.2, 16).tolist()) for i in range(400)]
    check(spark, rows)
    assert not any(copies for _, copies in staged)
    assert max(size for size, _ in staged) < 4 * staged[0][0]


def test_ties_among_different_vectors(spark, monkeypatch):
    """Entries of equal scores are many more than a list holds, over several products; smaller ids are better."""
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 8)
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", 48)
    rng = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate((rng.integers(-1, 2, (900, 6)) / 256).tolist())]
    rows += [(1000 + i, [0.0] * i + [0.5] + [0.0] * (299 - i)) for i in range(300)]
    rows += [(1500, [0.0] * 300), (1550, [-1.0] * 300), (1600, [0.25] * 300)]
    check(spark, rows)


@pytest.mark.parametrize("scale", [1.0, 3e2, 3e4, 1e6])
def test_numbers_of_all_sizes(spark, monkeypatch, scale):
    monkeypatch.setattr(topk_search, "CANDIDATE_BLOCK", 32)
    rng = np.random.default_rng(6)
    check(spark, [(i, (rng.normal(0, 1, 5) * (scale if i % 3 else 1)).tolist()) for i in range(400)])


def test_packing_of_many_widths(monkeypatch):
    monkeypatch.setattr(topk_search, "PACK_BYTES", 2000)
    rng = np.random.default_rng(7)
    vectors = [[int(x) for x in rng.integers(-(1 << 40), 1 << 40, i % 7)] for i in range(300)]
    keys = [i.to_bytes(32, "big") for i in range(300)]
    table = topk_search.pa.table({"key": keys, "first_id": list(range(300)), "vector": vectors})
    found = {}
    for block in topk_search._packed(10)(iter(table.to_batches(90))):
        for row in block.to_pylist():
            block_keys, ids, numbers = topk_search._unpacked(row)
            assert len(ids) <= 10 and numbers.shape == (len(ids), row["width"])
            found |= {int(i): (k.tobytes(), n.tolist()) for k, i, n in zip(block_keys, ids, numbers)}
    assert found == {i: (k, v) for i, (k, v) in enumerate(zip(keys, vectors))}
