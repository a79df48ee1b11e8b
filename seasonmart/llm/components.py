"""Connected components by union-find: in each task first, then over all tasks by contraction."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonmart.llm.common import frugal
from seasonmart.sources.sinks import Scratch

EDGES = "a binary, b binary"


class UnionFind(dict):
    """Parent of each node; the smallest node of a set is its root."""

    def find(self, node):
        path = []
        while (parent := self.get(node, node)) != node:
            path.append(node)
            node = parent
        for passed in path:
            self[passed] = node
        return node

    def join(self, a, b) -> bool:
        """Whether the two were in different sets before."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self[max(a, b)] = min(a, b)
        return True


def _contract(batches):
    """A task's edges as stars: each node with its root, at most as many as there were edges."""
    sets = UnionFind()
    for batch in batches:
        for a, b in zip(*(column.to_pylist() for column in batch.columns)):
            sets.join(a, b)
    nodes = list(sets)
    for at in range(0, len(nodes), 50_000):
        some = nodes[at : at + 50_000]
        columns = [pa.array([sets.find(x) for x in some], pa.binary()), pa.array(some, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b"])


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """Columns node and root for every node of the edges (a, b): equal roots for connected nodes.

    Each round unites what one task holds with union-find, labels every node with its smallest
    neighbour, and goes on with the edges between labels. As nodes are hashes, a round leaves a
    fraction of them; labels are put together in the end. Only tables hold nodes and edges, and
    joins read them from files, so that the edges of a hot node can be split.
    """
    labels: list[DataFrame] = []
    edges = edges.select("a", "b").where("a <> b")
    while True:
        turn = len(labels)
        stars = scratch.stage(edges.mapInArrow(frugal(_contract), EDGES).where("a <> b"), f"{name}_edges_{turn}")
        if turn and stars.isEmpty():
            break
        both = stars.union(stars.select("b", "a"))
        label = both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("root")
        )
        label = scratch.stage(label, f"{name}_labels_{turn}")
        labels.append(label)
        edges = (
            stars.join(label.toDF("a", "root_a"), "a").join(label.toDF("b", "root_b"), "b")
            .select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).where("a <> b").distinct()
        )
    found = labels[-1]
    for label in reversed(labels[:-1]):
        upper = found.toDF("root", "next")
        found = label.join(upper, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return scratch.stage(found, f"{name}_components")
