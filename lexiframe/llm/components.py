"""Connected components of a graph too large for any one machine."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiframe.llm.common import cut

#: So few edges, whatever the graph's size was, are joined up in one task.
LAST_EDGES = 10_000


def place(node: str) -> Column:
    """A node's place in an order that no graph can be hostile to: by hash, then by the node itself."""
    return F.struct(F.xxhash64(node).alias("h"), F.col(node).alias("node"))


def joined_up(live: DataFrame) -> DataFrame:
    """``node, to`` of a graph of at most ``LAST_EDGES`` edges, in one task: ``to`` is the same for all nodes of a component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict = {}

        def find(node):
            while (up := root.setdefault(node, node)) != node:
                root[node], node = root[up], up
            return node

        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
        columns = [pa.array(nodes, kind) for nodes in (list(root), [find(n) for n in root])]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "to"])

    kind = pa.int64() if live.schema["a"].dataType.typeName() == "long" else pa.binary()
    name = live.schema["a"].dataType.simpleString()
    return live.coalesce(1).mapInArrow(run, f"node {name}, to {name}")


def contract(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, label`` for every node, a bigint or binary, that has an edge; nodes of a component share a label, one of its nodes.

    Each round, every node points to the first of itself and its neighbours in
    order, and the edges are redrawn between the nodes pointed to, until few
    are left. A star is gone after three rounds and a path loses a constant
    share of its nodes in each, so rounds grow with the logarithm of the graph.
    Minima are taken before the shuffle, so a node with very many edges costs
    one row a task. Each round writes its result to the checkpoint folder. The
    last edges, few at any size of the graph, are joined up in one task.
    """
    live = cut(edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a != b").distinct())
    rounds = []
    while live.count() > LAST_EDGES:
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = both.groupBy("a").agg(F.min(place("b")).alias("first"))
        rounds.append(cut(first.select(F.col("a").alias("node"), F.least(place("a"), "first")["node"].alias("to"))))
        side = lambda s: rounds[-1].select(F.col("node").alias(s), F.col("to").alias(f"to_{s}"))
        moved = live.join(side("a"), "a").join(side("b"), "b").where("to_a != to_b")
        live = cut(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
    rounds.append(joined_up(live))
    labels = rounds[0].withColumnRenamed("to", "label")
    for later in rounds[1:]:
        labels = labels.join(later.select(F.col("node").alias("label"), "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return cut(labels)
