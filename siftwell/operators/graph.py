"""Connected components by contraction."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.plans.staging import stage

#: Edges that one task settles by itself.
TASK_EDGES = 1_000_000


def connected_components(edges: DataFrame, left: str = "src", right: str = "dst", max_rounds: int = 64, task_edges: int = TASK_EDGES) -> DataFrame:
    """(node, component) for every node that occurs in an edge; the component is its smallest node.

    Each round lets every node point at its smallest neighbour, follows pointers a step, and replaces both ends of each
    edge by what they point at; edges inside one node go. Nodes at least halve from round to round, so the rounds grow
    with the logarithm of the longest path, and once ``task_edges`` edges or fewer are left, one task settles them. All
    joins are between staged tables on unique keys of one side, so adaptive execution can split a hub's rows. Self-loops
    give a node of its own; null ends are ignored.
    """
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    pairs = stage(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    maps: list[DataFrame] = []
    for _ in range(max_rounds):
        n = pairs.count()
        if n <= task_edges:
            if n or not maps:
                maps.append(stage(_settled(pairs), "hooks"))
            break
        both = pairs.select(F.col("v").alias("node"), F.col("u").alias("to")).unionByName(pairs.select(F.col("u").alias("node"), F.col("u").alias("to")))
        hooks = stage(both.groupBy("node").agg(F.min("to").alias("to")), "hooks")
        further = hooks.select(F.col("node").alias("to"), F.col("to").alias("further"))
        hooks = stage(hooks.join(further, "to").select("node", F.col("further").alias("to")), "hooks")
        maps.append(hooks)
        for side in ("u", "v"):
            pairs = pairs.join(hooks.select(F.col("node").alias(side), F.col("to").alias(f"{side}_to")), side).drop(side).withColumnRenamed(f"{side}_to", side)
        pairs = pairs.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        pairs = stage(pairs, "edges")
    else:
        raise RuntimeError("components did not settle")

    def follow(labels: DataFrame, hooks: DataFrame) -> DataFrame:
        step = hooks.select(F.col("node").alias("component"), F.col("to").alias("next"))
        moved = labels.join(step, "component", "left")
        return stage(moved.select("node", F.coalesce("next", "component").alias("component")), "labels")

    return reduce(follow, maps[1:], maps[0].select("node", F.col("to").alias("component")))


def _settled(pairs: DataFrame) -> DataFrame:
    """(node, to) of the few edges that are left, by one task; ``to`` is the component's smallest node."""
    kind = pairs.schema["u"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        both = pa.Table.from_batches(held)
        ends = pa.chunked_array([*both.column(0).chunks, *both.column(1).chunks]).combine_chunks()
        nodes = ends.unique().sort()
        at = pc.index_in(ends, nodes).to_numpy().astype(np.int64)
        label = united(at[: both.num_rows], at[both.num_rows :], len(nodes))
        yield pa.RecordBatch.from_arrays([nodes, nodes.take(pa.array(label))], names=["node", "to"])

    return pairs.coalesce(1).mapInArrow(run, f"node {kind}, to {kind}")


def united(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest member of each node's component, for edges (a, b) among n numbered nodes."""
    parent = np.arange(n)
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(above := parent[parent], parent):
            parent = above
    return parent
