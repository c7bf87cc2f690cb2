"""Connected components of a graph too large for one machine, by alternating stars."""

import pyarrow as pa
from pyspark.sql import functions as F

from creditloom.llm.workers import map_batches


def _local_stars(batches):
    """The edges of one task as stars around the smallest node of each of its components."""
    root = {}

    def find(x):
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(u), find(v)
            root.setdefault(u, u), root.setdefault(v, v)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = list(root)
    for first in range(0, len(nodes), 100_000):
        part = [(x, find(x)) for x in nodes[first:first + 100_000]]
        part = [(x, r) for x, r in part if x != r]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in part], pa.int64()), pa.array([r for _, r in part], pa.int64())], names=["u", "v"]
        )


def _is_stars(edges):
    """Whether every node points at one centre and no centre points anywhere."""
    again = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1)
    onward = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi").limit(1)
    return again.select("u").union(onward.select("u")).isEmpty()


def components(links, scratch, name="components"):
    """(node, component) for every node of ``links`` (columns a, b: long); component is its smallest reachable node.

    Each task first shortens its own edges to stars. Then every node connects
    its larger neighbours to its smallest one, and its smaller neighbours
    likewise, in turn, until nothing changes: a few rounds even for long chains.
    A node with very many neighbours only takes part in minima, which combine in
    the tasks, and in joins that adaptive execution splits.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = scratch.keep(map_batches(edges, _local_stars, "u long, v long").distinct(), f"{name}0")
    round_ = 0
    while not _is_stars(edges):
        round_ += 1
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )).alias("e")
        ).select("e.u", "e.v").where("u <> v").distinct()
        edges = scratch.keep(small, f"{name}{round_}")
        scratch.drop(f"{name}{round_ - 1}")
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(leaves.select(F.col("component").alias("node"), "component").distinct())
