"""Connected components of an edge table by alternating large-star and small-star steps.

First each task joins what its own edges connect (union-find over a bounded number of nodes at a time) and
hands on one edge to the least node of each; that leaves few rounds, and none where all edges were in one such piece. Where so few edges are
left that one task can hold their nodes, it joins them in the same way. All further
steps are joins and aggregations; hot nodes are pre-aggregated and spread, and nothing is
collected but a count. Each round is written to the shared folder, so a lost
executor costs one round."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardamom.llm._common import Staged, at_most


#: Neighbours of a node that meet its least one in one task; those of a hub are spread over several.
HUB = 2_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: each node's neighbours (its larger ones, if ``large``) are linked to its least one."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("a", "m"))
    parts = F.ceil(F.col("n") / HUB).cast("int")
    hubs = least.filter(F.col("n") > HUB).select("a", parts.alias("parts"))
    both = both.join(hubs, "a", "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")), F.lit(0)).cast("int")).drop("parts")
    out = both.join(least.select("a", "m", F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt")), ["a", "salt"])
    if large:
        out = out.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.filter("a <> b").distinct()


#: Nodes that a task joins at a time.
HELD = 1_000_000
#: Edges that one task joins when others have joined theirs.
LAST = 125_000


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b, piece) that connect what the given ones do, b being the least node that a piece of a task's edges leads to from a."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        piece = TaskContext.get().partitionId() << 32

        def root(x: int) -> int:
            while (y := parent[x]) != x:
                parent[x] = x = parent[y]
            return x

        def give() -> pa.RecordBatch:
            pairs = [(x, y) for x in parent if (y := root(x)) != x]
            return pa.RecordBatch.from_arrays([*(pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)), pa.array([piece] * len(pairs), pa.int64())], names=["a", "b", "piece"])

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parent.setdefault(x, x)
                parent.setdefault(y, y)
                x, y = root(x), root(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if len(parent) > HELD:
                yield give()
                parent.clear()
                piece += 1
        yield give()

    return edges.mapInArrow(run, "a long, b long, piece long")


def _state(edges: DataFrame) -> tuple:
    """What changes with every step that changes something: the sums of all ends fall."""
    row = edges.agg(F.count("*").alias("n"), F.sum(F.col("b").cast("decimal(38,0)")).alias("s"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["s"], row["h"]


def _listed(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60, tasks: int | None = None) -> DataFrame:
    """(node, component): the least node that each node of an edge can reach. Tables are written by ``tasks`` tasks at most.

    Nodes of no edge are not listed. Null ends are dropped; loops and repeated edges do no harm."""
    once = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b")).distinct()
    held = Staged(_contracted(at_most(once, tasks)), "edges")
    ends = held.read().agg(F.min("piece").alias("x"), F.max("piece").alias("y")).first()
    if ends["x"] == ends["y"]:  # one piece, or no edge at all: each node has its least one
        return _listed(held.read())
    if held.read().count() <= LAST:
        held, pieces = Staged(_contracted(held.read().select("a", "b").coalesce(1)), "edges"), held
        pieces.drop()
        return _listed(held.read())
    held, pieces = Staged(at_most(held.read().select("a", "b").distinct(), tasks), "edges"), held
    pieces.drop()
    state = _state(held.read())
    for _ in range(rounds):
        new = Staged(at_most(_star(_star(held.read(), True), False), tasks), "edges")
        held.drop()
        held, before, state = new, state, _state(new.read())
        if state == before:
            return _listed(held.read())
    raise RuntimeError(f"components did not settle in {rounds} rounds")
