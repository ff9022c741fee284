"""Connected components: union-find in tasks of bounded size, then hooking and pointer jumping."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekwise.llm.common import Scratch, salted_lookup

TASK_LINKS = 200_000     # links that one union-find holds


def _flatten(parents: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, parent) with every parent replaced by its root."""
    while True:
        used = parents.groupBy(F.col("parent").alias("at")).agg(F.count("*").alias("weight"))
        jumps = scratch.save(used.join(parents.select(F.col("id").alias("at"), F.col("parent").alias("up")), "at"),
                             "jumps")
        if jumps.isEmpty():
            return parents
        nxt = salted_lookup(parents, jumps.withColumnRenamed("at", "parent"), ["parent"], "weight", ["id"], "left")
        new = scratch.save(nxt.select("id", F.coalesce("up", "parent").alias("parent")), "parents")
        scratch.drop(parents, jumps)
        parents = new


def _local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): a forest with the components of the task's links, every id below its root."""
    up: dict[int, int] = {}
    for batch in batches:
        for ends in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            roots = []
            for x in ends:
                up.setdefault(x, x)
                while up[x] != x:
                    up[x] = x = up[up[x]]
                roots.append(x)
            up[max(roots)] = min(roots)
    found = []
    for x in up:
        r = x
        while up[r] != r:
            r = up[r]
        if r != x:
            found.append((x, r))
    yield pa.RecordBatch.from_pydict({"a": pa.array([a for a, _ in found], pa.int64()),
                                      "b": pa.array([b for _, b in found], pa.int64())})


def _distinct(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(links: DataFrame, scratch: Scratch, task_links: int = TASK_LINKS) -> DataFrame:
    """(id, root) of every id in ``links`` (columns a, b) but the roots.

    Tasks of at most about ``task_links`` links first replace theirs by a
    forest.  If one task holds all, that is the answer.  Otherwise each round
    hooks every id to its smallest neighbour below it, flattens the forest
    and replaces the links by links between roots, until none are left.
    """
    pairs = scratch.save(_distinct(links), "links")
    tasks = -(-pairs.count() // task_links)
    if tasks <= 1:
        found = pairs.coalesce(1).mapInArrow(_local_roots, "a long, b long")
        return scratch.save(found.select(F.col("a").alias("id"), F.col("b").alias("root")), "roots")
    forest = pairs.repartition(tasks, "b").mapInArrow(_local_roots, "a long, b long")
    pairs = scratch.save(_distinct(forest), "links")
    roots = None
    while not pairs.isEmpty():
        parents = _flatten(scratch.save(pairs.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("parent")),
                                        "parents"), scratch)
        found = parents.select("id", F.col("parent").alias("root"))
        ends = pairs
        for side in ("a", "b"):
            used = ends.groupBy(side).agg(F.count("*").alias("weight"))
            up = found.select(F.col("id").alias(side), F.col("root").alias("up")).join(used, side)
            ends = (salted_lookup(ends, up, [side], "weight", ["a", "b"], "left")
                    .withColumn(side, F.coalesce("up", side)).drop("up"))
        nxt = scratch.save(_distinct(ends), "links")
        # earlier roots may have hooked since
        roots = parents if roots is None else _flatten(scratch.save(roots.unionByName(parents), "parents"), scratch)
        scratch.drop(pairs)
        pairs = nxt
    return roots.select("id", F.col("parent").alias("root"))
