"""Connected components by alternating large and small stars, all in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .runtime import materialize


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges to stars on the least node that they link: as many as it has
    nodes at most, with the same components."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while root[top] != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            root.setdefault(u, u)
            root.setdefault(v, v)
            a, b = find(u), find(v)
            if a != b:
                root[max(a, b)] = min(a, b)
    own = [(x, r) for x in list(root) if (r := find(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in own], pa.int64()), pa.array([r for _, r in own], pa.int64())], ["u", "v"])


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of the undirected ``edges`` (a, b): the least
    id it is linked with, itself included.

    Each task first contracts its own edges. Then each round hangs a node's larger neighbours on its least one, then its
    smaller ones too; the number of rounds grows with the logarithm of a
    component's size. No neighbour list is gathered: rounds are minima per node
    and joins, which adaptive execution splits where a hub is hot. Repeated
    edges, loops and an empty table are fine; null ends are left out.
    """
    ship_package(edges.sparkSession)
    links = edges.filter("a <> b").select(F.greatest("a", "b").cast("long").alias("u"), F.least("a", "b").cast("long").alias("v"))
    links = materialize(links.mapInArrow(_contract, "u long, v long").distinct(), "links")
    while True:
        # stars only: no node is both a centre and a leaf, and no leaf has two centres
        ends = links.select(F.col("u").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(links.select(F.col("v").alias("x"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
        odd = ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre")).filter("leaf + centre > 1 AND leaf > 0")
        if odd.isEmpty():
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "small-stars")
    centres = links.select(F.col("v").alias("id")).distinct()
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(centres.select("id", F.col("id").alias("component")))
