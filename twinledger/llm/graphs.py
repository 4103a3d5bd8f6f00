"""Connected components by smallest labels."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import cut

#: Nodes that a task joins up at a time; more are done in further lots.
LOT = 500_000


def local_stars(edges: DataFrame) -> DataFrame:
    """Fewer edges (a > b) that connect the same nodes: each lot of a partition's edges as stars around the smallest nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := root.get(x, x)) != x:
                root[x] = root.get(y, y)
                x = y
            return x

        def stars() -> pa.RecordBatch:
            found = [(x, find(x)) for x in list(root)]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else [()] * 2)], names=["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = find(a), find(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
            if len(root) >= LOT:
                yield stars()
                root.clear()
        yield stars()

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def _unfinished(links: DataFrame) -> bool:
    """Whether some node hangs on two others, or on one that hangs itself."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.lit(1).alias("up")), F.struct(F.col("b").alias("x"), F.lit(0).alias("up")))).alias("e")).select("e.*")
    seen = ends.groupBy("x").agg(F.sum("up").alias("ups"), F.min("up").alias("leaf"))
    return not seen.where("ups > 1 or (ups = 1 and leaf = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, label (smallest node it reaches) for all nodes of edges (a, b).

    Rounds hang every node and its neighbours on the smallest of them until all are stars (alternating large-star and
    small-star); the number of rounds grows with the logarithm of the longest chain.
    """
    links = cut(local_stars(edges).where("a <> b").distinct())
    while _unfinished(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select("a", "b", "m")
        small = small.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        links = cut(local_stars(small.where("a <> b")).distinct())
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionByName(stars.select(F.col("label").alias("node"), "label").distinct())
