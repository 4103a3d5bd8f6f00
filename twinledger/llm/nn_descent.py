"""Approximate nearest neighbours by cosine: a neighbour graph by NN-descent, searched greedily from its nodes.

Equal vectors are one node.  First lists come from several random orders of the nodes, cut into short runs.  Each
round of NN-descent then joins every node's neighbours, and those that have it as a neighbour, with each other where one
of the two is new to the node, and keeps the best per node, until few entries change.  A query walks the graph: it opens
the best nodes it has seen, meets their neighbours, and goes on until all of its best are open.  So both the number of
rounds and the length of a walk follow from the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import cut, join_heavy, partitions

EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sim", pa.float64())])
EDGE_DDL = "a long, b long, sim double"


def matrix(column) -> np.ndarray:
    """The vectors of a list column, one a row."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return np.asarray(column.flatten(), np.float64).reshape(n, -1) if n else np.empty((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v: vectors without null, zero and non-finite ones, of the most frequent length (the smaller one on ties)."""
    v = F.col("v")
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where(v.isNotNull() & F.col("id").isNotNull()).where(~odd).where(F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).select("d")
    return rows.join(F.broadcast(length), F.size("v") == F.col("d")).drop("d")


def top(edges: DataFrame, k: int) -> DataFrame:
    """The k best b of each a, ties to the smaller b; `fresh` if none of the equal edges is old."""
    best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    one = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    return one.withColumn("r", best).where(F.col("r") <= k).drop("r")


def first_lists(nodes: DataFrame, dims: int, k: int, orders: int, run: int, seed: int) -> DataFrame:
    """Edges inside runs of neighbours in `orders` random orders: signs of projections, then one projection's value."""
    planes = np.random.default_rng(seed).standard_normal((orders, 13, dims))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = unit(matrix(batch.column(1)))
            for o in range(orders):
                p = x @ planes[o].T
                code = (p[:, 1:] > 0) @ (1 << np.arange(12))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), o)), pa.array(code), pa.array(p[:, 0]), *batch.columns], names=["o", "code", "fine", "id", "v"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, run):
            ids, x = table["id"].to_numpy(), unit(matrix(table["v"]))
            sims = x @ x.T
            np.fill_diagonal(sims, -2)
            m = min(k, len(ids) - 1)
            if m < 1:
                continue
            at = np.argpartition(-sims, m - 1, axis=1)[:, :m]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, m)), pa.array(ids[at].ravel()), pa.array(np.take_along_axis(sims, at, 1).ravel())], schema=EDGE)

    keyed = nodes.mapInArrow(keys, "o long, code long, fine double, id long, v array<float>")
    dealt = keyed.repartitionByRange(partitions(nodes.sparkSession), "o", "code", "fine").sortWithinPartitions("o", "code", "fine", "id")
    return dealt.select("id", "v").mapInArrow(compare, EDGE_DDL)


def runs(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.Table]:
    """Consecutive rows in tables of `run` rows; the last one has the rest and part of what came before."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        while len(held) >= 2 * run:
            yield held.slice(0, run)
            held = held.slice(run)
    if held is not None and len(held):
        yield held


def descend(graph: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """One round: neighbours of neighbours.  Of the nodes that have one as a neighbour, the k nearest take part.

    Two neighbours meet if one of them is fresh, that is came in the round before; others have met already.
    """
    back = top(graph.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim", "fresh"), k)
    around = graph.unionByName(back).groupBy("a", "b").agg(F.max("fresh").alias("fresh"))
    # the least similarity that still enters a node's list
    least = graph.groupBy("a").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(F.lit(-2.0)).alias("least"))
    held = nodes.join(least, nodes.id == least.a).select("id", "v", "least")
    near = around.join(held, around.b == held.id).select(F.col("a").alias("at"), "id", "v", "least", "fresh")

    def local(table: pa.Table) -> pa.Table:
        fresh = np.asarray(table["fresh"].combine_chunks().to_numpy(zero_copy_only=False), bool)
        if not fresh.any():
            return EDGE.empty_table()
        ids, x, least = table["id"].to_numpy(), unit(matrix(table["v"])), table["least"].to_numpy()
        sims = x @ x.T
        np.fill_diagonal(sims, -3)
        i, j = np.nonzero((sims > least[:, None]) & (fresh[:, None] | fresh))
        return pa.Table.from_arrays([pa.array(ids[i]), pa.array(ids[j]), pa.array(sims[i, j])], schema=EDGE)

    found = near.groupBy("at").applyInArrow(local, EDGE_DDL)
    old = graph.withColumn("fresh", F.lit(False))
    return top(old.unionByName(found.withColumn("fresh", F.lit(True))), k)


def small(v):
    """Vectors as they travel while the graph is built: scaled to [-1, 1], in single precision."""
    most = F.array_max(F.transform(v, F.abs))
    return F.transform(v, lambda x: (x / most).cast("float"))


def build_graph(nodes: DataFrame, dims: int, k: int = 32, orders: int = 8, run: int = 128, settled: float = 0.02, seed: int = 0) -> DataFrame:
    """a, b, sim: about the k nearest b of each node a.  Similarities are good to single precision; answers are scored anew.

    Rounds go on until at most the share `settled` of all entries is new.
    """
    nodes = cut(nodes.select("id", small(F.col("v")).alias("v")))
    graph = cut(top(first_lists(nodes, dims, k, orders, run, seed).withColumn("fresh", F.lit(True)), k))
    while True:
        size = graph.agg(F.count("*").alias("n"), F.count_if("fresh").alias("fresh")).first()
        if size.fresh <= settled * size.n:
            return graph.drop("fresh")
        graph = cut(descend(graph, nodes, k))


def cosines(pairs: DataFrame) -> DataFrame:
    """a, b, sim of rows a, va, b, vb, in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = matrix(batch.column(1)), matrix(batch.column(3))
            sim = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)) if len(x) else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sim)], schema=EDGE)

    return pairs.select("a", "va", "b", "vb").mapInArrow(run, EDGE_DDL)


def search(starts: DataFrame, graph: DataFrame, nodes: DataFrame, beam: int, opened: int) -> DataFrame:
    """a, b, sim: the `beam` nearest nodes seen from each start a, itself included.

    Each hop opens the best `opened` nodes not opened yet of each start's beam; the walk ends when no start has one.
    A beam only gets better, so a node that left it stays out and the walk comes to an end.
    """
    mine = nodes.join(starts, nodes.id == starts.a, "left_semi").select(F.col("id").alias("a"), F.col("v").alias("va"))
    theirs = nodes.select(F.col("id").alias("b"), F.col("v").alias("vb"))
    both_ways = graph.select("a", "b").unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    every = both_ways.withColumn("sim", -F.xxhash64("a", "b").cast("double")).unionByName(graph).withColumn("fresh", F.lit(False))
    links = cut(top(every, 2 * graph_width(graph)).select(F.col("a").alias("at"), F.col("b").alias("next")))
    own = mine.select("a", "va", F.col("a").alias("b"), F.col("va").alias("vb"))
    seen = cut(cosines(own).withColumn("open", F.lit(False)))
    while not seen.where("not open").isEmpty():
        rank = F.row_number().over(Window.partitionBy("a", "open").orderBy(F.desc("sim"), "b"))
        marked = seen.withColumn("now", ~F.col("open") & (rank <= opened))
        new = marked.where("now").join(links, F.col("b") == links["at"]).select("a", F.col("next").alias("b")).distinct()
        new = new.join(seen.select("a", "b"), ["a", "b"], "left_anti")
        scored = cosines(new.join(mine, "a").join(theirs, "b")).withColumn("open", F.lit(False))
        every = marked.select("a", "b", "sim", (F.col("open") | F.col("now")).alias("open")).unionByName(scored)
        best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
        seen = cut(every.withColumn("r", best).where(F.col("r") <= beam).drop("r"))
    return seen.select("a", "b", "sim")


def graph_width(graph: DataFrame) -> int:
    return graph.groupBy("a").count().agg(F.max("count")).first()[0] or 1


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            beam: int = 192, opened: int = 32, **graph_options) -> DataFrame:
    """query_id, rank (from 1), id, score: each query's k nearest of all other rows, largest cosine first.

    queries: rows of `vectors`, by id.  Ties go to the smaller id.  Vectors that are null, zero, of another length than
    most, or hold null or non-finite components take no part, neither do rows with a null id.  Rows that repeat an id
    count once, with the smallest of their vectors.  Fewer rows than k give fewer neighbours, an empty table none;
    columns other than the two named are not looked at.
    """
    rows = valid_vectors(vectors, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
    # of equal vectors the first k + 1 are enough; ranks are limited before the shuffle, so no copies travel
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = cut(rows.withColumn("r", rank).where(F.col("r") <= k + 1))
    nodes = cut(few.where("r = 1").select("id", "v"))
    members = few.groupBy("v").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("ids")).select("node", "ids", F.col("v").alias("mv"))
    first = nodes.first()
    dims = len(first.v) if first else 1
    graph = build_graph(nodes, dims, **graph_options)

    asked = rows.join(queries.select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
    asked = cut(asked.join(nodes.select(F.col("id").alias("node"), F.col("v").alias("nv")), F.col("v") == F.col("nv")).select("id", "node"))
    starts = asked.groupBy("node").agg(F.count("*").alias("n"))
    found = search(starts.select(F.col("node").alias("a")), graph, nodes, beam, opened)
    # exact scores of the first few, once for each distinct query
    best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    found = found.withColumn("r", best).where(F.col("r") <= k + 1)
    answer = found.join(members, found.b == members.node).select("a", "sim", F.explode("ids").alias("b"))
    answer = answer.groupBy("a").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("sim")).alias("far"), "b"))), 1, k + 1).alias("near"))
    table = answer.join(starts, answer.a == starts.node).select("node", "near", "n")
    each = join_heavy(asked, table, ["node"], "n", asked.count())
    own = F.filter("near", lambda x: x.b != F.col("id"))
    return each.select(F.col("id").alias("query_id"), F.posexplode(F.slice(own, 1, k)).alias("p", "x")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.b").alias(id_col), (-F.col("x.far")).alias("score"))
