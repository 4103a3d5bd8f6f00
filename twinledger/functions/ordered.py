"""Ordered work inside keys that stays parallel when one key holds a large share of all rows.

A plain ``Window.partitionBy(key).orderBy(...)`` puts every row of a key into one task.  That is the right plan while
keys are small, so each function first asks (or is told through ``large``) whether any key exceeds the bound.  The
question is one count per key over the key columns, combined on the map side.

When a key is too large, keys are cut into chunks that follow the order, the window runs inside (key, chunk), and a
small per-chunk table carries the state from one chunk to the next.  The input is checkpointed first, so the passes
over it read the same rows and a lost executor costs no recomputation of what came before.

The cut points of a large key are order values of its own rows, picked by a hash of the value, so every task and
every retry finds the same chunks.  A key yields about ``rows / chunk_rows`` cut points and never more than about
``MAX_CUTS``; at most ``all rows / chunk_rows`` keys can be large.  Both bounds make the broadcasts below small.
"""

from __future__ import annotations

import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

CHUNK_ROWS = 1_000_000
PART_ROWS = 100_000
MAX_CUTS = 1_000
CHUNK = "_chunk"


def has_large_key(df: DataFrame, keys: list[str], bound: int = CHUNK_ROWS) -> bool:
    """Whether some key has more than ``bound`` rows.  Keys finer than ``keys`` are then at most that large too."""
    return not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > bound).isEmpty()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder the session names; one of this machine only if all runs on it and none is named."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            named = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def _look(df: DataFrame, keys: list[str], bound: int, large: bool | None) -> bool:
    return has_large_key(df, keys, bound) if large is None else large


def _join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Broadcast join that treats null keys as equal and keeps one copy of the keys."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[f"_r_{k}"])
    return left.join(F.broadcast(right), cond, how).drop(*[f"_r_{k}" for k in keys])


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def chunked(df: DataFrame, keys: list[str], order: list, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``_chunk``: 0 for ordinary keys, else the number of cut points at or below the row's order value.

    ``order`` must sort ascending.  Rows that tie on all of ``order`` share a chunk.
    """
    value = F.struct(*[_as_col(c).alias(f"o{i}") for i, c in enumerate(order)])
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > chunk_rows)
    every = F.greatest(F.lit(chunk_rows), F.ceil(F.col("_n") / MAX_CUTS)).cast("long")
    cuts = (
        _join_keys(df.select(*keys, value.alias("_v")), large, keys, "inner")
        .filter(F.pmod(F.xxhash64(F.to_json("_v")), every) == 0)
        .groupBy(*keys).agg(F.sort_array(F.collect_set("_v")).alias("_cuts"))
    )
    marked = _join_keys(df, cuts, keys)
    chunk = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(
        F.size(F.filter("_cuts", lambda c: c <= value)))
    return marked.withColumn(CHUNK, chunk.cast("int")).drop("_cuts")


def _spread(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.repartition(*[F.col(k) for k in keys], F.col(CHUNK))


def _chunk_totals(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Per-chunk aggregates of the keys that have more than one chunk."""
    many = df.filter(F.col(CHUNK) > 0).select(*keys).distinct()
    return _join_keys(df, many, keys, "left_semi").groupBy(*keys, CHUNK).agg(*aggs)


def ordinal(df: DataFrame, keys: list[str], order: list, name: str, chunk_rows: int = CHUNK_ROWS,
            large: bool | None = None) -> DataFrame:
    """1-based ``row_number`` inside ``keys`` by ``order`` (ascending)."""
    if not _look(df, keys, chunk_rows, large):
        w = W.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w).cast("long"))
    c = chunked(cut(df), keys, order, chunk_rows)
    w = W.partitionBy(*keys, CHUNK).orderBy(*order)
    local = _spread(c, keys).withColumn(name, F.row_number().over(w))
    before = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    carry = _chunk_totals(c, keys, [F.count(F.lit(1)).alias("_n")]).select(
        *keys, CHUNK, F.sum("_n").over(before).alias("_before"))
    return (
        _join_keys(local, carry, keys + [CHUNK])
        .withColumn(name, (F.col(name) + F.coalesce("_before", F.lit(0))).cast("long"))
        .drop("_before", CHUNK)
    )


def running(df: DataFrame, keys: list[str], order: list, outputs: dict[str, tuple[str, Column]],
            chunk_rows: int = CHUNK_ROWS, include_current: bool = True, large: bool | None = None) -> DataFrame:
    """Running aggregates from the first row of the key up to each row.

    ``outputs`` maps a new column to ``(kind, expression)`` with kind ``sum``, ``min``, ``max`` or ``last``
    (latest non-null).  With ``include_current=False`` the row itself is left out.
    """
    kinds = {"sum": F.sum, "min": F.min, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}
    upto = W.currentRow if include_current else -1
    if not _look(df, keys, chunk_rows, large):
        w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, upto)
        return df.withColumns({name: kinds[k](e).over(w) for name, (k, e) in outputs.items()})
    c = chunked(cut(df.withColumns({f"_x{i}": e for i, (_, e) in enumerate(outputs.values())})), keys, order, chunk_rows)
    w = W.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(W.unboundedPreceding, upto)
    wc = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    value = F.struct(*[_as_col(o).alias(f"o{i}") for i, o in enumerate(order)])
    local, totals, carried, final = {}, [], [], {}
    for i, (name, (kind, _)) in enumerate(outputs.items()):
        x, l, t, b = F.col(f"_x{i}"), F.col(f"_l{i}"), F.col(f"_t{i}"), F.col(f"_c{i}")
        local[f"_l{i}"] = kinds[kind](x).over(w)
        total = F.max_by(x, F.when(x.isNotNull(), value)) if kind == "last" else kinds[kind](x)
        totals.append(total.alias(f"_t{i}"))
        carried.append(kinds[kind](t).over(wc).alias(f"_c{i}"))
        if kind == "last":
            final[name] = F.coalesce(l, b)
        elif kind == "sum":
            final[name] = F.coalesce(l + b, l, b)
        else:
            final[name] = (F.least if kind == "min" else F.greatest)(l, b)
    carry = _chunk_totals(c, keys, totals).select(*keys, CHUNK, *carried)
    out = _join_keys(_spread(c, keys).withColumns(local), carry, keys + [CHUNK]).withColumns(final)
    n = len(outputs)
    return out.drop(CHUNK, *[f"_{p}{i}" for p in "xlc" for i in range(n)])


def following(df: DataFrame, keys: list[str], order: list, name: str, expr: Column,
              chunk_rows: int = CHUNK_ROWS, large: bool | None = None) -> DataFrame:
    """First non-null ``expr`` among the rows after each row."""
    if not _look(df, keys, chunk_rows, large):
        w = W.partitionBy(*keys).orderBy(*order).rowsBetween(1, W.unboundedFollowing)
        return df.withColumn(name, F.first(expr, ignorenulls=True).over(w))
    c = chunked(cut(df.withColumn("_x", expr)), keys, order, chunk_rows)
    w = W.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(1, W.unboundedFollowing)
    wc = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(1, W.unboundedFollowing)
    value = F.struct(*[_as_col(o).alias(f"o{i}") for i, o in enumerate(order)])
    x = F.col("_x")
    carry = _chunk_totals(c, keys, [F.min_by(x, F.when(x.isNotNull(), value)).alias("_t")]).select(
        *keys, CHUNK, F.first("_t", ignorenulls=True).over(wc).alias("_c"))
    local = _spread(c, keys).withColumn("_l", F.first("_x", ignorenulls=True).over(w))
    return (
        _join_keys(local, carry, keys + [CHUNK])
        .withColumn(name, F.coalesce("_l", "_c")).drop(CHUNK, "_x", "_l", "_c")
    )


def best_per_key(df: DataFrame, keys: list[str], order: list, columns: list[str]) -> DataFrame:
    """The first row of each key by ``order`` (ascending), as a map-side combined aggregate."""
    o = F.struct(*[_as_col(c).alias(f"o{i}") for i, c in enumerate(order)])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), o).alias("_r"))
    return picked.select(*keys, *[F.col("_r")[c].alias(c) for c in columns])


def joined_parts(df: DataFrame, keys: list[str], number: str, text: Column, sep: str, name: str, part_rows: int,
                 extra: list[Column] | None = None) -> DataFrame:
    """Ordered concatenation of ``text`` per key in parts of ``part_rows`` entries, by the dense 1-based ``number``."""
    entry = F.struct(F.col(number).alias("o"), text.alias("t"))
    return (
        df.withColumn("part", F.floor((F.col(number) - 1) / part_rows).cast("int"))
        .groupBy(*keys, "part")
        .agg(F.sort_array(F.collect_list(entry)).alias("_e"), *(extra or []))
        .withColumn(name, F.array_join(F.transform("_e", lambda e: e["t"]), sep))
        .drop("_e")
    )


def joined_text(df: DataFrame, keys: list[str], order: list, text: Column, sep: str, name: str,
                part_rows: int = PART_ROWS, large: bool | None = None) -> DataFrame:
    """Ordered concatenation of ``text`` per key.

    A key with up to ``part_rows`` rows gives exactly one row (``part`` 0).  A larger key gives further numbered
    parts, so no task holds a whole large key and nothing is left out.
    """
    if _look(df, keys, part_rows, large):
        numbered = ordinal(df, keys, order, "_number", chunk_rows=max(part_rows, 1))
        return joined_parts(numbered, keys, "_number", text, sep, name, part_rows)
    entry = F.struct(*[_as_col(c).alias(f"o{i}") for i, c in enumerate(order)], text.alias("t"))
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("_e")).select(
        *keys, F.lit(0).alias("part"), F.array_join(F.transform("_e", lambda e: e["t"]), sep).alias(name))


def attach(left: DataFrame, keys: list[str], rights: dict[str, DataFrame], by_name: bool = False) -> DataFrame:
    """Left join with tables of one row per key, each as a struct column of its name (null where it has no row).

    A join exchanges both sides by all of ``keys``, also where they lie partitioned by some of them.  Tables that do
    (``by_name``) therefore travel as one union, and one window hands the rows over without any exchange.
    """
    rights = {name: r.select(*keys, F.struct(*[c for c in r.columns if c not in keys]).alias(name)) for name, r in rights.items()}
    if not by_name:
        return reduce(lambda rows, right: rows.join(right, keys, "left"), rights.values(), left)
    rows = left.withColumns({**{k: F.col(k) for k in keys}, "_own": F.lit(True)})
    for right in rights.values():
        rows = rows.unionByName(right.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    # null keys match nothing
    known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    w = W.partitionBy(*keys)
    found = {name: F.when(known, F.first(name, ignorenulls=True).over(w)) for name in rights}
    return rows.withColumns(found).filter("_own").drop("_own")


def gathered(left: DataFrame, keys: list[str], parts: list[DataFrame], aggs: dict[str, Column]) -> DataFrame:
    """``left`` with aggregates of the rows, its own and those of ``parts``, that share its keys, as new columns.

    Aggregates that collect lists keep them beside their rows and sort them twice.  Here all travel as one union, sorted
    once, and the aggregates are windows: without any exchange, where the tables lie partitioned by the first key.
    ``parts`` share no column but the keys with ``left``.  A row of ``left`` with a null key takes no part.
    """
    rows = left.withColumns({**{k: F.col(k) for k in keys}, "_own": F.lit(True)})
    for p in parts:
        rows = rows.unionByName(p.withColumns({**{k: F.col(k) for k in keys}, "_own": F.lit(False)}), allowMissingColumns=True)
    # null keys match nothing
    known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    w = W.partitionBy(*keys)
    made = rows.withColumns({name: a.over(w) for name, a in aggs.items()}).filter("_own")
    return made.select(*left.columns, *[F.when(known, F.col(name)).alias(name) for name in aggs])
