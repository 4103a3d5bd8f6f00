"""Two-pass external shuffle into shards.

The first pass scatters the rows by a seeded hash into buckets that fit in a task's memory; the second shuffles each
bucket by Fisher-Yates and writes it.  The buckets one after another are a random order of all rows, which is cut into
shards whose row counts are at most one apart.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import cut, shared_dir

#: Copies of one row that a task deals out at a time.
CHUNK = 4096


def _apart(rows: DataFrame, several: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """rows whose key is in several (key, n), and the others; keys with a thousandth of all rows, at most 1000, are broadcast."""
    heavy = F.col("n") * 1000 >= total
    hot, rare = F.broadcast(several.where(heavy).select("key")), several.where(~heavy).select("key")
    rest = rows.join(hot, "key", "left_anti")
    return rows.join(hot, "key", "left_semi").unionByName(rest.join(rare, "key", "left_semi")), rest.join(rare, "key", "left_anti")


def _copies(rows: DataFrame) -> DataFrame:
    """rows (..., n) n times each, with `copy` from 0; those of one row are dealt over tasks in chunks."""
    chunks = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {CHUNK}")))).repartition("key", "chunk")
    return chunks.withColumn("copy", F.explode(F.sequence(F.col("chunk") * CHUNK, F.least("n", (F.col("chunk") + 1) * CHUNK) - 1))).drop("chunk", "n")


def shuffle_into_shards(docs: DataFrame, shards: int = 8, seed: int = 11, id_col: str = "doc_id", text_col: str = "text",
                        bucket_bytes: int = 16 << 20, path: str | None = None) -> DataFrame:
    """Per row: id, text, size (UTF-8 bytes and 1), bucket, shard, slot; read from the shards written to `path`.

    `path` gets a folder `shard=k` for each shard, its files in the order of slots; left out, it is a new folder of the
    session's shared one.  Row counts of shards are at most one apart and slots have no gap.  A bucket is one array in
    one task: `bucket_bytes` times some six must fit its memory, and the number of buckets (tasks) grows with the input,
    so at 100 TB give 512 MB or so.  Null and empty texts are rows of size 1.  Ids may be null or of any type.  Rows
    that repeat id and text are shuffled one by one, like different rows, without meeting in one task; very long texts
    are one row of a larger bucket; an empty table gives no rows.  Other columns are left out, whatever their names.
    The order depends on the seed, the rows and the number of buckets, not on the layout of the input.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    slim = slim.withColumn("size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1)
    slim = slim.withColumn("key", F.xxhash64(F.lit(seed), F.col("id").isNull(), F.col("id").cast("string"), F.col("text").isNull(), "text"))
    keys = cut(slim.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")))
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.max("n").alias("most")).first()
    buckets = max(1, math.ceil(total.bytes / bucket_bytes))
    bucket = F.pmod(F.xxhash64(F.lit(seed), "key", "copy"), F.lit(buckets)).alias("bucket")

    once = keys.where("n = 1").select("key", F.lit(0).cast("long").alias("copy"))
    rows = slim.withColumn("copy", F.lit(0).cast("long"))
    if (total.most or 0) > 1:
        several = keys.where("n > 1").select("key", "n")
        again, single = _apart(slim, several, total.rows)
        grouped = again.groupBy("key", "id", "text", "size").agg(F.count("*").alias("n"))
        rows = single.withColumn("copy", F.lit(0).cast("long")).unionByName(_copies(grouped))
        once = once.unionByName(_copies(several))
    counts = once.groupBy(bucket).agg(F.count("*").alias("held"))
    # as many rows as buckets: the only step in one task
    starts = counts.select("bucket", (F.sum("held").over(Window.orderBy("bucket")) - F.col("held")).alias("before"))

    held = rows.select(bucket, F.struct("key", "copy", "id", "text", "size").alias("row")).repartition(buckets, "bucket")
    held = held.groupBy("bucket").agg(F.sort_array(F.collect_list("row")).alias("rows")).join(starts, "bucket")
    # the random numbers of a task follow the order of its buckets, so a second run of it gives the same
    mixed = held.sortWithinPartitions("bucket").select("bucket", "before", F.shuffle("rows", F.lit(seed)).alias("rows"))
    dealt = mixed.select("bucket", "before", F.posexplode("rows").alias("at", "row"))
    out = dealt.select("row.id", "row.text", "row.size", "bucket", *_place("before", "at", total.rows, shards))
    path = path or f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return spark.read.schema(out.schema).parquet(path).withColumnRenamed("id", id_col)


def _place(before: str, at: str, total: int, shards: int) -> list[Column]:
    """shard and slot of a row's place among all, in whole numbers; the first total % shards shards have a row more."""
    small, more = divmod(total, shards)
    edge, place = more * (small + 1), f"({before} + {at})"
    shard = f"IF({place} < {edge}, {place} div {small + 1}, {more} + ({place} - {edge}) div {max(small, 1)})"
    slot = f"IF({place} < {edge}, {place} % {small + 1}, ({place} - {edge}) % {max(small, 1)})"
    return [F.expr(shard).cast("int").alias("shard"), F.expr(slot).cast("long").alias("slot")]
