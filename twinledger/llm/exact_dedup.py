"""Exact duplicates through an extendible-hash index on shared files.

The directory starts with as many hash bits as the number of entries asks for and is doubled wherever a bucket is
overfull, until each holds `capacity` entries or all doublings are used; what is overfull then is a longer chain.
Buckets are written in the order of their hashes, a range of them to each owner task.  Entries with one hash are told
apart by digest, and documents that an entry has more than one of are compared byte by byte.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from twinledger.llm.common import cut, join_heavy, lower_ascii, shared_dir

BITS = 60  # of the digest, as a positive long
DOUBLINGS = 6


def bucket_of(entries: DataFrame, capacity: int, total: int) -> DataFrame:
    """The entries with depth and bucket: how many leading bits of their hash name their bucket, and these bits."""
    start = min(BITS - DOUBLINGS, max(0, math.ceil(math.log2(max(1, total / capacity)))))
    deepest = start + DOUBLINGS
    bits = lambda d: F.shiftrightunsigned("cell", deepest - d)
    cells = entries.groupBy(F.shiftrightunsigned("h", BITS - deepest).alias("cell")).agg(F.count("*").alias("n"))
    depth = F.lit(deepest)
    for d in range(deepest - 1, start - 1, -1):
        held = F.sum("n").over(Window.partitionBy(bits(start), bits(d)))
        depth = F.when(held <= capacity, F.lit(d)).otherwise(depth)
    directory = cells.select("cell", depth.alias("depth"))
    # a directory entry for each cell: those of one bucket point to the same place
    return entries.withColumn("cell", F.shiftrightunsigned("h", BITS - deepest)).join(directory, "cell").select(
        *entries.columns, "depth", F.expr(f"shiftrightunsigned(cell, {deepest} - depth)").alias("bucket"))


def write_index(entries: DataFrame, capacity: int) -> DataFrame:
    """The entries in files of the shared folder, ordered by hash, with their buckets."""
    spark = entries.sparkSession
    path = f"{shared_dir(spark)}/extendible-{uuid.uuid4().hex}"
    placed = bucket_of(entries, capacity, entries.count())
    placed.repartitionByRange("h").sortWithinPartitions("h", "digest").write.parquet(path)
    return spark.read.parquet(path)


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _hash(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("long")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, salts: int = 16) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after lower-casing A-Z; null counts as empty.  The row with the largest id stays;
    rows that also repeat the id stay or go together, and a null id stays only where its group has no other.
    A digest that two different texts share stops the job.
    """
    norm = F.coalesce(lower_ascii(F.col(text_col)), F.lit(""))
    keyed = cut(docs.select(F.col(id_col).alias("id"), _digest(norm).alias("hex")).select("id", _hash(F.col("hex")).alias("h"), F.unhex("hex").alias("digest")))
    index = write_index(keyed.groupBy("h", "digest").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")), capacity)

    # rows of a large group are dealt over several salts, so the few entries with more than one row are repeated
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    several = index.where("group_size > 1").select("h", "digest", salt.alias("salt"))
    texts = docs.select(norm.alias("norm"), F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int").alias("salt"), _digest(norm).alias("hex"))
    texts = texts.select("norm", "salt", _hash(F.col("hex")).alias("h"), F.unhex("hex").alias("digest"))
    chains = texts.join(several, ["h", "digest", "salt"]).groupBy("digest", "norm").count()
    clashes = chains.groupBy("digest").agg(F.count("*").alias("texts")).where("texts > 1").count()
    if clashes:
        raise ValueError(f"{clashes} digests have more than one text")

    total = keyed.count()
    out = join_heavy(keyed, index.select("h", "digest", "keep_id", "group_size"), ["h", "digest"], "group_size", total)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
