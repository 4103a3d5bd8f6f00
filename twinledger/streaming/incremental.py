"""Incremental runs: what is still to do, upserts, and the same work as a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from twinledger.sources import store


def incremental(todo: DataFrame, done: DataFrame, key: str = "name", force: bool = False) -> DataFrame:
    """Rows of ``todo`` whose key is not done; each key is claimed once per run."""
    t = todo.dropDuplicates([key])
    return t if force else t.join(done.select(key).distinct(), key, "left_anti")


def _by_batch(existing: DataFrame, incoming: DataFrame, keys: list[str], pick, order: str | None) -> DataFrame:
    cols = [c for c in existing.columns if c not in keys]
    place = [F.col(order)] if order else []
    rows = existing.withColumn("_b", F.lit(0)).unionByName(incoming.withColumn("_b", F.lit(1)))
    r = rows.groupBy(*keys).agg(pick(F.struct(*cols), F.struct("_b", *place)).alias("_r"))
    return r.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Union by key, the incoming (last) record winning."""
    return _by_batch(existing, incoming, keys, F.max_by, order)


def keep_first(existing: DataFrame, incoming: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Union by key, the stored (first) record winning."""
    return _by_batch(existing, incoming, keys, F.min_by, order)


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Idempotent store: rewrite only the partitions present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def stream_to_store(spark: SparkSession, source: str, schema, path: str, checkpoint: str, key: str = "name",
                    work: Callable[[DataFrame], DataFrame] = lambda df: df, files: int | None = None) -> StreamingQuery:
    """Process the files that are new since the checkpoint, put the results into the store at ``path``, then stop.

    A batch is stored under the checkpoint and its number: one that is repeated after a crash, whether it was stored before or not, leaves
    the store as if it had run once.  ``files`` bounds the files of a batch.
    """
    def batch(df: DataFrame, number: int) -> None:
        store.store_results(work(df), path, key, batch=f"{checkpoint} {number}")

    reader = spark.readStream.schema(schema)
    stream = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_files(spark: SparkSession, source: str, schema, store: str, checkpoint: str, partition: str,
                 work: Callable[[DataFrame], DataFrame] = lambda df: df) -> StreamingQuery:
    """Process new files once, write the result of each batch to its own folder of the store, then stop.

    A repeated batch overwrites its own folder, so a restart after a lost driver adds nothing twice.
    """
    def batch(df: DataFrame, number: int) -> None:
        work(df).write.mode("overwrite").partitionBy(partition).parquet(f"{store}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
