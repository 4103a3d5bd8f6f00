"""A result store that a rerun leaves as it is.

Results are kept by key in hash buckets.  A batch reads only the buckets that its keys touch, puts its rows over the
stored ones, and writes these buckets anew as the next version; the others stay where they are.  The version counts once
its commit, one small file, is there.  A run that is interrupted before leaves a version that no reader sees and that
the next run writes over; a batch that has a commit is not stored again.  One writer at a time.

    data/version=3/bucket=17/*.parquet      commits/version=3/*.parquet  (batch, bucket)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

BUCKETS = 64
COMMIT = "batch string, bucket int, version int"


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def _buckets_in(spark: SparkSession, path: str) -> list[int]:
    """The buckets that have a folder there: no more than a store has."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("bucket="))


def commits(spark: SparkSession, path: str) -> DataFrame:
    """(batch, bucket, version): what each stored batch has written."""
    folder = f"{path}/commits"
    return spark.read.schema(COMMIT).parquet(folder) if _exists(spark, folder) else spark.createDataFrame([], COMMIT)


def read_store(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """The stored rows: of each bucket its last committed version.  ``schema`` is that of the rows, for a store that may be empty."""
    # at most one row for each bucket
    latest = commits(spark, path).groupBy("bucket").agg(F.max("version").alias("version"))
    if not _exists(spark, f"{path}/data"):
        if schema is None:
            raise ValueError(f"nothing is stored in {path}; name a schema")
        return spark.createDataFrame([], schema)
    rows = spark.read.parquet(f"{path}/data")
    return rows.join(F.broadcast(latest), ["version", "bucket"], "left_semi").drop("version", "bucket")


def store_results(results: DataFrame, path: str, key: str = "name", batch: str | None = None, order: str | None = None, buckets: int = BUCKETS) -> bool:
    """Put results over those stored under the same key; false if ``batch`` is stored already or has no result.

    Placeholders (null ``result``) are left out.  Of several rows of a key in one batch the largest by ``order``, then
    by the other columns, stays.  Every batch of a store takes the same number of buckets and the same columns.
    """
    spark = results.sparkSession
    known = commits(spark, path)
    if batch is not None and not known.filter(F.col("batch") == batch).isEmpty():
        return False
    version = (known.agg(F.max("version")).first()[0] or 0) + 1
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    others = [c for c in results.columns if c != key]
    rank = F.struct(*([order] if order else []), *others)
    fresh = results.filter(F.col("result").isNotNull()).groupBy(key).agg(F.max_by(F.struct(*others), rank).alias("r")).select(key, "r.*").withColumn("bucket", bucket)
    touched = fresh.select("bucket").distinct()
    rows = fresh
    if version > 1:
        stored = read_store(spark, path).withColumn("bucket", bucket).join(F.broadcast(touched), "bucket", "left_semi")
        both = stored.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
        rows = both.groupBy(key, "bucket").agg(F.max_by(F.struct(*others), F.col("_new")).alias("r")).select(key, "bucket", "r.*")
    folder = f"{path}/data/version={version}"
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
    # what was written names the touched buckets, so the input is not run again for them
    written = _buckets_in(spark, folder)
    if written:
        done = spark.createDataFrame([(batch, b) for b in written], "batch string, bucket int")
        done.coalesce(1).write.mode("overwrite").parquet(f"{path}/commits/version={version}")
    return bool(written)
