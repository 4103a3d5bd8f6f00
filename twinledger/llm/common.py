"""Shared helpers: words, checkpoints, bounded memos, joins with heavy keys."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space; bytes.split() cuts in the same places.
WORD = r"[^\x20\x09-\x0D]+"


class Memo(dict):
    """A function's results, forgotten all at once when there are too many, so that a worker's memory stays bounded."""

    def __init__(self, fn: Callable, limit: int = 300_000):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.fn(key)
        return value


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session; one of this machine only if none is set and everything runs on it."""
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
    """The rows, computed once and kept in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], key: str, text: str, most: int, first: Callable[[bytes], bytes] = bytes) -> Iterator[list[tuple]]:
    """(key, words) of documents, in lists of about `most` words; `first` is applied to a text before it is cut."""
    held, n = [], 0
    for batch in batches:
        for k, t in zip(batch.column(key).to_pylist(), utf8(batch.column(text))):
            words = first(t).split() if t else []
            held.append((k, words))
            n += len(words)
            if n >= most:
                yield held
                held, n = [], 0
    if held:
        yield held


def join_heavy(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, total: int, share: int = 1000) -> DataFrame:
    """rows inner join table, which has one row for each key and, in `weight`, how many rows have it.

    Keys with at least 1/share of all rows are at most `share`, so these are broadcast; no other key is large.
    """
    heavy = F.col(weight) * share >= total
    keys = list(keys)
    light_rows = rows.join(F.broadcast(table.where(heavy).select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(table.where(heavy)), keys).unionByName(light_rows.join(table.where(~heavy), keys))
