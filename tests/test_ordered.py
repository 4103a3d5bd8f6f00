"""The cut-up paths must equal plain windows, also when one key holds a third of all rows."""

import pytest
from pyspark.sql import Window as W, functions as F

from twinledger.functions import ordered as O


@pytest.fixture(scope="module")
def rows(spark):
    r = spark.range(1500)
    key = F.when(r.id % 3 == 0, F.lit("hot")).otherwise((r.id % 41).cast("string"))
    return r.select(key.alias("k"), F.concat(F.lit("u"), r.id * 7919 % 100).alias("u"), "id",
                    F.when(r.id % 5 == 0, r.id).alias("x"))


def same(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def W_ALL():
    return W.partitionBy("k").orderBy("u", "id")


@pytest.mark.parametrize("chunk", [20, 10_000])
def test_ordinal(rows, chunk):
    want = rows.withColumn("n", F.row_number().over(W_ALL()).cast("long"))
    assert same(O.ordinal(rows, ["k"], ["u", "id"], "n", chunk), want)


@pytest.mark.parametrize("current", [True, False])
def test_running(rows, current):
    w = W_ALL().rowsBetween(W.unboundedPreceding, 0 if current else -1)
    want = rows.withColumns({"s": F.sum("x").over(w), "m": F.min("x").over(w), "l": F.last("x", True).over(w)})
    outs = {"s": ("sum", F.col("x")), "m": ("min", F.col("x")), "l": ("last", F.col("x"))}
    assert same(O.running(rows, ["k"], ["u", "id"], outs, 20, current), want)
    assert same(O.running(rows, ["k"], ["u", "id"], outs, 10_000, current), want)


def test_following(rows):
    want = rows.withColumn("f", F.first("x", True).over(W_ALL().rowsBetween(1, W.unboundedFollowing)))
    assert same(O.following(rows, ["k"], ["u", "id"], "f", F.col("x"), 20), want)


def test_joined_text_in_parts_loses_nothing(rows):
    whole = O.joined_text(rows, ["k"], ["u", "id"], F.col("id").cast("string"), ",", "t")
    parts = O.joined_text(rows, ["k"], ["u", "id"], F.col("id").cast("string"), ",", "t", part_rows=50)
    assert parts.filter("k = 'hot'").count() == 10
    again = parts.groupBy("k").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "t"))), lambda p: p["t"]), ",").alias("t"))
    assert same(again, whole.drop("part"))


def test_large_key_question(rows):
    assert O.has_large_key(rows, ["k"], 400) and not O.has_large_key(rows, ["k"], 500)
