"""Tables that lie in buckets by name meet without an exchange, with the rows that joins give."""

import os

import pytest
from pyspark.sql import functions as F

from twinledger.functions.ordered import attach
from twinledger.operators import merge as M
from twinledger.plans import bindings as B, q_flatten as QF, q_reconcile as QR

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def exchanges(df) -> int:
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")).count("Exchange hashpartitioning")


def rows(df):
    return sorted(df.collect(), key=str)


def test_attach_is_a_left_join(spark):
    left = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (1, 2, "c"), (2, 1, "d"), (None, 1, "e"), (3, None, "f")], "name long, k long, v string")
    one = spark.createDataFrame([(1, 1, "x", [1, 2]), (2, 1, None, [3]), (None, 1, "n", [4]), (3, None, "o", [5]), (9, 9, "z", [6])], "name long, k long, t string, l array<int>")
    two = spark.createDataFrame([(1, 2, {"p": 1})], "name long, k long, m map<string,int>")
    both = [attach(left, ["name", "k"], {"r1": one, "r2": two}, by_name).select("name", "k", "v", "r1.*", "r2.*") for by_name in (False, True)]
    assert rows(both[0]) == rows(both[1])
    assert len(rows(both[1])) == 6


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_steps_need_no_exchange(spark):
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        large = B.large_names(spark, SF)
        with B.written_once(spark, SF, large) as by_name:
            merged, gd, fd = QF._step1_parts(spark, SF, large, by_name)
            classes = M.merge_classes(merged, B.classes_a(spark, SF), B.classes_b(spark, SF), QR.class_decisions(spark, SF), by_name=by_name)
            assert exchanges(classes) == 0
        assert exchanges(QF.X.route_line_texts(merged, gd, fd, by_name)) == 0
        assert exchanges(QF.X.step1_texts(merged, gd, fd, by_name=by_name)) == 0
        assert exchanges(QF.final_rows(spark, SF)) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_buckets_change_no_row(spark, monkeypatch):
    """Rows by buckets are those of plain joins."""
    def texts(by_name):
        a, b = QR._ab(spark, SF)
        fd = B.field_decisions(spark, SF, QR._disputes(spark, SF))
        gd = B.group_decisions(spark, SF, a, b)
        merged = M.merge_step1(a, b, gd, fd, large=False)
        return QF.X.route_line_texts(merged, gd, fd, by_name).select("name", "seq", "text")
    plain = texts(False)
    merged, gd, fd, by_name = QF.step1_parts(spark, SF)
    bucketed = QF.X.route_line_texts(merged, gd, fd, by_name).select("name", "seq", "text")
    assert by_name and plain.exceptAll(bucketed).isEmpty() and bucketed.exceptAll(plain).isEmpty()
    assert plain.filter(F.col("text") != "").count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_review_step2_needs_no_exchange(spark):
    assert exchanges(QF.j6_2(spark, SF)) == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_class_dispute_requests_need_no_exchange(spark):
    from twinledger.plans import q_requests

    assert exchanges(q_requests.p8_classes(spark, SF)) == 0
