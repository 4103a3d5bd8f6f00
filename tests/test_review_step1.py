"""The review of step 1 by tables that lie by name is that by joins, also where keys repeat or are null."""

import os

import pytest

from twinledger.operators import flatten as X
from twinledger.plans import q_flatten as QF

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def exchanges(df) -> int:
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")).count("Exchange hashpartitioning")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_review_step1_needs_no_exchange(spark):
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert exchanges(QF.j6_1(spark, SF)) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)


def test_review_step1_by_windows(spark):
    diffs = spark.createDataFrame(
        [(1, 1, None, None, "episode_split", "拆分方式", "a", "b", "MEDIUM", 0), (None, 2, None, None, "episode_missing", "LLM1缺失", "a", "b", "MEDIUM", 0),
         (1, 2, 1, "u", "episode_field", "start", "1", "2", "HIGH", 0), (1, 2, 2, "u", "episode_field", "start", "1", "3", "HIGH", 0),
         (1, 2, 1, "v", "episode_field", "end", "1", "2", "HIGH", 0), (2, 2, 1, None, "episode_field", "end", "1", "2", "HIGH", 0),
         (None, 1, 1, "u", "episode_field", "unit", "1", "2", "MEDIUM", 0), (3, 1, 1, "w", "episode_field", "unit", "1", "2", "MEDIUM", 0)],
        "name long, source_line long, rn long, unit string, scope string, field string, value_a string, value_b string, level string, part int")
    a = spark.createDataFrame([(1, 2, 1, "u", "p", "s"), (1, 2, 2, "u", "later", "s"), (1, 2, 3, "v", "q", None), (None, 1, 1, "u", "p", "s"), (2, 2, 1, None, "p", "s")],
                              "name long, line_zero long, pos long, unit string, position string, start string")
    gd = spark.createDataFrame([(1, 1, "9", "g", None), (None, 2, "8", "n", "m")], "name long, source_line long, confidence string, reason string, judge_model string")
    fd = spark.createDataFrame(
        [(1, 2, "u", "p", "s", "start", "x", "1", "c", "r", "m"), (1, 2, "u", "p", "s", "start", "y", "2", None, "r", "m"), (1, 2, "v", "q", "", "end", "z", "3", "c", "r", "m"),
         (None, 1, "u", "p", "s", "unit", "n", "3", "c", "r", "m"), (3, 1, "w", "", "", "unit", "k", None, "c", "r", "m"), (9, 1, "w", "", "", "unit", "k", None, "c", "r", "m")],
        "name long, source_line long, unit string, position string, start string, field string, verdict string, correct_value string, confidence string, reason string, judge_model string")
    got, want = (X.review_step1(diffs, a, gd, fd, by_name) for by_name in (True, False))
    assert got.columns == want.columns or sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())) and want.count() == 10
