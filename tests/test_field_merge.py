"""Merging both versions, and reviewing their differences, exchange the given rows once, as columns of the table."""

import os

import pytest

from twinledger.plans import q_reconcile as QR

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def exchanges(df) -> int:
    return df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")).count("Exchange hashpartitioning")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_field_merge_needs_no_exchange(spark):
    assert exchanges(QR.m7(spark, SF)) == 0
