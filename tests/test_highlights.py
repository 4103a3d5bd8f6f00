"""Signals asked of each text alone are those of the texts of the wide row."""

import os

import pytest

from test_wide_rows import rows, wide_inputs
from twinledger.operators import flatten as X
from twinledger.plans import q_flatten as QF

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_highlighted_says_what_highlights_says(spark):
    have = wide_inputs(spark)
    want = X.highlights(X.flatten(**have)).select("name", "seq", "hl_role", "hl_blocked", "hl_lowconf")
    got = rows(X.highlighted(have["episodes"], have["line_texts"], have["texts"]))
    assert got == rows(want)
    # a number beyond the range is neither low nor not
    assert {r[4] for r in got} == {True, False, None} and {r[3] for r in got} == {True, False}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_highlights_put_no_text_together(spark):
    plan = QF.k5(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join" not in plan and "collect_list" not in plan
