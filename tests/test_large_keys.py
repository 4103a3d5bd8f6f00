"""The queries give the same rows when every ordered step takes the path for large keys."""

import os

import duckdb
import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from twinledger import constants as K
from twinledger.functions import ordered as O
from twinledger.operators import flatten as X, queue as Q, reconcile as R
from twinledger.plans import bindings as B, check

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
NAMES = ["j3_ordered_pairs", "f2_split_diff", "m7_m8_field_merge", "w12_rank_drops", "w13_end_backfill", "w2_a2_rank_to_date", "x2_judge1_text"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_large_path(spark, con, name, monkeypatch):
    monkeypatch.setattr(B, "large_names", lambda spark, sf: True)
    # three rows already make a key large, so most keys are cut
    real = O.chunked
    monkeypatch.setattr(O, "chunked", lambda df, keys, order, chunk_rows=0: real(df, keys, order, 3))
    result = check.compare(spark, SF, name, entry.queries()[name], entry.oracle_sql()[name], con)
    assert not result.startswith("FAIL"), result


def test_a_row_carries_all_its_texts(spark):
    n = 250
    routed = spark.range(n).selectExpr("'p' as name", "1L as seq", "id as dpos", "concat('t', id) as text")
    assert [r.judge1 for r in X.row_texts(routed.repartition(7), "judge1").collect()] == [" | ".join(f"t{i}" for i in range(n))]


def test_many_decisions_on_a_line_of_many_rows(spark):
    """10,000 decisions on a line of 10,000 rows, and a few of single rows that go in between."""
    n = 10_000
    e = spark.range(n).selectExpr("'p' as name", "3L as source_line", "id + 1 as seq", "concat('u', id) as unit", "'x' as position", "'1990.01' as start")
    dec = "'m' as judge_model, '9' as confidence, concat('r', id) as reason"
    group = spark.range(n).selectExpr("'p' as name", "3L as source_line", "id * 10 as pos", *dec.split(", ", 2))
    field = spark.range(5).selectExpr("'p' as name", "3L as source_line", "concat('u', id) as unit", "'x' as position", "if(id = 4, 'gone', if(id = 3, '', '1990.01')) as start", "'unit' as field", "id * 10 + 5 as pos", *dec.split(", ", 2))
    got = X.step1_texts(e, group, field).select("seq", F.size(F.split("judge1", r" \| ")).alias("n"), F.split("judge1", r" \| ").alias("all"))
    counts = {r.n: r["count"] for r in got.groupBy("n").count().collect()}
    assert counts == {n: n - 5, n + 1: 5}
    row = got.filter("seq = 3").first()["all"]
    assert row[:6] == [row[0], row[1], row[2], row[3], row[4], row[5]] and "r2" in row[2] and "r2" in row[3] and "r3" in row[4]


@pytest.mark.parametrize("large", [True, False])
def test_a_line_is_one_difference(spark, large):
    n = 25
    rows = [("p", 1, i, "a", f"u{i}", "x", n, 2) for i in range(n)] + [("p", 1, i, "b", f"v{i}", "y", n, 2) for i in range(2)]
    rows += [("q", 4, i, "b", f"u{i}", None, 0, n) for i in range(n)]
    u = spark.createDataFrame(rows, "name string, line_pos long, pos long, side string, unit string, position string, n_a long, n_b long")
    got = {r.name: (r.part, r.scope, r.value_a, r.value_b) for r in R.group_diffs(u, large, part_rows=4).collect()}
    assert R.group_diffs(u, large, part_rows=4).count() == 2
    assert got == {"p": (0, "episode_split", f"{n}条: " + "; ".join(f"u{i} x" for i in range(n)), "2条: v0 y; v1 y"),
                   "q": (0, "episode_missing", K.NONE_MARK, "; ".join(f"u{i} " for i in range(n)))}


def test_a_person_is_one_request(spark, monkeypatch):
    eps = spark.range(1, 26).selectExpr("'p' as name", "id as seq", "id as source_line", "'' as start", "'' as end", "concat('u', id) as unit", "'x' as position")
    whole = [tuple(r) for r in Q.episode_requests(eps, 2).collect()]
    monkeypatch.setattr(Q, "PART_ROWS", 4)
    got = Q.episode_requests(eps, 2).collect()
    assert [tuple(r) for r in got] == whole and (got[0].part, got[0].n_episodes) == (0, 25)
    assert Q.episode_requests(eps, 2, max_episodes=10).count() == 3


def test_pending_fields_compares_once(spark):
    """Disputes and the decisions derived from them come from what is stored, not from the tables twice."""
    plan = entry.queries()["j7_pending_fields"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan and plan.count("LogicalRDD") == 2
