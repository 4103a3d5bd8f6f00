"""Queries next to their oracle, and the pipeline stage by stage against brute force."""

import collections
import os

import duckdb
import pytest

import corpus_pipeline
from tests.llm.test_texts import LOWER, linked_components, words
from twinledger.llm import queries
from twinledger.plans import check

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_oracle(spark, con, name):
    result = check.compare(spark, SF, name, queries.QUERIES[name], queries.ORACLES[name], con)
    assert result.startswith("ok"), result


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9_000_001, None, "en", "src0", 0), (9_000_002, "12 34", "en", "src0", 5), (9_000_003, "", None, None, 0)], docs.schema)
    rows, before = docs.unionByName(odd), None
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, rows, SF).write.parquet(str(tmp_path / name))
        before, rows = rows.collect(), spark.read.parquet(str(tmp_path / name))
        if name != "best_fit_packing":
            assert rows.columns == docs.columns
        after = rows.collect()
        texts = {r.doc_id: r.text for r in before}
        kept = {r.doc_id for r in after}
        if name == "language_id":
            assert set(texts) - kept == {9_000_001, 9_000_002, 9_000_003}
        elif name == "exact_dedup":
            last = collections.defaultdict(int)
            for k, t in texts.items():
                last[t.translate(LOWER)] = max(k, last[t.translate(LOWER)])
            assert kept == set(last.values())
        elif name == "ngram_jaccard":
            assert kept == {c for _, c in linked_components([(r.doc_id, r.text) for r in before], 5, 80).values()}
        elif name == "source_mix":
            n = sum(len(words(t)) for t in texts.values())
            assert kept <= set(texts) and sum(len(words(texts[k])) for k in kept) >= n * 80 // 100
        else:
            assert kept == set(texts) and max(r.offset + r.length for r in after) <= 1024


def test_stages_keep_rows_of_null_and_repeated_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    text = {r.doc_id: r.text for r in docs.collect()}
    odd = [(None, "a first clean text without an id about the river"), (None, "another clean text without an id about the hill"),
           (3, text[3]), (3, text[3]), (5, "12 34"), (7, text[9].upper()), (7, "one more text under an id that is used twice")]
    a = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    near = [(None, a), (None, a + " more"), (8, a.replace("wordba", "x")), (8, a.replace("wordbb", "y"))]
    frame = lambda rows: docs.unionByName(spark.createDataFrame([(k, t, "en", "src0", len(t)) for k, t in rows], docs.schema))
    stages = dict(corpus_pipeline.STAGES)
    run = lambda name, rows: collections.Counter((r.doc_id, r.text) for r in stages[name](spark, rows, SF).collect())

    got = run("language_id", frame(odd))
    assert {k: got[k] for k in set(odd)} == {k: n + (k in text.items()) for k, n in collections.Counter(odd).items() if k[1] != "12 34"} | {(5, "12 34"): 0}

    got = run("exact_dedup", frame(odd))
    best = {}
    for k, t in [*text.items(), *odd]:
        low = t.translate(LOWER)
        best[low] = max(best.get(low, (-2, "")), (-1 if k is None else k, low))
    assert collections.Counter((k, t.translate(LOWER)) for k, t in got.elements()) == collections.Counter((None if k == -1 else k, low) for k, low in best.values())

    got = run("ngram_jaccard", frame(odd[:2] + near + [(3, text[3]), (None, ""), (None, "")]))
    alone = {c for _, c in linked_components(list(text.items()), 5, 80).values()}
    assert all(got[k] == 1 for k in [*odd[:2], (None, "")]) and got[3, text[3]] == (3 in alone)
    assert sorted(got[k] for k in near) == [0, 0, 0, 1] and got[near[2]] + got[near[3]] == 1

    rows = [(None, f"a clean text {i} " * 30) for i in range(200)] + [(4, f"another text {i} " * 30) for i in range(200)]
    got = run("source_mix", frame([*rows, rows[0], rows[0]]))
    total = sum(len(words(t)) for _, t in {*text.items(), *rows})
    took = sum(len(words(t)) * n for (_, t), n in got.items())
    assert max(got.values()) == 1 and set(got) <= {*text.items(), *rows}
    assert 0.8 * total <= took < total and any(k is None for k, _ in got)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns
