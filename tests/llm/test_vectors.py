"""Nearest neighbours against brute force."""

import numpy as np

from twinledger.llm import nn_descent
from twinledger.llm.graphs import components


def brute(rows, k, queries):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    n = np.linalg.norm(x, axis=1)
    out = {}
    for q in queries:
        at = int(np.flatnonzero(ids == q)[0])
        s = x @ x[at] / (n * n[at])
        s[at] = -9
        out[q] = [(int(ids[i]), s[i]) for i in np.lexsort((ids, -np.round(s, 12)))[:k]]
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1500, 24)).round(3)
    x[200:260] = x[7]  # many copies of one vector
    rows = [(int(i), [float(a) for a in v]) for i, v in enumerate(x)]
    odd = [(9000, None), (9001, [0.0] * 24), (9002, [float("nan")] + [1.0] * 23), (9003, [None] + [1.0] * 23), (9004, [1.0, 2.0]), (9005, [float("inf")] * 24), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in rows + odd + rows[:1]], "vec_id long, embedding array<double>, id string, node string")
    got = nn_descent.nearest(df, df.where("vec_id % 50 = 0"), k=5).collect()
    want = brute(rows, 5, range(0, 1500, 50))
    by = {q: sorted((r for r in got if r.query_id == q), key=lambda r: r.rank) for q in want}
    assert {r.query_id for r in got} == set(want) and len(got) == 5 * len(want)
    hits = sum(len({r.vec_id for r in by[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)
    assert [r.vec_id for r in by[200]] == [i for i, _ in want[200]] == [7, 201, 202, 203, 204]
    score = {(q, i): s for q, near in brute(rows, 1500, want).items() for i, s in near}
    for r in got:
        assert abs(r.score - score[r.query_id, r.vec_id]) < 1e-12


def test_few_rows(spark):
    kind = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], kind)
    got = nn_descent.nearest(df, df.where("vec_id = 0")).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(1, 2), (2, 1)]
    assert nn_descent.nearest(df.where("vec_id = 0"), df).count() == 0
    assert nn_descent.nearest(df.where("false"), df).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (200, 200)] + [(300, i) for i in range(301, 340)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {100: 100, 101: 100} | {i: 300 for i in range(300, 340)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeated_ids_and_copies(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((40, 7)).round(3)
    x[30] = x[3]
    rows = [(int(i), [float(a) for a in v]) for i, v in enumerate(x)]
    again = [(3, [9.0] * 7), (5, rows[5][1])]  # the smallest vector of an id counts
    df = spark.createDataFrame([(i, v, "x", True) for i, v in rows + again], "vec_id long, embedding array<double>, a string, fresh boolean")
    smallest = {i: min([v] + [w for j, w in again if j == i]) for i, v in rows}
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in nn_descent.nearest(df, df.where("vec_id % 10 = 0")).collect())
    want = brute(sorted(smallest.items()), 5, range(0, 40, 10))
    assert got == [(q, n + 1, i, round(s, 12)) for q in want for n, (i, s) in enumerate(want[q])]
    v = x[3]
    first = [r for r in got if r[:2] == (30, 1)][0]
    assert first[2] == 3 and first[3] == round(v @ v / (np.linalg.norm(v) ** 2), 12)


def test_graph_settles(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((600, 12))
    nodes = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "id long, v array<double>")
    graph = nn_descent.build_graph(nodes, 12, k=10, run=16, orders=2, settled=0.005).collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    sims = u @ u.T
    np.fill_diagonal(sims, -2)
    want = {(i, int(j)) for i in range(600) for j in np.argsort(-sims[i])[:10]}
    assert len(graph) == 6000 and len({(r.a, r.b) for r in graph} & want) >= 0.9 * len(want)
