"""Stored results, gold, matching, accuracy and legacy flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger import constants as K
from twinledger.operators import legacy as Lg, matching as Mt, quality as Ql, reconcile as R
from twinledger.plans import bindings as B, q_reconcile as QR, sqltext as S
from twinledger.plans.registry import query
from twinledger.sources import readers

# ---- JSON scans

RESULT_JSON = """SELECT o_orderkey AS pos, CASE o_orderkey % 11 WHEN 10 THEN 'null' WHEN 9 THEN '[1]' WHEN 8 THEN '{{"episodes": []}}' ELSE
  concat('{{"_meta": {{"name": "c', o_custkey, '"}}, "episodes": [{{"source_line": ', CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '"2"' END, ', "起始时间": "', year(o_orderdate), '", "供职单位": "u', o_orderkey, '"}}, {{"职务": "p"}}]}}') END AS j FROM {orders}"""


@query("s4_nested_results", """WITH r AS (SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS k, arg_max(year(o_orderdate), o_orderkey) AS y FROM orders WHERE o_orderkey % 11 < 8 GROUP BY 1)
SELECT concat('c', o_custkey) AS name, 0 AS pos, CASE WHEN k % 2 = 0 THEN 1 ELSE 2 END AS source_line, CAST(y AS VARCHAR) AS start, NULL AS "end", concat('u', k) AS unit, NULL AS position FROM r
UNION ALL SELECT concat('c', o_custkey), 1, NULL, NULL, NULL, NULL, 'p' FROM r""")
def s4(spark, sf):
    return readers.explode_result(readers.parse_results(B.recipe(spark, sf, RESULT_JSON), "j", "step1"), "step1")


DEC_JSON = """SELECT o_orderkey AS id, concat('{{"n', o_custkey, CASE o_orderkey % 5 WHEN 0 THEN concat('||sl_group||', o_orderkey % 30) WHEN 1 THEN concat('||ep_batch||sl', o_orderkey % 30, '||单位||职|务||1990.01||unit')
  WHEN 2 THEN concat('||classify||', o_orderkey % 9, '||flag') WHEN 3 THEN '||label||promo_gov' ELSE '||rank||x' END, '": {{"verdict": "采纳LLM1", "confidence": ', o_orderkey % 101, ', "reason": "r"',
  CASE WHEN o_orderkey % 5 = 0 THEN ', "adopt": "LLM2", "episodes": [{{"source_line": 3, "供职单位": "u"}}]' ELSE '' END, '}}}}') AS j FROM {orders}"""


@query("s5_decision_scan", """SELECT o_orderkey AS id, concat('n', o_custkey) AS name, CASE o_orderkey % 5 WHEN 0 THEN 'sl_group' WHEN 1 THEN 'ep_batch' WHEN 2 THEN 'classify' WHEN 3 THEN 'label' ELSE 'rank' END AS kind,
  CASE WHEN o_orderkey % 5 < 2 THEN CAST(o_orderkey % 30 AS INTEGER) END AS source_line, CASE WHEN o_orderkey % 5 = 2 THEN CAST(o_orderkey % 9 AS INTEGER) END AS episode_idx,
  CASE WHEN o_orderkey % 5 = 1 THEN '单位' END AS unit, CASE WHEN o_orderkey % 5 = 1 THEN '职|务' END AS position, CASE WHEN o_orderkey % 5 = 1 THEN '1990.01' END AS start,
  CASE o_orderkey % 5 WHEN 1 THEN 'unit' WHEN 2 THEN 'flag' WHEN 3 THEN 'promo_gov' END AS field, '采纳LLM1' AS verdict, CAST(o_orderkey % 101 AS VARCHAR) AS confidence, 'r' AS reason,
  CASE WHEN o_orderkey % 5 = 0 THEN 'LLM2' END AS adopt, CASE WHEN o_orderkey % 5 = 0 THEN '3u' END AS first_episode FROM orders""")
def s5(spark, sf):
    d = readers.parse_decisions(B.recipe(spark, sf, DEC_JSON), "j", ["id"])
    return d.withColumn("first_episode", F.concat(F.col("episodes")[0]["source_line"], F.col("episodes")[0]["unit"])).drop("episodes", "correct_value", "judge_model")


RESPONSES = """SELECT o_orderkey AS id, CASE o_orderkey % 8 WHEN 0 THEN concat('```json', chr(10), '{{"episodes": [{{"source_line": "', o_orderkey % 40, '", "供职单位": "u"}}]}}', chr(10), '```')
  WHEN 1 THEN concat('Sure: {{"episodes": [{{"source_line": ', o_orderkey % 40, '}}, {{"职务": "p"}}]}} done') WHEN 2 THEN '{{"episodes": {{"a": 1}}}}' WHEN 3 THEN '{{"other": 1}}' WHEN 4 THEN 'no json at all'
  WHEN 5 THEN '{{"episodes": [}}' WHEN 6 THEN '  {{"episodes": []}}  ' ELSE '' END AS r FROM {orders}"""


@query("s8_response_scan", """SELECT o_orderkey AS id, CASE o_orderkey % 8 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 6 THEN 'ok' WHEN 2 THEN 'schema_error' WHEN 3 THEN 'schema_error' ELSE 'parse_error' END AS status,
  CASE o_orderkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 6 THEN 0 END AS n, CASE WHEN o_orderkey % 8 < 2 THEN CAST(o_orderkey % 40 AS VARCHAR) END AS first_line FROM orders""")
def s8(spark, sf):
    p = readers.parse_responses(B.recipe(spark, sf, RESPONSES), "r", "step1")
    e = F.col("parsed.episodes")
    return p.select("id", "status", F.when(F.col("status") == "ok", F.size(e)).alias("n"), F.try_element_at(e, F.lit(1))["source_line"].alias("first_line"))


_KIND = "CASE o_orderkey % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 2 THEN 'schema_error' ELSE 'parse_error' END"
CLASSES = """SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN concat('{{"classifications": [{{"episode_idx": ', o_orderkey % 40, ', "组织标签": "其他", "任职地（省）": "p', o_custkey, '"}}, {{"标志位": "无"}}]}}')
  WHEN 1 THEN concat('```json', chr(10), '{{"classifications": []}}', chr(10), '```') WHEN 2 THEN '{{"classifications": 3}}' ELSE '{{"classifications": [' END AS r FROM {orders}"""
RANKINGS = """SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN concat('{{"ranks": [{{"episode_idx": "', o_orderkey % 40, '", "final_rank": "正厅级", "reasoning_chain": "r', o_custkey, '"}}]}}')
  WHEN 1 THEN '{{"other": 1}}' WHEN 2 THEN '{{"ranks": "x"}}' ELSE 'none' END AS r FROM {orders}"""
PERSONS = """SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN concat('{{"raw_bio": {{"姓名": "n', o_custkey, '"}}, "升迁_省长": 1, "升迁_省委书记": 0, "本省提拔": "1", "本省提拔依据": "d", "本省学习": 0, "本省学习依据": ""}}')
  WHEN 1 THEN concat('x {{"raw_bio": {{}}, "升迁_省长": ', o_custkey, ', "升迁_省委书记": 0, "本省提拔": 0, "本省提拔依据": "", "本省学习": 0, "本省学习依据": ""}} y') WHEN 2 THEN '{{"raw_bio": {{}}, "升迁_省长": 1}}' ELSE '[1]' END AS r FROM {orders}"""


@query("s8_class_responses", f"""SELECT o_orderkey AS id, {_KIND} AS status, CASE o_orderkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 0 END AS n, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 40 AS VARCHAR) END AS idx,
  CASE WHEN o_orderkey % 4 = 0 THEN '其他' END AS org_tag, CASE WHEN o_orderkey % 4 = 0 THEN concat('p', o_custkey) END AS prov FROM orders""")
def s8_2(spark, sf):
    p = readers.parse_responses(B.recipe(spark, sf, CLASSES), "r", "step2")
    c = F.col("parsed.classifications")
    first = F.try_element_at(c, F.lit(1))
    return p.select("id", "status", F.when(F.col("status") == "ok", F.size(c)).alias("n"), first["episode_idx"].alias("idx"), first["org_tag"].alias("org_tag"), first["prov"].alias("prov"))


@query("s8_rank_responses", f"""SELECT o_orderkey AS id, {_KIND} AS status, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 40 AS VARCHAR) END AS idx,
  CASE WHEN o_orderkey % 4 = 0 THEN '正厅级' END AS rank, CASE WHEN o_orderkey % 4 = 0 THEN concat('r', o_custkey) END AS chain FROM orders""")
def s8_3(spark, sf):
    p = readers.parse_responses(B.recipe(spark, sf, RANKINGS), "r", "step3")
    first = F.try_element_at("parsed.ranks", F.lit(1))
    return p.select("id", "status", first["episode_idx"].alias("idx"), first["final_rank"].alias("rank"), first["reasoning_chain"].alias("chain"))


@query("s8_person_responses", f"""SELECT o_orderkey AS id, {_KIND} AS status, CASE WHEN o_orderkey % 4 = 0 THEN concat('n', o_custkey) END AS person,
  CASE o_orderkey % 4 WHEN 0 THEN '1' WHEN 1 THEN CAST(o_custkey AS VARCHAR) END AS promo_gov FROM orders""")
def s8_4(spark, sf):
    p = readers.parse_responses(B.recipe(spark, sf, PERSONS), "r", "step4")
    return p.select("id", "status", F.try_element_at("parsed.raw_bio", F.lit("姓名")).alias("person"), F.try_element_at("parsed.labels", F.lit("升迁_省长")).alias("promo_gov"))


BIO_FILES = """SELECT CASE o_orderkey % 4 WHEN 0 THEN concat('file:/data/%E4%BA%BA', o_orderkey, '_biography.txt') WHEN 1 THEN concat('hdfs://host/a/n', o_orderkey, '_biography.txt')
  WHEN 2 THEN concat('file:/data/x%20', o_orderkey, '_biography.txt') ELSE concat('file:/data/', o_orderkey, '_notes.txt') END AS file, concat('=== ', o_custkey, chr(10), 'text') AS text FROM {orders}"""


@query("s3_biography_files", """SELECT concat(CASE o_orderkey % 4 WHEN 0 THEN '人' WHEN 1 THEN 'n' ELSE 'x ' END, o_orderkey) AS name, concat('=== ', o_custkey, chr(10), 'text') AS text FROM orders WHERE o_orderkey % 4 < 3""")
def s3(spark, sf):
    return readers.biographies_of(B.recipe(spark, sf, BIO_FILES))


EVALS = """SELECT concat('mode2_', o_orderkey, '.json') AS file, CASE o_orderkey % 5 WHEN 4 THEN '{{"model": "broken' WHEN 3 THEN '' ELSE
  concat('{{"model": "m', o_custkey % 4, '", "elapsed_s": ', o_orderkey % 100, '.5, "agg_step2": {{"组织标签": {{"correct": ', o_orderkey % 9, ', "total": 9, "accuracy": 0.5}}}}, "errors": [',
  CASE WHEN o_orderkey % 2 = 0 THEN '{{"official": "p", "episode_idx": 3, "field": "f", "gold": "g", "pred": "q"}}' ELSE '' END, ']}}') END AS value FROM {orders}"""


@query("s9_eval_results", """SELECT concat('mode2_', o_orderkey, '.json') AS file, concat('m', o_custkey % 4) AS model, o_orderkey % 100 + 0.5::DOUBLE AS elapsed_s, CAST(o_orderkey % 9 AS BIGINT) AS correct, 9::BIGINT AS total,
  CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS n_errors, CASE WHEN o_orderkey % 2 = 0 THEN '3' END AS first_idx FROM orders WHERE o_orderkey % 5 < 3""")
def s9(spark, sf):
    e = readers.parse_eval(B.recipe(spark, sf, EVALS))
    tag = F.try_element_at("agg_step2", F.lit("组织标签"))
    return e.select("file", "model", "elapsed_s", tag["correct"].alias("correct"), tag["total"].alias("total"), F.size("errors").alias("n_errors"), F.try_element_at("errors", F.lit(1))["episode_idx"].alias("first_idx"))


GOLD_ROWS = """SELECT o_custkey AS name, o_orderkey AS rowno, CASE WHEN o_orderkey % 3 = 0 THEN ' ' WHEN o_orderkey % 3 = 1 THEN 'nan' ELSE concat(' u', o_orderkey) END AS unit, CASE o_orderkey % 4 WHEN 0 THEN '1.0' WHEN 1 THEN '' WHEN 2 THEN 'x' ELSE '2' END AS promo_gov,
  CASE o_orderkey % 5 WHEN 0 THEN NULL ELSE concat('省', o_orderkey % 7) END AS origin, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR(9)) END AS seq, o_orderkey AS position_in_name FROM {orders}"""


@query("s7_gold_person", f"""WITH g AS ({B.duck(GOLD_ROWS)}), f AS (SELECT name, min(rowno) AS rowno FROM g GROUP BY 1)
SELECT name, CASE promo_gov WHEN '1.0' THEN '1' WHEN '' THEN NULL ELSE promo_gov END AS promo_gov, origin FROM g JOIN f USING (name, rowno)""")
def s7(spark, sf):
    return readers.gold_person(B.recipe(spark, sf, GOLD_ROWS), ["promo_gov", "origin"])


@query("s7_p32_gold_episodes", f"""SELECT name, CAST(rowno AS BIGINT) AS episode_idx, CAST(rowno AS BIGINT) AS source_line, '' AS start, '' AS "end", CASE WHEN rowno % 3 < 2 THEN '' ELSE trim(unit) END AS unit, '' AS position FROM ({B.duck(GOLD_ROWS)}) g""")
def s7e(spark, sf):
    rows = B.recipe(spark, sf, GOLD_ROWS).withColumns({c: F.lit(None).cast("string") for c in ("start", "end", "position")})
    g = readers.gold_episodes(rows, K.EPISODE_FIELDS)
    return readers.gold_step1_view(g).withColumns({c: F.col(c).cast("long") for c in ("episode_idx", "source_line")})


@query("p33_focus_lines", f"WITH a AS ({B.DUCK_A}) SELECT name, source_line, k1, k2 FROM a WHERE source_line IN (2, 5)")
def p33(spark, sf):
    return R.focus(B.episodes_a(spark, sf), [2, 5]).select("name", "source_line", "k1", "k2")


@query("a1_line_keys", f"WITH a AS ({B.DUCK_A}) SELECT name, k1, k2, CASE WHEN k1 % 4 = 0 THEN pos ELSE source_line END AS line_pos, CASE WHEN k1 % 4 = 0 THEN 0 ELSE source_line END AS line_zero FROM a")
def a1(spark, sf):
    from twinledger.functions.ordered import ordinal

    e = ordinal(B.episodes_a(spark, sf), ["name"], ["pos"], "n", large=B.large_names(spark, sf))
    e = e.withColumn("source_line", F.when(F.col("k1") % 4 != 0, F.col("source_line")))
    return R.with_line_keys(e, pos="n").select("name", "k1", "k2", "line_pos", "line_zero")


# ---- matching: the oracle walks each person's records in a recursive CTE, with a list of what is taken

def _set(x: str) -> str:
    return f"list_sort(list_distinct(list_filter(string_split({x}, ''), lambda c: c <> '')))"


def _alike(x: str, y: str, empty: str) -> str:
    both = f"len(list_intersect({x}, {y}))"
    return f"CASE WHEN len({x}) + len({y}) = 0 THEN {empty} ELSE {both} / (len({x}) + len({y}) - {both}) END"


def _matching(weighted: bool) -> str:
    """CTEs that end in `m` (name, g_no, p_no): what each gold takes, and the preds left over if weighted."""
    score = f"{_alike('g.us', 'p.us', '0.0')} * 0.6::DOUBLE + {_alike('g.vs', 'p.vs', '0.0')} * 0.4::DOUBLE" if weighted else _alike("g.us", "p.us", "1.0")
    extra = "UNION ALL SELECT name, NULL, pos FROM p ANTI JOIN hits ON hits.name = p.name AND hits.p_no = p.pos" if weighted else ""
    return f"""
g AS MATERIALIZED (SELECT *, {_set('unit')} AS us, {_set('position')} AS vs FROM a),
p AS MATERIALIZED (SELECT *, {_set('unit')} AS us, {_set('position')} AS vs FROM b),
scored AS (SELECT g.name, g.pos AS g_no, p.pos AS p_no, {score} AS s FROM g JOIN p ON g.name = p.name),
liked AS MATERIALIZED (SELECT name, g_no, list(p_no ORDER BY s DESC, p_no) AS preds FROM scored WHERE s {'> 0.3::DOUBLE' if weighted else '>= 0.3::DOUBLE'} GROUP BY name, g_no),
turns AS MATERIALIZED (SELECT g.name, g.pos AS g_no, coalesce(preds, []) AS preds FROM g LEFT JOIN liked ON liked.name = g.name AND liked.g_no = g.pos),
walk AS (
  SELECT DISTINCT name, 0::BIGINT AS g_no, []::BIGINT[] AS used, NULL::BIGINT AS p_no FROM turns
  UNION ALL
  SELECT name, g_no, CASE WHEN p_no IS NULL THEN used ELSE list_append(used, p_no) END, p_no
  FROM (SELECT t.name, t.g_no, w.used, list_filter(t.preds, lambda x: NOT list_contains(w.used, x))[1] AS p_no FROM walk w JOIN turns t ON t.name = w.name AND t.g_no = w.g_no + 1) n),
hits AS MATERIALIZED (SELECT name, g_no, p_no FROM walk WHERE g_no > 0),
m AS MATERIALIZED (SELECT name, CAST(g_no AS INTEGER) AS g_no, p_no FROM hits {extra})"""


MATCHED = B.EPISODES_WITH.replace("WITH ", "WITH RECURSIVE ", 1) + ","
UNITS = "SELECT m.name, m.g_no, a.unit AS gold_unit, b.unit AS pred_unit FROM m LEFT JOIN a ON a.name = m.name AND a.pos = m.g_no LEFT JOIN b ON b.name = m.name AND b.pos = m.p_no"
_SAME = {f: f"""CAST(count(*) FILTER (trim(a."{f}") = coalesce(trim(b."{f}"), '')) AS BIGINT) AS {f}_ok""" for f in ("unit", "position", "start", "end")}
SCORES = f"""s AS MATERIALIZED (SELECT m.name, count(*) AS n_gold, count(m.p_no) AS matched, {', '.join(_SAME.values())}
  FROM m JOIN a ON a.name = m.name AND a.pos = m.g_no LEFT JOIN b ON b.name = m.name AND b.pos = m.p_no GROUP BY m.name),
n AS (SELECT name, count(*) AS n_pred FROM b GROUP BY name),
r AS (SELECT s.*, coalesce(n_pred, 0) AS n_pred, matched / n_gold AS recall, CASE WHEN coalesce(n_pred, 0) > 0 THEN matched / n_pred ELSE 0.0 END AS precision FROM s LEFT JOIN n USING (name)),
step1 AS MATERIALIZED (SELECT *, CASE WHEN recall + precision > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM r)"""


def _matched(spark, sf):
    return Mt.match_episodes(B.episodes_a(spark, sf), B.episodes_b(spark, sf), K.EPISODE_FIELDS)


@query("j13_greedy_match", MATCHED + _matching(False) + " " + UNITS)
def j13(spark, sf):
    return _matched(spark, sf).select("name", "g_no", F.col("gold.unit").alias("gold_unit"), F.col("pred.unit").alias("pred_unit"))


@query("j14_weighted_match", MATCHED + _matching(True) + " " + UNITS)
def j14(spark, sf):
    m = Mt.match_episodes(B.episodes_a(spark, sf), B.episodes_b(spark, sf), K.EPISODE_FIELDS, weighted=True)
    return m.select("name", "g_no", F.col("gold.unit").alias("gold_unit"), F.col("pred.unit").alias("pred_unit"))


@query("a10_step1_scores", MATCHED + _matching(False) + "," + SCORES + " SELECT * FROM step1")
def a10(spark, sf):
    return Ql.step1_scores(B.episodes_a(spark, sf), B.episodes_b(spark, sf), _matched(spark, sf))


TAG_A = "CASE WHEN {e}.k1 % 3 = 0 THEN 'a' ELSE 'b' END"
TAG_B = "CASE WHEN {e}.k2 % 4 = 0 THEN 'c' WHEN {e}.k1 % 3 = 0 THEN 'a' ELSE 'b' END"
_YEARS = {x: f"coalesce({S.frac_year(f'{x}.start')}, -1.0)" for x in ("a", "b")}
LEGACY_DIFFS = f"""both_ AS MATERIALIZED (SELECT m.name, m.g_no, m.p_no, a.start AS sa, b.start AS sb, {_YEARS['a']} AS fa, {_YEARS['b']} AS fb, {TAG_A.format(e='a')} AS ta, {TAG_B.format(e='b')} AS tb,
  a.unit AS ua, b.unit AS ub FROM m LEFT JOIN a ON a.name = m.name AND a.pos = m.g_no LEFT JOIN b ON b.name = m.name AND b.pos = m.p_no),
counts AS (SELECT name, count(*) FILTER (side = 'a') AS n_a, count(*) FILTER (side = 'b') AS n_b FROM (SELECT name, 'a' AS side FROM a UNION ALL SELECT name, 'b' FROM b) GROUP BY name),
gaps AS (SELECT *, CASE WHEN fa < 0 OR fb < 0 THEN 0.0 ELSE abs(fa - fb) END AS years FROM both_ WHERE g_no IS NOT NULL AND p_no IS NOT NULL)
SELECT name, 'count' AS field, CAST(n_a AS VARCHAR) AS value_a, CAST(n_b AS VARCHAR) AS value_b, CASE WHEN abs(n_a - n_b) > 4 THEN 'HIGH' ELSE 'MEDIUM' END AS level FROM counts WHERE abs(n_a - n_b) > 2
UNION ALL SELECT name, 'start', sa, sb, CASE WHEN years > 2 THEN 'HIGH' ELSE 'MEDIUM' END FROM gaps WHERE years > 1
UNION ALL SELECT name, 'org_tag', ta, tb, 'MEDIUM' FROM gaps WHERE ta <> tb
UNION ALL SELECT name, 'unmatched', ua, ub, NULL FROM both_ WHERE g_no IS NULL OR p_no IS NULL"""


@query("f12_legacy_compare", MATCHED + _matching(True) + "," + LEGACY_DIFFS)
def f12(spark, sf):
    tag = F.when(F.col("k1") % 3 == 0, "a").otherwise("b")
    a = B.episodes_a(spark, sf).withColumn("org_tag", tag)
    b = B.episodes_b(spark, sf).withColumn("org_tag", F.when(F.col("k2") % 4 == 0, "c").otherwise(tag))
    m = Mt.match_episodes(a, b, ["start", "unit", "position", "org_tag"], weighted=True)
    n = (a.select("name", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(b.select("name", F.lit(0).alias("a"), F.lit(1).alias("b")))
         .groupBy("name").agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b")))
    return Ql.compare_legacy(m, n)


# ---- accuracy

SCORED = B.CLASS_WITH + f""",
scored AS MATERIALIZED (SELECT x.name, x.episode_idx, x.name % 4 AS model, {', '.join(f"replace(x.{f}, '省委常委（其他)', '省常委（其他）') AS g_{f}, replace(coalesce(y.{f}, ''), '省委常委（其他)', '省常委（其他）') AS p_{f}" for f in K.CLASS_FIELDS)}
  FROM class_a x LEFT JOIN class_b y ON y.name = x.name AND y.episode_idx = x.episode_idx)"""
_ALL = " AND ".join(f"g_{f} = p_{f}" for f in K.CLASS_FIELDS)
ACC = "acc AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT model, '{f}' AS field, count(*) FILTER ({c}) AS correct, count(*) AS total FROM scored GROUP BY model"
    for f, c in [*((f, f"g_{f} = p_{f}") for f in K.CLASS_FIELDS), ("all_fields", _ALL)]) + ")"
ERRS = " UNION ALL ".join(f"SELECT name, episode_idx, '{f}' AS field, g_{f} AS gold, p_{f} AS pred FROM scored WHERE g_{f} <> p_{f}" for f in K.CLASS_FIELDS)


def _scored(spark, sf):
    return Ql.score_indexed(B.classes_a(spark, sf), B.classes_b(spark, sf), K.CLASS_FIELDS).withColumn("model", F.col("name") % 4)


def _rank_scored(spark, sf):
    return Ql.score_indexed(B.ranks_a(spark, sf), B.ranks_b(spark, sf), ["rank"]).withColumn("model", F.col("name") % 4)


@query("a7_class_accuracy", SCORED + "," + ACC + " SELECT * FROM acc")
def a7(spark, sf):
    return Ql.accuracy(_scored(spark, sf), K.CLASS_FIELDS, ["model"])


@query("a7_class_errors", SCORED + " " + ERRS)
def a7e(spark, sf):
    return Ql.errors(_scored(spark, sf), K.CLASS_FIELDS, ["name", "episode_idx"])


RSCORED = B.RANK_WITH + """, rscored AS MATERIALIZED (SELECT x.name, x.episode_idx, x.name % 4 AS model, x.rank AS g, coalesce(y.rank, '') AS p FROM rank_a x LEFT JOIN rank_b y ON y.name = x.name AND y.episode_idx = x.episode_idx)"""


@query("a8_rank_accuracy", RSCORED + " SELECT model, 'rank' AS field, count(*) FILTER (g = p) AS correct, count(*) AS total FROM rscored GROUP BY model")
def a8(spark, sf):
    return Ql.accuracy(_rank_scored(spark, sf), ["rank"], ["model"]).filter("field = 'rank'")


_num = lambda x: f"CAST(TRY_CAST({x} AS DOUBLE) AS INTEGER)"
LABEL_ACC = B.PERSON_WITH + f""", lab AS MATERIALIZED (SELECT x.name, x.name % 4 AS model, CAST({' + '.join(f"coalesce(CAST({_num(f'x.{f}')} = {_num(f'y.{f}')} AS INT), 0)" for f in K.LABEL_FIELDS)} AS INTEGER) AS correct,
  CAST({' + '.join(f"CAST({_num(f'x.{f}')} IS NOT NULL AS INT)" for f in K.LABEL_FIELDS)} AS INTEGER) AS total FROM person_a x LEFT JOIN person_b y USING (name))"""


def _labels(spark, sf):
    a = B.people_a(spark, sf).withColumn("model", F.col("name") % 4)
    return Ql.label_accuracy(a, B.people_b(spark, sf), keep=["model"])


@query("a9_label_accuracy", LABEL_ACC + " SELECT name, model, correct, total FROM lab")
def a9(spark, sf):
    return _labels(spark, sf)


@query("a11_micro_aggregate", LABEL_ACC + " SELECT model, CAST(sum(correct) AS BIGINT) AS correct, CAST(sum(total) AS BIGINT) AS total, CAST(sum(correct) AS DOUBLE) / sum(total) AS accuracy FROM lab GROUP BY model")
def a11(spark, sf):
    return Ql.micro(_labels(spark, sf), ["model"])


@query("a12_leaderboard", SCORED + "," + ACC + ", " + RSCORED[RSCORED.index("rank_all AS"):] + f""",
allacc AS (SELECT * FROM acc UNION ALL SELECT model, 'rank', count(*) FILTER (g = p), count(*) FROM rscored GROUP BY model),
w AS (SELECT model, {', '.join(f"max(correct / total) FILTER (field = '{f}') AS {f}" for f in [*K.CLASS_FIELDS, 'rank', 'all_fields'])} FROM allacc GROUP BY model)
SELECT *, ({' + '.join([*K.CLASS_FIELDS, 'rank'])}) / 6 AS mean_acc FROM w WHERE {' OR '.join(f'{f} <> 0' for f in K.CLASS_FIELDS)}""")
def a12(spark, sf):
    acc = Ql.accuracy(_scored(spark, sf), K.CLASS_FIELDS, ["model"]).unionByName(Ql.accuracy(_rank_scored(spark, sf), ["rank"], ["model"]).filter("field = 'rank'"))
    return Ql.leaderboard_classes(acc)


@query("a12_extraction_leaderboard", MATCHED + _matching(False) + "," + SCORES + "," + LABEL_ACC.removeprefix("WITH ").removeprefix(B.EPISODES_WITH.removeprefix("WITH ")) + """,
per AS (SELECT name % 4 AS model, avg(f1) AS f1, avg(recall) AS recall FROM step1 GROUP BY 1), acc AS (SELECT model, sum(correct) / sum(total) AS label_acc FROM lab GROUP BY model)
SELECT model, label_acc, coalesce(f1, 0) AS f1, coalesce(recall, 0) AS recall, (label_acc + coalesce(f1, 0)) / 2 AS score FROM acc LEFT JOIN per USING (model)""")
def a12x(spark, sf):
    s1 = Ql.step1_scores(B.episodes_a(spark, sf), B.episodes_b(spark, sf), _matched(spark, sf)).withColumn("model", F.col("name") % 4)
    return Ql.leaderboard_extraction(s1, _labels(spark, sf))


@query("a13_l3_top_errors", SCORED + f", e AS ({ERRS}) SELECT field, gold, pred, count(*) AS n FROM e GROUP BY ALL ORDER BY n DESC, field, gold, pred LIMIT 5")
def a13(spark, sf):
    return Ql.top_errors(Ql.errors(_scored(spark, sf), K.CLASS_FIELDS, ["name"]))


@query("a20_error_direction", RSCORED + f" SELECT CASE WHEN {S.rank_ord('p')} < {S.rank_ord('g')} THEN 'over' WHEN {S.rank_ord('p')} > {S.rank_ord('g')} THEN 'under' ELSE 'other' END AS direction, count(*) AS n FROM rscored WHERE g <> p GROUP BY 1")
def a20(spark, sf):
    return Ql.error_direction(Ql.errors(_rank_scored(spark, sf), ["rank"], ["name"]))


MARKS = "SELECT o_orderkey AS name, CAST(o_custkey % 7 + 1 AS BIGINT) AS seq, CASE o_orderkey % 4 WHEN 0 THEN 'org_tag' WHEN 1 THEN 'flag' WHEN 2 THEN 'city' ELSE 'nowhere' END AS column FROM {orders}"
DMARKS = B.duck(MARKS).replace("AS column", 'AS "column"')


def _marked(spark, sf):
    rows = R.last_by_index(B.classes_a(spark, sf), K.CLASS_FIELDS).withColumnRenamed("episode_idx", "seq")
    return rows, Ql.locate_errors(rows, B.recipe(spark, sf, MARKS), K.CLASS_FIELDS)


LOCATED = B.CLASS_WITH + f""", mk AS ({DMARKS}), located AS (SELECT m.name, m.seq, "column", CASE "column" WHEN 'org_tag' THEN org_tag WHEN 'flag' THEN flag WHEN 'city' THEN city END AS value,
  c.name IS NOT NULL AND "column" <> 'nowhere' AS found FROM mk m LEFT JOIN class_a c ON c.name = m.name AND c.episode_idx = m.seq)"""


@query("j15_error_cells", LOCATED + " SELECT * FROM located")
def j15(spark, sf):
    return _marked(spark, sf)[1]


@query("a17_column_error_rate", LOCATED + """, per AS (SELECT "column", count(*) AS errors, (SELECT count(*) FROM class_a) AS cells FROM located WHERE found GROUP BY 1),
every AS (FROM per UNION ALL SELECT 'TOTAL', CAST(sum(errors) AS BIGINT), CAST(sum(cells) AS BIGINT) FROM per HAVING count(*) > 0) SELECT *, errors / cells AS rate FROM every""")
def a17(spark, sf):
    rows, located = _marked(spark, sf)
    return Ql.column_error_rate(located, rows.agg(F.count(F.lit(1)).alias("n")))


# ---- legacy person flags

LEGACY = "SELECT name, source_line, k1, k2, start, CASE WHEN k1 % 5 = 0 THEN '北京市政府' WHEN k1 % 5 = 1 THEN '北京市委' ELSE unit END AS unit, CASE WHEN k2 % 4 = 0 THEN '市长' WHEN k2 % 4 = 1 THEN '市委书记' ELSE position END AS position FROM "


@query("a18_legacy_person_flags", f"""WITH a AS ({B.DUCK_A}), e AS ({LEGACY} a) SELECT name,
  max(CASE WHEN contains(position, '市长') AND NOT {S.any_word('position', ['副市长', '常务副', '第一副'])} AND {S.any_word('unit', ['北京', '市政府', '市人民政府'])} THEN 1 ELSE 0 END) AS ever_mayor,
  max(CASE WHEN (contains(position, '委书记') AND {S.any_word('unit', ['北京', '市委'])}) OR (trim(position) = '书记' AND contains(unit, '市委') AND contains(unit, '北京')) THEN 1 ELSE 0 END) AS ever_secretary,
  min(CAST(substring(start, 1, 4) AS INTEGER)) FILTER (contains(unit, '北京') AND {S.any_word('position', ['市长', '代市长', '书记'])}) AS focal_start FROM e GROUP BY name""")
def a18(spark, sf):
    return Lg.person_flags(B.recipe(spark, sf, LEGACY + "{a}", a=B.episodes_a(spark, sf)), "北京")


@query("a18_verification_notes", QR.ALL_DIFFS + "," + QR.SUMMARY + f""" SELECT name, concat('[需人工核查:DeepSeek/Qwen差异', high_count + medium_count, '处,', {S.verdict('high_count', 'medium_count')}, ']') AS note
FROM summary WHERE {S.verdict('high_count', 'medium_count')} <> 'PASS'""")
def a18n(spark, sf):
    return Lg.verification_notes(QR.step1_summary(spark, sf))
