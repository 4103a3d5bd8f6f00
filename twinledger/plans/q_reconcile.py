"""Comparing, queueing and merging the two episode versions derived from ``lineitem``."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger import constants as K
from twinledger.functions.ordered import best_per_key
from twinledger.operators import merge as M, queue as Q, reconcile as R
from twinledger.plans import bindings as B, sqltext as S
from twinledger.plans.registry import query

# ---- shared oracle steps

PAIRED = B.EPISODES_WITH + """,
both_sides AS MATERIALIZED (
  SELECT 'a' AS side, * FROM a WHERE name IN (SELECT name FROM b)
  UNION ALL SELECT 'b' AS side, * FROM b WHERE name IN (SELECT name FROM a)),
sizes AS MATERIALIZED (SELECT name, source_line, count(*) FILTER (side = 'a') AS n_a, count(*) FILTER (side = 'b') AS n_b
  FROM both_sides GROUP BY ALL),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY side, name, source_line ORDER BY unit, pos) AS rn FROM both_sides),
paired AS MATERIALIZED (SELECT x.name, x.source_line, x.rn, x.start AS start_a, y.start AS start_b, x."end" AS end_a, y."end" AS end_b,
    x.unit AS unit_a, y.unit AS unit_b, x.position AS position_a, y.position AS position_b
  FROM ranked x JOIN ranked y ON x.side = 'a' AND y.side = 'b' AND x.name = y.name AND x.source_line = y.source_line AND x.rn = y.rn)"""


def _unpivot(level: bool) -> str:
    levels = {"start": S.date_level("start_a", "start_b"), "end": S.date_level("end_a", "end_b"),
              "unit": f"CASE WHEN {S.norm_org('unit_a')} <> {S.norm_org('unit_b')} THEN 'MEDIUM' END", "position": "'MEDIUM'"}
    return " UNION ALL ".join(
        f"SELECT name, source_line, rn, unit_a AS unit, position_a AS position, start_a AS start, '{f}' AS field, {f}_a AS value_a, "
        f"{f}_b AS value_b" + (f", {levels[f]} AS level" if level else "") + f" FROM paired WHERE {f}_a <> {f}_b"
        for f in K.EPISODE_FIELDS)


FIELD_DIFFS = PAIRED + f",\nfield_diffs AS MATERIALIZED (SELECT * FROM ({_unpivot(True)}) t WHERE level IS NOT NULL)"
GROUP_DIFFS = """
texts AS MATERIALIZED (SELECT name, source_line, side, string_agg(concat(unit, ' ', position), '; ' ORDER BY pos) AS d FROM both_sides GROUP BY ALL),
group_diffs AS MATERIALIZED (SELECT s.name, s.source_line, 0 AS part,
    CASE WHEN n_a > 0 AND n_b > 0 THEN 'episode_split' ELSE 'episode_missing' END AS scope,
    CASE WHEN n_a > 0 AND n_b > 0 THEN '拆分方式' WHEN n_a = 0 THEN 'LLM1缺失' ELSE 'LLM2缺失' END AS field,
    CASE WHEN n_a = 0 THEN '（无）' WHEN n_b = 0 THEN ta.d ELSE concat(n_a, '条: ', ta.d) END AS value_a,
    CASE WHEN n_b = 0 THEN '（无）' WHEN n_a = 0 THEN tb.d ELSE concat(n_b, '条: ', tb.d) END AS value_b, 'MEDIUM' AS level
  FROM sizes s LEFT JOIN texts ta ON ta.side = 'a' AND ta.name = s.name AND ta.source_line = s.source_line
    LEFT JOIN texts tb ON tb.side = 'b' AND tb.name = s.name AND tb.source_line = s.source_line WHERE n_a <> n_b)"""
ALL_DIFFS = FIELD_DIFFS + "," + GROUP_DIFFS
DISPUTES = PAIRED + f""",
disputes AS MATERIALIZED (SELECT * FROM ({_unpivot(False)}) t JOIN (SELECT name, source_line FROM sizes WHERE n_a = n_b) USING (name, source_line))"""
DECIDED = DISPUTES + f",\nfield_dec AS MATERIALIZED ({B.duck(B.FIELD_DECISIONS)})"
GROUP_DEC = f"""
all_lines AS (SELECT DISTINCT name, source_line FROM (SELECT name, source_line FROM a UNION ALL SELECT name, source_line FROM b) t),
group_dec AS MATERIALIZED ({B.duck(B.GROUP_DECISIONS)})"""

SUMMARY = f"""
people AS (SELECT name FROM a INTERSECT SELECT name FROM b),
summary AS MATERIALIZED (SELECT name, count(*) FILTER (level = 'HIGH') AS high_count, count(*) FILTER (level = 'MEDIUM') AS medium_count
  FROM (SELECT name, NULL AS level FROM people UNION ALL SELECT name, level FROM field_diffs UNION ALL SELECT name, level FROM group_diffs) t
  GROUP BY name)"""


def _ab(spark, sf):
    return B.episodes_a(spark, sf), B.episodes_b(spark, sf)


def _u(spark, sf, large=None):
    large = B.large_names(spark, sf) if large is None else large
    return R.both_sides(*_ab(spark, sf), large)


# ---- J1-J3, F1-F3, F9-F11

@query("j1_people_in_both", B.EPISODES_WITH + " SELECT name FROM a INTERSECT SELECT name FROM b")
def j1(spark, sf):
    # names only: the derivation needs no positions here
    return R.people_in_both(B.recipe(spark, sf, B.RAW_A), B.recipe(spark, sf, B.RAW_B))


@query("j2_line_full_outer", PAIRED + " SELECT name, source_line AS line_pos, n_a, n_b FROM sizes")
def j2(spark, sf):
    return R.group_sizes(R.sides(*_ab(spark, sf)))


@query("j3_ordered_pairs", PAIRED + " SELECT name, source_line, rn, unit_a, unit_b, start_a, start_b FROM paired")
def j3(spark, sf):
    return R.pairs(_u(spark, sf)).select(
        "name", F.col("line_pos").alias("source_line"), "rn", F.col("a.unit").alias("unit_a"), F.col("b.unit").alias("unit_b"),
        F.col("a.start").alias("start_a"), F.col("b.start").alias("start_b"))


@query("f1_field_diff", FIELD_DIFFS + " SELECT name, source_line, rn, unit, field, value_a, value_b, level FROM field_diffs")
def f1(spark, sf):
    return R.field_diffs(R.pairs(_u(spark, sf))).select("name", "source_line", "rn", "unit", "field", "value_a", "value_b", "level")


def _group_diffs(spark, sf):
    large = B.large_names(spark, sf)
    return R.group_diffs(_u(spark, sf, large), large)


@query("f2_split_diff", PAIRED + "," + GROUP_DIFFS + " SELECT * FROM group_diffs WHERE scope = 'episode_split'")
def f2(spark, sf):
    return _group_diffs(spark, sf).filter("scope = 'episode_split'")


@query("f3_missing_diff", PAIRED + "," + GROUP_DIFFS + " SELECT * FROM group_diffs WHERE scope = 'episode_missing'")
def f3(spark, sf):
    return _group_diffs(spark, sf).filter("scope = 'episode_missing'")


def step1_summary(spark, sf):
    return R.summarize_episodes(_u(spark, sf))


@query("f9_verdict", ALL_DIFFS + "," + SUMMARY + f" SELECT *, {S.verdict('high_count', 'medium_count')} AS verdict FROM summary")
def f9(spark, sf):
    return step1_summary(spark, sf)


@query("f10_run_summary", ALL_DIFFS + "," + SUMMARY +
       f" SELECT {S.verdict('high_count', 'medium_count')} AS verdict, count(*) AS people FROM summary GROUP BY 1")
def f10(spark, sf):
    return R.run_summary(step1_summary(spark, sf))


_ORD_B = ("SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1000 WHEN o_orderkey % 5 = 0 THEN 5000 ELSE 0 END AS total, "
          "CASE WHEN o_orderkey % 4 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS prio, "
          "CASE WHEN o_orderkey % 6 = 0 THEN 'X' ELSE o_orderstatus END AS status FROM {orders} WHERE o_orderkey % 11 <> 0")


@query("f11_generic_reconcile", f"""WITH a AS (SELECT o_orderkey, o_totalprice AS total, o_orderpriority AS prio, o_orderstatus AS status
  FROM orders WHERE o_orderkey % 13 <> 0), b AS ({B.duck(_ORD_B)}),
j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, a.o_orderkey IS NULL AS no_a, b.o_orderkey IS NULL AS no_b,
  abs(a.total - b.total) AS gap, a.prio AS pa, b.prio AS pb, a.status AS sa, b.status AS sb FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
SELECT o_orderkey, '_missing' AS field, CASE WHEN no_a THEN 'a' ELSE 'b' END AS value_a, 'MEDIUM' AS level FROM j WHERE no_a OR no_b
UNION ALL SELECT o_orderkey, 'total', '', CASE WHEN gap > 2000 THEN 'HIGH' ELSE 'MEDIUM' END FROM j WHERE gap > 500
UNION ALL SELECT o_orderkey, 'prio', pa, 'MEDIUM' FROM j WHERE lower(pa) <> lower(pb)
UNION ALL SELECT o_orderkey, 'status', sa, 'HIGH' FROM j WHERE sa <> sb""")
def f11(spark, sf):
    a = B.recipe(spark, sf, "SELECT o_orderkey, o_totalprice AS total, o_orderpriority AS prio, o_orderstatus AS status FROM {orders} WHERE o_orderkey % 13 <> 0")
    b = B.recipe(spark, sf, _ORD_B)
    out = R.reconcile(a, b, ["o_orderkey"], {"total": {"tolerance": (500, 2000)}, "prio": {"normalize": F.lower}, "status": {"level": R.HIGH}})
    return out.select("o_orderkey", "field", F.when(F.col("field") == "total", "").otherwise(F.col("value_a")).alias("value_a"), "level")


# ---- J4, J5, F4, F5

def _class_unpivot(fields, high, src_a="class_a", src_b="class_b"):
    return " UNION ALL ".join(
        f"SELECT coalesce(x.name, y.name) AS name, coalesce(x.episode_idx, y.episode_idx) AS episode_idx, '{f}' AS field, "
        f"coalesce(x.{f}, '') AS value_a, coalesce(y.{f}, '') AS value_b, '{'HIGH' if f in high else 'MEDIUM'}' AS level "
        f"FROM (SELECT * FROM {src_a} WHERE name IN (SELECT name FROM {src_b})) x "
        f"FULL JOIN {src_b} y ON x.name = y.name AND x.episode_idx = y.episode_idx "
        f"WHERE coalesce(x.{f}, '') <> coalesce(y.{f}, '')" for f in fields)


CLASS_DIFFS = B.CLASS_WITH + f",\nclass_diffs AS MATERIALIZED ({_class_unpivot(K.CLASS_FIELDS, K.CLASS_HIGH)})"
RANK_DIFFS = B.RANK_WITH + f",\nrank_diffs AS MATERIALIZED ({_class_unpivot(['rank'], [], 'rank_a', 'rank_b')})"


def class_diffs(spark, sf):
    return R.diff_classes(B.classes_a(spark, sf), B.classes_b(spark, sf))


def rank_diffs(spark, sf):
    return R.diff_ranks(B.ranks_a(spark, sf), B.ranks_b(spark, sf))


@query("j4_f4_class_diff", CLASS_DIFFS + " SELECT * FROM class_diffs")
def f4(spark, sf):
    return class_diffs(spark, sf).drop("scope")


@query("f5_rank_diff", RANK_DIFFS + " SELECT * FROM rank_diffs")
def f5(spark, sf):
    return rank_diffs(spark, sf).drop("scope")


@query("f5_rank_verdict", RANK_DIFFS + """ SELECT name, CAST(0 AS BIGINT) AS high_count, count(level) AS medium_count,
  CASE WHEN count(level) > 0 THEN 'NEEDS_REVIEW' ELSE 'PASS' END AS verdict
FROM (SELECT name, NULL AS level FROM (SELECT name FROM rank_a INTERSECT SELECT name FROM rank_b) UNION ALL SELECT name, level FROM rank_diffs) t
GROUP BY name""")
def f5_verdict(spark, sf):
    return R.summarize_indexed(B.ranks_a(spark, sf), B.ranks_b(spark, sf), ["rank"], [], rank_rule=True)


@query("j5_context_lookup", B.CLASS_WITH + f""", class_diffs AS ({_class_unpivot(K.CLASS_FIELDS, K.CLASS_HIGH)}),
ctx AS (SELECT name, pos, source_line, unit, position, start FROM a WHERE k1 % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY name, source_line ORDER BY pos) = 1)
SELECT d.*, coalesce(c.source_line, 0) AS source_line, coalesce(unit, '') AS unit, coalesce(position, '') AS position, coalesce(start, '') AS start
FROM class_diffs d LEFT JOIN ctx c ON c.name = d.name AND c.source_line = d.episode_idx""")
def j5(spark, sf):
    ctx = best_per_key(B.episodes_a(spark, sf).filter("k1 % 3 <> 0"), ["name", "source_line"], ["pos"], ["unit", "position", "start"])
    ctx = ctx.withColumns({"seq": F.col("source_line"), "pos": F.col("source_line")})
    return R.diff_classes(B.classes_a(spark, sf), B.classes_b(spark, sf), context=ctx).drop("scope")


# ---- F6-F8

def _person_diffs() -> str:
    rows = []
    for f in K.BIO_FIELDS:
        rows.append(f"SELECT name, 'bio' AS scope, '{f}' AS field, x.{f} AS value_a, y.{f} AS value_b, '' AS reason_a, '' AS reason_b, "
                    f"'{'HIGH' if f in K.BIO_HIGH else 'MEDIUM'}' AS level FROM person_a x JOIN person_b y USING (name) WHERE x.{f} <> y.{f}")
    for f in K.LABEL_FIELDS:
        rows.append(f"SELECT name, 'label', '{f}', x.{f}, y.{f}, coalesce(x.{f}_reason, ''), coalesce(y.{f}_reason, ''), 'HIGH' "
                    f"FROM person_a x JOIN person_b y USING (name) WHERE x.{f} <> y.{f}")
    rows.append("SELECT name, 'corruption', 'fell', x.fell, y.fell, '', '', 'HIGH' FROM person_a x JOIN person_b y USING (name) "
                "WHERE x.fell <> '' AND y.fell <> '' AND x.fell <> y.fell")
    return " UNION ALL ".join(rows)


PERSON_DIFFS = B.PERSON_WITH + f",\nperson_diffs AS MATERIALIZED ({_person_diffs()})"


def person_diffs(spark, sf):
    return R.diff_people(B.people_a(spark, sf), B.people_b(spark, sf))


#: The fields of a person whose type counts.
_TYPED = [("bio", f, "HIGH" if f in K.BIO_HIGH else "MEDIUM") for f in K.BIO_FIELDS] + [("label", f, "HIGH") for f in K.LABEL_FIELDS]

for _scope, _name in (("bio", "f6_bio_diff"), ("label", "f7_label_diff"), ("corruption", "f8_fell_diff")):
    @query(_name, PERSON_DIFFS + f" SELECT * FROM person_diffs WHERE scope = '{_scope}'")
    def _pd(spark, sf, scope=_scope):
        return person_diffs(spark, sf).filter(F.col("scope") == scope).drop("type_mismatch")


@query("f6_type_mismatch", B.PERSON_WITH + " " + " UNION ALL ".join(f"""SELECT name, '{scope}' AS scope, '{f}' AS field, a.{f} AS value_a, b.{f} AS value_b, '{level}' AS level, a.{f} = b.{f} AS type_mismatch
FROM person_a a JOIN person_b b USING (name) WHERE a.{f} <> b.{f} OR a.{f} = b.{f} AND (name % 3 = 0) <> (name % 2 = 0)""" for scope, f, level in _TYPED))
def f6t(spark, sf):
    """Each version records what type a value had; equal texts of another type differ too."""
    kinds = lambda d, test: d.withColumns({f"{f}_type": F.when(F.expr(test), "number").otherwise("text") for _, f, _ in _TYPED})
    d = R.diff_people(kinds(B.people_a(spark, sf), "name % 3 = 0"), kinds(B.people_b(spark, sf), "name % 2 = 0"))
    return d.filter("scope <> 'corruption'").drop("reason_a", "reason_b")


@query("f13_field_corrections", B.CLASS_WITH + f"""
SELECT name, k1, k2, 'org_tag' AS field, org_tag AS before, '国务院及其组成部门' AS after FROM class_all WHERE org_tag = '国务院组成部门'
UNION ALL SELECT name, k1, k2, 'flag', flag, '省委常委（其他）' FROM class_all WHERE flag = '省委常委（其他)'
UNION ALL SELECT name, k1, k2, 'city', city, '' FROM class_all WHERE city <> '' AND ({S.one_of('flag', K.PROVINCE_FLAGS)} OR {S.one_of('org_tag', K.CENTRAL_TAGS)})""")
def f13(spark, sf):
    return R.apply_corrections(B.classes_a(spark, sf), ["name", "k1", "k2"], clear_city=True)[1]


# ---- M1-M5, J7

def _disputes(spark, sf):
    return Q.field_disputes(_u(spark, sf))


def _field_dec(spark, sf):
    return B.field_decisions(spark, sf, _disputes(spark, sf))


DISPUTE_COLS = "name, source_line, rn, unit, position, start, field, value_a, value_b"


@query("m1_field_disputes", DISPUTES + f" SELECT {DISPUTE_COLS} FROM disputes")
def m1(spark, sf):
    return _disputes(spark, sf)


@query("m1_group_disputes", PAIRED + " SELECT * FROM sizes WHERE n_a <> n_b")
def m1g(spark, sf):
    return Q.group_disputes(R.sides(*_ab(spark, sf)))


@query("m2_class_dispute_groups", CLASS_DIFFS + f""", dec AS ({B.duck(B.CLASS_DECISIONS).replace('FROM diffs', 'FROM class_diffs')} AND name % 3 <> 0)
SELECT name, episode_idx, count(*)::INTEGER AS n_fields, string_agg(concat(field, '=', value_a, '/', value_b), ',' ORDER BY field) AS fields
FROM class_diffs d WHERE NOT EXISTS (SELECT 1 FROM dec c WHERE c.name = d.name AND c.episode_idx = d.episode_idx AND c.field = d.field)
GROUP BY name, episode_idx""")
def m2(spark, sf):
    d = class_diffs(spark, sf)
    dec = B.recipe(spark, sf, B.CLASS_DECISIONS, diffs=d).filter("name % 3 <> 0")
    g = Q.class_dispute_groups(d, dec)
    text = F.transform("fields", lambda f: F.concat(f["field"], F.lit("="), f["value_a"], F.lit("/"), f["value_b"]))
    return g.select("name", "episode_idx", "n_fields", F.array_join(text, ",").alias("fields"))


VALIDATED = f"""SELECT name, source_line, field, CASE WHEN asks THEN '需拆分' WHEN multi AND field = 'unit' THEN '需拆分' WHEN multi THEN '两者均存疑' ELSE verdict END AS verdict,
  CASE WHEN asks OR multi THEN '' ELSE correct_value END AS correct_value, asks OR multi AS downgraded,
  CASE WHEN asks THEN 'natural_language_recovered_to_needsplit' WHEN multi AND field = 'unit' THEN 'multivalue_unit_recovered_to_needsplit'
    WHEN multi THEN concat('invalid_separator_in_', {S.mapped('field', K.FIELD_LABELS, "''")}) END AS downgrade_reason, unit, position, start
FROM (SELECT *, candidate AND {S.any_word('correct_value', K.NEED_SPLIT_WORDS)} AS asks,
    candidate AND NOT {S.any_word('correct_value', K.NEED_SPLIT_WORDS)} AND
    (CASE field {' '.join(f"WHEN '{f}' THEN {S.any_word('correct_value', s)}" for f, s in K.FORBIDDEN_SEPARATORS.items())} ELSE FALSE END) AS multi
  FROM (SELECT *, verdict IN ('自行修正', '两者均存疑') AND correct_value <> '' AS candidate FROM field_dec) f) g"""


@query("m4_verdict_validation", DECIDED + " " + VALIDATED)
def m4(spark, sf):
    return Q.validate_verdicts(_field_dec(spark, sf)).select(
        "name", "source_line", "field", "verdict", "correct_value", "downgraded", "downgrade_reason", "unit", "position", "start")


@query("m5_escalation", DECIDED + "," + GROUP_DEC + f""", v AS ({VALIDATED})
SELECT DISTINCT name, source_line FROM v WHERE verdict = '需拆分'
  AND NOT EXISTS (SELECT 1 FROM group_dec g WHERE g.name = v.name AND g.source_line = v.source_line)""")
def m5(spark, sf):
    a, b = _ab(spark, sf)
    return Q.escalate(Q.validate_verdicts(_field_dec(spark, sf)), B.group_decisions(spark, sf, a, b))


@query("m5_downgraded_groups", DECIDED + "," + GROUP_DEC + f""", v AS ({VALIDATED})
SELECT DISTINCT name, source_line FROM v WHERE verdict = '需拆分' AND (name, source_line) NOT IN (SELECT (name, source_line) FROM group_dec WHERE (name + source_line) % 3 > 0)""")
def m5d(spark, sf):
    """A third of the group decisions are downgraded, which leaves their lines to be asked again."""
    g = B.group_decisions(spark, sf, *_ab(spark, sf)).withColumn("downgraded", F.expr("nullif((name + source_line) % 3 = 0, false)"))
    return Q.escalate(Q.validate_verdicts(_field_dec(spark, sf)), g)


@query("j7_pending_fields", DECIDED + f""", dec AS (SELECT * FROM field_dec WHERE NOT (field = 'end' AND source_line % 3 = 0)),
open_ AS (SELECT DISTINCT name, source_line, unit, position, start FROM disputes ANTI JOIN dec USING (name, source_line, unit, position, start, field))
SELECT {DISPUTE_COLS} FROM disputes SEMI JOIN open_ USING (name, source_line, unit, position, start)""")
def j7f(spark, sf):
    # compared once: the decisions are derived from what is stored
    d = B.stored(_disputes(spark, sf))
    dec = B.field_decisions(spark, sf, d).filter("not (field = 'end' and source_line % 3 = 0)")
    return Q.pending_fields(d, dec)


@query("j7_pending_groups", PAIRED + "," + GROUP_DEC + """ SELECT * FROM sizes s WHERE n_a <> n_b
  AND NOT EXISTS (SELECT 1 FROM group_dec g WHERE g.name = s.name AND g.source_line = s.source_line)""")
def j7g(spark, sf):
    a, b = _ab(spark, sf)
    return Q.pending_groups(Q.group_disputes(R.sides(a, b)), B.group_decisions(spark, sf, a, b))


@query("j7_pending_ranks", RANK_DIFFS + """ SELECT name, episode_idx, value_a, value_b FROM rank_diffs WHERE name % 4 = 2""")
def j7r(spark, sf):
    d = rank_diffs(spark, sf)
    return Q.pending_by_key(d, B.recipe(spark, sf, B.RANK_DECISIONS, diffs=d), ["name", "episode_idx"]).select(
        "name", "episode_idx", "value_a", "value_b")


@query("j7_pending_labels", PERSON_DIFFS + " SELECT name, scope, field, value_a, value_b FROM person_diffs WHERE name % 4 = 3")
def j7l(spark, sf):
    d = person_diffs(spark, sf)
    return Q.pending_by_key(d, B.recipe(spark, sf, B.LABEL_DECISIONS, diffs=d), ["name", "field"]).select(
        "name", "scope", "field", "value_a", "value_b")


_RESP = """SELECT o_orderkey AS id, o_orderkey % 3 + 1 AS n,
  CASE o_orderkey % 6 WHEN 0 THEN concat('{{"verdict": "采纳LLM1", "reason": "flat ', o_orderkey, '"}}')
    WHEN 1 THEN concat('{{"start": {{"verdict": "自行修正", "correct_value": "', o_custkey, '", "confidence": ', o_orderkey % 100, '}}}}')
    WHEN 2 THEN '{{"start": {{"verdict": "采纳LLM2"}}, "end": {{"verdict": "采纳LLM1", "reason": "e"}}, "unit": {{"verdict": "两者均存疑"}}}}'
    WHEN 3 THEN '{{"verdict": "采纳LLM2", "end": {{"verdict": "自行修正", "correct_value": "v"}}}}'
    WHEN 4 THEN '{{"other": 1, "end": "text"}}' ELSE 'not json' END AS response
FROM {orders}"""


@query("m3_response_fan_out", "WITH r AS (" + B.duck(_RESP.replace("{{", "<").replace("}}", ">")).replace("<", "{").replace(">", "}") + """),
f AS (SELECT id, n, unnest(list_slice(['start', 'end', 'unit'], 1, n)) AS field, CASE WHEN json_valid(response) THEN response::JSON END AS j FROM r),
x AS (SELECT id, n, field, CASE WHEN n = 1 AND json_exists(j, '$.verdict') THEN j
  WHEN json_type(j -> field) = 'OBJECT' THEN j -> field WHEN json_exists(j, '$.verdict') THEN j END AS v FROM f)
SELECT id, field, coalesce(v ->> 'verdict', '两者均存疑') AS verdict, v ->> 'correct_value' AS correct_value, v ->> 'confidence' AS confidence,
  CASE WHEN v IS NULL THEN CASE WHEN n = 1 THEN '解析失败' ELSE '批量裁判未覆盖此字段' END ELSE v ->> 'reason' END AS reason FROM x""")
def m3(spark, sf):
    o = B.recipe(spark, sf, _RESP)
    fields = F.slice(F.array(F.lit("start"), F.lit("end"), F.lit("unit")), F.lit(1), F.col("n").cast("int"))
    return Q.fan_out(o.select("id", fields.alias("fields"), "response"))


# ---- M6-M12

MERGE_GROUPS = """
plan AS MATERIALIZED (SELECT g.*, fa.first_pos, CASE WHEN has_episode THEN 'judge' WHEN adopt IN ('LLM2', 'VF') AND EXISTS (SELECT 1 FROM b
    WHERE b.name = g.name AND b.source_line = g.source_line) THEN 'b' WHEN first_pos IS NOT NULL THEN 'first' ELSE 'none' END AS kind
  FROM group_dec g LEFT JOIN (SELECT name, source_line, min(pos) AS first_pos FROM a GROUP BY ALL) fa
    ON fa.name = g.name AND fa.source_line = g.source_line WHERE g.name IN (SELECT name FROM a)),
pieces AS (
  SELECT a.name, a.source_line AS ln, start, "end", unit, position, 0 AS unseen, a.pos AS anchor, 0 AS idx
    FROM a LEFT JOIN plan p ON p.name = a.name AND p.source_line = a.source_line WHERE kind IS NULL OR (kind = 'first' AND a.pos = first_pos)
  UNION ALL SELECT b.name, b.source_line, start, "end", unit, position, CASE WHEN first_pos IS NULL THEN 1 ELSE 0 END, coalesce(first_pos, p.source_line), b.pos
    FROM b JOIN plan p ON p.name = b.name AND p.source_line = b.source_line WHERE kind = 'b'
  UNION ALL SELECT name, coalesce(own_line, source_line), '1990.01', '1991.02', concat('判定单位', source_line), '主席',
    CASE WHEN first_pos IS NULL THEN 1 ELSE 0 END, coalesce(first_pos, source_line), 0 FROM plan WHERE kind = 'judge'),
merged_groups AS MATERIALIZED (SELECT name, row_number() OVER (PARTITION BY name ORDER BY CASE WHEN name IN (SELECT name FROM plan) THEN ln ELSE 0 END,
    unseen, anchor, idx) AS seq, ln AS source_line, start, "end", unit, position FROM pieces)"""
MERGED = DECIDED + "," + GROUP_DEC + "," + MERGE_GROUPS + f""",
merged AS MATERIALIZED (SELECT m.name, m.seq, m.source_line, {', '.join(
    f'''coalesce(CASE WHEN EXISTS (SELECT 1 FROM group_dec g WHERE g.name = m.name AND g.source_line = m.source_line) THEN NULL
      WHEN d_{f}.verdict IN ('采纳LLM2', '采纳QW') THEN {('bl.' + ('"end"' if f == 'end' else f)) if f in ('start', 'end') else 'm.' + f}
      WHEN d_{f}.verdict IN ('自行修正', '两者均存疑') THEN nullif(d_{f}.correct_value, '') END, m.{'"end"' if f == 'end' else f}) AS {'"end"' if f == 'end' else f}'''
    for f in K.EPISODE_FIELDS)}
  FROM merged_groups m {' '.join(
    f'''LEFT JOIN (SELECT name, source_line, unit, position, start, max_by(verdict, pos) AS verdict, max_by(correct_value, pos) AS correct_value
      FROM field_dec WHERE field = '{f}' GROUP BY ALL) d_{f} ON d_{f}.name = m.name AND d_{f}.source_line = m.source_line AND d_{f}.unit = m.unit
      AND d_{f}.position = m.position AND d_{f}.start = m.start''' for f in K.EPISODE_FIELDS)}
  LEFT JOIN (SELECT name, source_line, unit, position, max_by(start, pos) AS start, max_by("end", pos) AS "end" FROM b GROUP BY ALL) bl
    ON bl.name = m.name AND bl.source_line = m.source_line AND bl.unit = m.unit AND bl.position = m.position)"""


@query("m6_group_merge", B.EPISODES_WITH + "," + GROUP_DEC + "," + MERGE_GROUPS + " SELECT * FROM merged_groups")
def m6(spark, sf):
    a, b = _ab(spark, sf)
    return M.merge_groups(a, b, B.group_decisions(spark, sf, a, b), large=B.large_names(spark, sf))


def merged_step1(spark, sf):
    large = B.large_names(spark, sf)
    with B.written_once(spark, sf, large, ("lineitem",)) as by_name:
        a, b = _ab(spark, sf)
        u = R.both_sides(a, b, large, by_name=by_name)
        return M.merge_step1(a, b, B.group_decisions(spark, sf, a, b), B.field_decisions(spark, sf, Q.field_disputes(u)), large=large, by_name=by_name)


@query("m7_m8_field_merge", MERGED + " SELECT * FROM merged")
def m7(spark, sf):
    return merged_step1(spark, sf)


def class_decisions(spark, sf):
    return B.recipe(spark, sf, B.CLASS_DECISIONS, diffs=class_diffs(spark, sf))


CLASS_DEC = f"class_dec AS MATERIALIZED ({B.duck(B.CLASS_DECISIONS).replace('FROM diffs', 'FROM class_diffs')})"
CLASS_LAYER = f"""SELECT m.*, {', '.join(f'''coalesce(CASE WHEN d_{f}.verdict IN ('采纳LLM2', '采纳QW') THEN nullif(y.{f}, '')
      WHEN d_{f}.verdict IN ('自行修正', '两者均存疑') THEN nullif(d_{f}.correct_value, '') END, nullif(x.{f}, ''), y.{f}, '') AS {f}''' for f in K.CLASS_FIELDS)}
  FROM base m LEFT JOIN class_a x ON x.name = m.name AND x.episode_idx = m.seq LEFT JOIN class_b y ON y.name = m.name AND y.episode_idx = m.seq
  {' '.join(f"LEFT JOIN class_dec d_{f} ON d_{f}.field = '{f}' AND d_{f}.name = m.name AND d_{f}.episode_idx = m.seq" for f in K.CLASS_FIELDS)}"""


@query("m9_class_layering", CLASS_DIFFS + "," + CLASS_DEC + ", base AS (SELECT DISTINCT name, source_line AS seq FROM a) " + CLASS_LAYER)
def m9(spark, sf):
    eps = B.episodes_a(spark, sf).select("name", F.col("source_line").alias("seq")).distinct()
    return M.merge_classes(eps, B.classes_a(spark, sf), B.classes_b(spark, sf), class_decisions(spark, sf))


RANK_DEC = f"rank_dec AS MATERIALIZED ({B.duck(B.RANK_DECISIONS).replace('FROM diffs', 'FROM rank_diffs')})"
RESOLVED_RANKS = RANK_DIFFS + "," + RANK_DEC + """,
resolved_ranks AS MATERIALIZED (SELECT coalesce(x.name, d.name) AS name, coalesce(x.episode_idx, d.episode_idx) AS episode_idx,
  CASE WHEN verdict IN ('采纳LLM2', '采纳QW') THEN coalesce(y.rank, x.rank, '') WHEN verdict IN ('自行修正', '两者均存疑') AND correct_value <> ''
    THEN correct_value ELSE x.rank END AS rank
FROM rank_a x FULL JOIN rank_dec d ON d.name = x.name AND d.episode_idx = x.episode_idx
LEFT JOIN rank_b y ON y.name = coalesce(x.name, d.name) AND y.episode_idx = coalesce(x.episode_idx, d.episode_idx))"""


def resolved_ranks(spark, sf):
    return M.resolve_ranks(B.ranks_a(spark, sf), B.ranks_b(spark, sf), B.recipe(spark, sf, B.RANK_DECISIONS, diffs=rank_diffs(spark, sf)))


@query("m10_rank_resolution", RESOLVED_RANKS + " SELECT * FROM resolved_ranks")
def m10(spark, sf):
    return resolved_ranks(spark, sf)


LABEL_DEC = f"label_dec AS MATERIALIZED ({B.duck(B.LABEL_DECISIONS).replace('FROM diffs', 'FROM person_diffs')})"
RESOLVED_LABELS = PERSON_DIFFS + "," + LABEL_DEC + f""",
resolved_labels AS MATERIALIZED (SELECT x.name, x.birth_year, x.origin, x.origin_city, x.minority, x.female, x.bachelor, x.fell, x.fell_reason, {', '.join(
  f'''CASE WHEN d_{f}.verdict IN ('采纳LLM2', '采纳QW') THEN coalesce(y.{f}, '-1') WHEN d_{f}.verdict IN ('自行修正', '两者均存疑') AND d_{f}.correct_value <> ''
    THEN coalesce(CAST(TRY_CAST(d_{f}.correct_value AS INTEGER) AS VARCHAR), d_{f}.correct_value) ELSE coalesce(x.{f}, '-1') END AS {f}''' for f in K.LABEL_FIELDS)}
FROM person_a x LEFT JOIN person_b y ON y.name = x.name {' '.join(f"LEFT JOIN label_dec d_{f} ON d_{f}.name = x.name AND d_{f}.field = '{f}'" for f in K.LABEL_FIELDS)})"""


def label_decisions(spark, sf):
    return B.recipe(spark, sf, B.LABEL_DECISIONS, diffs=person_diffs(spark, sf))


def resolved_labels(spark, sf):
    return M.resolve_labels(B.people_a(spark, sf), B.people_b(spark, sf), label_decisions(spark, sf))


@query("m11_label_overrides", RESOLVED_LABELS + " SELECT * FROM resolved_labels")
def m11(spark, sf):
    return resolved_labels(spark, sf).select(
        "name", "birth_year", "origin", "origin_city", "minority", "female", "bachelor", "fell", "fell_reason", *K.LABEL_FIELDS)


@query("m12_merge_scope", B.EPISODES_WITH + """ SELECT name, name IN (SELECT name FROM b) AS has_b FROM a GROUP BY name""")
def m12(spark, sf):
    a = B.recipe(spark, sf, B.RAW_A).select("name").distinct()
    b = B.recipe(spark, sf, B.RAW_B).select("name").distinct().withColumn("has_b", F.lit(True))
    return a.join(b, "name", "left").select("name", F.coalesce("has_b", F.lit(False)).alias("has_b"))
