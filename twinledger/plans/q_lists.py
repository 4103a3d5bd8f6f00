"""Rosters, source lists, panels."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger import constants as K
from twinledger.operators import panel as P, roster as L
from twinledger.plans import bindings as B, sqltext as S
from twinledger.plans.registry import query
from twinledger.sources import readers

# ---- rosters

_line = S.strip("line")
_n = S.strip(f"split_part({_line}, ',', 1)")
_d = S.strip(f"substring({_line}, strpos({_line}, ',') + 1)")


def _nd(x):
    s = S.strip(x)
    return (f"CASE WHEN {S.one_of(s, K.OPEN_WORDS_PROVINCE)} THEN '至今' WHEN regexp_matches({s}, '^\\d{{4}}\\.\\d{{1,2}}$') THEN concat(split_part({s}, '.', 1), '.', lpad(split_part({s}, '.', 2), 2, '0')) "
            f"WHEN regexp_matches({s}, '^\\d{{4}}$') THEN concat({s}, '.00') ELSE {s} END")


ROSTER = f"""WITH raw AS ({B.duck(B.ROSTER_LINE)}),
entries AS MATERIALIZED (SELECT file, concat('第', file, '省') AS province, CASE WHEN file % 2 = 0 THEN 1990 END AS start_year, sec, k,
  CASE WHEN file % 3 = 0 THEN '主席' ELSE '省长' END AS gov_title, CASE file % 3 WHEN 0 THEN '自治区党委书记' WHEN 1 THEN '省委书记' ELSE '书记' END AS sec_title,
  CASE sec WHEN 0 THEN 'governor' ELSE 'secretary' END AS role_kind, trim(replace(replace({_n}, '（代）', ''), '（代理）', '')) AS name, {_n} AS raw_name,
  contains({_n}, '（代') AS acting, {_nd(f"split_part({_d}, '-', 1)")} AS start, CASE WHEN contains({_d}, '-') THEN {_nd(f"substring({_d}, strpos({_d}, '-') + 1)")} ELSE '至今' END AS "end", {_d} AS d FROM raw)
"""


@query("s1_roster_scan", ROSTER + 'SELECT file, province, start_year, gov_title, sec_title, role_kind, name, acting, start, "end" FROM entries')
def s1(spark, sf):
    return readers.parse_rosters(B.roster_texts(spark, sf)).drop("ord")


@query("s2_strict_roster_scan", ROSTER + "SELECT file, province, role_kind, raw_name AS name, split_part(d, '-', 1) AS start, split_part(d, '-', 2) AS \"end\" FROM entries "
       "WHERE regexp_matches(d, '^(\\d{4}\\.\\d\\d|至今)-(\\d{4}\\.\\d\\d|至今)$') AND NOT (file % 3 = 2 AND sec = 1) "
       "UNION ALL SELECT file, province, 'governor', raw_name, split_part(d, '-', 1), split_part(d, '-', 2) FROM entries "
       "WHERE regexp_matches(d, '^(\\d{4}\\.\\d\\d|至今)-(\\d{4}\\.\\d\\d|至今)$') AND file % 3 = 2 AND sec = 1")
def s2(spark, sf):
    # a header the strict reading does not know leaves the section before it open
    return readers.parse_rosters(B.roster_texts(spark, sf), strict=True).select("file", "province", "role_kind", "name", "start", "end")


def _entries(spark, sf):
    e = readers.parse_rosters(B.roster_texts(spark, sf))
    return L.started_after(e, F.col("start_year"))


KEPT = ROSTER + ", kept AS (SELECT * FROM entries WHERE start_year IS NULL OR coalesce(TRY_CAST(split_part(start, '.', 1) AS INT) >= start_year, true))"
FOLD = """, g AS (SELECT file, name, arg_min(start, sec * 1000000000 + k) AS start, arg_min("end", sec * 1000000000 + k) AS "end", arg_min(acting, sec * 1000000000 + k) AS acting, any_value(gov_title) AS gov_title,
  any_value(sec_title) AS sec_title, count(*) FILTER (sec = 0) AS ng, count(*) FILTER (sec = 1) AS ns FROM kept GROUP BY ALL)"""


@query("a3_roster_consolidation", KEPT + FOLD + """ SELECT file, name, CASE WHEN ng = 0 THEN sec_title ELSE concat(CASE WHEN acting THEN '代' ELSE '' END, gov_title, CASE WHEN ns > 0 THEN concat('/', sec_title) ELSE '' END) END AS role,
  start, "end", false AS needs_check FROM g""")
def a3(spark, sf):
    return L.consolidate(_entries(spark, sf), "file")


@query("a3_city_consolidation", KEPT + FOLD + """ SELECT file, name, CASE WHEN ng = 0 THEN sec_title ELSE concat(CASE WHEN acting THEN '代' ELSE '' END, gov_title, repeat(concat('/', gov_title), ng - 1),
  CASE WHEN ns > 0 THEN concat('/', sec_title) ELSE '' END) END AS role, start, "end", false AS needs_check FROM g""")
def a3c(spark, sf):
    return L.consolidate(_entries(spark, sf), "file", city_rule=True)


@query("p19_active_after", ROSTER + """SELECT file, k, name, "end" FROM (SELECT *, row_number() OVER () FROM entries) e WHERE "end" = '至今' OR coalesce(TRY_CAST(split_part("end", '.', 1) AS INT) >= 2005, true)""".replace(
    "SELECT file, k, name", "SELECT file, name"))
def p19(spark, sf):
    return L.active_after(readers.parse_rosters(B.roster_texts(spark, sf)), 2005).select("file", "name", "end")


@query("p20_single_entity", ROSTER + "SELECT file, name, start FROM entries WHERE name = '官3'")
def p20(spark, sf):
    return L.only(readers.parse_rosters(B.roster_texts(spark, sf)), "官3").select("file", "name", "start")


@query("d8_l2_list_file_body", ROSTER + """SELECT file, role_kind, 0 AS part, string_agg(concat(name, ', ', start, '-', "end"), chr(10) ORDER BY start, k) AS body FROM entries GROUP BY ALL""")
def d8l2(spark, sf):
    e = readers.parse_rosters(B.roster_texts(spark, sf))
    return L.list_lines(e, "file")


# ---- several sources

SOURCES = [(m, r) for m, r in ((2, 0), (3, 1), (5, 2), (7, 3))]


def _source_sql(i, m, r):
    return (f"SELECT concat('n', CAST(c_custkey % 900 AS VARCHAR(9))) AS name, concat('role', c_nationkey % 3) AS role, 1980 + c_nationkey AS start_year, 'e{i}' AS end_year, 's{i}' AS source, "
            f"c_custkey % 50 = {i} AS needs_check, c_custkey AS ord FROM {{customer}} WHERE c_custkey % {m} = {r}")


ALL_SOURCES = " UNION ALL ".join(f"SELECT {i} AS l, * FROM ({B.duck(_source_sql(i, m, r))}) s{i}" for i, (m, r) in enumerate(SOURCES))


@query("a4_u2_source_consolidation", f"""WITH u AS ({ALL_SOURCES}) SELECT name, arg_min(role, l * 10000000000 + ord) AS role, arg_min(start_year, l * 10000000000 + ord) AS start_year, arg_min(end_year, l * 10000000000 + ord) AS end_year,
  string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) AS mentions, bool_or(needs_check) OR count(DISTINCT source) = 1 AS needs_check FROM u GROUP BY name""")
def a4(spark, sf):
    return L.consolidate_sources([B.recipe(spark, sf, _source_sql(i, m, r)) for i, (m, r) in enumerate(SOURCES)])


FIRST = "SELECT c_nationkey AS province, c_custkey AS name FROM {customer} WHERE c_custkey % (c_nationkey * 20 + 7) = 0"
SECOND = "SELECT c_nationkey AS province, c_custkey AS name FROM {customer} WHERE c_custkey % 4 = 1 AND c_nationkey % 6 <> 5"


@query("a5_source_preference", f"""WITH f AS ({B.duck(FIRST)}), s AS ({B.duck(SECOND)}), good AS (SELECT province FROM f GROUP BY 1 HAVING count(*) >= 5)
SELECT *, 'first' AS source FROM f WHERE province IN (FROM good) UNION ALL SELECT *, 'second' FROM s WHERE province NOT IN (FROM good)""")
def a5(spark, sf):
    return L.prefer_source(B.recipe(spark, sf, FIRST), B.recipe(spark, sf, SECOND))


@query("a6_coverage", f"""WITH f AS ({B.duck(FIRST)}), s AS ({B.duck(SECOND)}), j AS (SELECT n_nationkey AS province, (SELECT count(*) FROM f WHERE province = n_nationkey) AS g, (SELECT count(*) FROM s WHERE province = n_nationkey) AS c FROM nation)
SELECT province, CAST(sum(g) AS BIGINT) AS governors, CAST(sum(c) AS BIGINT) AS secretaries, CAST(sum(CASE WHEN g > 0 AND c >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS complete FROM j GROUP BY ROLLUP (province)""")
def a6(spark, sf):
    keys = B.table(spark, sf, "nation").select(F.col("n_nationkey").alias("province"))
    return L.coverage(keys, B.recipe(spark, sf, FIRST), B.recipe(spark, sf, SECOND))


@query("j11_u3_cross_check", f"WITH f AS ({B.duck(FIRST)}), s AS ({B.duck(SECOND)}) SELECT DISTINCT name, 'a' AS only_in FROM f WHERE name NOT IN (SELECT name FROM s) UNION ALL SELECT DISTINCT name, 'b' FROM s WHERE name NOT IN (SELECT name FROM f)")
def j11(spark, sf):
    return L.cross_check(B.recipe(spark, sf, FIRST), B.recipe(spark, sf, SECOND))


TITLES = """SELECT concat('第', c_nationkey, '省') AS province, c_custkey AS ord, CASE c_custkey % 7 WHEN 0 THEN concat('历任第', c_nationkey, '省省长') WHEN 1 THEN concat('第', c_nationkey, '省历任省委书记') WHEN 2 THEN concat('历任第', c_nationkey, '省人大主席')
  WHEN 3 THEN '历任省长' WHEN 4 THEN concat('第', c_nationkey, '省历任自治区党的书记') WHEN 5 THEN concat('第', c_nationkey, '省名人') ELSE concat('历任第', c_nationkey, '省党委书记、主席') END AS title FROM {customer}"""


@query("p26_list_titles", f"""WITH t AS ({B.duck(TITLES)}), r AS (SELECT *, CASE WHEN regexp_matches(title, '历任.*(省长|主席|市长)') THEN 'governor' WHEN regexp_matches(title, '历任.*(省委书记|市委书记|自治区.*书记|党委书记)') THEN 'secretary' END AS role FROM t)
SELECT province, role, arg_min(title, ord) AS title FROM r WHERE role IS NOT NULL AND contains(title, province) GROUP BY ALL""")
def p26(spark, sf):
    return L.first_titles(B.recipe(spark, sf, TITLES))


LIST_JSON = """SELECT c_custkey AS id, concat('{{"第', c_nationkey, '省": {{"governor_list": [{{"name": "g', c_custkey, '", "term": "', 1990 + c_custkey % 20, '年-"}}', CASE WHEN c_custkey % 3 = 0 THEN concat(', {{"name": "h', c_custkey, '"}}') ELSE '' END,
  '], "secretary_list": [', CASE WHEN c_custkey % 2 = 0 THEN concat('{{"name": "s', c_custkey, '", "term": "t", "summary": "z"}}') ELSE '' END, ']}}}}') AS j, c_nationkey AS nk FROM {customer}"""


@query("s6_source_lists", """SELECT c_custkey AS id, concat('第', c_nationkey, '省') AS province, 'governor' AS role_kind, 0 AS ord, concat('g', c_custkey) AS name, concat(1990 + c_custkey % 20, '年-') AS term_raw, '' AS summary FROM customer
UNION ALL SELECT c_custkey, concat('第', c_nationkey, '省'), 'governor', 1, concat('h', c_custkey), '', '' FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT c_custkey, concat('第', c_nationkey, '省'), 'secretary', 0, concat('s', c_custkey), 't', 'z' FROM customer WHERE c_custkey % 2 = 0""")
def s6(spark, sf):
    return readers.parse_source_lists(B.recipe(spark, sf, LIST_JSON), "j", ["id"])


# ---- panels

TEN = f"""WITH ten AS ({B.duck(B.TENURES)}), yrs AS (SELECT CAST(range AS INTEGER) AS year FROM range(1990, 2026)),
act AS MATERIALIZED (SELECT t.*, year FROM ten t JOIN yrs ON sy <= year AND year <= ey),
mon AS MATERIALIZED (SELECT *, CASE WHEN sy < year AND ey > year THEN 12 WHEN sy = year AND ey > year THEN CASE WHEN sm > 0 THEN 13 - sm END WHEN sy < year AND ey = year THEN CASE WHEN em > 0 THEN em END
    WHEN sm > 0 AND em > 0 THEN greatest(em - sm + 1, 1) END AS months,
  CASE WHEN sy < year THEN true WHEN sm IN (0, 7) THEN NULL ELSE sm <= 6 END AS a1, CASE WHEN ey > year THEN true WHEN em IN (0, 7) THEN NULL ELSE em >= 8 END AS b1,
  row_number() OVER (PARTITION BY unit, role, year ORDER BY sy DESC, CASE WHEN sm > 0 THEN sm ELSE 13 END DESC, ord DESC) AS latest, count(*) OVER (PARTITION BY unit, role, year) AS n FROM act),
mx AS MATERIALIZED (SELECT *, max(months) OVER w AS top, count(*) FILTER (months IS NULL) OVER w AS unknown, count(*) FILTER (a1 AND b1) OVER w AS n_on FROM mon WINDOW w AS (PARTITION BY unit, role, year)),
tops AS MATERIALIZED (SELECT *, count(*) FILTER (months = top) OVER (PARTITION BY unit, role, year) AS n_top FROM mx),
longest AS MATERIALIZED (SELECT unit, role, year, coalesce(max(holder) FILTER (n > 1 AND months = top AND n_top = 1 AND unknown = 0), max(holder) FILTER (latest = 1)) AS holder FROM tops GROUP BY ALL),
midyear AS MATERIALIZED (SELECT unit, role, year, coalesce(max(holder) FILTER (n > 1 AND n_on = 1 AND a1 AND b1), max(holder) FILTER (latest = 1)) AS holder FROM tops GROUP BY ALL)"""


@query("j12_active_years", TEN + " SELECT unit, role, holder, year FROM act")
def j12(spark, sf):
    return P.active_years(B.tenures(spark, sf)).select("unit", "role", "holder", "year")


@query("w5_months_in_year", TEN + " SELECT unit, role, holder, year, months, a1 AND b1 AS midyear FROM mon")
def w5(spark, sf):
    return P.active_years(B.tenures(spark, sf)).select("unit", "role", "holder", "year", P.months_in_year().alias("months"), P.in_office_midyear().alias("midyear"))


@query("t1_panel_longest", TEN + " SELECT * FROM longest")
def t1(spark, sf):
    return P.pick_longest(P.active_years(B.tenures(spark, sf)))


@query("t2_w6_panel_midyear", TEN + " SELECT * FROM midyear")
def t2(spark, sf):
    return P.pick_midyear(P.active_years(B.tenures(spark, sf)))


@query("w7_panel_latest", TEN + " SELECT unit, role, year, holder FROM mon WHERE latest = 1")
def w7(spark, sf):
    return P.pick_latest(P.active_years(B.tenures(spark, sf)))


@query("t3_panel_grid", TEN + """, picked AS (SELECT *, 'longest' AS rule FROM longest UNION ALL SELECT *, 'midyear' FROM midyear)
SELECT n_nationkey AS unit, y.year, r.rule, coalesce(max(CAST(holder AS VARCHAR)) FILTER (role = 'governor'), '') AS governor, coalesce(max(CAST(holder AS VARCHAR)) FILTER (role = 'secretary'), '') AS secretary
FROM nation CROSS JOIN yrs y CROSS JOIN (VALUES ('longest'), ('midyear')) r(rule) LEFT JOIN picked p ON p.unit = n_nationkey AND p.year = y.year AND p.rule = r.rule GROUP BY ALL""")
def t3(spark, sf):
    return P.panel(B.tenures(spark, sf), B.table(spark, sf, "nation").select(F.col("n_nationkey").alias("unit")))
