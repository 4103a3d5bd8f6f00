"""Rule-based labels, pages, audit, incremental work."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from twinledger import constants as K, manuals
from twinledger.functions.ordered import shared_folder
from twinledger.operators import audit as A, labels as Lb, pages as Pg
from twinledger.plans import bindings as B, sqltext as S
from twinledger.plans.registry import query
from twinledger.sources import store as Store
from twinledger.streaming import incremental as I

# ---- one post per lineitem row, with texts the rules can read

POSTS = """SELECT name, source_line, k1, k2, pos AS seq, start, CASE WHEN k1 % 10 = 9 THEN '' WHEN k1 % 23 = 0 THEN '至今' ELSE "end" END AS "end",
  CASE k1 % 10 WHEN 0 THEN '浙江省政府' WHEN 1 THEN '中共浙江省委' WHEN 2 THEN '中共杭州市委' WHEN 3 THEN '杭州市政府' WHEN 4 THEN '南京农业大学' WHEN 5 THEN '中共中央政治局' WHEN 6 THEN '国务院、浙江省人大'
    WHEN 7 THEN '北京理工大学' WHEN 8 THEN '浙江省委组织部' ELSE '某集团' END AS unit,
  CASE k2 % 9 WHEN 0 THEN '省长' WHEN 1 THEN '副书记' WHEN 2 THEN '书记' WHEN 3 THEN '常委' WHEN 4 THEN '市长' WHEN 5 THEN '研究生' WHEN 6 THEN '教授' WHEN 7 THEN '副省长' ELSE '部长' END AS position,
  CASE k1 % 4 WHEN 0 THEN '浙江省' WHEN 1 THEN '' WHEN 2 THEN '浙江' ELSE '北京市' END AS prov, CASE k2 % 3 WHEN 0 THEN '杭州市' ELSE '' END AS city,
  CASE k2 % 5 WHEN 0 THEN '地方政府' WHEN 1 THEN '国务院及其组成部门' ELSE '其他' END AS org_tag,
  CASE k1 % 7 WHEN 0 THEN '副国级' WHEN 1 THEN '正部级' WHEN 2 THEN '副部级' WHEN 3 THEN '难以判断' WHEN 4 THEN '' WHEN 5 THEN '局级' ELSE '正厅级' END AS rank,
  CASE k2 % 6 WHEN 0 THEN '省长' WHEN 1 THEN '省委副书记（非省长）' WHEN 2 THEN '市委副书记（非市长）' WHEN 3 THEN '市长' WHEN 4 THEN '省委书记' ELSE '无' END AS flag FROM """
PW = f"WITH a AS ({B.DUCK_A}), e AS MATERIALIZED ({POSTS} a)"


def _posts(spark, sf):
    a = B.episodes_a(spark, sf)
    return B.recipe(spark, sf, POSTS.replace('"end"', "`end`") + "{a}", a=a)


# units of both manuals, some within longer names, some with other names or years
UNITS = ["北京大学光华管理学院", "中国矿业大学（北京）", "中国科学院大学", "南京农业大学", "西安交通大学电气学院", "中国纺织大学", "哈尔滨工业大学", "郑州大学", "中石油辽宁销售分公司", "国家电网山东省电力公司",
         "国家电网", "招商局集团", "中国银行", "中国农业发展银行", "中国农业银行浙江省分行", "中信集团", "一汽", "中国铁道建筑集团", "中铁建", "某集团", "中央党校", "浙江省委党校", "", "浙江省政府", "中共杭州市委", "国务院", "中共中央政治局", "南京军区", "宁波市人民政府", "外交学院"]
TITLES = ["校长", "常务副校长", "副校长", "董事长", "总经理", "副总经理", "书记", "副书记", "常委", "省长", "市长", "副市长", "研究生", "教授", "处长", "系主任", "秘书", "秘书长", "委员", "讲师"]
_pick = lambda k, names: f"CASE {k} % {len(names)} " + " ".join(f"WHEN {i} THEN {S.q(n)}" for i, n in enumerate(names)) + " END"
STAFF = f"""SELECT name, source_line, k1, k2, CASE WHEN k1 % 31 = 0 THEN '' ELSE concat(CAST(1985 + k2 % 30 AS VARCHAR(4)), '.09') END AS start, {_pick('k1', UNITS)} AS unit, {_pick('k2', TITLES)} AS position FROM """
_value = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else S.q(v)
UNIT_TABLE = "(VALUES " + ", ".join(f"({', '.join(map(_value, r))})" for r in manuals.unit_rows()) + ") AS r(ord, unit_name, tag, level, central, first_year, last_year)"
STAFFED = f"""WITH a AS ({B.DUCK_A}), e AS MATERIALIZED ({STAFF} a), u AS (SELECT DISTINCT unit, TRY_CAST(substring(start, 1, 4) AS INT) AS y FROM e),
known AS (SELECT unit, y, tag, level, central FROM u JOIN {UNIT_TABLE} ON contains(unit, unit_name) AND (first_year IS NULL OR y >= first_year) AND (last_year IS NULL OR y <= last_year)
  QUALIFY row_number() OVER (PARTITION BY unit, y ORDER BY length(unit_name) DESC, r.ord) = 1),
s AS MATERIALIZED (SELECT e.*, tag AS unit_tag, level AS unit_level, central AS unit_central FROM e LEFT JOIN known ON known.unit = e.unit AND known.y IS NOT DISTINCT FROM TRY_CAST(substring(e.start, 1, 4) AS INT))"""


def _rule_case(kind):
    """The rules of one kind as a CASE over s; regular expressions match anywhere, as in Spark."""
    fields = {"level": "coalesce(unit_level, '')", "unit": "unit", "position": "position", "exclude": "position"}
    whens = []
    for _, _, value, *patterns in (r for r in manuals.rule_rows() if r[0] == kind):
        tests = [f"{'NOT ' if f == 'exclude' else ''}regexp_matches({x}, {S.q(p)})" for (f, x), p in zip(fields.items(), patterns) if p]
        whens.append(f"WHEN {' AND '.join(tests)} THEN {S.q(value)}")
    return f"CASE {' '.join(whens)} END AS {kind}"


def _staff(spark, sf):
    a = B.episodes_a(spark, sf)
    return Lb.unit_rules(B.recipe(spark, sf, STAFF + "{a}", a=a), manuals.unit_rules(spark))


@query("p34_rule_classify", STAFFED + f" SELECT name, source_line, k1, k2, {', '.join(map(_rule_case, manuals.RULES))} FROM s")
def p34(spark, sf):
    return Lb.classify_by_rules(_staff(spark, sf), manuals.class_rules(spark), level="unit_level").select("name", "source_line", "k1", "k2", *manuals.RULES)


@query("p35_rule_check", PW + f""" SELECT name, source_line, k1, k2, 'city_not_empty' AS violation FROM e WHERE ({S.one_of('flag', K.PROVINCE_FLAGS)} OR {S.one_of('org_tag', K.CENTRAL_TAGS)}) AND city <> ''
UNION ALL SELECT name, source_line, k1, k2, 'province_not_full' FROM e WHERE prov = '浙江' UNION ALL SELECT name, source_line, k1, k2, 'line_missing' FROM e WHERE source_line <= 0
UNION ALL SELECT name, source_line, k1, k2, 'rank_not_allowed' FROM e WHERE rank IN ('', '局级') UNION ALL SELECT name, source_line, k1, k2, 'several_units' FROM e WHERE {S.any_word('unit', ['；', ';', '、', '和'])}""")
def p35(spark, sf):
    return Lb.rule_check(_posts(spark, sf), ["name", "source_line", "k1", "k2"])


@query("j16_unit_rules", STAFFED + " SELECT name, source_line, k1, k2, unit_tag, unit_level, unit_central FROM s")
def j16(spark, sf):
    return _staff(spark, sf).select("name", "source_line", "k1", "k2", "unit_tag", "unit_level", "unit_central")


@query("w8_concurrent_flags", PW + """ SELECT name, source_line, k1, k2, CASE WHEN flag = '省委副书记（非省长）' AND bool_or(flag = '省长') OVER w THEN '省委副书记（省长）'
  WHEN flag = '市委副书记（非市长）' AND bool_or(flag = '市长') OVER w THEN '市委副书记（市长）' ELSE flag END AS flag FROM e WINDOW w AS (PARTITION BY name, source_line)""")
def w8(spark, sf):
    return Lb.concurrent_flags(_posts(spark, sf)).select("name", "source_line", "k1", "k2", "flag")


TARGET = "flag = '省长'"
FACTS = f", f AS MATERIALIZED (SELECT name, min(source_line) FILTER ({TARGET}) AS first_line, max(source_line) FILTER ({TARGET}) AS last_line, arg_max(\"end\", seq) FILTER ({TARGET}) AS last_end FROM e GROUP BY name)"


@query("w9_next_posting", PW + FACTS + f""", l AS (SELECT e.name, source_line, bool_or(flag = '省委书记') AS s, min({S.rank_ord('rank')}) AS o FROM e JOIN f ON f.name = e.name WHERE source_line > last_line GROUP BY ALL),
n AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY name ORDER BY source_line) = 1)
SELECT f.name, CASE WHEN last_line IS NULL THEN '' WHEN last_end = '至今' THEN '-1' WHEN n.name IS NULL THEN '2' WHEN s OR o <= 2 THEN '1' WHEN o IS NOT NULL THEN '0' ELSE '-1' END AS label FROM f LEFT JOIN n ON n.name = f.name""")
def w9(spark, sf):
    return Lb.next_posting(_posts(spark, sf), F.col("flag") == "省长", F.col("flag") == "省委书记")


@query("w10_prior_posting", PW + FACTS + """, l AS (SELECT e.name, source_line, bool_or(prov = '浙江省' AND regexp_matches(unit, '省委|省政府|省人大|省政协|自治区')) AS l, bool_or(prov <> '') AS k FROM e JOIN f ON f.name = e.name WHERE source_line < first_line GROUP BY ALL),
n AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY name ORDER BY source_line DESC) = 1)
SELECT f.name, CASE WHEN first_line IS NULL THEN '' WHEN n.name IS NULL THEN '-1' WHEN l THEN '1' WHEN k THEN '0' ELSE '-1' END AS label FROM f LEFT JOIN n ON n.name = f.name""")
def w10(spark, sf):
    return Lb.prior_posting(_posts(spark, sf), F.col("flag") == "省长", "浙江省")


@query("w11_prior_study", PW + FACTS + """ SELECT name, CASE WHEN EXISTS (SELECT 1 FROM e WHERE e.name = f.name AND position = '研究生' AND prov = '浙江省' AND source_line < first_line) THEN '1' ELSE '0' END AS label FROM f""")
def w11(spark, sf):
    return Lb.prior_study(_posts(spark, sf), F.col("flag") == "省长", "浙江省")


@query("w13_end_backfill", PW + """, l AS (SELECT name, source_line, min(nullif(start, '')) AS s FROM e GROUP BY ALL), n AS (SELECT *, lead(s) OVER (PARTITION BY name ORDER BY source_line) AS nx FROM l)
SELECT e.name, e.source_line, k1, k2, CASE WHEN "end" = '' THEN coalesce(nx, '') ELSE "end" END AS "end" FROM e JOIN n ON n.name = e.name AND n.source_line = e.source_line""")
def w13(spark, sf):
    return Lb.backfill_end(_posts(spark, sf), B.large_names(spark, sf)).select("name", "source_line", "k1", "k2", "end")


# ---- pages

@query("p24_l4_page_fields", """WITH p AS (SELECT page_id, html, [trim(regexp_replace(x, '<[^>]*>', '', 'g'), E' \\t\\n\\r') FOR x IN regexp_extract_all(html, '(?is)<p>(.*?)</p>', 1)] AS ps FROM pages),
c AS (SELECT page_id, html, list_filter([regexp_replace(x, '\\[\\d+(?:-\\d+)?\\]', '', 'g') FOR x IN ps], lambda x: length(x) >= 10) AS ps FROM p)
SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]*>', '', 'g'), E' \\t\\n\\r') AS title, CAST(len(ps) AS INTEGER) AS n, array_to_string(ps, '|') AS body FROM c""")
def p24(spark, sf):
    f = Pg.page_fields(B.table(spark, sf, "pages"))
    return f.select("page_id", "title", F.size("paragraphs").alias("n"), F.array_join("paragraphs", "|").alias("body"))


#: A third of the pages with marked blocks, a third with years in loose paragraphs, a third as they are; with boxes and tables.
PAGED = """SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '' ELSE regexp_extract(html, '<title>([^ <]*)', 1) END AS person, concat(CASE page_id % 3
  WHEN 0 THEN replace(replace(replace(replace(replace(replace(replace(html, '<p><b>', '<p>'), '<p>', '<div class="para_1">'), '</p>', '<sup class="reference">9</sup>[1][2-3]</div>'), '<article>', '<div class="J-lemma-content">'), '</article>', '</div>'), '<nav>', '<div class="lemmaSummary_x">'), '</nav>', '</div>')
  WHEN 1 THEN replace(html, '<p>', '<p>1990') ELSE html END,
  CASE WHEN page_id % 2 = 0 THEN concat('<div class="basicInfo_x"><dl><dt>a &lt; b</dt><dd>', url, '</dd></dl></div>') ELSE '' END,
  '<table><tr><th>', CASE WHEN page_id % 4 = 0 THEN '任职时间' ELSE '姓名' END, '</th></tr><tr><td>', url, '</td></tr></table>') AS html FROM {pages}"""


def _page_texts_sql() -> str:
    def gone(x: str, tag: str, attribute: str = "\\b[^>]*") -> str:
        return f"regexp_replace({x}, {S.q(f'(?is)<{tag}{attribute}>.*?</{tag}\\s*>')}, '', 'g')"

    body = "regexp_replace(coalesce(html, ''), '(?s)<!--.*?-->', '', 'g')"
    for tag in Pg.HIDDEN:
        body = gone(body, tag)
    for tag in Pg.MARKS:
        body = gone(body, tag, """\\s[^>]*class=["'][^"']*(?:lemmaref|reference)[^"']*["'][^>]*""")
    text = "trim(x, E' \\t\\n\\r')"
    for entity, char in Pg.ENTITIES.items():
        text = f"replace({text}, {S.q(entity)}, {S.q(char)})"
    joined = lambda h, sep="''": f"array_to_string(list_filter([{text} FOR x IN regexp_split_to_array({h}, '<[^>]*>')], lambda y: y <> ''), {sep})"
    cited = lambda t: f"regexp_replace({t}, {S.q(Pg.CITATION)}, '', 'g')"
    found = lambda h, pattern: f"regexp_extract_all({h}, {S.q(pattern)}, 1)"
    block = lambda word: f"array_to_string({found('h', Pg.block(word))}, '<br>')"
    content = """regexp_extract(h, '(?is)<div[^>]*class=["''][^"'']*j-lemma-content[^"'']*["''][^>]*>(.*)$', 1)"""
    return f"""WITH p AS ({B.duck(PAGED)}), f AS (SELECT page_id, person, regexp_replace({body}, {S.q(Pg.block('para'))}, '<p class="para">\\1</p>', 'g') AS h FROM p),
c AS (SELECT *, {joined("regexp_extract(h, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title, {cited(joined(block('lemmasummary')))} AS summary, {joined(block('(?:basicinfo|j-basic-info)'), "' | '")} AS info,
  list_filter([{cited(joined('z'))} FOR z IN {found(content, '(?is)<p class="para">(.*?)</p>')}], lambda t: length(t) >= 10) AS own,
  list_filter([{joined('z')} FOR z IN {found('h', '(?is)<(?:p|li|td|dd)(?:\\s[^>]*)?>(.*?)</(?:p|li|td|dd)>')}], lambda t: length(t) >= 10 AND (regexp_matches(t, '(?:19|20)\\d{{2}}') OR {S.any_word('t', K.ROLE_WORDS)})) AS loose,
  [struct_pack(head := array_to_string([{joined('w')} FOR w IN {found('z', '(?is)<th(?:\\s[^>]*)?>(.*?)</th>')}], ''), cells := {joined('z', "E'\\t'")}) FOR z IN {found('h', '(?is)<table[^>]*>(.*?)</table>')}] AS tables FROM f),
s AS (SELECT page_id, CASE WHEN title <> '' AND contains(title, person) THEN concat(E'=== 词条标题 ===\\n', title) END AS a, CASE WHEN length(summary) > 20 THEN concat(E'=== 人物简介 ===\\n', summary) END AS b,
  CASE WHEN length(info) > 20 THEN concat(E'=== 基本信息 ===\\n', info) END AS c, CASE WHEN len(own) > 0 THEN own ELSE loose END AS paras,
  [concat(E'=== 履历表格 ===\\n', t.cells) FOR t IN tables IF {S.any_word('t.head', K.TENURE_HEADER_WORDS)}] AS d FROM c)
SELECT page_id, array_to_string(list_concat(list_filter([a, b, c, CASE WHEN len(paras) > 0 THEN concat(E'=== 履历段落 ===\\n', array_to_string(paras, E'\\n')) END], lambda y: y IS NOT NULL), d), E'\\n\\n') AS text FROM s"""


@query("p24_page_texts", _page_texts_sql())
def p24t(spark, sf):
    return Pg.extract_pages(B.recipe(spark, sf, PAGED), name="person")


LINKED = "SELECT page_id, concat(replace(html, 'href=\"/', 'href=\"/item/x/1'), CASE WHEN page_id % 3 = 0 THEN '多义词<a href=\"/q?fromModule=disambiguation\">浙江省省长</a><a href=\"/r?fromModule=disambiguation\">教授</a>' WHEN page_id % 3 = 1 THEN '义项' ELSE '' END) AS html FROM {pages}"
CAND = f"""WITH p AS ({B.duck(LINKED)}), l0 AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\\s[^>]*href="[^"]*"[^>]*>.*?</a>') AS al FROM p WHERE contains(html, '多义词') OR contains(html, '义项')),
l1 AS (SELECT page_id, unnest(al) AS a, generate_subscripts(al, 1) - 1 AS pos FROM l0),
l AS (SELECT page_id, CAST(pos AS INTEGER) AS pos, regexp_extract(a, 'href="([^"]*)"', 1) AS href, trim(regexp_replace(a, '<[^>]*>', '', 'g')) AS text FROM l1),
k AS (SELECT *, contains(href, 'disambiguation') AS m FROM l WHERE length(text) > 2 AND (contains(href, 'disambiguation') OR regexp_matches(href, '^/item/.+/\\d+'))),
cand AS (SELECT page_id, pos, href, text FROM k WHERE m OR page_id NOT IN (SELECT page_id FROM k WHERE m))"""


@query("p25_candidate_links", CAND + " SELECT * FROM cand")
def p25(spark, sf):
    return Pg.candidate_links(B.recipe(spark, sf, LINKED))


@query("p23_candidate_scoring", CAND + f""", s AS (SELECT *, CAST({' + '.join(f"CAST(contains(text, '{w}') AS INT)" for w in K.CANDIDATE_WORDS)} + CASE WHEN contains(text, '浙江') THEN 5 ELSE 0 END + CASE WHEN contains(text, '省长') THEN 3 ELSE 0 END AS INTEGER) AS score FROM cand)
SELECT page_id, replace(href, '?fromModule=disambiguation', '') AS href, text, score FROM s QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) = 1""")
def p23(spark, sf):
    return Pg.score_candidates(Pg.candidate_links(B.recipe(spark, sf, LINKED)), province="浙江", role="省长")


TABLES = """SELECT c_custkey AS page_id, concat('<p>x</p><table class="wikitable sortable"><tr><th>姓名</th><th>任期</th></tr><tr><td>', c_custkey, '</td><td><b>', CASE c_custkey % 4 WHEN 0 THEN '王小明' WHEN 1 THEN '李四' WHEN 2 THEN '五个字的名' ELSE 'x' END,
  '</b></td></tr><tr><td>赵六</td></tr><tr><td>张三</td><td>李四</td></tr></table>') AS html FROM {customer}"""


@query("p31_table_names", "SELECT c_custkey AS page_id, 0 AS table_no, 1 AS row_no, CASE c_custkey % 4 WHEN 0 THEN '王小明' ELSE '李四' END AS name FROM customer WHERE c_custkey % 4 < 2 UNION ALL SELECT c_custkey, 0, 3, '张三' FROM customer")
def p31(spark, sf):
    return Pg.table_names(B.recipe(spark, sf, TABLES))


# ---- failure and usage log

LOG = """SELECT event_id, ts, event_type AS scope, user_id % 3 AS source, user_id % 4 AS step, concat('p', user_id % 5) AS phase, concat('m', user_id % 4) AS model,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS prompt_tokens, CAST(floor(value / 2) AS BIGINT) AS completion_tokens,
  CASE WHEN event_id % 3 = 0 THEN CAST(floor(value / 3) AS BIGINT) END AS cache_hit, CASE WHEN event_id % 3 = 0 THEN CAST(floor(value / 4) AS BIGINT) END AS cache_miss,
  CASE event_id % 7 WHEN 0 THEN 'Content Exists Risk: x' WHEN 1 THEN 'Cannot parse JSON from y' WHEN 2 THEN 'Missing keys: z' WHEN 3 THEN 'timeout' ELSE '' END AS error FROM {events}"""
LG = f"WITH log AS ({B.duck(LOG)})"


def _log(spark, sf):
    return B.recipe(spark, sf, LOG)


@query("a14_failure_summary", LG + """, s AS (SELECT scope AS label, count(*) AS n FROM log GROUP BY 1), p AS (SELECT concat(source, '/', step) AS label, count(*) AS n FROM log GROUP BY 1 ORDER BY n DESC, label LIMIT 10), f AS (SELECT event_id FROM log ORDER BY ts, event_id LIMIT 5)
SELECT 'total' AS kind, 1 AS rank, '' AS label, count(*) AS n FROM log UNION ALL SELECT 'scope', row_number() OVER (ORDER BY n DESC, label), label, n FROM s
UNION ALL SELECT 'source_step', row_number() OVER (ORDER BY n DESC, label), label, n FROM p UNION ALL SELECT 'sample', row_number() OVER (ORDER BY event_id), concat('#', event_id), 1 FROM f""")
def a14(spark, sf):
    out = A.failure_summary(_log(spark, sf))
    return out.withColumn("rank", F.col("rank").cast("long"))


USAGE = LG + """, u AS (SELECT *, coalesce(prompt_tokens, coalesce(cache_hit, 0) + coalesce(cache_miss, 0)) AS p, coalesce(completion_tokens, 0) AS c FROM log),
usage AS MATERIALIZED (SELECT phase, model, count(*) FILTER (p > 0 OR c > 0) AS calls, CAST(sum(p) AS BIGINT) AS input, CAST(sum(c) AS BIGINT) AS output,
  CASE WHEN coalesce(sum(cache_hit + cache_miss), 0) > 0 THEN sum(cache_hit) / sum(cache_hit + cache_miss) ELSE 0 END AS hit_rate FROM u GROUP BY ALL HAVING count(*) FILTER (p > 0 OR c > 0) > 0)"""


@query("a15_usage_by_phase", USAGE + " SELECT * FROM usage")
def a15(spark, sf):
    return A.usage_by_phase(_log(spark, sf))


@query("a15_usage_snapshots", USAGE + " SELECT model, phase, CAST(sum(calls) OVER w AS BIGINT) AS calls, CAST(sum(input) OVER w AS BIGINT) AS input, CAST(sum(output) OVER w AS BIGINT) AS output FROM usage WINDOW w AS (PARTITION BY model ORDER BY phase)")
def a15s(spark, sf):
    return A.snapshots(A.usage_by_phase(_log(spark, sf)))


@query("k6_run_totals", USAGE + " SELECT model, CAST(sum(calls) AS BIGINT) AS calls, CAST(sum(input) AS BIGINT) AS input, CAST(sum(output) AS BIGINT) AS output FROM usage GROUP BY model")
def k6(spark, sf):
    return A.usage_totals(A.usage_by_phase(_log(spark, sf)))


@query("a16_outcome_matrix", LG + """, r AS (SELECT model, step, arg_max(CASE event_id % 7 WHEN 0 THEN 'blocked' WHEN 1 THEN 'parse_error' WHEN 2 THEN 'schema_error' WHEN 3 THEN 'api_error' ELSE 'success' END, ts) AS st FROM (SELECT * REPLACE (concat('m', event_id % 6) AS model) FROM log) l GROUP BY ALL)
SELECT model, count(*) FILTER (st = 'success') AS success, count(*) FILTER (st = 'blocked') AS blocked, count(*) FILTER (st NOT IN ('success', 'blocked')) AS other_failures,
  max(st) FILTER (step = 0) AS step_0, max(st) FILTER (step = 1) AS step_1, max(st) FILTER (step = 2) AS step_2, max(st) FILTER (step = 3) AS step_3 FROM r GROUP BY model""")
def a16(spark, sf):
    log = _log(spark, sf).withColumns({"status": A.error_class(F.col("error")), "model": F.concat(F.lit("m"), F.col("event_id") % 6)})
    return A.outcome_matrix(log, [0, 1, 2, 3])


# ---- incremental work

TODO = "SELECT user_id AS name, event_id FROM {events}"
DONE = "SELECT DISTINCT user_id AS name FROM {events} WHERE event_type = 'purchase' AND user_id % 2 = 0"


@query("i1_i2_incremental", f"SELECT DISTINCT name FROM ({B.duck(TODO)}) t WHERE name NOT IN ({B.duck(DONE)})")
def i1(spark, sf):
    return I.incremental(B.recipe(spark, sf, TODO), B.recipe(spark, sf, DONE)).select("name")


OLD = "SELECT o_custkey AS name, o_orderkey AS seq, o_totalprice AS v FROM {orders} WHERE o_orderkey % 3 <> 0"
NEW = "SELECT o_custkey AS name, o_orderkey AS seq, -o_totalprice AS v FROM {orders} WHERE o_orderkey % 3 = 0"
BOTH = f"WITH u AS (SELECT 0 AS b, * FROM ({B.duck(OLD)}) o UNION ALL SELECT 1, * FROM ({B.duck(NEW)}) n) SELECT name, seq, v FROM u QUALIFY row_number() OVER (PARTITION BY name ORDER BY b {{0}}, seq {{0}}) = 1"


@query("u4_upsert_last_wins", BOTH.format("DESC"))
def u4(spark, sf):
    return I.upsert(B.recipe(spark, sf, OLD), B.recipe(spark, sf, NEW), ["name"], "seq")


@query("u5_keep_first", BOTH.format("ASC"))
def u5(spark, sf):
    return I.keep_first(B.recipe(spark, sf, OLD), B.recipe(spark, sf, NEW), ["name"], "seq")


# ---- the result store, filled by batches and by a stream of files

RESULTS = "SELECT o_custkey AS name, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat('r', o_orderkey) END AS result, o_orderkey AS seq FROM {orders}"
PARTS = ["o_orderkey % 5 < 3", "o_orderkey % 5 = 3", "o_orderkey % 5 = 4"]
# the last part that has a result of the name, and in it the largest seq
STORED = "WITH u AS (" + " UNION ALL ".join(f"SELECT {i} AS part, * FROM ({B.duck(RESULTS)} WHERE {w}) p" for i, w in enumerate(PARTS)) + """)
SELECT name, seq, result FROM u WHERE result IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY part DESC, seq DESC) = 1"""


def _parts(spark, sf):
    return [B.recipe(spark, sf, f"{RESULTS} WHERE {w}") for w in PARTS]


def _new_folder(spark):
    return f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"


def _as_stored(df):
    return df.groupBy("name").agg(F.max_by("result", F.when(F.col("result").isNotNull(), F.col("seq"))).alias("result"), F.max(F.when(F.col("result").isNotNull(), F.col("seq"))).alias("seq"))


@query("k4_result_store", STORED)
def k4(spark, sf):
    path = _new_folder(spark)
    for i, part in enumerate(_parts(spark, sf)):
        Store.store_results(part, path, batch=str(i), order="seq")
        Store.store_results(part, path, batch=str(i), order="seq")  # a rerun adds nothing
    return Store.read_store(spark, path).select("name", "seq", "result")


@query("i1_stream_store", STORED)
def i1_stream(spark, sf):
    """Files of three days; the stream is started after each, and once more with nothing new."""
    path = _new_folder(spark)
    for i, part in enumerate(_parts(spark, sf)):
        part.write.parquet(f"{path}/files/day{i}")
        I.stream_to_store(spark, f"{path}/files/*", part.schema, f"{path}/store", f"{path}/checkpoint", work=_as_stored).awaitTermination()
    I.stream_to_store(spark, f"{path}/files/*", part.schema, f"{path}/store", f"{path}/checkpoint", work=_as_stored).awaitTermination()
    return Store.read_store(spark, f"{path}/store").select("name", "seq", "result")
