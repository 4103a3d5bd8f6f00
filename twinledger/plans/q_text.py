"""Dates, normalisers, predicates, biography parsing and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger import constants as K
from twinledger.functions import dates as D, text as T
from twinledger.operators import biography as Bio, queue as Q
from twinledger.plans import bindings as B, sqltext as S
from twinledger.plans.registry import query

# ---- date texts, one per order

DATE_TEXT = """SELECT o_orderkey AS id, CASE o_orderkey % 14
    WHEN 0 THEN printf('%04d.%02d', CAST(1950 + o_custkey % 70 AS INT), CAST(o_custkey % 13 AS INT))
    WHEN 1 THEN printf('%04d.%d', CAST(1950 + o_custkey % 70 AS INT), CAST(o_custkey % 9 + 1 AS INT))
    WHEN 2 THEN printf('%04d', CAST(1950 + o_custkey % 70 AS INT)) WHEN 3 THEN '至今' WHEN 4 THEN '现任' WHEN 5 THEN ''
    WHEN 6 THEN concat(' ', CAST(1950 + o_custkey % 70 AS VARCHAR(9)), '.5　') WHEN 7 THEN concat('n', CAST(o_custkey AS VARCHAR(9)))
    WHEN 8 THEN printf('%04d.', CAST(1950 + o_custkey % 70 AS INT)) WHEN 9 THEN 'nan' WHEN 10 THEN NULL
    WHEN 11 THEN printf('%04d.%02d.11', CAST(1950 + o_custkey % 70 AS INT), CAST(o_custkey % 13 AS INT)) WHEN 12 THEN 'present' ELSE '1990.x' END AS t
FROM {orders}"""
DT = f"WITH d AS ({B.duck(DATE_TEXT)}) "
_s = S.strip("t")
_ym = f"regexp_extract({_s}, '^(\\d{{4}})\\.(\\d{{1,2}})$', 1)"
_mm = f"regexp_extract({_s}, '^(\\d{{4}})\\.(\\d{{1,2}})$', 2)"


def _dates(spark, sf):
    return B.recipe(spark, sf, DATE_TEXT)


def _scalar(name, sql, expr, source=_dates, prefix=DT, cols=("id",)):
    @query(name, f"{prefix}SELECT {', '.join(cols)}, {sql} FROM {'d' if prefix is DT else 'src'}")
    def run(spark, sf):
        return source(spark, sf).select(*cols, *expr())


c = lambda n="t": F.col(n)

_scalar("d1_norm_date", f"CASE WHEN {S.one_of(_s, K.OPEN_WORDS_PROVINCE)} THEN '至今' WHEN regexp_matches({_s}, '^\\d{{4}}\\.\\d{{1,2}}$') "
        f"THEN concat({_ym}, '.', lpad({_mm}, 2, '0')) WHEN regexp_matches({_s}, '^\\d{{4}}$') THEN concat({_s}, '.00') ELSE {_s} END AS province_form, "
        f"CASE WHEN {S.one_of(_s, K.OPEN_WORDS_CITY)} THEN '至今' WHEN regexp_matches({_s}, '^\\d{{4}}\\.\\d{{1,2}}$') "
        f"THEN concat({_ym}, '.', lpad({_mm}, 2, '0')) WHEN regexp_matches({_s}, '^\\d{{4}}$') THEN concat({_s}, '.00') ELSE {_s} END AS city_form",
        lambda: [D.norm_date(c()).alias("province_form"), D.norm_date(c(), K.OPEN_WORDS_CITY).alias("city_form")])
_scalar("d2_frac_year", f"{S.frac_year('t')} AS f, coalesce({S.frac_year('t')}, -1.0) AS legacy",
        lambda: [D.frac_year(c()).alias("f"), D.frac_year_legacy(c()).alias("legacy")])
_scalar("d3_parse_ym", f"CASE WHEN {_s} = '至今' THEN 9999 WHEN regexp_matches({_s}, '^\\d{{4}}(\\.\\d\\d)?$') THEN CAST(substring({_s}, 1, 4) AS INTEGER) END AS y, "
        f"CASE WHEN {_s} = '至今' THEN 12 WHEN regexp_matches({_s}, '^\\d{{4}}\\.\\d\\d$') THEN CAST(substring({_s}, 6, 2) AS INTEGER) WHEN regexp_matches({_s}, '^\\d{{4}}$') THEN 0 END AS m",
        lambda: [D.parse_ym(c())["y"].alias("y"), D.parse_ym(c())["m"].alias("m")])
_scalar("d4_parse_year", "TRY_CAST(regexp_extract(t, '^\\d{4}') AS INTEGER) AS y", lambda: [D.parse_year(c()).alias("y")])
_scalar("d7_clean_date", f"CASE WHEN t IN ('', '至今') THEN t WHEN regexp_matches(rtrim({_s}, '.'), '^\\d{{4}}$') THEN concat(rtrim({_s}, '.'), '.00') "
        f"WHEN regexp_matches({_s}, '^\\d{{4}}\\.\\d{{1,2}}$') THEN concat({_ym}, '.', lpad({_mm}, 2, '0')) ELSE rtrim({_s}, '.') END AS v",
        lambda: [D.clean_date(c()).alias("v")])
_scalar("d10_sort_key", f"{S.sort_key('t')} AS k", lambda: [D.sort_key(c()).alias("k")])
_scalar("d11_int_or_text", "CASE WHEN regexp_matches(trim(t), '^[+-]?[0-9]+$') THEN coalesce(CAST(TRY_CAST(trim(t) AS INTEGER) AS VARCHAR), t) ELSE t END AS v",
        lambda: [D.int_or_text(c()).alias("v")])

TERM = """SELECT o_orderkey AS id, concat(CASE WHEN o_orderkey % 2 = 0 THEN '任期：' ELSE '' END,
  CASE o_orderkey % 8 WHEN 0 THEN printf('%04d年%d月—%04d年%d月', CAST(1950 + o_custkey % 60 AS INT), CAST(o_custkey % 12 + 1 AS INT), CAST(1955 + o_custkey % 60 AS INT), CAST(o_custkey % 9 + 1 AS INT))
    WHEN 1 THEN printf('%04d年-%04d年', CAST(1950 + o_custkey % 60 AS INT), CAST(1955 + o_custkey % 60 AS INT))
    WHEN 2 THEN printf('%04d年%d月%d日－ ', CAST(1950 + o_custkey % 60 AS INT), CAST(o_custkey % 12 + 1 AS INT), CAST(o_custkey % 28 + 1 AS INT))
    WHEN 3 THEN printf('%04d年', CAST(1950 + o_custkey % 60 AS INT)) WHEN 4 THEN printf('%04d.%02d-%04d.%02d（代）-', CAST(1950 + o_custkey % 60 AS INT), CAST(o_custkey % 12 + 1 AS INT), CAST(1951 + o_custkey % 60 AS INT), CAST(o_custkey % 12 + 1 AS INT))
    WHEN 5 THEN printf('%04d.%02d-%04d（代）-%04d.%02d', CAST(1950 + o_custkey % 60 AS INT), CAST(o_custkey % 12 + 1 AS INT), CAST(1951 + o_custkey % 60 AS INT), CAST(1953 + o_custkey % 60 AS INT), CAST(o_custkey % 12 + 1 AS INT))
    WHEN 6 THEN concat('"文革"初期-', CAST(1967 + o_custkey % 9 AS VARCHAR(9)), '年') ELSE printf('%04d年–至今', CAST(1950 + o_custkey % 60 AS INT)) END) AS t
FROM {orders}"""
_cn = "regexp_replace(regexp_replace(t, '任期：', '', 'g'), '任期:', '', 'g')"
_cd = "(\\d{4})年(\\d{1,2})?月?(\\d{1,2})?日?"
_tail = f"regexp_extract(trim({_cn}), '^.*?\\d{{4}}年(?:\\d{{1,2}})?月?(?:\\d{{1,2}})?日?(.*)$', 1, 's')"


def _cnym(x):
    return f"concat(regexp_extract({x}, '{_cd}', 1), '.', lpad(coalesce(nullif(regexp_extract({x}, '{_cd}', 2), ''), '0'), 2, '0'))"


_rest = "CASE " + " ".join(f"WHEN contains(tail, '{x}') THEN trim(substring(tail, strpos(tail, '{x}') + 1))" for x in "—–-－") + " END"


@query("d5_parse_term_cn", f"""WITH s AS (SELECT id, trim({_cn}) AS w, {_tail} AS tail FROM ({B.duck(TERM)}) x), r AS (SELECT *, {_rest} AS rest, regexp_matches(w, '{_cd}') AS hit FROM s)
SELECT id, CASE WHEN hit THEN {_cnym('w')} ELSE '' END AS start, CASE WHEN NOT hit OR rest IS NULL THEN '' WHEN rest IN ('', '至今', '现任') THEN '至今'
  WHEN regexp_matches(rest, '{_cd}') THEN {_cnym('rest')} ELSE '至今' END AS "end" FROM r""")
def d5(spark, sf):
    return B.recipe(spark, sf, TERM).select("id", D.parse_term_cn(c()).alias("x")).select("id", "x.*")


@query("d6_parse_term_list", f"""WITH s AS (SELECT id, regexp_replace(regexp_replace(replace(replace(replace(replace(replace(t, '年', '.'), '月', ''), '日', ''), '—', '-'), '－', '-'), '^任期[：:]?\\s*', ''),
  '"?文(化大)?革(命)?"?([初前]期)?', '1966', 'g') AS w FROM ({B.duck(TERM)}) x), r AS (SELECT id, w, regexp_extract_all(w, '\\d{{4}}[.\\d]*') AS ds FROM s)
SELECT id, coalesce(ds[1], '') AS start, CASE WHEN len(ds) = 0 THEN '' WHEN len(ds) = 1 OR ends_with(rtrim(w), '-') THEN '至今' ELSE ds[len(ds)] END AS "end" FROM r""")
def d6(spark, sf):
    return B.recipe(spark, sf, TERM).select("id", D.parse_term_list(c()).alias("x")).select("id", "x.*")


def _cleaned(x):
    s = S.strip(x)
    return (f"CASE WHEN {x} IN ('', '至今') THEN {x} WHEN regexp_matches(rtrim({s}, '.'), '^\\d{{4}}$') THEN concat(rtrim({s}, '.'), '.00') "
            f"WHEN regexp_matches({s}, '^\\d{{4}}\\.\\d{{1,2}}$') THEN concat(split_part({s}, '.', 1), '.', lpad(split_part({s}, '.', 2), 2, '0')) ELSE rtrim({s}, '.') END")


@query("d8_format_entry", f"""WITH x AS (SELECT id, coalesce(t, '') AS t FROM ({B.duck(DATE_TEXT)}) y), s AS (SELECT id, {_cleaned('t')} AS s, CASE WHEN id % 3 = 0 THEN '' ELSE {_cleaned('t')} END AS e FROM x)
SELECT id, concat('n', id, ', ', CASE WHEN s = '' THEN '?-?' ELSE concat(s, '-', CASE WHEN e = '' THEN '?' ELSE e END) END) AS entry FROM s""")
def d8(spark, sf):
    d = _dates(spark, sf)
    end = F.when(F.col("id") % 3 == 0, "").otherwise(c())
    return d.select("id", D.format_entry(F.concat(F.lit("n"), F.col("id").cast("string")), c(), end).alias("entry"))


RANKS3 = """SELECT o_orderkey AS id, CASE o_custkey % 4 WHEN 0 THEN '正厅级' WHEN 1 THEN ' 副厅级' WHEN 2 THEN '无' ELSE '' END AS r1,
  CASE o_orderkey % 5 WHEN 0 THEN '正科级' WHEN 1 THEN '副国级 ' WHEN 2 THEN '难以判断' WHEN 3 THEN '正处级' ELSE 'x' END AS r2 FROM {orders}"""


@query("d9_highest_rank", f"WITH s AS ({B.duck(RANKS3)}) SELECT id, {S.rank_name('least(' + S.rank_ord('trim(r1)') + ', ' + S.rank_ord('trim(r2)') + ')')} AS best, {S.rank_ord('trim(r1)')} AS o1 FROM s")
def d9(spark, sf):
    return B.recipe(spark, sf, RANKS3).select("id", T.highest_rank(F.array("r1", "r2")).alias("best"), T.rank_ord(F.col("r1")).alias("o1"))


EVAL_TEXT = """SELECT o_orderkey AS id, CASE o_orderkey % 8 WHEN 0 THEN '省委常委（其他)' WHEN 1 THEN '省委常委(其他)' WHEN 2 THEN ' 副省长（非常委)' WHEN 3 THEN '市委副书记（非市长)'
  WHEN 4 THEN NULL WHEN 5 THEN '省委副书记（省长)　' WHEN 6 THEN concat('x', CAST(o_custkey AS VARCHAR(9))) ELSE '市常委（其他）' END AS t FROM {orders}"""
_en = S.strip("coalesce(t, '')")
_en = f"regexp_replace({_en}, '（(其他|常委|非常委|省长|非省长|市长|非市长)\\)', '（\\1）', 'g')"


@query("d12_eval_norm", f"WITH d AS ({B.duck(EVAL_TEXT)}) SELECT id, CASE WHEN {_en} IN ('省委常委（其他）', '省委常委(其他)') THEN '省常委（其他）' ELSE {_en} END AS v FROM d")
def d12(spark, sf):
    return B.recipe(spark, sf, EVAL_TEXT).select("id", T.eval_norm(c()).alias("v"))


@query("d13_char_jaccard", """WITH s AS (SELECT p_partkey AS id, list_distinct(string_split(p_name, '')) AS a, list_distinct(string_split(p_type, '')) AS b FROM part)
SELECT id, CASE WHEN len(a) + len(b) = 0 THEN 1.0 ELSE CAST(len(list_intersect(a, b)) AS DOUBLE) / (len(a) + len(b) - len(list_intersect(a, b))) END AS j FROM s""")
def d13(spark, sf):
    return B.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), T.char_jaccard(F.col("p_name"), F.col("p_type")).alias("j"))


# ---- names of organisations and places

ORGS = """SELECT c_custkey AS id, CASE c_custkey % 12 WHEN 0 THEN '深圳市委' WHEN 1 THEN '中共浙江省委员会' WHEN 2 THEN concat('第', c_nationkey, '省人民政府')
  WHEN 3 THEN concat(' 第', c_nationkey, '市人民政府　办公厅') WHEN 4 THEN '中国人民政治协商会议浙江省委员会' WHEN 5 THEN '浙江省人民代表大会常务委员会'
  WHEN 6 THEN '全国人民代表大会' WHEN 7 THEN '广西壮族自治区人民政府' WHEN 8 THEN '临夏自治州委' WHEN 9 THEN concat('中共第', c_nationkey, '县委员会') WHEN 10 THEN '中国人民政治协商会议全国委员会'
  ELSE '' END AS org,
  CASE c_custkey % 11 WHEN 0 THEN '浙江' WHEN 1 THEN '贵州' WHEN 2 THEN '青海' WHEN 3 THEN '广州' WHEN 4 THEN '内蒙' WHEN 5 THEN '吉林市' WHEN 6 THEN ' 宁夏回族' WHEN 7 THEN ''
    WHEN 8 THEN '广西壮族自治区' WHEN 9 THEN concat('第', c_nationkey, '地') ELSE '新疆生产' END AS prov,
  CASE c_custkey % 9 WHEN 0 THEN '杭州' WHEN 1 THEN '深圳市' WHEN 2 THEN '哈尔滨道里' WHEN 3 THEN '' WHEN 4 THEN '延边自治州' WHEN 5 THEN concat('x', c_nationkey) WHEN 6 THEN '临夏县'
    WHEN 7 THEN NULL ELSE '阿里地区' END AS city FROM {customer}"""
OG = f"WITH s AS ({B.duck(ORGS)}) "


def _orgs(spark, sf):
    return B.recipe(spark, sf, ORGS)


@query("p9_norm_org", OG + f"SELECT id, {S.norm_org('org')} AS v FROM s")
def p9(spark, sf):
    return _orgs(spark, sf).select("id", T.norm_org(F.col("org")).alias("v"))


@query("p10_norm_prov", OG + f"SELECT id, {S.norm_prov('prov')} AS v FROM s")
def p10(spark, sf):
    return _orgs(spark, sf).select("id", T.norm_prov(F.col("prov")).alias("v"))


@query("p11_norm_city", OG + f"SELECT id, {S.norm_city('city')} AS v FROM s")
def p11(spark, sf):
    return _orgs(spark, sf).select("id", T.norm_city(F.col("city")).alias("v"))


def _short(x):
    for p in ["(壮族|回族|维吾尔)?自治区$", "特别行政区$", "省$", "[市州盟]$"]:
        x = f"regexp_replace({x}, '{p}', '')"
    return f"rtrim({x}, '地区')"


@query("p12_admin_short", OG + f"SELECT id, {_short('prov')} AS prov, {_short('city')} AS city, coalesce({S.one_of(_short('prov'), K.PROVINCE_SHORT)}, false) AS is_prov FROM s")
def p12(spark, sf):
    return _orgs(spark, sf).select("id", T.admin_short(F.col("prov")).alias("prov"), T.admin_short(F.col("city")).alias("city"),
                                   T.is_province(F.col("prov")).alias("is_prov"))


POSTS = """SELECT l_orderkey AS name, l_partkey AS k1, l_suppkey AS k2,
  CASE l_partkey % 14 WHEN 0 THEN '省长' WHEN 1 THEN '代省长' WHEN 2 THEN '副省长' WHEN 3 THEN '主席' WHEN 4 THEN '省委书记' WHEN 5 THEN '省委副书记、省长' WHEN 6 THEN '书记'
    WHEN 7 THEN '党组书记' WHEN 8 THEN '市长' WHEN 9 THEN '市委书记' WHEN 10 THEN '副市长' WHEN 11 THEN '' WHEN 12 THEN '常务副市长' ELSE '自治区党委书记' END AS position,
  CASE l_suppkey % 7 WHEN 0 THEN '浙江省政府' WHEN 1 THEN '浙江省委' WHEN 2 THEN '浙江省政协' WHEN 3 THEN '' WHEN 4 THEN '北京市委' WHEN 5 THEN '北京市政府' ELSE '广西区委' END AS unit,
  CASE l_linenumber % 3 WHEN 0 THEN '浙江省' WHEN 1 THEN '' ELSE NULL END AS loc FROM {lineitem}"""
BRK = "(^|[\\s\\x{3000}、，,])"


def _role_sql(role, short, municipal):
    u, l = "unit", "coalesce(loc, '')"
    hit = lambda p: f"regexp_matches(position, '{BRK}{p}')"
    no = lambda *w: f"NOT {S.any_word('position', list(w))}"
    if role == "governor":
        body = f"{no('副省长', '副主席', '常务副')} AND ({hit('代?省长')} OR ({hit('代?主席')} AND NOT {S.any_word('concat(unit, position)', ['政协', '人大'])})"
        body += (f" OR (NOT {hit('代?主席')} AND {no('副市长')} AND {hit('代?市长')}))" if municipal else ")")
    elif role == "secretary":
        body = f"{no('副书记')} AND ({hit('省委书记')} OR {hit('自治区党委书记')} OR ({hit('书记$')} AND {S.any_word(u, ['省委', '自治区党委'])})"
        body += (f" OR {hit('市委书记')} OR ({hit('书记$')} AND contains(unit, '市委')))" if municipal else ")")
    elif role == "mayor":
        body = f"{no('副市长', '常务副')} AND {hit('代?市长')}"
    else:
        body = f"{no('副书记', '副市委')} AND ({hit('市委书记')} OR ({hit('书记$')} AND contains(unit, '市委')))"
    return f"(position <> '' AND (concat({u}, {l}) = '' OR contains(concat({u}, {l}), '{short}')) AND {body})"


@query("p13_role_match", f"WITH s AS ({B.duck(POSTS)}) SELECT name, k1, k2, {_role_sql('governor', '浙江', False)} AS gov, {_role_sql('secretary', '浙江', False)} AS sec, "
       f"{_role_sql('governor', '北京', True)} AS gov_m, {_role_sql('secretary', '北京', True)} AS sec_m, {_role_sql('mayor', '北京', True)} AS mayor, {_role_sql('city_secretary', '北京', True)} AS city_sec FROM s")
def p13(spark, sf):
    s = B.recipe(spark, sf, POSTS)
    m = lambda t, r: T.role_match(F.col("position"), F.col("unit"), F.col("loc"), F.lit(t), r)
    return s.select("name", "k1", "k2", m("浙江省", "governor").alias("gov"), m("浙江省", "secretary").alias("sec"), m("北京市", "governor").alias("gov_m"),
                    m("北京市", "secretary").alias("sec_m"), m("北京市", "mayor").alias("mayor"), m("北京市", "city_secretary").alias("city_sec"))


@query("p28_p29_legacy_flags", f"""WITH s AS ({B.duck(POSTS)}) SELECT name, k1, k2,
  CASE WHEN {S.any_word('position', K.LEGACY_STUDY_WORDS)} THEN 1 WHEN {S.any_word('position', K.VICE_PROVINCIAL_WORDS)} THEN 0
    WHEN {S.any_word('unit', K.VICE_PROVINCIAL_CITIES)} AND {S.any_word('position', ['市长', '书记', '常委'])} THEN 0 ELSE 1 END AS bureau,
  CASE WHEN contains(position, '市长') AND NOT {S.any_word('position', ['副市长', '常务副', '第一副'])} AND {S.any_word('unit', ['北京', '市政府', '市人民政府'])} THEN 1 ELSE 0 END AS mayor_row,
  CASE WHEN contains(position, '委书记') AND {S.any_word('unit', ['北京', '市委'])} THEN 1 WHEN trim(position) = '书记' AND contains(unit, '市委') AND contains(unit, '北京') THEN 1 ELSE 0 END AS sec_row
FROM s""")
def p28(spark, sf):
    from twinledger.operators import legacy as L

    s = B.recipe(spark, sf, POSTS)
    return s.select("name", "k1", "k2", L.bureau_or_below(F.col("position"), F.col("unit"), F.lit("")).alias("bureau"),
                    L.mayor_row(F.col("position"), F.col("unit"), "北京").alias("mayor_row"), L.secretary_row(F.col("position"), F.col("unit"), "北京").alias("sec_row"))


# ---- biography texts

BIO = f"""WITH t AS ({B.duck(B.BIO_TEXT)}),
ls AS (SELECT name, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM t),
hd AS (SELECT *, regexp_matches({S.strip('line')}, '^===\\s*(.+?)\\s*===$') AS is_head FROM ls),
sec AS (SELECT *, count(*) FILTER (is_head) OVER (PARTITION BY name ORDER BY pos) AS g FROM hd),
ttl AS (SELECT name, g, max(CASE WHEN is_head THEN regexp_extract({S.strip('line')}, '^===\\s*(.+?)\\s*===$', 1) END) AS title,
  count(*) FILTER (NOT is_head) AS n, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT is_head) AS body FROM sec GROUP BY ALL),
sections AS MATERIALIZED (SELECT name, coalesce(title, '_header') AS section, arg_max(body, g) AS body FROM ttl WHERE n > 0 GROUP BY ALL),
career AS (SELECT t.name, coalesce((SELECT nullif(body, '') FROM sections s WHERE s.name = t.name AND section = '履历段落'), (SELECT body FROM sections s WHERE s.name = t.name AND section = '人物履历'), '') AS body FROM t),
cl0 AS (SELECT name, {S.strip('l')} AS line, p FROM (SELECT name, unnest(string_split(body, chr(10))) AS l, generate_subscripts(string_split(body, chr(10)), 1) AS p FROM career) x),
cl AS MATERIALIZED (SELECT *, {S.line_kind('line')} AS kind FROM cl0 WHERE line <> ''),
num AS MATERIALIZED (SELECT *, count(*) FILTER (kind = 'career') OVER (PARTITION BY name ORDER BY p) AS line_num FROM cl),
entries AS MATERIALIZED (SELECT name, CAST(line_num AS INTEGER) AS line_num, string_agg(line, '　' ORDER BY p) AS raw_text FROM num WHERE line_num > 0 AND kind <> 'honor' GROUP BY ALL),
ym AS MATERIALIZED (SELECT *, {S.start_part('raw_text', 'y')} AS y, {S.start_part('raw_text', 'm')} AS m, {S.has_end('raw_text')} AS ended FROM entries),
nxt AS (SELECT *, lead(y) OVER w AS ny, lead(m) OVER w AS nm FROM ym WINDOW w AS (PARTITION BY name ORDER BY line_num)),
lines AS MATERIALIZED (SELECT name, line_num, raw_text, CASE WHEN ended THEN NULL WHEN nm > 0 THEN concat(ny, '年', lpad(CAST(nm AS VARCHAR), 2, '0'), '月') WHEN ny IS NOT NULL THEN concat(ny, '年') END AS inferred_end, y, m, ended FROM nxt)
"""


def _pre(spark, sf):
    return Bio.preprocess(B.bio_texts(spark, sf))


@query("p1_section_split", BIO + "SELECT name, section, body FROM sections")
def p1(spark, sf):
    return Bio.split_sections(B.bio_texts(spark, sf), "name", "text")


@query("p2_line_kind", BIO + "SELECT name, p, kind FROM cl")
def p2(spark, sf):
    s = B.bio_texts(spark, sf).select("name", Bio.section_array(F.col("text")).alias("s"))
    body = F.coalesce(F.nullif(Bio.section_body(F.col("s"), "履历段落"), F.lit("")), Bio.section_body(F.col("s"), "人物履历"), F.lit(""))
    x = s.select("name", F.posexplode(F.split(body, "\n")).alias("p", "line"))
    return x.select("name", (F.col("p") + 1).cast("long").alias("p"), T.line_kind(F.col("line")).alias("kind")).filter("kind <> 'blank'")


@query("p3_w1_career_lines", BIO + "SELECT name, line_num, raw_text, inferred_end FROM lines")
def p3(spark, sf):
    return Bio.career_lines(_pre(spark, sf)).drop("undated")


@query("p3_extra_text", BIO + f"SELECT t.name, {S.strip('''coalesce(x.e, '')''')} AS extra_text, coalesce(n, 0) AS total_lines FROM t LEFT JOIN (SELECT name, "
       "string_agg(line, chr(10) ORDER BY p) FILTER (kind = 'honor' OR line_num = 0) AS e, CAST(max(line_num) AS INTEGER) AS n FROM num GROUP BY name) x ON x.name = t.name")
def p3x(spark, sf):
    return _pre(spark, sf).select("name", "extra_text", "total_lines")


@query("p4_p5_start_and_end", BIO + "SELECT name, line_num, y, m, ended FROM lines")
def p4(spark, sf):
    lines = Bio.career_lines(_pre(spark, sf)).select("name", "line_num", T.start_ym(F.col("raw_text")).alias("s"), T.has_end(F.col("raw_text")).alias("ended"))
    return lines.select("name", "line_num", "s.y", "s.m", "ended")


_in = S.strip("coalesce((SELECT body FROM sections s WHERE s.name = t.name AND section = '人物简介'), '')")
_ba = "coalesce((SELECT body FROM sections s WHERE s.name = t.name AND section = '基本信息'), '')"


@query("p6_bio_summary", BIO + f"SELECT name, {S.strip(f'''concat({_in}, CASE WHEN {_ba} <> '' THEN concat(chr(10), {S.strip(_ba)}) ELSE '' END)''')} AS bio_summary FROM t")
def p6(spark, sf):
    return _pre(spark, sf).select("name", "bio_summary")


_ren = "concat(printf('L%02d', line_num), ': ', raw_text, CASE WHEN inferred_end IS NOT NULL AND NOT ended THEN concat('  [至', inferred_end, '止]') ELSE '' END)"


@query("p7_render_lines", BIO + f"SELECT t.name, CAST(count(line_num) AS INTEGER) AS total_lines, coalesce(string_agg({_ren}, chr(10) ORDER BY line_num) FILTER (line_num IS NOT NULL), '') AS career_text FROM t LEFT JOIN lines USING (name) GROUP BY t.name")
def p7(spark, sf):
    return Bio.render_lines(_pre(spark, sf))


@query("p8_line_requests", BIO + f"SELECT t.name, CAST(count(line_num) AS INTEGER) AS total_lines, concat('官员：', t.name, '，浙江省省长', chr(10), chr(10), '=== 编号履历行（共', count(line_num), '行）===', chr(10), "
       f"coalesce(string_agg({_ren}, chr(10) ORDER BY line_num) FILTER (line_num IS NOT NULL), '')) AS request FROM t LEFT JOIN lines USING (name) GROUP BY t.name")
def p8a(spark, sf):
    return Q.line_requests(_pre(spark, sf), location="浙江省", role="省长")


_EPS = f"WITH a AS ({B.DUCK_A}) "


def _numbered(spark, sf):
    from twinledger.functions.ordered import ordinal

    return ordinal(B.episodes_a(spark, sf), ["name"], ["pos"], "seq", large=B.large_names(spark, sf))


@query("p8_class_requests", _EPS + f"""SELECT name, 0 AS part, count(*) AS n_episodes, concat('官员：', name, chr(10), chr(10), '=== Episodes (Step1 已固定) ===', chr(10), string_agg(concat('  #', pos, ': source_line=', source_line,
  '  起始=', start, '  终止=', "end", '  供职单位=', unit, '  职务=', position), chr(10) ORDER BY pos)) AS request, bool_or({S.any_word('unit', K.UNIVERSITY_WORDS)}) AS needs_university,
  bool_or({S.any_word('unit', K.ENTERPRISE_WORDS)}) AS needs_enterprise FROM a GROUP BY name""")
def p8b(spark, sf):
    return Q.episode_requests(_numbered(spark, sf), 2)


@query("p8_rank_requests_chunked", _EPS + """SELECT name, CAST((pos - 1) // 2 AS INTEGER) AS part, count(*) AS n_episodes, concat('以下是某官员的全部 ', count(*), ' 段职务经历（仅凭职务/单位名称判断级别）：', chr(10),
  string_agg(concat('  ', pos, '. 供职单位: ', unit, '  职务: ', position), chr(10) ORDER BY pos)) AS request FROM a GROUP BY name, (pos - 1) // 2""")
def p8c(spark, sf):
    return Q.episode_requests(_numbered(spark, sf), 3, max_episodes=2).drop("needs_university", "needs_enterprise")


def _dispute_sql() -> str:
    from twinledger.plans import q_reconcile as QR

    text = "concat('  ', field, ': LLM1=「', value_a, '」 LLM2=「', value_b, '」')"
    cols = ", ".join(f"max({text}) FILTER (field = '{f}') AS f_{f}" for f in K.EPISODE_FIELDS)
    names = ", ".join(f"f_{f}" for f in K.EPISODE_FIELDS)
    count = " + ".join(f"CAST(f_{f} IS NOT NULL AS INT)" for f in K.EPISODE_FIELDS)
    return QR.DISPUTES + f""", ln AS ({B.duck(B.LINES)}), g AS (SELECT name, source_line, unit, position, start, {cols} FROM disputes GROUP BY ALL)
SELECT g.name, source_line, unit, position, start, CAST({count} AS INTEGER) AS n_fields, concat('官员：', g.name, chr(10), chr(10), 'LLM1来源行：', printf('L%02d', source_line),
  CASE WHEN raw_text IS NOT NULL THEN concat(': ', raw_text) ELSE '' END, chr(10), 'LLM2来源行：（无）', chr(10), chr(10), '以下 ', {count}, ' 个字段存在争议：', chr(10), concat_ws(chr(10), {names})) AS request
FROM g LEFT JOIN ln ON ln.name = g.name AND ln.line_num = source_line"""


@query("p8_dispute_requests", _dispute_sql())
def p8d(spark, sf):
    from twinledger.plans import q_reconcile as QR

    return Q.dispute_requests(QR._disputes(spark, sf), B.lines(spark, sf))


@query("p30_keyword_flags", f"SELECT doc_id, {S.any_word('t', K.UNIVERSITY_WORDS)} AS needs_university, {S.any_word('t', K.ENTERPRISE_WORDS)} AS needs_enterprise FROM "
       "(SELECT doc_id, concat(replace(replace(text, 'The', '大学'), 'Le', '石油'), lang) AS t FROM documents) x")
def p30(spark, sf):
    d = B.recipe(spark, sf, "SELECT doc_id, concat(replace(replace(text, 'The', '大学'), 'Le', '石油'), lang) AS t FROM {documents}")
    return Bio.keyword_flags(d, "t").drop("t")


TAGGED = "SELECT doc_id, replace(replace(replace(text, 'The', '浙江'), 'Le', '省长'), 'On', '1995年') AS t FROM {documents}"


@query("p21_identity_check", f"SELECT doc_id, contains(t, '浙江') AND {S.any_word('t', K.ROLE_WORDS)} AS ok FROM ({B.duck(TAGGED)}) x")
def p21(spark, sf):
    return B.recipe(spark, sf, TAGGED).select("doc_id", Bio.identity_check(F.col("t"), province="浙江省").alias("ok"))


@query("p22_quality_score", f"""SELECT *, score >= 60 AS passes FROM (SELECT name, CAST(CASE WHEN contains(text, '=== 履历段落 ===') THEN 40 ELSE 0 END + CASE WHEN contains(text, '=== 人物简介 ===') THEN 20 ELSE 0 END
  + CASE WHEN contains(text, '=== 基本信息 ===') THEN 15 ELSE 0 END + least(25, 2 * len(regexp_extract_all(text, '\\d{{4}}[年.．]'))) AS INTEGER) AS score FROM ({B.duck(B.BIO_TEXT)}) t) s""")
def p22(spark, sf):
    return B.bio_texts(spark, sf).select("name", Bio.quality_score(F.col("text")).alias("score")).withColumn("passes", Bio.passes_quality(F.col("score")))


MINED = "SELECT doc_id, replace(replace(replace(replace(text, ' the ', '1995王小明'), ' le ', '李四书记'), ' und ', '2003年市长张三丰'), ' de ', '1980赵六') AS t FROM {documents}"


@query("p27_name_mining", f"""WITH l AS (SELECT doc_id, p, {S.strip('l')} AS l FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS p FROM ({B.duck(MINED)}) x) y),
k AS (SELECT doc_id, p, regexp_extract_all(l, '[\\x{{4e00}}-\\x{{9fff}}]{{2,4}}') AS ns FROM l WHERE TRY_CAST(regexp_extract(l, '(19|20)\\d\\d') AS INT) >= 1990),
n AS (SELECT doc_id, p, unnest(ns) AS name, generate_subscripts(ns, 1) AS i FROM k),
f AS (SELECT doc_id, name, min(p * 100000 + i) AS o FROM n WHERE NOT {S.one_of('name', K.NAME_STOP_WORDS)} GROUP BY ALL)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY o) AS INTEGER) AS ord, name FROM f""")
def p27(spark, sf):
    return Bio.name_mining(B.recipe(spark, sf, MINED), "doc_id", "t", 1990)
