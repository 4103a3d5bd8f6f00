"""Derivations of the library's input tables from the provided tables.

Row-level recipes are SQL text that Spark and DuckDB both accept, so the oracle starts from the same rows.  Positions
inside a key are one wide number per row on Spark (order is all they need) and ``row_number`` in the oracle.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from twinledger.functions.ordered import cut, has_large_key


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A provided table, read as it lies, or as ``written_once`` stored it."""
    if name in _written:
        return _written[name]
    return spark.read.parquet(f"{sf}/{name}.parquet")


def recipe(spark: SparkSession, sf: str, sql: str, **frames: DataFrame) -> DataFrame:
    """Run a row-level recipe whose table names are written ``{lineitem}``."""
    import string

    names = {f for _, f, _, _ in string.Formatter().parse(sql) if f}
    frames = {n: frames[n] if n in frames else table(spark, sf, n) for n in names}
    return spark.sql(sql, **frames)


def duck(sql: str) -> str:
    """The same recipe with plain table names."""
    return sql.replace("{", "").replace("}", "")


_SUPP_UNIT = (
    "CASE l_suppkey % 3 WHEN 0 THEN concat('第', l_suppkey, '省人民政府') "
    "WHEN 1 THEN concat('第', l_suppkey, '市委') ELSE concat('第', l_suppkey, '大学') END"
)
_M0 = "(year(l_shipdate) * 12 + month(l_shipdate) - 1)"
_Q = "CAST(l_quantity AS INT)"


def _ym(expr: str) -> str:
    return f"printf('%04d.%02d', CAST(floor(({expr}) / 12) AS INT), CAST(({expr}) % 12 + 1 AS INT))"


ORDER_COLS = ["k0", "k1", "k2"]
_KEYS = "CAST(l_linenumber AS BIGINT) AS k0, l_partkey AS k1, l_suppkey AS k2"

RAW_A = f"""SELECT l_orderkey AS name, CAST(l_linenumber AS BIGINT) AS source_line, {_KEYS},
  {_ym(_M0)} AS start_ym,
  CASE {_Q} WHEN 50 THEN '至今' WHEN 49 THEN '' WHEN 48 THEN 'unknown' ELSE {_ym(f"{_M0} + {_Q}")} END AS end_ym,
  {_SUPP_UNIT} AS unit,
  CASE l_returnflag WHEN 'A' THEN '省长' WHEN 'N' THEN '省委副书记' ELSE '书记' END AS position
FROM {{lineitem}}"""

_SH = "CASE l_suppkey % 8 WHEN 1 THEN 6 WHEN 2 THEN 18 WHEN 3 THEN 36 ELSE 0 END"
RAW_B = f"""SELECT l_orderkey AS name, CAST(l_linenumber AS BIGINT) AS source_line, {_KEYS},
  {_ym(f"{_M0} + {_SH}")} AS start_ym,
  CASE WHEN {_Q} = 50 AND l_partkey % 2 = 0 THEN '至今' WHEN {_Q} = 48 THEN 'none' ELSE {_ym(f"{_M0} + {_Q}")} END AS end_ym,
  CASE WHEN l_suppkey % 6 = 0 THEN concat('第', l_suppkey, '省政府')
       WHEN l_suppkey % 6 = 1 THEN concat('中共第', l_suppkey, '市委')
       WHEN l_suppkey % 7 = 3 THEN concat('新', {_SUPP_UNIT}) ELSE {_SUPP_UNIT} END AS unit,
  CASE WHEN l_suppkey % 5 = 0 THEN CASE l_linestatus WHEN 'O' THEN '主任' ELSE '市长' END
       ELSE CASE l_returnflag WHEN 'A' THEN '省长' WHEN 'N' THEN '省委副书记' ELSE '书记' END END AS position
FROM {{lineitem}} WHERE l_partkey % 17 <> 0 AND l_orderkey % 23 <> 0"""


def _episodes(spark: SparkSession, sf: str, raw: str) -> DataFrame:
    if "lineitem" in _written:
        rows = recipe(spark, sf, raw.replace("AS k2,", f"AS k2, {POS} AS pos,")).withColumnsRenamed({"start_ym": "start", "end_ym": "end"})
        return rows.withColumns({"line_pos": F.col("source_line"), "line_zero": F.col("source_line")})
    wide = (F.col("k0") * 100_000_000_000 + F.col("k1")).cast("decimal(20,0)") * F.lit(10**12).cast("decimal(13,0)")
    return recipe(spark, sf, raw).withColumnsRenamed({"start_ym": "start", "end_ym": "end"}).withColumns({
        "pos": (wide + F.col("k2").cast("decimal(13,0)")).cast("decimal(36,0)"),
        "line_pos": F.col("source_line"), "line_zero": F.col("source_line")})


def large_names(spark: SparkSession, sf: str) -> bool:
    """Whether one name owns so many rows that ordered work on it must be cut up.  Reads one column."""
    return has_large_key(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("name")), ["name"])


BUCKET_ROWS = 150_000
#: The columns that the episodes, lines and people are derived from.
_BY_NAME = {"lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"],
            "orders": ["o_orderkey", "o_custkey"]}
#: Of stored rows, their place among those of the name by the order columns: what the wide number says, but a plain number.
POS = "l_pos"
_written: dict[str, DataFrame] = {}
_buckets = 0


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    """The rows as a stored table in buckets by ``key``.  The key is renamed back on reading: a union keeps the
    partitioning of such a column, but not that of a table's own."""
    name = f"twinledger_{uuid.uuid4().hex}"
    df.withColumnRenamed(key, f"_{key}").write.format("parquet").bucketBy(_buckets, f"_{key}").saveAsTable(name)
    return df.sparkSession.table(name).withColumnRenamed(f"_{key}", key)


def stored(df: DataFrame) -> DataFrame:
    """A step's result as a stored table: in buckets by name inside ``written_once``, else a checkpoint."""
    return _bucketed(df, "name") if _written else cut(df)


def _with_pos(lineitem: DataFrame) -> DataFrame:
    """Equal rows share a place, and a row without one of the order columns has none, as with the wide number.  Such rows
    are not put in any order, so that they stay as they came."""
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    known = F.col(order[0]).isNotNull() & F.col(order[1]).isNotNull() & F.col(order[2]).isNotNull()
    w = W.partitionBy("l_orderkey").orderBy(*[F.when(known, F.col(c)) for c in order])
    return lineitem.withColumn(POS, F.when(known, F.dense_rank().over(w)).cast("long"))


@contextmanager
def written_once(spark: SparkSession, sf: str, large: bool, names: tuple = tuple(_BY_NAME)):
    """The given tables as tables in buckets by name, for queries that take them many times.

    All that is derived from them by name, line or row, windows, aggregates, unions and joins by name, then needs no
    further exchange.  If one name is so large that ordered work on it is cut up, nothing is stored here.
    """
    global _buckets
    if large:
        yield False
        return
    rows = table(spark, sf, "lineitem").count()
    _buckets = max(1, -(-rows // BUCKET_ROWS), min(spark.sparkContext.defaultParallelism, rows // 20_000))
    try:
        tables = {}
        for t in names:
            key = _BY_NAME[t][0]
            rows = table(spark, sf, t).select(*_BY_NAME[t]).repartition(_buckets, key)
            tables[t] = _bucketed(_with_pos(rows) if t == "lineitem" else rows, key)
        _written.update(tables)
        yield True
    finally:
        _written.clear()


def episodes_a(spark: SparkSession, sf: str) -> DataFrame:
    return _episodes(spark, sf, RAW_A)


def episodes_b(spark: SparkSession, sf: str) -> DataFrame:
    return _episodes(spark, sf, RAW_B)


def _positions(sql: str) -> str:
    return (f"SELECT name, source_line, k1, k2, row_number() OVER (PARTITION BY name ORDER BY {', '.join(ORDER_COLS)}) AS pos, "
            f'start_ym AS start, end_ym AS "end", unit, position FROM ({duck(sql)}) r')


DUCK_A = _positions(RAW_A)
DUCK_B = _positions(RAW_B)
EPISODES_WITH = f"WITH a AS MATERIALIZED ({DUCK_A}),\nb AS MATERIALIZED ({DUCK_B})"


# ---- classifications and ranks per (name, episode_idx); duplicates of an index occur, the last counts

CLASS_A = """SELECT name, source_line AS episode_idx, pos, k1, k2,
  CASE k1 % 6 WHEN 0 THEN '地方党委' WHEN 1 THEN '地方政府' WHEN 2 THEN '国务院组成部门' WHEN 3 THEN '教育部直属高校'
    WHEN 4 THEN '' ELSE '其他' END AS org_tag,
  CASE k2 % 7 WHEN 0 THEN '省长' WHEN 1 THEN '省委书记' WHEN 2 THEN '学习进修' WHEN 3 THEN '省委常委（其他)'
    WHEN 4 THEN '学校' WHEN 5 THEN '无' ELSE '副省长（常委）' END AS flag,
  CASE k1 % 8 WHEN 0 THEN '浙江' WHEN 1 THEN '广东省' WHEN 2 THEN '贵州' WHEN 3 THEN '青海' WHEN 4 THEN ''
    WHEN 5 THEN '吉林市' WHEN 6 THEN '内蒙' ELSE '第三地' END AS prov,
  CASE k2 % 6 WHEN 0 THEN '杭州' WHEN 1 THEN '深圳市' WHEN 2 THEN '' WHEN 3 THEN '宁波' WHEN 4 THEN '广州天河' ELSE '安吉县' END AS city,
  CASE k1 % 2 WHEN 0 THEN '中央' ELSE '地方' END AS central
FROM {a}"""
CLASS_B = """SELECT name, episode_idx, pos, k1, k2,
  CASE WHEN k1 % 7 = 0 THEN '其他' ELSE org_tag END AS org_tag, CASE WHEN k2 % 11 = 0 THEN '' ELSE flag END AS flag,
  CASE WHEN k1 % 9 = 0 THEN '北京' ELSE prov END AS prov, city,
  CASE WHEN k2 % 10 = 0 THEN '中央' ELSE central END AS central
FROM {class_a} WHERE k1 % 13 <> 0 AND name % 19 <> 0"""
RANK_A = """SELECT name, source_line AS episode_idx, pos, k1, k2,
  CASE k1 % 9 WHEN 0 THEN '副国级' WHEN 1 THEN '正部级' WHEN 2 THEN '副部级' WHEN 3 THEN '正厅级' WHEN 4 THEN '副厅级'
    WHEN 5 THEN '正处级' WHEN 6 THEN '难以判断' WHEN 7 THEN '无' ELSE '' END AS rank
FROM {a}"""
RANK_B = """SELECT name, episode_idx, pos, k1, k2, CASE WHEN k2 % 6 = 0 THEN '副国级' WHEN k2 % 6 = 1 THEN '正处级' ELSE rank END AS rank
FROM {rank_a} WHERE k1 % 17 <> 0"""
LINES = """SELECT l_orderkey AS name, CAST(l_linenumber AS BIGINT) AS line_num, concat('post ', min(l_partkey)) AS raw_text
FROM {lineitem} WHERE l_orderkey % 10 <> 3 GROUP BY l_orderkey, l_linenumber"""

def _last(sql: str) -> str:
    return f"SELECT * FROM ({sql}) t QUALIFY row_number() OVER (PARTITION BY name, episode_idx ORDER BY pos DESC) = 1"


CLASS_WITH = (f"WITH a AS MATERIALIZED ({DUCK_A}),\nclass_all AS MATERIALIZED ({duck(CLASS_A)}),\n"
              f"class_b AS MATERIALIZED ({_last(duck(CLASS_B).replace('class_a', 'class_all'))}),\nclass_a AS MATERIALIZED ({_last('SELECT * FROM class_all')})")
RANK_WITH = (f"WITH a AS MATERIALIZED ({DUCK_A}),\nrank_all AS MATERIALIZED ({duck(RANK_A)}),\n"
             f"rank_b AS MATERIALIZED ({_last(duck(RANK_B).replace('rank_a', 'rank_all'))}),\nrank_a AS MATERIALIZED ({_last('SELECT * FROM rank_all')})")


def classes_a(spark, sf):
    return recipe(spark, sf, CLASS_A, a=episodes_a(spark, sf))


def classes_b(spark, sf):
    return recipe(spark, sf, CLASS_B, class_a=classes_a(spark, sf))


def ranks_a(spark, sf):
    return recipe(spark, sf, RANK_A, a=episodes_a(spark, sf))


def ranks_b(spark, sf):
    return recipe(spark, sf, RANK_B, rank_a=ranks_a(spark, sf))


def lines(spark, sf):
    return recipe(spark, sf, LINES)


# ---- person records

PERSON_A = """SELECT o_orderkey AS name, CAST(1940 + o_custkey % 30 AS STRING) AS birth_year,
  concat('第', o_custkey % 31, '省') AS origin, concat('第', o_custkey % 97, '市') AS origin_city,
  CAST(o_orderkey % 2 AS STRING) AS minority, CASE WHEN o_orderkey % 12 = 5 THEN NULL ELSE CAST(o_custkey % 2 AS STRING) END AS female,
  CAST(o_orderkey % 3 AS STRING) AS bachelor,
  CASE WHEN o_orderkey % 6 = 5 THEN '' ELSE CAST(o_orderkey % 6 - 1 AS STRING) END AS promo_gov,
  CAST(o_custkey % 5 - 1 AS STRING) AS promo_sec,
  CASE WHEN o_orderkey % 14 = 3 THEN NULL ELSE CAST(o_orderkey % 2 AS STRING) END AS local_promo,
  CAST(o_custkey % 3 - 1 AS STRING) AS local_study,
  concat('g', o_orderkey % 4) AS promo_gov_reason, concat('s', o_orderkey % 5) AS promo_sec_reason,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE 'p' END AS local_promo_reason, 'q' AS local_study_reason,
  CASE o_orderkey % 10 WHEN 0 THEN '是' WHEN 1 THEN '' ELSE '否' END AS fell,
  CASE WHEN o_orderkey % 10 = 0 THEN concat('reason ', o_custkey) ELSE '' END AS fell_reason
FROM {orders}"""
PERSON_B = """SELECT name, CASE WHEN name % 9 = 0 THEN '1939' ELSE birth_year END AS birth_year,
  CASE WHEN name % 9 = 1 THEN '别处' ELSE origin END AS origin, origin_city,
  CASE WHEN name % 9 = 2 THEN '1' ELSE minority END AS minority, female,
  CASE WHEN name % 9 = 3 THEN '9' ELSE bachelor END AS bachelor,
  CASE WHEN name % 9 = 4 THEN '1' ELSE promo_gov END AS promo_gov,
  CASE WHEN name % 9 = 5 THEN NULL ELSE promo_sec END AS promo_sec,
  CASE WHEN name % 9 = 6 THEN '0' ELSE local_promo END AS local_promo,
  CASE WHEN name % 9 < 3 THEN '1' ELSE local_study END AS local_study,
  promo_gov_reason, 'other' AS promo_sec_reason, local_promo_reason, local_study_reason,
  CASE WHEN name % 9 = 7 THEN '是' ELSE fell END AS fell, fell_reason
FROM {person_a} WHERE name % 21 <> 0"""
PERSON_WITH = f"WITH person_a AS MATERIALIZED ({duck(PERSON_A)}),\nperson_b AS MATERIALIZED ({duck(PERSON_B)})".replace(
    "AS STRING)", "AS VARCHAR)")


def people_a(spark, sf):
    return recipe(spark, sf, PERSON_A)


def people_b(spark, sf):
    return recipe(spark, sf, PERSON_B, person_a=people_a(spark, sf))


# ---- decisions

def verdict_sql(code: str, value: str) -> str:
    """Columns of a decision from an integer code."""
    return f"""CASE ({code}) % 5 WHEN 0 THEN '采纳LLM1' WHEN 1 THEN '采纳LLM2' WHEN 2 THEN '自行修正' WHEN 3 THEN '两者均存疑'
    ELSE '自行修正' END AS verdict,
  CASE ({code}) % 5 WHEN 2 THEN {value} WHEN 4 THEN CASE ({code}) % 3 WHEN 0 THEN concat({value}, '；', 'x') WHEN 1 THEN '需拆分' ELSE {value} END
    ELSE '' END AS correct_value,
  CASE ({code}) % 11 WHEN 0 THEN '' WHEN 1 THEN 'high' ELSE CAST((({code}) * 7) % 101 AS VARCHAR(9)) END AS confidence,
  concat('r', ({code}) % 13) AS reason, CASE WHEN ({code}) % 29 = 0 THEN 'blocked' ELSE 'm1' END AS judge_model"""


FIELD_NO = ("CASE field WHEN 'start' THEN 0 WHEN 'end' THEN 1 WHEN 'unit' THEN 2 WHEN 'position' THEN 3 ELSE 4 END")
FIELD_DECISIONS = f"""SELECT name, source_line, unit, position, start, field,
  source_line * 1000000 + rn * 10 + {FIELD_NO} AS pos,
  {verdict_sql(f"name * 31 + source_line + {FIELD_NO}", "concat('fix ', source_line)")}
FROM {{disputes}} WHERE name % 4 <> 0"""
GROUP_DECISIONS = """SELECT name, source_line, CASE WHEN name % 2 = 0 THEN 'LLM1' ELSE 'LLM2' END AS adopt,
  name % 3 = 0 AS has_episode, CASE WHEN name % 9 = 0 THEN source_line + 1 END AS own_line, source_line AS pos,
  CAST((name * 7 + source_line) % 101 AS VARCHAR(9)) AS confidence, concat('g', source_line) AS reason,
  CASE WHEN name % 29 = 0 THEN 'blocked' ELSE 'm1' END AS judge_model
FROM {all_lines} WHERE (name + source_line) % 6 = 0"""
CLASS_NO = "CASE field WHEN 'org_tag' THEN 0 WHEN 'flag' THEN 1 WHEN 'prov' THEN 2 WHEN 'city' THEN 3 ELSE 4 END"
CLASS_DECISIONS = f"""SELECT name, episode_idx, field, episode_idx * 10 + {CLASS_NO} AS pos,
  {verdict_sql(f"name * 31 + episode_idx + {CLASS_NO}", "concat('c', episode_idx)")}
FROM {{diffs}} WHERE name % 4 <> 1"""
RANK_DECISIONS = f"""SELECT name, episode_idx, episode_idx AS pos,
  {verdict_sql("name * 31 + episode_idx", "CASE WHEN episode_idx % 2 = 0 THEN '正国级' ELSE '副科级' END")}
FROM {{diffs}} WHERE name % 4 <> 2"""
LABEL_NO = ("CASE field WHEN 'promo_gov' THEN 0 WHEN 'promo_sec' THEN 1 WHEN 'local_promo' THEN 2 WHEN 'local_study' THEN 3 ELSE 4 END")
LABEL_DECISIONS = f"""SELECT name, field, {LABEL_NO} AS pos,
  {verdict_sql(f"name * 31 + {LABEL_NO}", "CASE WHEN name % 2 = 0 THEN '02' ELSE 'text' END")}
FROM {{diffs}} WHERE name % 4 <> 3"""


def field_decisions(spark, sf, disputes):
    return recipe(spark, sf, FIELD_DECISIONS, disputes=disputes)


def group_decisions(spark, sf, a, b):
    all_lines = a.select(F.col("name").alias("name"), "source_line").unionByName(b.select("name", "source_line")).distinct()
    d = recipe(spark, sf, GROUP_DECISIONS, all_lines=all_lines)
    line = F.col("source_line").cast("string")
    ep = F.struct(F.col("own_line").cast("string").alias("source_line"), F.lit("1990.01").alias("start"), F.lit("1991.02").alias("end"),
                  F.concat(F.lit("判定单位"), line).alias("unit"), F.lit("主席").alias("position"))
    return d.withColumn("episodes", F.when(F.col("has_episode"), F.array(ep))).drop("has_episode", "own_line")


# ---- sectioned biography texts, one per document

def _replaced(text: str, rules: list[tuple[str, str]]) -> str:
    for letter, line in rules:
        text = f"replace({text}, '. {letter}', concat(chr(10), {line}, '{letter}'))"
    return text


_Y, _Y2, _M = "CAST(1950 + doc_id % 60 AS INT)", "CAST(1955 + doc_id % 60 AS INT)", "CAST(doc_id % 14 AS INT)"
BIO_TEXT = f"""SELECT doc_id AS name, concat('top ', lang, chr(10),
  '=== 人物简介 ===', chr(10), ' intro ', source, chr(10), '===  基本信息 ===', chr(10), 'born in ', lang, chr(10),
  CASE WHEN doc_id % 5 = 0 THEN concat('=== 人物简介 ===', chr(10), 'second intro', chr(10)) ELSE '' END,
  CASE WHEN doc_id % 6 = 0 THEN concat('=== 空 ===', chr(10)) ELSE '' END,
  CASE WHEN doc_id % 7 = 0 THEN '=== 人物履历 ===' ELSE '=== 履历段落 ===' END, chr(10),
  {_replaced("text", [
      ("A", f"printf('%04d.%02d-%04d.%02d ', {_Y}, {_M}, {_Y2}, {_M})"),
      ("E", f"printf('%04d年%d月', {_Y}, {_M})"),
      ("I", f"printf('%04d.%d— ', {_Y}, {_M})"),
      ("O", "'中共十届委员 '"),
      ("L", f"printf('%04d年至%04d年', {_Y}, {_Y2})"),
      ("D", f"printf('从%04d年底 ', {_Y})"),
      ("T", f"printf('%04d.%02d.11，', {_Y}, {_M})"),
      ("W", f"printf('%04d～ ', {_Y})"),
      ("C", f"printf('%04d月%02d月，', {_Y}, {_M})"),
      ("B", "concat('　=== 附录 ===  ', chr(10))"),
      ("R", "'　　plain '"),
  ])}) AS text FROM {{documents}}"""


def bio_texts(spark, sf):
    return recipe(spark, sf, BIO_TEXT)


# ---- rosters: one small file per forty customers

ROSTER_LINE = """SELECT CAST(floor(c_custkey / 40) AS BIGINT) AS file, c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS sec,
  concat(' 官', CAST(c_custkey % 17 AS VARCHAR(9)), CASE c_custkey % 8 WHEN 1 THEN '（代）' WHEN 2 THEN '（代理）' ELSE '' END, ', ',
    CASE c_custkey % 6 WHEN 0 THEN printf('%04d.%02d', CAST(1980 + c_custkey % 40 AS INT), CAST(c_custkey % 12 + 1 AS INT))
      WHEN 1 THEN printf('%04d.%d', CAST(1980 + c_custkey % 40 AS INT), CAST(c_custkey % 9 + 1 AS INT))
      WHEN 2 THEN printf('%04d', CAST(1980 + c_custkey % 40 AS INT)) ELSE printf('%04d.00', CAST(1980 + c_custkey % 40 AS INT)) END,
    CASE c_custkey % 5 WHEN 0 THEN '-至今' WHEN 1 THEN '-现任' WHEN 2 THEN '' WHEN 3 THEN printf('-%04d.%02d ', CAST(1985 + c_custkey % 40 AS INT), CAST(c_custkey % 12 + 1 AS INT))
      ELSE printf('- %04d', CAST(1986 + c_custkey % 40 AS INT)) END) AS line
FROM {customer}"""


def roster_texts(spark, sf):
    """(file, text); a file never has more than forty entries, so the text is bounded."""
    r = recipe(spark, sf, ROSTER_LINE)
    g = r.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("sec", "k", "line"))).alias("e"))

    def part(sec: int):
        return F.array_join(F.transform(F.filter("e", lambda x: x["sec"] == sec), lambda x: x["line"]), "\n")

    fid = F.col("file").cast("string")
    head = F.concat(F.lit("# 名单\n\n省份："), F.lit("第"), fid, F.lit("省\n"),
                    F.when(F.col("file") % 2 == 0, "起始年份：1990\n").otherwise(""), F.lit("stray, 1990.01-1991.01\n"))
    gov = F.when(F.col("file") % 3 == 0, "[主席]").otherwise("[省长]")
    sec = F.when(F.col("file") % 3 == 0, "[自治区党委书记]").when(F.col("file") % 3 == 1, "[省委书记]").otherwise("[书记]")
    return g.select("file", F.concat(head, gov, F.lit("\n"), part(0), F.lit("\n\n"), sec, F.lit("\n"), part(1), F.lit("\n")).alias("text"))


# ---- tenures for the panels

TENURES = """SELECT c_nationkey AS unit, c_custkey AS holder, CASE WHEN c_custkey % 2 = 0 THEN 'governor' ELSE 'secretary' END AS role,
  c_custkey AS ord, CAST(year(min(o_orderdate)) AS INT) AS sy,
  CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE CAST(month(min(o_orderdate)) AS INT) END AS sm,
  CASE WHEN c_custkey % 7 = 1 THEN 9999 ELSE CAST(year(max(o_orderdate)) AS INT) END AS ey,
  CASE WHEN c_custkey % 7 = 1 THEN 12 WHEN c_custkey % 10 = 5 THEN 0 ELSE CAST(month(max(o_orderdate)) AS INT) END AS em
FROM {customer} JOIN {orders} ON o_custkey = c_custkey GROUP BY c_nationkey, c_custkey"""


def tenures(spark, sf):
    return recipe(spark, sf, TENURES)
