"""Scans: files or text columns to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from twinledger import constants as K
from twinledger.functions import dates as D
from twinledger.functions.dates import strip
from twinledger.functions.text import let

# every leaf is text: one number written as text would otherwise null the whole array
EPISODE = "struct<source_line:string,start:string,end:string,unit:string,position:string>"
LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

RESPONSE_SCHEMAS = {
    "step1": f"struct<episodes:array<{EPISODE}>>",
    "step2": "struct<classifications:array<struct<episode_idx:string,org_tag:string,flag:string,prov:string,city:string,central:string>>>",
    "step3": "struct<ranks:array<struct<episode_idx:string,final_rank:string,reasoning_chain:string>>>",
    "step4": "struct<raw_bio:map<string,string>,labels:map<string,string>>",
}
REQUIRED_LABELS = ["升迁_省长", "升迁_省委书记", "本省提拔", "本省提拔依据", "本省学习", "本省学习依据"]
# fixed values: field names inside the stored JSON
JSON_NAMES = {"start": "起始时间", "end": "终止时间", "unit": "供职单位", "position": "职务", "org_tag": "组织标签",
              "flag": "标志位", "prov": "任职地（省）", "city": "任职地（市）", "central": "中央/地方"}


# ---- rosters

def parse_rosters(files: DataFrame, file: str = "file", text: str = "text", strict: bool = False) -> DataFrame:
    """One row per entry of each roster text.

    A roster is one text cell; its lines are walked inside the row.  ``strict`` is the panel reading: only
    ``YYYY.MM`` or the open word on both sides, the acting mark stays in the name, fewer headers.
    """
    heads = K.STRICT_ROSTER_HEADERS if strict else K.ROSTER_HEADERS
    lines = F.filter(F.transform(F.split(F.col(text), LINE_BREAKS), lambda x: strip(x)), lambda x: (x != "") & ~x.startswith("#"))
    is_head = lambda x: x.isin(list(heads))
    bare = lambda h: F.regexp_replace(h, r"^\[|\]$", "")

    def meta(l: Column, name: str) -> Column:
        row = F.try_element_at(F.filter(l, lambda x: ~x.startswith("[") & (strip(F.substring_index(x, "：", 1)) == name)
                                        & F.contains(x, F.lit("："))), F.lit(-1))
        return strip(F.substr(row, F.locate("：", row) + F.lit(1)))

    def title(l: Column, role: str) -> Column:
        return bare(F.try_element_at(F.filter(l, lambda x: x.isin([h for h, r in heads.items() if r == role])), F.lit(-1)))

    def walked(l: Column, at: Column) -> Column:
        """The lines that stand below a header, each with its position and that header."""
        def one(x: Column, i: Column) -> Column:
            head = F.try_element_at(F.filter(at, lambda p: p < i), F.lit(-1))
            return F.struct(i.alias("_i"), x.alias("_x"), F.try_element_at(l, head + 1).alias("_section"))

        return F.filter(F.transform(l, one), lambda e: e["_section"].isNotNull() & ~is_head(e["_x"]))

    def roster(l: Column) -> Column:
        at = F.filter(F.transform(l, lambda x, i: F.when(is_head(x), i)), lambda p: p.isNotNull())
        return F.struct(
            meta(l, "省份").alias("province"), meta(l, "起始年份").try_cast("int").alias("start_year"),
            F.coalesce(title(l, "governor"), F.lit("省长")).alias("gov_title"),
            F.coalesce(title(l, "secretary"), F.lit("省委书记")).alias("sec_title"), let(at, lambda h: walked(l, h)).alias("_e"))

    m = files.select(file, F.inline(F.array(let(lines, roster))))
    e = m.select(file, "province", "start_year", "gov_title", "sec_title", F.inline("_e"))
    section = F.col("_section")
    role = F.create_map(*[x for h, r in heads.items() for x in (F.lit(h), F.lit(r))])
    x = F.col("_x")
    comma = F.locate(",", x)
    e = e.withColumns({"role_kind": F.element_at(role, section), "_n": strip(F.substring_index(x, ",", 1)),
                       "_d": strip(F.substr(x, comma + F.lit(1)))}).filter(comma > 0)
    if strict:
        one = r"(\d{4}\.\d{2}|至今)"
        e = e.filter(~x.startswith("省份") & ~x.startswith("起始") & F.col("_d").rlike(f"^{one}-{one}$"))
        name, acting = F.col("_n"), F.lit(False)
        start, end = F.regexp_extract("_d", f"^{one}-{one}$", 1), F.regexp_extract("_d", f"^{one}-{one}$", 2)
    else:
        e = e.filter(~F.contains(x, F.lit("：")) | x.startswith("["))
        acting = F.contains(F.col("_n"), F.lit("（代）")) | F.contains(F.col("_n"), F.lit("（代理）"))
        name = strip(F.regexp_replace("_n", "（代）|（代理）", ""))
        dash = F.locate("-", F.col("_d"))
        start = D.norm_date(F.when(dash > 0, F.substring_index("_d", "-", 1)).otherwise(F.col("_d")))
        end = F.when(dash > 0, D.norm_date(F.substr(F.col("_d"), dash + F.lit(1)))).otherwise(K.OPEN_END)
    return e.select(file, "province", "start_year", "gov_title", "sec_title", "role_kind", F.col("_i").alias("ord"),
                    name.alias("name"), acting.alias("acting"), start.alias("start"), end.alias("end"))


def _whole_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("text"))


def read_rosters(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    return parse_rosters(_whole_texts(spark, path), strict=strict)


def biographies_of(files: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """(name, text) of whole files; the name is in the file's, ``{name}_biography.txt``, others are left out."""
    name = F.regexp_extract(F.url_decode(file), r"([^/]+)_biography\.txt$", 1)
    return files.select(name.alias("name"), F.col(text).alias("text")).filter("name <> ''")


def read_biographies(spark: SparkSession, directory: str) -> DataFrame:
    """(name, text) from ``{name}_biography.txt`` files."""
    return biographies_of(_whole_texts(spark, f"{directory}/*_biography.txt"))


# ---- stored results

def renamed_json(text: Column) -> Column:
    """Stored JSON with the library's field names."""
    for en, cn in JSON_NAMES.items():
        text = F.replace(text, F.lit(f'"{cn}"'), F.lit(f'"{en}"'))
    return text


def parse_results(records: DataFrame, body: str, kind: str, pos: str = "pos") -> DataFrame:
    """(name, result) from JSON records carrying ``_meta.name``.

    Records that are no objects or have no name are left out; of equal names the last by ``pos`` counts.
    """
    parsed = records.select(
        F.get_json_object(F.col(body), "$._meta.name").alias("name"), F.col(pos).alias("_p"),
        F.from_json(renamed_json(F.col(body)), RESPONSE_SCHEMAS[kind]).alias("result"))
    named = parsed.filter(F.coalesce("name", F.lit("")) != "")
    return named.groupBy("name").agg(F.max_by("result", "_p").alias("result"))


def read_results(spark: SparkSession, path: str, kind: str, force: bool = False) -> DataFrame:
    """A stored result file: a JSON list, or JSON lines, of records.  ``force`` reads nothing."""
    raw = spark.read.text(path, wholetext=True).select(F.col("value"), F.input_file_name().alias("_f"))
    if force:
        raw = raw.limit(0)
    items = F.coalesce(F.from_json("value", "array<string>"), F.array(F.lit(None).cast("string")))
    rows = raw.select("_f", F.posexplode(items).alias("_i", "body")).withColumn("pos", F.struct("_f", "_i"))
    return parse_results(rows.filter("body is not null"), "body", kind)


def explode_result(results: DataFrame, kind: str) -> DataFrame:
    """Result arrays to rows with ``pos`` (0-based) and numbers cast where they are numbers."""
    field = {"step1": "episodes", "step2": "classifications", "step3": "ranks"}[kind]
    e = results.select("name", F.posexplode(F.col(f"result.{field}")).alias("pos", "e")).select("name", "pos", "e.*")
    num = "source_line" if kind == "step1" else "episode_idx"
    return e.withColumn(num, D.to_int(F.col(num)))


def parse_decisions(objects: DataFrame, body: str, keep: list[str] = ()) -> DataFrame:
    """Rows of a flat decision object whose keys join their parts with two pipes."""
    value = ("struct<verdict:string,correct_value:string,confidence:string,reason:string,judge_model:string,adopt:string,"
             f"episodes:array<{EPISODE}>>")
    m = objects.select(*keep, F.explode(F.from_json(renamed_json(F.col(body)), f"map<string,{value}>")).alias("k", "v"))
    p = F.split("k", r"\|\|")
    at = lambda i: F.try_element_at(p, F.lit(i))
    kind = at(2)
    line = F.when(kind == "sl_group", at(3)).when(kind == "ep_batch", F.regexp_replace(at(3), "^sl", ""))
    return m.select(
        *keep, at(1).alias("name"), kind.alias("kind"), D.to_int(line).alias("source_line"),
        D.to_int(F.when(kind.isin("classify", "rank"), at(3))).alias("episode_idx"),
        F.when(kind == "ep_batch", at(4)).alias("unit"), F.when(kind == "ep_batch", at(5)).alias("position"),
        F.when(kind == "ep_batch", at(6)).alias("start"),
        F.when(kind == "ep_batch", at(7)).when(kind == "classify", at(4)).when(kind == "label", at(3)).alias("field"), "v.*")


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    return parse_decisions(spark.read.text(path, wholetext=True), "value")


def parse_source_lists(objects: DataFrame, body: str, keep: list[str] = ()) -> DataFrame:
    """(province, role_kind, ord, name, term_raw, summary) from lists keyed by province."""
    entry = "array<struct<name:string,term:string,summary:string>>"
    m = objects.select(*keep, F.explode(F.from_json(F.col(body), f"map<string,struct<governor_list:{entry},secretary_list:{entry}>>")).alias("province", "v"))
    both = F.array(F.struct(F.lit("governor").alias("role_kind"), F.col("v.governor_list").alias("l")),
                   F.struct(F.lit("secretary").alias("role_kind"), F.col("v.secretary_list").alias("l")))
    return m.select(*keep, "province", F.explode(both).alias("b")).select(
        *keep, "province", "b.role_kind", F.posexplode("b.l").alias("ord", "e")).select(
        *keep, "province", "role_kind", "ord", F.col("e.name").alias("name"), F.coalesce("e.term", F.lit("")).alias("term_raw"),
        F.coalesce("e.summary", F.lit("")).alias("summary"))


# ---- gold

def clean_cell(c: Column) -> Column:
    s = strip(c)
    return F.when(s.isin("", "None", "nan", "NaN"), None).otherwise(s)


def gold_person(rows: DataFrame, fields: list[str], order: str = "rowno") -> DataFrame:
    """Person fields from the first row of each name; numeric ones as canonical integers, else as text."""
    def value(f: str) -> Column:
        v = clean_cell(F.col(f))
        return F.coalesce(v.try_cast("double").cast("int").cast("string"), v) if f in K.GOLD_NUMERIC else v

    return rows.groupBy("name").agg(F.min_by(F.struct(*[value(f).alias(f) for f in fields]), F.col(order)).alias("p")).select("name", "p.*")


def gold_episodes(rows: DataFrame, fields: list[str], position: str = "position_in_name") -> DataFrame:
    """Episode rows; a missing number becomes the position inside the name."""
    return rows.select("name", F.coalesce(D.to_int(F.col("seq")), F.col(position)).alias("episode_idx"),
                       *[clean_cell(F.col(f)).alias(f) for f in fields])


def gold_step1_view(gold: DataFrame) -> DataFrame:
    """Gold as step-1 input: the index also serves as line, missing values become empty."""
    return gold.select("name", "episode_idx", F.col("episode_idx").alias("source_line"),
                       *[F.coalesce(c, F.lit("")).alias(c) for c in K.EPISODE_FIELDS])


# ---- extractor responses

def parse_responses(df: DataFrame, response: str, kind: str) -> DataFrame:
    """Adds ``parsed`` and ``status`` (ok, parse_error, schema_error).

    A surrounding code fence is removed; if the rest does not parse, the outermost braces are tried.  Texts that need
    repair are not guessed at: they come out as parse errors.
    """
    text = F.regexp_replace(strip(F.col(response)), r"(?U)^```(?:json)?\s*", "")
    text = F.regexp_replace(text, r"(?U)\s*```$", "")
    block = F.regexp_extract(text, r"(?s)(\{.*\})", 1)

    def as_map(t: Column) -> Column:
        # a top-level object; anything else, or broken text, gives null
        return F.when(t.startswith("{"), F.try_parse_json(t))

    whole = as_map(text)
    chosen = F.when(whole.isNotNull(), text).when(as_map(block).isNotNull(), block)
    d = df.withColumn("_t", renamed_json(chosen))
    shape = lambda key: F.get_json_object("_t", f"$.{key}")
    if kind == "step1":
        valid = shape("episodes").startswith("[")
    elif kind in ("step2", "step3"):
        key = "classifications" if kind == "step2" else "ranks"
        valid = shape(key).isNull() | shape(key).startswith("[")
    else:
        keys = F.json_object_keys("_t")
        valid = F.array_contains(keys, "raw_bio") & (F.size(F.array_except(F.array(*[F.lit(k) for k in REQUIRED_LABELS]), keys)) == 0)
    status = F.when(F.col("_t").isNull(), "parse_error").when(F.coalesce(valid, F.lit(False)), "ok").otherwise("schema_error")
    if kind == "step4":
        parsed = F.struct(F.from_json(F.get_json_object("_t", "$.raw_bio"), "map<string,string>").alias("raw_bio"),
                          F.from_json("_t", "map<string,string>").alias("labels"))
    else:
        parsed = F.from_json("_t", RESPONSE_SCHEMAS[kind])
    return d.withColumns({"status": status, "parsed": F.when(status == "ok", parsed)}).drop("_t")


def parse_eval(files: DataFrame, file: str = "file", body: str = "value") -> DataFrame:
    """Stored evaluation results, one JSON text a row; unreadable ones are skipped."""
    fs = "map<string,struct<correct:bigint,total:bigint,accuracy:double>>"
    schema = (f"struct<model:string,model_id:string,elapsed_s:double,agg_step2:{fs},agg_step3:{fs},agg_step4:struct<correct:bigint,total:bigint,accuracy:double>,"
              "per_official_step1:map<string,struct<episode_f1:double,episode_recall:double>>,"
              "per_official_step2:map<string,struct<all_fields_correct:struct<correct:bigint,total:bigint>>>,"
              "errors:array<struct<official:string,episode_idx:string,field:string,gold:string,pred:string>>>")
    # text that is not one whole object parses to nothing, or to a struct of nulls
    whole = F.try_parse_json(F.col(body)).isNotNull()
    return files.select(F.col(file).alias("file"), F.when(whole, F.from_json(body, schema)).alias("r")).filter("r is not null").select("file", "r.*")


def read_eval(spark: SparkSession, path: str, mode: int) -> DataFrame:
    """Stored evaluation results of one mode, by file name."""
    raw = spark.read.text(f"{path}/mode{mode}_*.json", wholetext=True).select(F.input_file_name().alias("file"), "value")
    return parse_eval(raw).orderBy("file")
