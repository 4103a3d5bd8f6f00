"""From merged records to the wide result rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from twinledger import constants as K
from twinledger.functions import dates as D, text as T
from twinledger.functions.ordered import CHUNK_ROWS, attach, gathered, ordinal, running


# ---- decision texts

def decision_texts(decisions: DataFrame) -> DataFrame:
    """Decisions with their rendered ``text``; those without text are dropped."""
    return decisions.withColumn(
        "text", T.decision_text(F.col("judge_model"), F.col("confidence"), F.col("reason"))).filter("text <> ''")


def routed_fields(eps: DataFrame, field_decisions: DataFrame, by_name: bool = False) -> DataFrame:
    """(name, source_line, dpos, text, seq) of each field decision with text; ``seq`` is null where no row matches.

    Rows and decisions travel as one union, partitioned once by line, unit and position, unless all lie partitioned
    ``by_name``; the first row of a post, by each start and by any, are windows over one sort.
    """
    line, post = ["name", "source_line"], ["name", "source_line", "unit", "position"]
    label = reduce(lambda acc, kv: acc.when(F.col("field") == kv[0], kv[1]), list(K.FIELD_LABELS.items())[1:],
                   F.when(F.col("field") == "start", K.FIELD_LABELS["start"])).otherwise(F.col("field"))
    d = decision_texts(field_decisions).select(
        *[F.col(c).alias(c) for c in post], F.coalesce("start", F.lit("")).alias("start"), F.col("pos").alias("dpos"), F.concat(label, F.col("text")).alias("text"))
    e = eps.select(*[F.col(c).alias(c) for c in post], F.coalesce("start", F.lit("")).alias("start"), F.col("seq").alias("s"))
    rows = d.withColumn("_own", F.lit(True)).unionByName(e.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    rows = rows if by_name else rows.repartition(*post)
    # the wider key first: its sort serves the other
    rows = rows.withColumn("_exact", F.min("s").over(W.partitionBy(*post, "start"))).withColumn("_any", F.min("s").over(W.partitionBy(*post)))
    # null keys match nothing; an empty start in the key matches any start
    known = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in post])
    seq = F.when(known, F.coalesce(F.when(F.col("start") != "", F.col("_exact")), F.col("_any")))
    return rows.filter("_own").select(*line, "dpos", "text", seq.alias("seq"))


def route_texts(eps: DataFrame, group_decisions: DataFrame, field_decisions: DataFrame, by_name: bool = False,
                store=lambda d: d) -> tuple[DataFrame, DataFrame]:
    """Where each step-1 decision text belongs: (name, source_line, dpos, text) of whole lines, (name, seq, dpos, text) of rows.

    A line decision goes to every row of the line.  A field decision goes to the first row that matches unit,
    position and start, else the first that matches unit and position, else every row of the line.  Tables that lie
    partitioned ``by_name`` are not exchanged.  Both results are parts of one table, which ``store`` may keep.
    """
    line = ["name", "source_line"]
    group = decision_texts(group_decisions).select(*line, F.col("pos").alias("dpos"), "text")
    d = store(routed_fields(eps, field_decisions, by_name))
    whole = d.filter("seq is null and source_line > 0").drop("seq")
    return group.unionByName(whole), d.filter("seq is not null").select("name", "seq", "dpos", "text")


def route_line_texts(eps: DataFrame, group_decisions: DataFrame, field_decisions: DataFrame, by_name: bool = False) -> DataFrame:
    """(name, seq, dpos, text): a row for each text of each row; a line's texts come with every row of the line."""
    lines, rows = route_texts(eps, group_decisions, field_decisions, by_name)
    e = eps.select("name", "source_line", "seq")
    if by_name:
        of_line = lines.groupBy("name", "source_line").agg(F.collect_list(F.struct("dpos", "text")).alias("texts"))
        of_line = attach(e, ["name", "source_line"], {"_line": of_line}, by_name).select("name", "seq", F.inline("_line.texts"))
    else:
        of_line = lines.join(e, ["name", "source_line"]).select("name", "seq", "dpos", "text")
    return of_line.unionByName(rows)


def _collected(kind: str | None = None) -> Column:
    """Aggregate: the texts (of a kind) as an array of struct(dpos, text)."""
    entry = F.struct("dpos", "text")
    return F.collect_list(F.when(F.col("kind") == kind, entry) if kind else F.when(F.col("text").isNotNull(), entry))


def _texts(kind: str | None = None) -> Column:
    """Aggregate: the texts (of a kind) in decision order, as an array of struct(dpos, text)."""
    return F.sort_array(_collected(kind))


def _joined(entries: Column) -> Column:
    """The texts of such an array, or null if it has none.

    A lambda, so that the projection of the wide row, which is too long for one generated method that the JVM would
    compile, is made of many.
    """
    return F.when(F.size(entries) > 0, F.array_join(F.transform(entries, lambda x: x["text"]), " | "))


def row_texts(routed: DataFrame, name: str, keys: list[str] = ("name", "seq")) -> DataFrame:
    """All texts of a row in one cell, joined with `` | `` in decision order."""
    return routed.groupBy(*keys).agg(_texts().alias(name)).withColumn(name, _joined(F.col(name)))


def step1_texts(eps: DataFrame, group_decisions: DataFrame, field_decisions: DataFrame, name: str = "judge1",
                by_name: bool = False) -> DataFrame:
    """(name, seq, judge1) of rows that have texts.  A line's texts are one array, which each row merges with its own."""
    lines, rows = route_texts(eps, group_decisions, field_decisions, by_name)
    of_line = lines.groupBy("name", "source_line").agg(_texts().alias("_line")).withColumn("_line_text", _joined(F.col("_line")))
    of_row = rows.groupBy("name", "seq").agg(_texts().alias("_row"))
    # a line's texts come last: they are many, and no row that carries them is shuffled
    e = attach(eps.select("name", "source_line", "seq"), ["name", "seq"], {"_r": of_row}, by_name)
    e = attach(e, ["name", "source_line"], {"_l": of_line}, by_name).select("name", "seq", "_r.*", "_l.*")
    return e.select("name", "seq", _with_line("_row").alias(name)).filter(F.col(name).isNotNull())


def _with_line(own: str) -> Column:
    """The texts of `own` and of `_line` in order; `_line_text`, made once for a line, where a row has none of its own."""
    entries = "array<struct<dpos:bigint,text:string>>"
    both = F.sort_array(F.concat(F.coalesce(F.col("_line").cast(entries), F.array().cast(entries)), F.col(own).cast(entries)))
    return F.when(F.coalesce(F.size(own), F.lit(0)) > 0, _joined(both)).otherwise(F.col("_line_text"))


def routed_by_index(decisions: DataFrame, with_field: bool) -> DataFrame:
    """(name, seq, dpos, text) for decisions keyed by episode index (steps 2 and 3)."""
    label = F.create_map(*[x for k, v in K.FIELD_LABELS.items() for x in (F.lit(k), F.lit(v))])
    text = F.col("text")
    if with_field:
        text = F.concat(F.coalesce(F.try_element_at(label, F.col("field")), F.col("field")), text)
    return decision_texts(decisions).select("name", F.col("episode_idx").alias("seq"), F.col("pos").alias("dpos"),
                                            text.alias("text"))


# ---- ranks over time

def rank_to_date(eps: DataFrame, large: bool | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(name, source_line, line_rank, best): best level up to each line, lines in order of their earliest start.

    ``eps`` has name, source_line, start, rank.  Levels are reduced per line before anything is ordered.
    """
    lines = eps.groupBy("name", "source_line").agg(
        F.min(T.rank_ord(F.col("rank"))).alias("line_ord"),
        F.min(D.sort_key(F.coalesce("start", F.lit("")))).alias("k"))
    r = running(lines, ["name"], ["k", "source_line"], {"best_ord": ("min", F.col("line_ord"))}, chunk_rows, large=large)
    return r.select("name", "source_line", F.coalesce(T.rank_name(F.col("line_ord")), F.lit("")).alias("line_rank"),
                    F.coalesce(T.rank_name(F.col("best_ord")), F.lit("")).alias("best_rank"))


def rank_drops(eps: DataFrame, large: bool | None = None, chunk_rows: int = CHUNK_ROWS,
               keep: list[str] = ()) -> DataFrame:
    """Rows whose level is below the best level before them (by start, line, seq)."""
    o = eps.withColumns({"_k": D.sort_key(F.coalesce("start", F.lit(""))), "_o": T.rank_ord(F.col("rank"))})
    r = running(o, ["name"], ["_k", "source_line", "seq"], {"_best": ("min", F.col("_o"))}, chunk_rows, False, large)
    return r.filter("_o > _best").select("name", *keep, "seq", "rank", T.rank_name(F.col("_best")).alias("best_before"))


# ---- row rules

def is_study_row(flag: Column, position: Column) -> Column:
    return F.coalesce((flag == K.STUDY_FLAG) | ((flag == K.LEGACY_SCHOOL_FLAG) & T.any_word(position, K.STUDENT_WORDS)),
                      F.lit(False))


def source_ref(existing: Column, line: Column, raw: Column) -> Column:
    """Keep a real quotation; a bare line label is replaced by the label with the line's text, when known."""
    label = T.line_label(line)
    return (
        F.when((F.coalesce(existing, F.lit("")) != "") & ~existing.rlike(r"^L\d+$"), existing)
        .when(raw.isNotNull(), F.concat(label, F.lit(": "), raw)).otherwise(label)
    )


def fell_flag(c: Column) -> Column:
    return F.when(F.contains(F.coalesce(c, F.lit("否")), F.lit("是")), "是").otherwise("否")


def enum_guards(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "org_tag": T.enum_guard(F.coalesce("org_tag", F.lit("")), K.ORG_TAGS, "无效标签"),
        "flag": T.enum_guard(F.coalesce("flag", F.lit(K.RANK_NONE)), K.FLAGS, "无效标志位"),
    })


def focal_year(eps: DataFrame, target: str, start_year: int) -> DataFrame:
    """(name, year): start year of the first row, in order, that holds a target post from ``start_year`` on."""
    t = F.lit(target)
    args = F.col("position"), F.col("unit")
    prov = T.role_match(*args, F.col("prov"), t, "governor") | T.role_match(*args, F.col("prov"), t, "secretary")
    city = T.role_match(*args, F.col("city"), t, "mayor") | T.role_match(*args, F.col("city"), t, "city_secretary")
    hit = F.when(T.is_province(t), prov).otherwise(city)
    y = D.parse_year(F.col("start"))
    ok = hit & (y >= start_year)
    return eps.groupBy("name").agg(
        F.coalesce(F.min_by(F.when(ok, y), F.when(ok, F.col("seq"))), F.lit(start_year)).cast("int").alias("year"))


# ---- the whole

def flatten(episodes: DataFrame, labels: DataFrame, ranks: DataFrame, lines: DataFrame | None = None,
            line_texts: DataFrame | None = None, texts: dict[str, DataFrame] | None = None, target: str = "", province: str = "",
            start_year: int = 0, label_text_row: str = "original_first", large: bool | None = None, chunk_rows: int = CHUNK_ROWS,
            by_name: bool = False) -> DataFrame:
    """The wide rows, English column names.

    ``episodes``: name, seq, source_line, the step-1 and step-2 fields; ``labels``: one row per person with resolved
    labels; ``ranks``: name, episode_idx, rank; ``texts``: judge1..judge3 as (name, seq, dpos, text) and judge4 as
    (name, dpos, text); ``line_texts``: judge1 texts of whole lines as (name, source_line, dpos, text).  A row carries
    all its texts, whatever their number.

    All that belongs to a row, a line or a person comes together in one aggregate each, so rows are joined three times.
    Tables that lie partitioned ``by_name`` meet without an exchange, in one window for each of them.
    """
    texts = texts or {}
    kinds = ["judge1", "judge2", "judge3"]
    spare = {"rank": "string", "kind": "string", "dpos": "bigint", "text": "string"}

    def typed(parts: list[DataFrame], columns: dict[str, str]) -> list[DataFrame]:
        have = [p.withColumns({"name": F.col("name")} | {c: F.lit(None).cast(t) for c, t in columns.items() if c not in p.columns}) for p in parts]
        return [h.withColumns({c: F.col(c).cast(t) for c, t in columns.items()}) for h in have]

    def stacked(parts: list[DataFrame], columns: dict[str, str]) -> DataFrame:
        return reduce(DataFrame.unionByName, typed(parts, columns))

    row_parts = [ranks.select("name", F.col("episode_idx").alias("seq"), "rank"),
                 *[texts[k].select("name", "seq", F.lit(k).alias("kind"), "dpos", "text") for k in kinds if k in texts]]
    line_parts = []
    if lines is not None:
        line_parts.append(lines.select("name", F.col("line_num").alias("source_line"), "raw_text"))
    if line_texts is not None:
        line_parts.append(line_texts.select("name", "source_line", "dpos", "text"))
    known = [c for c in ("birth_year", "origin", "origin_city", "minority", "female", "bachelor", *K.LABEL_FIELDS, "fell", "fell_reason") if c in labels.columns]
    of_person = {c: labels.schema[c].dataType.simpleString() for c in known} | {"dpos": "bigint", "text": "string"}
    person_parts = [labels.select("name", *known)]
    if "judge4" in texts:
        person_parts.append(texts["judge4"].select("name", "dpos", "text"))
    years = focal_year(episodes, target, start_year)
    study = is_study_row(F.col("flag"), F.col("position"))

    if by_name:
        e = gathered(episodes, ["name", "seq"], typed(row_parts, spare), {"_rank": F.max("rank"), **{f"_{k}": _collected(k) for k in kinds}})
        e = e.withColumns({"rank": F.coalesce("_rank", F.lit("")), **{f"_{k}": F.sort_array(f"_{k}") for k in kinds}, "_kept": ~study}).withColumnRenamed("seq", "_old")
        # numbered while the rows lie by their old numbers
        so_far = W.partitionBy("name").orderBy("_old").rowsBetween(W.unboundedPreceding, W.currentRow)
        e = e.withColumn("seq", F.count_if("_kept").over(so_far))
        e = e.withColumns({"_o": T.rank_ord(F.col("rank")), "_k": D.sort_key(F.coalesce("start", F.lit("")))})
        e = gathered(e, ["name", "source_line"], typed(line_parts, {"raw_text": "string", "dpos": "bigint", "text": "string"}),
                     {"_raw": F.max("raw_text"), "_line": _collected(), "_line_o": F.min("_o"), "_line_k": F.min("_k")})
        best = F.min("_line_o").over(W.partitionBy("name").orderBy("_line_k", "source_line").rowsBetween(W.unboundedPreceding, W.currentRow))
        e = e.withColumn("_best", best).filter("_kept").withColumnRenamed("_raw", "raw_text").withColumns({
            "best_rank": T.rank_name(F.col("_best")), "_line": F.sort_array("_line")}).withColumn("_line_text", _joined(F.col("_line")))
        person = gathered(years, ["name"], typed(person_parts, of_person), {f"_{c}": F.max(c) for c in known} | {"_judge4": _collected()})
        person = person.select("name", "year", *[F.col(f"_{c}").alias(c) for c in known], F.sort_array("_judge4").alias("_judge4"))
        e = e.join(person, "name", "left")
    else:
        rows = stacked(row_parts, spare).groupBy("name", "seq").agg(F.max("rank").alias("rank"), *[_texts(k).alias(f"_{k}") for k in kinds])
        e = attach(episodes, ["name", "seq"], {"_r": rows})
        e = e.select(*episodes.columns, F.coalesce("_r.rank", F.lit("")).alias("rank"), *[f"_r._{k}" for k in kinds])
        # ranks alone, so that texts are not put together a second time for them
        of_rank = ranks.groupBy("name", F.col("episode_idx").alias("seq")).agg(F.max("rank").alias("rank"))
        ranked = attach(episodes.select("name", "seq", "source_line", "start"), ["name", "seq"], {"_r": of_rank})
        ranked = ranked.select("name", "source_line", "start", F.coalesce("_r.rank", F.lit("")).alias("rank"))
        line = stacked([rank_to_date(ranked, large, chunk_rows).select("name", "source_line", "best_rank"), *line_parts],
                       {"best_rank": "string", "raw_text": "string", "dpos": "bigint", "text": "string"})
        line = line.groupBy("name", "source_line").agg(F.max("best_rank").alias("best_rank"), F.max("raw_text").alias("raw_text"), _texts().alias("_line"))
        line = line.withColumn("_line_text", _joined(F.col("_line")))
        person = stacked([years, *person_parts], of_person | {"year": "int"}).groupBy("name").agg(
            *[F.max(c).alias(c) for c in [*known, "year"]], _texts().alias("_judge4"))
        e = e.join(person, "name", "left").filter(~study)
        e = ordinal(e.withColumn("_old", F.col("seq")).drop("seq"), ["name"], ["_old"], "seq", chunk_rows, large)
        # a line's texts come last: they may be many, and no row that carries them is shuffled
        e = attach(e, ["name", "source_line"], {"_l": line}).select(*e.columns, "_l.*")
    kept = e.withColumns({"judge1": _with_line("_judge1"), "judge2": _joined(F.col("_judge2")), "judge3": _joined(F.col("_judge3")), "judge4": _joined(F.col("_judge4"))})
    for c in ("fell", "fell_reason", "source_ref", "remark", "org_tag", "prov", "city", "central"):
        if c not in kept.columns:
            kept = kept.withColumn(c, F.lit(None).cast("string"))
    first = (F.col("_old") == 1) if label_text_row == "original_first" else (F.col("seq") == 1)
    kept = enum_guards(kept)
    row_rank = F.coalesce(F.nullif(F.col("rank"), F.lit("")), F.lit(K.RANK_NONE))
    out = kept.withColumns({
        "province": F.lit(province), "unit": T.norm_org(F.coalesce("unit", F.lit(""))),
        "prov": T.norm_prov(F.col("prov")), "city": T.norm_city(F.col("city")),
        "source_ref": source_ref(F.col("source_ref"), F.col("source_line"), F.col("raw_text")),
        "fell": fell_flag(F.col("fell")), "judge4": F.when(first, F.col("judge4")),
        "rank": row_rank, "rank_to_date": F.coalesce(F.nullif(F.col("best_rank"), F.lit("")), row_rank),
    })
    return final_columns(out)


def numbered_flags(episodes: DataFrame, large: bool | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(name, seq, flag) of the rows of ``flatten``, for what asks for no more of them: from the episodes alone."""
    e = episodes.filter(~is_study_row(F.col("flag"), F.col("position")))
    e = ordinal(e.select("name", F.col("seq").alias("_old"), "org_tag", "flag"), ["name"], ["_old"], "seq", chunk_rows, large)
    return enum_guards(e).select("name", "seq", "flag")


def final_columns(df: DataFrame) -> DataFrame:
    """All 33 columns in order as text (year and seq stay numbers), missing ones empty."""
    def col(c: str) -> Column:
        if c not in df.columns:
            return F.lit("").alias(c)
        if c in ("year", "seq", "name"):
            return F.col(c)
        return F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)

    return df.select(*[col(c) for c in K.FINAL_COLUMNS])


def rename_out(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(k).alias(v) for k, v in K.FINAL_COLUMNS.items()])


# ---- subsets and highlights

def role_subset(rows: DataFrame, role: str, names: DataFrame | None = None) -> DataFrame:
    """All rows of the people on the list, or, without a list, of people who hold a flag of the role."""
    if names is None:
        flags = K.GOVERNOR_FLAGS if role == "governor" else K.SECRETARY_FLAGS
        names = rows.filter(F.col("flag").isin(flags)).select("name")
    return rows.join(names.select("name").distinct(), "name", "left_semi")


def _signals(text: Column) -> dict[str, Column]:
    """Whether a text tells of a blocked verdict, or of a confidence that is low."""
    numbers = F.regexp_extract_all(text, F.lit(r"\[信心:(-?\d+)\]"), 1)
    return {"hl_blocked": F.contains(text, F.lit("[裁判被拦截]")), "hl_lowconf": F.exists(numbers, lambda x: x.try_cast("int") < K.LOW_CONFIDENCE)}


def highlights(rows: DataFrame) -> DataFrame:
    """The signals a spreadsheet would colour: role rows, blocked verdicts, low confidence."""
    both = F.concat_ws(" | ", "judge1", "judge2", "judge3", "judge4")
    return rows.withColumns({"hl_role": F.col("flag").isin(K.GOVERNOR_FLAGS + K.SECRETARY_FLAGS), **_signals(both)})


def highlighted(episodes: DataFrame, line_texts: DataFrame, texts: dict[str, DataFrame]) -> DataFrame:
    """(name, seq, hl_role, hl_blocked, hl_lowconf): what ``highlights`` says of the rows of ``flatten``.

    Neither signal can lie across two texts, so each text is asked alone and a row takes what any of its texts says; no
    text is put together, and ranks, labels and lines are not needed.  All tables lie partitioned by name.
    """
    def said(t: DataFrame, *keys) -> DataFrame:
        found = t.select(*keys, *[c.alias(n) for n, c in _signals(F.col("text")).items()])
        low = F.col("hl_lowconf")
        return found.filter(F.col("hl_blocked") | F.coalesce(low, F.lit(True))).select(
            *keys, F.col("hl_blocked").alias("_b"), F.coalesce(low, F.lit(False)).alias("_l"), low.isNull().alias("_u"))

    # a person's own texts sit on the original first row
    of_rows = [said(texts[k], "name", "seq") for k in ("judge1", "judge2", "judge3")] + [said(texts["judge4"], "name", F.lit(1).cast("long").alias("seq"))]
    any_of = lambda at: {f"{at}{c}": F.max(c) for c in ("_b", "_l", "_u")}
    e = episodes.select("name", F.col("seq").cast("long").alias("seq"), "source_line", "flag", (~is_study_row(F.col("flag"), F.col("position"))).alias("_kept"))
    e = gathered(e, ["name", "seq"], of_rows, any_of("_row"))
    # numbered while the rows lie by their old numbers
    so_far = W.partitionBy("name").orderBy("seq").rowsBetween(W.unboundedPreceding, W.currentRow)
    e = e.withColumn("_new", F.count_if("_kept").over(so_far))
    e = gathered(e, ["name", "source_line"], [said(line_texts, "name", "source_line")], any_of("_line")).filter("_kept")
    either = lambda c: F.coalesce(f"_row{c}", F.lit(False)) | F.coalesce(f"_line{c}", F.lit(False))
    flag = T.enum_guard(F.coalesce("flag", F.lit(K.RANK_NONE)), K.FLAGS, "无效标志位")
    return e.select("name", F.col("_new").alias("seq"), flag.isin(K.GOVERNOR_FLAGS + K.SECRETARY_FLAGS).alias("hl_role"),
                    either("_b").alias("hl_blocked"), F.when(either("_l"), True).when(~either("_u"), False).alias("hl_lowconf"))


def export_counts(rows: DataFrame) -> DataFrame:
    """Rows and distinct people of each export, in one pass over per-person counts."""
    per = rows.groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("flag").isin(K.GOVERNOR_FLAGS).cast("int")).alias("g"),
        F.max(F.col("flag").isin(K.SECRETARY_FLAGS).cast("int")).alias("s"))
    subset = F.array_compact(F.array(F.lit("all"), F.when(F.col("g") == 1, "governor"), F.when(F.col("s") == 1, "secretary")))
    return per.select("n", F.explode(subset).alias("subset")).groupBy("subset").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("people"))


# ---- review tables

def review_step1(diffs: DataFrame, a: DataFrame, group_decisions: DataFrame, field_decisions: DataFrame, by_name: bool = False) -> DataFrame:
    """Every step-1 difference with its decision, as ``review_parts`` says."""
    is_field = F.col("scope") == "episode_field"
    return review_parts(diffs.filter(is_field), diffs.filter(~is_field), a, group_decisions, field_decisions, by_name)


def review_parts(of_field: DataFrame, of_line: DataFrame, a: DataFrame, group_decisions: DataFrame, field_decisions: DataFrame,
                 by_name: bool = False) -> DataFrame:
    """Field differences, and differences of lines, with their decisions.

    Split and missing lines use the line key.  A field difference finds its key through the first A row of the line
    with the same unit.  Tables that lie partitioned ``by_name`` are not exchanged.
    """
    cols = ["verdict", "correct_value", "confidence", "reason", "judge_model"]
    line = ["name", "source_line"]

    def named(d: DataFrame, keys: list[str], extra: tuple = ()) -> DataFrame:
        have = [c for c in cols if c in d.columns]
        return d.select(*keys, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in have],
                        *[F.lit("").alias(c) for c in cols if c not in d.columns])

    first, key = a.withColumn("source_line", F.col("line_zero")), [*line, "unit", "position", "start", "field"]
    post = {c: F.coalesce(f"k.{c}", F.lit("")) for c in ("position", "start")}
    if by_name:
        by_line = attach(of_line, line, {"_g": named(group_decisions, line)}, True).select(*of_line.columns, "_g.*").drop("rn")
        k = F.min_by(F.struct(F.col("_position").alias("position"), F.col("_start").alias("start")), F.col("_pos"))
        f = gathered(of_field, [*line, "unit"], [first.select(*line, "unit", *[F.col(c).alias(f"_{c}") for c in ("position", "start", "pos")])], {"k": k})
        d = named(field_decisions, key).select(*key, F.struct(*cols).alias("_d"))
        f = gathered(f.withColumns(post).drop("k"), key, [d], {"_all": F.collect_list("_d")})
        by_field = f.select(*[c for c in of_field.columns if c != "rn"], F.expr("inline_outer(_all)"))
    else:
        by_line = of_line.join(named(group_decisions, line), line, "left").drop("rn")
        first = first.groupBy(*line, "unit").agg(F.min_by(F.struct("position", "start"), F.col("pos")).alias("k"))
        by_field = (
            of_field.join(first, [*line, "unit"], "left").withColumns(post).drop("k")
            .join(named(field_decisions, key), key, "left").drop("position", "start", "rn")
        )
    out = by_line.unionByName(by_field)
    return out.withColumns({c: F.coalesce(c, F.lit("")) for c in [*cols, "unit"]})


def review_by_key(diffs: DataFrame, decisions: DataFrame, keys: list[str], by_name: bool = False) -> DataFrame:
    """Steps 2 to 4: every difference with the decision of its key (at most one, if they lie partitioned ``by_name``)."""
    cols = ["verdict", "correct_value", "confidence", "reason", "judge_model"]
    d = decisions.select(*keys, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols])
    j = attach(diffs, keys, {"_d": d}, by_name).select(*diffs.columns, "_d.*")
    return j.withColumns({c: F.coalesce(c, F.lit("")) for c in cols})
