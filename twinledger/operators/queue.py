"""Disputes still to be decided, the request rows for them, and the checking of verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from twinledger import constants as K
from twinledger.functions import text as T
from twinledger.functions.ordered import PART_ROWS, attach, joined_parts
from twinledger.operators import reconcile as R
from twinledger.operators.biography import career_text

GROUP_KEY = ["name", "source_line"]
FIELD_KEY = ["name", "source_line", "unit", "position", "start", "field"]


def field_disputes(u: DataFrame) -> DataFrame:
    """Raw text inequality per field of paired rows, only for lines whose sides have equal size.

    Wider than the differences: no tolerance, no normalising.
    """
    return disputes_of(R.pairs(u))


def disputes_of(p: DataFrame) -> DataFrame:
    """``field_disputes`` of rows that are paired already."""
    p = p.filter("n_a = n_b")
    rows = F.array(*[
        F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f"a.{f}"), F.lit("")).alias("value_a"),
                 F.coalesce(F.col(f"b.{f}"), F.lit("")).alias("value_b")) for f in K.EPISODE_FIELDS])
    return p.select(
        "name", F.col("line_pos").alias("source_line"), "rn",
        *[F.coalesce(F.col(f"a.{c}"), F.lit("")).alias(c) for c in ("unit", "position", "start")],
        F.inline(F.filter(rows, lambda r: r["value_a"] != r["value_b"])))


def group_disputes(u: DataFrame) -> DataFrame:
    """Lines whose two sides have different sizes."""
    return R.group_sizes(u).filter("n_a <> n_b").withColumnRenamed("line_pos", "source_line")


def pending_groups(disputes: DataFrame, decisions: DataFrame) -> DataFrame:
    return disputes.join(decisions.select(*GROUP_KEY), GROUP_KEY, "left_anti")


def pending_fields(disputes: DataFrame, decisions: DataFrame) -> DataFrame:
    """All disputed fields of every episode that lacks a decision for at least one of them.

    Disputes and decisions travel as one union, partitioned once by episode; whether a field is decided, and whether an
    episode has one that is not, are aggregates over that partitioning.
    """
    ep = [k for k in FIELD_KEY if k != "field"]
    both = disputes.withColumn("_dispute", F.lit(True)).unionByName(decisions.select(*FIELD_KEY).withColumn("_dispute", F.lit(False)), allowMissingColumns=True)
    both = both.repartition(*ep).withColumn("_decided", F.max(~F.col("_dispute")).over(W.partitionBy(*FIELD_KEY)))
    both = both.withColumn("_open", F.max(F.col("_dispute") & ~F.col("_decided")).over(W.partitionBy(*ep)))
    return both.filter("_dispute and _open").select(*disputes.columns)


def pending_by_key(diffs: DataFrame, decisions: DataFrame, keys: list[str], by_name: bool = False) -> DataFrame:
    """Differences without a stored decision, per key (classes: name, index, field; ranks: name, index; labels:
    name, field).  Tables that lie partitioned ``by_name`` are not exchanged."""
    if by_name:
        done = decisions.select(*keys).distinct().withColumn("_is", F.lit(True))
        return attach(diffs, keys, {"_done": done}, by_name).filter("_done is null").select(*diffs.columns)
    return diffs.join(decisions.select(*keys).distinct(), keys, "left_anti")


def class_dispute_groups(diffs: DataFrame, decisions: DataFrame | None = None, by_name: bool = False) -> DataFrame:
    """One row per (name, episode) with the list of its still undecided fields (at most one entry per field)."""
    d = diffs if decisions is None else pending_by_key(diffs, decisions, ["name", "episode_idx", "field"], by_name)
    f = F.struct("field", "value_a", "value_b")
    return d.groupBy("name", "episode_idx").agg(F.sort_array(F.collect_set(f)).alias("fields")).withColumn(
        "n_fields", F.size("fields"))


def fan_out(responses: DataFrame, fields: str = "fields", response: str = "response") -> DataFrame:
    """One verdict per disputed field of a response.

    ``fields`` is an array of field names, ``response`` a JSON object: either field name to verdict, or one flat
    verdict.  A single disputed field may be answered flat; with several, a flat verdict serves those not named, and
    with neither the field gets a doubt verdict.
    """
    verdict = "struct<verdict:string,correct_value:string,confidence:string,reason:string>"
    by_field = F.from_json(F.col(response), f"map<string,string>")
    flat = F.from_json(F.col(response), verdict)
    j = responses.withColumns({"_m": by_field, "_flat": flat}).withColumn("field", F.explode(fields))
    own = F.from_json(F.try_element_at("_m", F.col("field")), verdict)
    is_own = F.try_element_at("_m", F.col("field")).startswith("{") & own.isNotNull()
    has_flat = F.map_contains_key(F.coalesce("_m", F.create_map().cast("map<string,string>")), F.lit("verdict"))
    single = F.size(fields) == 1
    doubt = F.struct(F.lit(K.DOUBT).alias("verdict"), F.lit(None).cast("string").alias("correct_value"),
                     F.lit(None).cast("string").alias("confidence"),
                     F.when(single, K.UNPARSED_REASON).otherwise(K.NOT_COVERED_REASON).alias("reason"))
    picked = (
        F.when(single & has_flat, F.col("_flat")).when(is_own, own).when(has_flat, F.col("_flat")).otherwise(doubt)
    )
    keep = [c for c in responses.columns if c not in (fields, response)]
    return j.select(*keep, "field", picked.alias("v")).select(*keep, "field", "v.*")


def validate_verdicts(d: DataFrame) -> DataFrame:
    """Turn multi-valued corrections into need-split (unit, or a text asking for it) or a doubt without value."""
    value = F.coalesce("correct_value", F.lit(""))
    candidate = F.col("verdict").isin(K.CORRECTED) & (value != "")
    asks = candidate & T.any_word(value, K.NEED_SPLIT_WORDS)
    multi = F.lit(False)
    for field, seps in K.FORBIDDEN_SEPARATORS.items():
        multi = multi | ((F.col("field") == field) & T.any_word(value, seps))
    is_unit = F.col("field") == "unit"
    plain = d.columns
    d = d.withColumns({"_asks": asks, "_multi": candidate & ~asks & multi})
    asks, multi = F.col("_asks"), F.col("_multi")
    label = F.create_map(*[x for k, v in K.FIELD_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return d.withColumns({
        "downgraded": asks | multi,
        "downgrade_reason": F.when(asks, "natural_language_recovered_to_needsplit")
        .when(multi & is_unit, "multivalue_unit_recovered_to_needsplit")
        .when(multi, F.concat(F.lit("invalid_separator_in_"), F.try_element_at(label, F.col("field")))),
        "verdict": F.when(asks | (multi & is_unit), K.NEED_SPLIT).when(multi, K.DOUBT).otherwise(F.col("verdict")),
        "correct_value": F.when(asks | multi, "").otherwise(F.col("correct_value")),
    }).select(*plain, "downgraded", "downgrade_reason")


def escalate(field_decisions: DataFrame, group_decisions: DataFrame) -> DataFrame:
    """Lines with a need-split verdict that have no group decision, or only a downgraded one."""
    need = field_decisions.filter(F.col("verdict") == K.NEED_SPLIT).select(*GROUP_KEY).distinct()
    g = group_decisions
    if "downgraded" in g.columns:
        g = g.filter(~F.coalesce("downgraded", F.lit(False)))
    return need.join(g.select(*GROUP_KEY), GROUP_KEY, "left_anti")


# ---- request texts

def episode_requests(eps: DataFrame, step: int, max_episodes: int | None = None) -> DataFrame:
    """Request text over numbered episodes (step 2 classification, step 3 rank), per person and part.

    ``max_episodes`` sets the chunk size; without it a person is one request whatever the number of episodes.
    """
    e = F.coalesce
    if step == 2:
        line = F.concat(F.lit("  #"), F.col("seq").cast("string"), F.lit(": source_line="),
                        e(F.col("source_line"), F.col("seq")).cast("string"), F.lit("  起始="), e("start", F.lit("")),
                        F.lit("  终止="), e("end", F.lit("")), F.lit("  供职单位="), e("unit", F.lit("")),
                        F.lit("  职务="), e("position", F.lit("")))
    elif step == 3:
        line = F.concat(F.lit("  "), F.col("seq").cast("string"), F.lit(". 供职单位: "), e("unit", F.lit("")),
                        F.lit("  职务: "), e("position", F.lit("")))
    else:
        raise ValueError("episode requests exist for steps 2 and 3")
    out = joined_parts(eps, ["name"], "seq", line, "\n", "body", max_episodes or PART_ROWS,
                       [F.count(F.lit(1)).alias("n_episodes")])
    if max_episodes is None:
        every = F.sort_array(F.collect_list(F.struct("part", "body")))
        out = out.groupBy("name").agg(F.lit(0).alias("part"), F.sum("n_episodes").alias("n_episodes"),
                                      F.array_join(F.transform(every, lambda p: p["body"]), "\n").alias("body"))
    flagged = out.withColumns({"needs_university": T.any_word(F.col("body"), K.UNIVERSITY_WORDS),
                               "needs_enterprise": T.any_word(F.col("body"), K.ENTERPRISE_WORDS)})
    head = (
        F.concat(F.lit("官员："), F.col("name").cast("string"), F.lit("\n\n=== Episodes (Step1 已固定) ===\n"))
        if step == 2 else
        F.concat(F.lit("以下是某官员的全部 "), F.col("n_episodes").cast("string"),
                 F.lit(" 段职务经历（仅凭职务/单位名称判断级别）：\n"))
    )
    return flagged.withColumn("request", F.concat(head, F.col("body"))).drop("body")


def line_requests(pre: DataFrame, name: str = "name", location: str = "", role: str = "") -> DataFrame:
    """Request text over the numbered lines of each person (step 1)."""
    head = F.concat(F.lit("官员："), F.col(name).cast("string"), F.lit(f"，{location}{role}\n\n=== 编号履历行（共"),
                    F.col("total_lines").cast("string"), F.lit("行）===\n"))
    return pre.select(name, "total_lines", F.concat(head, career_text()).alias("request"))


def label_requests(pre: DataFrame, name: str = "name", province: str = "", city: str = "", role: str = "") -> DataFrame:
    """Request text over the biography summary and the numbered lines (step 4)."""
    head = F.concat(F.lit("官员："), F.col(name).cast("string"), F.lit(
        f"\n目标城市：{city}\n目标省份：{province}\n职务：{role}\n\n=== 人物简介 ===\n"), F.col("bio_summary"),
        F.lit("\n\n=== 完整履历（共"), F.col("total_lines").cast("string"), F.lit("条）===\n"))
    return pre.select(name, "total_lines", F.concat(head, career_text()).alias("request"))


def dispute_requests(pending: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """One request per episode with its disputed fields (never more than the four of an episode)."""
    entry = F.concat(F.lit("  "), F.col("field"), F.lit(": LLM1=「"), F.col("value_a"), F.lit("」 LLM2=「"),
                     F.col("value_b"), F.lit("」"))
    g = pending.groupBy("name", "source_line", "unit", "position", "start").agg(*[
        F.max(F.when(F.col("field") == f, entry)).alias(f"_{f}") for f in K.EPISODE_FIELDS])
    g = g.withColumn("_e", F.array_compact(F.array(*[f"_{f}" for f in K.EPISODE_FIELDS])))
    ref = T.line_label(F.col("source_line"))
    if lines is not None:
        g = g.join(lines.select("name", F.col("line_num").alias("source_line"), "raw_text"), GROUP_KEY, "left")
        ref = F.when(F.coalesce("raw_text", F.lit("")) != "", F.concat(ref, F.lit(": "), F.col("raw_text"))).otherwise(ref)
    body = F.array_join("_e", "\n")
    n = F.size("_e")
    return g.select(
        "name", "source_line", "unit", "position", "start", n.alias("n_fields"),
        F.concat(F.lit("官员："), F.col("name").cast("string"), F.lit("\n\nLLM1来源行："), ref,
                 F.lit("\nLLM2来源行：（无）\n\n以下 "), n.cast("string"), F.lit(" 个字段存在争议：\n"), body).alias("request"))
