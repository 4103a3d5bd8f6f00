"""Requests to the adjudicator: the text that sets out one dispute, or all disputes of one record, for a decision.

A request is one cell: the episodes of a line, the fields of an episode, or one value with its two reasons.
``instructions`` is put at the end of each request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinledger import constants as K
from twinledger.functions import text as T
from twinledger.functions.ordered import attach
from twinledger.operators import reconcile as R

NONE_LINE = "  （无）"


def _text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("string")


def _label(field: Column) -> Column:
    names = F.create_map(*[x for k, v in K.FIELD_LABELS.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(names, field), field)


def _closed(parts: list[Column], instructions: str) -> Column:
    return F.concat(*parts, *([F.lit("\n\n" + instructions)] if instructions else [])).alias("request")


def _head(name: Column) -> Column:
    return F.concat(F.lit("官员："), name.cast("string"))


def group_requests(pending: DataFrame, a: DataFrame, b: DataFrame, lines: DataFrame | None = None, instructions: str = "") -> DataFrame:
    """(name, source_line, n_a, n_b, request): both versions of every episode of a line that was split differently.

    ``pending``: name, source_line.  Both versions meet in one aggregate by line; a line that one side lacks says so.
    """
    fields = [f for f in K.EPISODE_FIELDS]
    rows = R.sides(a, b).select("name", F.col("line_pos").alias("source_line"), "side", F.struct("pos", *fields).alias("e"))
    of = lambda side: F.sort_array(F.collect_list(F.when(F.col("side") == side, F.col("e"))))
    both = rows.groupBy("name", "source_line").agg(of("a").alias("a"), of("b").alias("b"))

    def listed(side: str) -> Column:
        line = lambda e, i: F.concat(F.lit("  #"), (i + 1).cast("string"), F.lit(": "),
                                     F.concat_ws(", ", *[F.concat(F.lit(f"{K.FIELD_LABELS[f]}="), _text(e[f])) for f in fields]))
        return F.when(F.size(side) == 0, NONE_LINE).otherwise(F.array_join(F.transform(F.col(side), line), "\n"))

    j = pending.select("name", "source_line").distinct().join(both, ["name", "source_line"])
    raw = F.lit("")
    if lines is not None:
        j = j.join(lines.select("name", F.col("line_num").alias("source_line"), "raw_text"), ["name", "source_line"], "left")
        raw = _text("raw_text")
    part = lambda who, side: [F.lit(f"\n\n{who}从此行提取了 "), F.size(side).cast("string"), F.lit(" 条经历：\n"), listed(side)]
    return j.select("name", "source_line", F.size("a").alias("n_a"), F.size("b").alias("n_b"), _closed(
        [_head(F.col("name")), F.lit("\n原文行 "), T.line_label(F.col("source_line")), F.lit(": "), raw, *part("LLM1", "a"), *part("LLM2", "b")], instructions))


def class_dispute_requests(groups: DataFrame, eps: DataFrame, instructions: str = "", by_name: bool = False) -> DataFrame:
    """(name, episode_idx, n_fields, request): one request for all undecided fields of an episode.

    ``groups``: name, episode_idx, fields (array of field, value_a, value_b), as `queue.class_dispute_groups` gives;
    ``eps``: one row per name and episode_idx with source_line, unit, position, start.
    """
    entry = lambda f: F.concat(F.lit("  "), _label(f["field"]), F.lit(": LLM1=「"), _text(f["value_a"]), F.lit("」 LLM2=「"), _text(f["value_b"]), F.lit("」"))
    e = eps.select("name", "episode_idx", "source_line", "unit", "position", "start")
    j = attach(groups, ["name", "episode_idx"], {"_e": e}, by_name).select(*groups.columns, "_e.*")
    where = F.concat_ws(" | ", _text("unit"), _text("position"), _text("start"))
    n = F.size("fields")
    return j.select("name", "episode_idx", n.alias("n_fields"), _closed(
        [_head(F.col("name")), F.lit("\n经历#"), F.col("episode_idx").cast("string"), F.lit(" ("), T.line_label(F.coalesce("source_line", F.lit(0))), F.lit("): "), where,
         F.lit("\n\n以下 "), n.cast("string"), F.lit(" 个分类字段存在争议：\n"), F.array_join(F.transform("fields", entry), "\n")], instructions))


def rank_dispute_requests(pending: DataFrame, eps: DataFrame, instructions: str = "") -> DataFrame:
    """(name, episode_idx, request): the two ranks of an episode.  ``pending``: name, episode_idx, value_a, value_b."""
    j = pending.join(eps.select("name", "episode_idx", "unit", "position"), ["name", "episode_idx"], "left")
    return j.select("name", "episode_idx", _closed(
        [_head(F.col("name")), F.lit("\n经历#"), F.col("episode_idx").cast("string"), F.lit(": "), _text("unit"), F.lit(" "), _text("position"),
         F.lit("\n\nLLM1判断级别："), _text("value_a"), F.lit("\nLLM2判断级别："), _text("value_b")], instructions))


def label_dispute_requests(pending: DataFrame, snippets: DataFrame | None = None, province: str = "", instructions: str = "") -> DataFrame:
    """(name, field, request): the two values of a person's label with the reason each side gave.

    ``pending``: name, scope, field, value_a, value_b, reason_a, reason_b; ``snippets``: name, snippet of the original.
    """
    j = pending.join(snippets.select("name", "snippet"), "name", "left") if snippets is not None else pending.withColumn("snippet", F.lit(None).cast("string"))
    or_none = lambda c: F.coalesce(F.nullif(_text(c), F.lit("")), F.lit("（无）"))
    return j.select("name", "field", _closed(
        [_head(F.col("name")), F.lit("  字段："), _label(F.col("field")), F.lit("（"), F.col("scope"), F.lit("）\n"), F.lit(f"目标省份：{province}\n" if province else ""),
         F.lit("\n原文依据："), or_none("snippet"), F.lit("\n\nLLM1提取："), _text("value_a"), F.lit("\nLLM1依据："), or_none("reason_a"),
         F.lit("\n\nLLM2提取："), _text("value_b"), F.lit("\nLLM2依据："), or_none("reason_b")], instructions))
