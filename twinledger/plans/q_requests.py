"""Requests to the adjudicator."""

from __future__ import annotations

from pyspark.sql import functions as F

from twinledger import constants as K
from twinledger.operators import queue as Q, reconcile as R, requests as Rq
from twinledger.plans import bindings as B, q_reconcile as QR, sqltext as S
from twinledger.plans.registry import query

_FIELDS = "', ', ".join(f"'{K.FIELD_LABELS[f]}=', \"{f}\", " for f in K.EPISODE_FIELDS).rstrip(", ")
_PARTS = lambda who, n, x: f"chr(10), chr(10), '{who}从此行提取了 ', {n}, ' 条经历：', chr(10), coalesce({x}.body, '  （无）')"
_LABEL = S.mapped("field", K.FIELD_LABELS, "field")
_LAST = "info AS (SELECT name, source_line AS episode_idx, arg_max(source_line, pos) AS source_line, arg_max(unit, pos) AS unit, arg_max(position, pos) AS position, arg_max(start, pos) AS start FROM a GROUP BY name, a.source_line)"


def _episodes(spark, sf):
    """What is known of each episode index: its last row."""
    e = F.struct("source_line", "unit", "position", "start")
    return B.episodes_a(spark, sf).groupBy("name", F.col("source_line").alias("episode_idx")).agg(F.max_by(e, F.col("pos")).alias("e")).select("name", "episode_idx", "e.*")


@query("p8_group_requests", QR.PAIRED + "," + QR.GROUP_DEC + f""", ln AS ({B.duck(B.LINES)}),
lists AS MATERIALIZED (SELECT name, source_line, side, string_agg(concat('  #', k, ': ', {_FIELDS}), chr(10) ORDER BY k) AS body
  FROM (SELECT *, row_number() OVER (PARTITION BY side, name, source_line ORDER BY pos) AS k FROM both_sides) GROUP BY ALL),
open_ AS (SELECT * FROM sizes WHERE n_a <> n_b AND NOT EXISTS (SELECT 1 FROM group_dec g WHERE g.name = sizes.name AND g.source_line = sizes.source_line))
SELECT o.name, o.source_line, CAST(n_a AS INTEGER) AS n_a, CAST(n_b AS INTEGER) AS n_b,
  concat('官员：', o.name, chr(10), printf('原文行 L%02d: ', o.source_line), coalesce(raw_text, ''), {_PARTS('LLM1', 'n_a', 'x')}, {_PARTS('LLM2', 'n_b', 'y')}) AS request
FROM open_ o LEFT JOIN ln ON ln.name = o.name AND ln.line_num = o.source_line LEFT JOIN lists x ON x.side = 'a' AND x.name = o.name AND x.source_line = o.source_line
LEFT JOIN lists y ON y.side = 'b' AND y.name = o.name AND y.source_line = o.source_line""")
def p8_groups(spark, sf):
    a, b = B.episodes_a(spark, sf), B.episodes_b(spark, sf)
    pending = Q.pending_groups(Q.group_disputes(R.sides(a, b)), B.group_decisions(spark, sf, a, b))
    return Rq.group_requests(pending, a, b, B.lines(spark, sf))


@query("p8_class_dispute_requests", QR.CLASS_DIFFS + "," + QR.CLASS_DEC + f""", {_LAST},
open_ AS (SELECT DISTINCT name, episode_idx, field, value_a, value_b FROM class_diffs ANTI JOIN class_dec USING (name, episode_idx, field)),
g AS (SELECT name, episode_idx, count(*) AS n, string_agg(concat('  ', {_LABEL}, ': LLM1=「', value_a, '」 LLM2=「', value_b, '」'), chr(10) ORDER BY field, value_a, value_b) AS body FROM open_ GROUP BY ALL)
SELECT g.name, g.episode_idx, CAST(n AS INTEGER) AS n_fields, concat('官员：', g.name, chr(10), '经历#', g.episode_idx, printf(' (L%02d): ', source_line), unit, ' | ', position, ' | ', start,
  chr(10), chr(10), '以下 ', n, ' 个分类字段存在争议：', chr(10), body) AS request FROM g JOIN info ON info.name = g.name AND info.episode_idx = g.episode_idx""")
def p8_classes(spark, sf):
    with B.written_once(spark, sf, B.large_names(spark, sf), ("lineitem",)) as by_name:
        groups = Q.class_dispute_groups(QR.class_diffs(spark, sf), QR.class_decisions(spark, sf), by_name)
        return Rq.class_dispute_requests(groups, _episodes(spark, sf), by_name=by_name)


@query("p8_rank_dispute_requests", QR.RANK_DIFFS + "," + QR.RANK_DEC + f""", {_LAST},
open_ AS (SELECT * FROM rank_diffs ANTI JOIN rank_dec USING (name, episode_idx))
SELECT o.name, o.episode_idx, concat('官员：', o.name, chr(10), '经历#', o.episode_idx, ': ', unit, ' ', position, chr(10), chr(10), 'LLM1判断级别：', value_a, chr(10), 'LLM2判断级别：', value_b) AS request
FROM open_ o JOIN info ON info.name = o.name AND info.episode_idx = o.episode_idx""")
def p8_ranks(spark, sf):
    d = QR.rank_diffs(spark, sf)
    return Rq.rank_dispute_requests(Q.pending_by_key(d, B.recipe(spark, sf, B.RANK_DECISIONS, diffs=d), ["name", "episode_idx"]), _episodes(spark, sf))


_OR_NONE = lambda x: f"coalesce(nullif({x}, ''), '（无）')"


@query("p8_label_dispute_requests", QR.PERSON_DIFFS + "," + QR.LABEL_DEC + f""",
s AS (SELECT o_orderkey AS name, o_comment_ AS snippet FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN concat('原文 ', o_custkey) END AS o_comment_ FROM orders) t),
open_ AS (SELECT * FROM person_diffs ANTI JOIN label_dec USING (name, field))
SELECT o.name, o.field, concat('官员：', o.name, '  字段：', {_LABEL}, '（', scope, '）', chr(10), '目标省份：浙江省', chr(10), chr(10), '原文依据：', coalesce(snippet, '（无）'), chr(10), chr(10),
  'LLM1提取：', coalesce(value_a, ''), chr(10), 'LLM1依据：', {_OR_NONE('reason_a')}, chr(10), chr(10), 'LLM2提取：', coalesce(value_b, ''), chr(10), 'LLM2依据：', {_OR_NONE('reason_b')}) AS request
FROM open_ o LEFT JOIN s ON s.name = o.name""")
def p8_labels(spark, sf):
    d = QR.person_diffs(spark, sf)
    pending = Q.pending_by_key(d, B.recipe(spark, sf, B.LABEL_DECISIONS, diffs=d), ["name", "field"])
    snippets = B.recipe(spark, sf, "SELECT o_orderkey AS name, CASE WHEN o_orderkey % 3 <> 0 THEN concat('原文 ', o_custkey) END AS snippet FROM {orders}")
    return Rq.label_dispute_requests(pending, snippets, province="浙江省")
