"""Literal cases for the behaviours that are easy to get wrong."""

import json
import random

import pytest
from pyspark.sql import functions as F

from twinledger import constants as K, manuals
from twinledger.functions import dates as D, text as T
from twinledger.operators import biography as Bio, flatten as X, labels as Lb, matching as Mt, merge as M, pages as Pg, panel as P, quality as Ql, queue as Q, reconcile as R, roster as L
from twinledger.sources import readers, sinks, store as Store
from twinledger.streaming import incremental as I


def values(spark, data, *exprs, schema="t string"):
    df = spark.createDataFrame([(d,) for d in data], schema)
    return [tuple(r) for r in df.select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).collect()]




def test_fractional_year(spark):
    got = [r[0] for r in values(spark, ["1990.00", "1978.10", "1990", "", "None", "abc", "至今", None, "１９９０.06", " 1990.5　"], D.frac_year(F.col("t")))]
    assert got == [1990.0, 1978 + 10 / 12, 1990.0, None, None, -1.0, -1.0, None, 1990.5, 1990 + 5 / 12]


def test_organisation_names(spark):
    got = [r[0] for r in values(spark, ["深圳市委", "中共浙江省委员会", "浙江省人民政府", "杭州市人民政府　", "中国人民政治协商会议浙江省委员会", "浙江省人民代表大会常务委员会", ""], T.norm_org(F.col("t")))]
    assert got == ["中共深圳市委", "中共浙江省委", "浙江省政府", "杭州市政府", "中共中国人民政治协商会议浙江省委", "浙江省人大常委会", ""]


def test_places_keep_known_gaps(spark):
    got = values(spark, ["青海", "广州", "吉林市", "贵州", "新疆"], T.norm_prov(F.col("t")), T.is_province(F.col("t")), T.is_province(F.col("t"), compat_guizhou=False))
    assert [r[0] for r in got] == ["青海", "广东省", "吉林省", "贵州省", "新疆维吾尔自治区"]
    assert got[3][1:] == (False, True)


def test_line_shapes(spark):
    lines = ["1990.05-1995.03 a", "1990.13- a", "1990年—1995年 x", "1990年5月任", "从1990年起", "1973.02，x", "2022-中央", "1982月09月，x", "中共十五大代表", "x", "　", "1990至1992x"]
    got = values(spark, lines, T.line_kind(F.col("t")), T.start_ym(F.col("t")), T.has_end(F.col("t")))
    assert [g[0] for g in got] == ["career"] * 8 + ["honor", "continuation", "blank", "career"]
    assert [tuple(g[1]) if g[1] else None for g in got[:8]] == [(1990, 5), (1990, 0), (1990, 0), (1990, 5), (1990, 0), (1973, 2), (2022, 0), (1982, 9)]
    assert [g[2] for g in got] == [True, False, True] + [False] * 8 + [True]


def test_biography(spark):
    text = "top\n=== 人物简介 ===\nold\n=== 人物简介 ===\n intro \n=== 空 ===\n=== 履历段落 ===\nbefore\n1990.01- a\n more\n中共十届委员\n1992年3月b\n1994.01-1995.02 c\n"
    df = spark.createDataFrame([("n", text)], "name string, text string")
    secs = {r.section: r.body for r in Bio.split_sections(df, "name", "text").collect()}
    assert set(secs) == {"_header", "人物简介", "履历段落"} and secs["人物简介"] == " intro "
    p = Bio.preprocess(df).first()
    assert p.bio_summary == "intro" and p.extra_text == "before\n中共十届委员" and p.total_lines == 3
    assert [(c.line_num, c.raw_text, c.inferred_end) for c in p.career_lines] == [
        (1, "1990.01- a　more", "1992年03月"), (2, "1992年3月b", "1994年01月"), (3, "1994.01-1995.02 c", None)]
    assert Bio.render_lines(Bio.preprocess(df)).first().career_text.startswith("L01: 1990.01- a　more  [至1992年03月止]\nL02:")


EP = "name string, source_line long, pos int, start string, end string, unit string, position string"


def eps(spark, *rows):
    return R.with_line_keys(spark.createDataFrame([("p", *r) for r in rows], EP))


def test_field_levels(spark):
    a = eps(spark, (1, 0, "1990.01", "至今", "u", "x"), (2, 1, "1990.01", "", "浙江省人民政府", "x"), (3, 2, "1990.01", "abc", "u", "x"))
    b = eps(spark, (1, 0, "1993.02", "1995.01", "u", "y"), (2, 1, "1991.01", "1995", "浙江省政府", "x"), (3, 2, "1991.06", "至今", "u", "x"))
    got = {(r.source_line, r.field): r.level for r in R.diff_episodes(a, b).collect()}
    assert got == {(1, "start"): "HIGH", (1, "end"): "HIGH", (1, "position"): "MEDIUM", (2, "end"): "MEDIUM", (3, "start"): "MEDIUM"}
    # the dispute set is wider: raw inequality
    d = {(r.source_line, r.field) for r in Q.field_disputes(R.both_sides(a, b)).collect()}
    assert d == set(got) | {(2, "start"), (2, "unit"), (3, "end")}


@pytest.mark.parametrize("chunk", [2, 1_000_000])
def test_split_and_missing(spark, chunk):
    a = eps(spark, (1, 0, "1", "", "b", "p"), (1, 1, "1", "", "a", "p"), (2, 2, "1", "", "only", "q"))
    b = eps(spark, (1, 0, "1", "", "a", "p"), (3, 1, "1", "", "z", "q"))
    rows = R.diff_episodes(a, b, chunk_rows=chunk).collect()
    got = {(r.source_line, r.scope): (r.field, r.value_a, r.value_b) for r in rows}
    assert got == {(1, "episode_split"): ("拆分方式", "2条: b p; a p", "1条: a p"), (2, "episode_missing"): ("LLM2缺失", "only q", "（无）"),
                   (3, "episode_missing"): ("LLM1缺失", "（无）", "z q")}


def test_same_source_has_no_differences(spark):
    a = eps(spark, (1, 0, "1990.01", "至今", "u", "x"), (1, 1, "1991", "x", "v", "y"))
    assert R.diff_episodes(a, a).isEmpty()
    assert [r.verdict for r in R.summarize(R.people_in_both(a, a), R.diff_episodes(a, a)).collect()] == ["PASS"]


def test_verdict_grid(spark):
    grid = spark.sql("select h, m from (select explode(array(0,1,2)) h) lateral view explode(array(0,1,2,3)) x as m")
    got = {(r.h, r.m): r.v for r in grid.withColumn("v", R.verdict(F.col("h"), F.col("m"))).collect()}
    assert [got[k] for k in [(0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 0)]] == ["PASS", "NEEDS_REVIEW", "NEEDS_REVIEW", "NEEDS_REVIEW", "MAJOR_CONFLICT", "MAJOR_CONFLICT"]


def test_type_mismatch_is_a_difference(spark):
    s = "name string, minority string, minority_type string, fell string"
    a, b = spark.createDataFrame([("p", "1", "int", "是")], s), spark.createDataFrame([("p", "1", "string", "")], s)
    r = R.diff_people(a, b).collect()
    assert [(x.field, x.level, x.type_mismatch) for x in r] == [("minority", "HIGH", True)]


def test_verdict_validation(spark):
    rows = [("unit", "自行修正", "甲、乙"), ("position", "自行修正", "甲、乙"), ("position", "自行修正", "甲；乙"), ("start", "两者均存疑", "1990；1991"),
            ("unit", "自行修正", "需拆分提取"), ("unit", "采纳LLM1", "甲、乙"), ("unit", "自行修正", "")]
    d = spark.createDataFrame(rows, "field string, verdict string, correct_value string")
    got = [(r.verdict, r.correct_value, r.downgraded) for r in Q.validate_verdicts(d).collect()]
    assert got == [("需拆分", "", True), ("自行修正", "甲、乙", False), ("两者均存疑", "", True), ("两者均存疑", "", True), ("需拆分", "", True),
                   ("采纳LLM1", "甲、乙", False), ("自行修正", "", False)]


GD = f"name string, source_line long, adopt string, episodes array<{readers.EPISODE}>"


@pytest.mark.parametrize("chunk", [2, 1_000_000])
def test_group_merge_rules(spark, chunk):
    a = eps(spark, (3, 0, "a", "", "keep", ""), (1, 1, "a", "", "a1", ""), (1, 2, "a", "", "a1b", ""), (2, 3, "a", "", "a2", ""), (4, 4, "a", "", "a4", ""))
    b = eps(spark, (2, 0, "b", "", "b2", ""), (2, 1, "b", "", "b2b", ""), (5, 2, "b", "", "b5", ""), (6, 3, "b", "", "b6", ""))
    new = [(None, "j", "", "judged", ""), ("2", "j", "", "moved", "")]
    d = spark.createDataFrame([("p", 1, "LLM1", []), ("p", 2, "LLM2", []), ("p", 4, "LLM2", new), ("p", 5, "LLM2", []), ("p", 6, "LLM1", [])], GD)
    got = [(r.seq, r.source_line, r.unit) for r in M.merge_groups(a, b, d, chunk_rows=chunk).orderBy("seq").collect()]
    assert got == [(1, 1, "a1"), (2, 2, "b2"), (3, 2, "b2b"), (4, 2, "moved"), (5, 3, "keep"), (6, 4, "judged"), (7, 5, "b5")]
    # without any decision the order stays as it came
    none = M.merge_groups(a, b, d.limit(0), chunk_rows=chunk).orderBy("seq").collect()
    assert [r.unit for r in none] == ["keep", "a1", "a1b", "a2", "a4"]


FD = "name string, source_line long, unit string, position string, start string, field string, verdict string, correct_value string, pos int"


def test_field_merge(spark):
    a = eps(spark, (1, 0, "1990", "1991", "u", "p"), (2, 1, "1992", "1993", "v", "q"))
    b = eps(spark, (1, 0, "1988", "1991", "u", "p"), (2, 1, "1999", "1993", "other", "q"))
    d = spark.createDataFrame([("p", 1, "u", "p", "1990", "start", "采纳LLM2", "", 0), ("p", 1, "u", "p", "1990", "position", "自行修正", "new", 1),
                               ("p", 2, "v", "q", "1992", "start", "采纳LLM2", "", 2), ("p", 2, "v", "q", "1992", "unit", "采纳LLM2", "", 3)], FD)
    g = spark.createDataFrame([], GD)
    got = [(r.start, r.unit, r.position) for r in M.merge_step1(a, b, g, d).orderBy("seq").collect()]
    assert got == [("1988", "u", "new"), ("1992", "v", "q")]  # adopting B on a unit B does not have changes nothing
    skip = spark.createDataFrame([("p", 1, "LLM1", [])], GD)
    assert M.merge_step1(a, b, skip, d).orderBy("seq").first().start == "1990"


def test_label_overrides(spark):
    s = "name string, promo_gov string, fell string"
    a, b = spark.createDataFrame([("p", "0", "否"), ("q", "1", "否")], s), spark.createDataFrame([("p", "1", "是")], s)
    d = spark.createDataFrame([("p", "promo_gov", "采纳LLM2", "", 0), ("q", "promo_gov", "自行修正", "02", 0), ("p", "fell", "采纳LLM2", "", 1)],
                              "name string, field string, verdict string, correct_value string, pos int")
    got = {r.name: (r.promo_gov, r.fell) for r in M.resolve_labels(a, b, d, ["promo_gov", "fell"]).collect()}
    assert got == {"p": ("1", "否"), "q": ("2", "否")}
    assert M.resolve_labels(a, b, d, ["promo_gov", "fell"], honour_all=True).filter("name = 'p'").first().fell == "是"


@pytest.mark.parametrize("chunk", [2, 1_000_000])
def test_rank_to_date(spark, chunk):
    rows = [("p", 1, "1990.01", "正处级"), ("p", 1, "1989.00", "无"), ("p", 2, "1995", "副处级"), ("p", 3, "", "正国级"), ("p", 4, "2000.02", "副厅级"), ("p", 5, "1980", "难以判断")]
    df = spark.createDataFrame(rows, "name string, source_line long, start string, rank string")
    got = {r.source_line: r.best_rank for r in X.rank_to_date(df, chunk_rows=chunk).collect()}
    assert got == {5: "", 1: "正处级", 2: "正处级", 4: "副厅级", 3: "正国级"}


def brute_panel(ten, year, rule):
    act = [x for x in ten if x["sy"] <= year <= x["ey"]]
    if not act:
        return None
    last = max(act, key=lambda x: (x["sy"], x["sm"] or 13, x["ord"]))
    if len(act) == 1:
        return act[0]["holder"]
    if rule == "longest":
        def months(x):
            lo, hi = (x["sm"] if x["sy"] == year else 1), (x["em"] if x["ey"] == year else 12)
            return max(hi - lo + 1, 1) if lo and hi else None
        ms = [months(x) for x in act]
        if None not in ms and ms.count(max(ms)) == 1:
            return act[ms.index(max(ms))]["holder"]
        return last["holder"]
    def on(x):
        s = True if x["sy"] < year else None if x["sm"] in (0, 7) else x["sm"] <= 6
        e = True if x["ey"] > year else None if x["em"] in (0, 7) else x["em"] >= 8
        return s is True and e is True
    sure = [x for x in act if on(x)]
    return sure[0]["holder"] if len(sure) == 1 else last["holder"]


def test_panel_against_brute_force(spark):
    rnd = random.Random(5)
    ten = []
    for u in range(6):
        for i in range(rnd.randint(1, 9)):
            sy = rnd.randint(1985, 2024)
            open_ = rnd.random() < .1
            ten.append(dict(unit=u, role="governor", holder=f"{u}-{i}", ord=i, sy=sy, sm=rnd.randint(0, 12), ey=9999 if open_ else sy + rnd.randint(0, 4), em=12 if open_ else rnd.randint(0, 12)))
    df = spark.createDataFrame(ten, "unit int, role string, holder string, ord int, sy int, sm int, ey int, em int")
    got = {(r.unit, r.year, r.rule): r.governor for r in P.panel(df).collect()}
    assert len(got) == len({x["unit"] for x in ten}) * 36 * 2
    for (u, y, rule), g in got.items():
        assert g == (brute_panel([x for x in ten if x["unit"] == u], y, rule) or ""), (u, y, rule)


def test_roster(spark):
    text = "# c\n省份：浙江省\r\n起始年份：1990\nx, 1990.01-1991.01\n[省长]\n甲（代）, 1995.1-1996\n甲, 1996.02-至今\n乙, 1989.01-1990.01\n坏行\n[省委书记]\n甲, 1999.01-2000.01\n丙, 2001\n"
    e = readers.parse_rosters(spark.createDataFrame([("f", text)], "file string, text string"))
    got = [(r.role_kind, r.name, r.acting, r.start, r.end) for r in e.orderBy("ord").collect()]
    assert got == [("governor", "甲", True, "1995.01", "1996.00"), ("governor", "甲", False, "1996.02", "至今"), ("governor", "乙", False, "1989.01", "1990.01"),
                   ("secretary", "甲", False, "1999.01", "2000.01"), ("secretary", "丙", False, "2001.00", "至今")]
    c = {r.name: (r.role, r.start) for r in L.consolidate(L.started_after(e, F.col("start_year")), "province").collect()}
    assert c == {"甲": ("代省长/省委书记", "1995.01"), "丙": ("省委书记", "2001.00")}
    strict = readers.parse_rosters(spark.createDataFrame([("f", text)], "file string, text string"), strict=True)
    assert [(r.name, r.start) for r in strict.orderBy("ord").collect()] == [("甲", "1996.02"), ("乙", "1989.01"), ("甲", "1999.01")]
    with pytest.raises(ValueError):
        L.only(e, "nobody")


def brute_match(gold, pred):
    def jac(a, b):
        a, b = set(a), set(b)
        return 1.0 if not a and not b else len(a & b) / len(a | b)
    left, out = list(range(len(pred))), []
    for g in gold:
        best = max(left, key=lambda i: (jac(g, pred[i]), -i), default=None)
        if best is not None and jac(g, pred[best]) >= 0.3:
            left.remove(best)
            out.append(best)
        else:
            out.append(None)
    return out


def test_greedy_match_against_brute_force(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randint(0, 4)))
    data = {f"n{i}": ([word() for _ in range(rnd.randint(1, 7))], [word() for _ in range(rnd.randint(0, 7))]) for i in range(40)}
    mk = lambda j: spark.createDataFrame([(n, i, "", "", u, "") for n, x in data.items() for i, u in enumerate(x[j])],
                                         "name string, pos int, start string, end string, unit string, position string")
    for pairs in (9, 4096):  # people of more pairs go in blocks
        got = {(r.name, r.g_no): r.pred.pos if r.pred else None for r in Mt.match_episodes(mk(0), mk(1), K.EPISODE_FIELDS, pairs=pairs, block=3).collect()}
        assert len(got) == sum(len(g) for g, _ in data.values())
        for n, (g, p) in data.items():
            assert [got[n, i + 1] for i in range(len(g))] == brute_match(g, p), n
    left = Mt.match_episodes(mk(0), mk(1), K.EPISODE_FIELDS, weighted=True)
    assert left.filter("pred is not null").count() == sum(len(p) for _, p in data.values())


def weighted_match(gold, pred):
    """Pairs of (unit, position) by 0.6 and 0.4, above 0.3; then the pred left over."""
    part = lambda x, y: len(set(x) & set(y)) / max(len(set(x) | set(y)), 1)
    used, out = set(), []
    for g in gold:
        best, at = 0.3, None
        for j, p in enumerate(pred):
            s = part(g[0], p[0]) * 0.6 + part(g[1], p[1]) * 0.4
            if j not in used and s > best:
                best, at = s, j
        used.add(at)
        out.append(at)
    return out, [j for j in range(len(pred)) if j not in used]


@pytest.mark.parametrize("pairs", [9, 4096])
def test_weighted_match_against_brute_force(spark, pairs):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(rnd.randint(0, 5)))
    rows = lambda n: [(word(), word()) for _ in range(n)]
    data = {f"n{i}": (rows(rnd.randint(1, 9)), rows(rnd.randint(0, 9))) for i in range(40)}
    mk = lambda j: spark.createDataFrame([(n, i, "", "", u, v) for n, x in data.items() for i, (u, v) in enumerate(x[j])],
                                         "name string, pos int, start string, end string, unit string, position string")
    got = Mt.match_episodes(mk(0), mk(1), K.EPISODE_FIELDS, weighted=True, pairs=pairs, block=9).collect()
    for n, (g, p) in data.items():
        hits, left = weighted_match(g, p)
        own = [r for r in got if r.name == n]
        assert [r.pred.pos if r.pred else None for r in sorted((r for r in own if r.gold), key=lambda r: r.g_no)] == hits, n
        assert sorted(r.pred.pos for r in own if not r.gold) == left, n


def test_match_of_a_person_of_50_000_rows(spark):
    """One person with 50,000 rows of 2,000 units: the i-th row of a unit takes the i-th row of its like."""
    rows = spark.range(50_000).select(
        F.when(F.col("id") < 49_900, F.lit("hot")).otherwise(F.concat(F.lit("p"), F.col("id") % 20)).alias("name"), F.col("id").alias("pos"),
        F.lit("").alias("start"), F.lit("").alias("end"), F.expr("concat(chr(19968 + id % 2000), chr(23000 + id % 2000))").alias("unit"), F.lit("").alias("position"))
    got = Mt.match_episodes(rows, rows.withColumn("pos", F.col("pos") * 3), K.EPISODE_FIELDS, block=8192)
    r = got.agg(F.count("*").alias("n"), F.count_if(F.col("pred.pos") == 3 * F.col("gold.pos")).alias("same")).first()
    assert (r.n, r.same) == (50_000, 50_000)


def test_responses(spark):
    ok = json.dumps({"raw_bio": {"姓名": "x"}, **{k: 0 for k in readers.REQUIRED_LABELS}}, ensure_ascii=False)
    rows = [("```json\n" + ok + "\n```",), ("{\"raw_bio\": {}}",), ("text {" + ok[1:] + " end",), ("[1]",)]
    got = [r.status for r in readers.parse_responses(spark.createDataFrame(rows, "r string"), "r", "step4").collect()]
    assert got == ["ok", "schema_error", "ok", "parse_error"]


def test_page_text(spark):
    html = ("<html><title>甲_百科</title><nav>2000 nav</nav><div class='lemmaSummary_x'>甲是一个很长的人物简介，长度超过二十个字符以便保留[1]。</div>"
            "<div class='J-lemma-content'><div class='para_y'>1990年至1995年任某某职务[2-3]</div><div class='para'>短</div></div>"
            "<table><tr><th>任职时间</th></tr><tr><td>1990</td></tr></table></html>")
    got = Pg.extract_pages(spark.createDataFrame([(1, html, "甲")], "page_id int, html string, n string"), name="n").first().text
    assert got == ("=== 词条标题 ===\n甲_百科\n\n=== 人物简介 ===\n甲是一个很长的人物简介，长度超过二十个字符以便保留。\n\n=== 履历段落 ===\n1990年至1995年任某某职务\n\n"
                   "=== 履历表格 ===\n任职时间\t1990")


def test_files_and_store(spark, tmp_path):
    (tmp_path / "甲_biography.txt").write_text("=== 履历段落 ===\n1990.01- a", encoding="utf-8")
    assert [(r.name, r.text[:3]) for r in readers.read_biographies(spark, str(tmp_path)).collect()] == [("甲", "===")]
    recs = [{"_meta": {"name": "p"}, "episodes": [{"source_line": "1", "供职单位": "old"}]}, None, {"episodes": []}, {"_meta": {"name": "p"}, "episodes": [{"source_line": 2, "供职单位": "new"}]}]
    (tmp_path / "r.json").write_text(json.dumps(recs, ensure_ascii=False), encoding="utf-8")
    got = readers.explode_result(readers.read_results(spark, str(tmp_path / "r.json"), "step1"), "step1").collect()
    assert [(r.name, r.source_line, r.unit) for r in got] == [("p", 2, "new")]
    assert readers.read_results(spark, str(tmp_path / "r.json"), "step1", force=True).isEmpty()
    rows = spark.createDataFrame([("p", 1, "浙江省", 1990, "u")], "name string, seq int, province string, year int, unit string")
    sinks.write_final(rows, str(tmp_path / "final"))
    out = spark.read.parquet(str(tmp_path / "final"))
    assert out.columns[:33] == list(K.FINAL_COLUMNS.values()) and out.first()["供职单位"] == "u"
    assert sinks.write_report(rows.limit(0), str(tmp_path / "none")) is False


def test_stream_once(spark, tmp_path):
    src, store, ck = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "ck")
    df = spark.createDataFrame([("p", 1), ("q", 2)], "name string, v int")
    df.write.parquet(src)
    for _ in range(2):
        I.stream_files(spark, src, df.schema, store, ck, "name").awaitTermination()
    assert spark.read.parquet(store).count() == 2
    df.write.mode("append").parquet(src)
    I.stream_files(spark, src, df.schema, store, ck, "name").awaitTermination()
    assert spark.read.parquet(store).count() == 4


def stored(spark, path):
    return sorted((r.name, r.result) for r in Store.read_store(spark, path).collect())


def test_store_is_written_once(spark, tmp_path, monkeypatch):
    path, s = str(tmp_path / "store"), "name string, result string"
    first = spark.createDataFrame([("p", "1"), ("q", "2"), ("x", None), (None, "n")], s)
    second = spark.createDataFrame([("q", "3"), ("r", "4"), ("p", None)], s)
    assert Store.read_store(spark, path, s).count() == 0
    assert Store.store_results(first, path, batch="a", buckets=4) and not Store.store_results(first, path, batch="a", buckets=4)
    assert sorted(r.result for r in Store.read_store(spark, path).collect()) == ["1", "2", "n"]
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "store").rglob("*.parquet")}

    def lost(*_):
        raise RuntimeError("the driver is lost after the data and before the commit")

    with monkeypatch.context() as m:
        m.setattr(Store, "_buckets_in", lost)
        with pytest.raises(RuntimeError):
            Store.store_results(second, path, batch="b", buckets=4)
    assert sorted(r.result for r in Store.read_store(spark, path).collect()) == ["1", "2", "n"]
    assert Store.store_results(second, path, batch="b", buckets=4) and not Store.store_results(second, path, batch="b", buckets=4)
    assert sorted(r.result for r in Store.read_store(spark, path).collect()) == ["1", "3", "4", "n"]
    assert {f: f.stat().st_mtime_ns for f in files} == files  # what earlier versions wrote stays as it is
    touched = {r.bucket for r in Store.commits(spark, path).filter("batch = 'b'").collect()}
    assert touched == {r.b for r in second.filter("result is not null").select(F.pmod(F.xxhash64("name"), F.lit(4)).alias("b")).collect()}
    assert not Store.store_results(first.limit(0), path, batch="c", buckets=4)


def test_stream_into_store(spark, tmp_path):
    src, path, ck = (str(tmp_path / x) for x in ("in", "store", "ck"))
    schema = "name string, result string"
    run = lambda: I.stream_to_store(spark, src, schema, path, ck, files=1).awaitTermination()
    spark.createDataFrame([("p", "1"), ("q", "2")], schema).coalesce(1).write.parquet(src)
    run()
    spark.createDataFrame([("q", "3"), ("r", "4")], schema).coalesce(1).write.mode("append").parquet(src)
    run()
    assert stored(spark, path) == [("p", "1"), ("q", "3"), ("r", "4")]
    # the stream dies after the batch is stored and before it notes that: the batch comes again
    last = max((f for f in (tmp_path / "ck" / "commits").iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
    for f in (last, last.with_name(f".{last.name}.crc")):
        f.unlink(missing_ok=True)
    n = Store.commits(spark, path).count()
    run()
    assert stored(spark, path) == [("p", "1"), ("q", "3"), ("r", "4")] and Store.commits(spark, path).count() == n


def test_upsert_and_claims(spark):
    s = "name string, v int"
    old, new = spark.createDataFrame([("p", 1), ("q", 2)], s), spark.createDataFrame([("q", 3), ("r", 4)], s)
    assert sorted(map(tuple, I.upsert(old, new, ["name"]).collect())) == [("p", 1), ("q", 3), ("r", 4)]
    assert sorted(map(tuple, I.keep_first(old, new, ["name"]).collect())) == [("p", 1), ("q", 2), ("r", 4)]
    assert [r.name for r in I.incremental(new.union(new), old).collect()] == ["r"]


def test_rules(spark):
    df = spark.createDataFrame([("中共浙江省委", "副书记", None), ("浙江省政府", "省长", None), ("某地", "工人", None), (None, None, None), ("北京大学", "校长", "副部级")], "u string, p string, l string")
    got = Lb.classify_by_rules(df, manuals.class_rules(spark), "u", "p", "l").collect()
    assert [r.flag for r in got] == ["省委副书记（非省长）", "省长", None, None, "高校/党校任职"]
    assert [r["rank"] for r in got] == ["副部级", "正部级", None, None, "副部级"]
    assert [r["rank"] for r in Lb.classify_by_rules(df, manuals.class_rules(spark), "u", "p").collect()][-1] is None
    with pytest.raises(ValueError):
        Lb.classify_by_rules(df, manuals.class_rules(spark), "u", "p", most=3)


def test_unit_rules_against_every_name(spark):
    """Thousands of names, some of one character, some within others, against looking for each."""
    rnd = random.Random(8)
    word = lambda n: "".join(rnd.choice("甲乙丙丁戊己") for _ in range(n))
    rules = [(i, word(rnd.randint(1, 5)), f"t{i}", None, None, rnd.choice([None, 1990]), rnd.choice([None, 2000])) for i in range(3000)]
    eps = [(word(rnd.randint(0, 9)), rnd.choice(["1989.01", "1995.03", "2001", ""])) for _ in range(400)] + [(None, "1995")]
    df = spark.createDataFrame([(u, s, i) for i, (u, s) in enumerate(eps)], "unit string, start string, i int")
    got = {r.i: r.unit_tag for r in Lb.unit_rules(df, spark.createDataFrame(rules, manuals.UNIT_SCHEMA)).collect()}
    assert len(got) == len(eps)
    for i, (u, s) in enumerate(eps):
        y = int(s[:4]) if s else None
        ok = [r for r in rules if u and r[1] in u and (r[5] is None or (y and y >= r[5])) and (r[6] is None or (y and y <= r[6]))]
        assert got[i] == (min(ok, key=lambda r: (-len(r[1]), r[0]))[2] if ok else None)


def _versions(spark, seed, people=6, rows=40):
    """Two random versions with people on one side only, lines of unequal size, empty and null values."""
    r = random.Random(seed)
    pick = lambda *v: r.choice(v)

    def side(n, names):
        return R.with_line_keys(spark.createDataFrame(
            [(pick(*names), pick(None, 1, 2, 3), i, pick("1990", "1991.02", "1999", "", None), pick("至今", "2001.01", "2003", ""),
              pick("甲", "乙省政府", "乙省人民政府", None), pick("主席", "书记", None)) for i in range(n)],
            "name string, source_line long, pos long, start string, end string, unit string, position string"))

    return side(rows, [f"p{i}" for i in range(people)]), side(rows, [f"p{i}" for i in range(2, people + 2)])


@pytest.mark.parametrize("large", [False, True])
def test_summary_without_differences_written_out(spark, large):
    a, b = _versions(spark, 3)
    want = R.summarize(R.people_in_both(a, b), R.diff_episodes(a, b))
    got = R.summarize_episodes(R.both_sides(a, b, large, chunk_rows=5))
    rows = lambda df: sorted(tuple(r) for r in df.select("name", "high_count", "medium_count", "verdict").collect())
    assert rows(got) == rows(want) and len(rows(got)) == 4
    # an empty side leaves nobody to compare
    assert R.summarize_episodes(R.both_sides(a, b.limit(0), False)).count() == 0


def test_indexed_records(spark):
    s = "name string, episode_idx long, pos long, rank string"
    a = spark.createDataFrame([("p", None, 0, "x"), ("p", 1, 1, "old"), ("p", 1, 2, "y"), ("q", 1, 0, "z"), ("r", 1, 0, "same"), ("r", 2, 1, None)], s)
    b = spark.createDataFrame([("p", 0, 0, "x"), ("p", 1, 1, "w"), ("p", 7, 2, "more"), ("r", 1, 0, "same"), ("r", 2, 1, ""), ("s", 1, 0, "z")], s)
    got = sorted(tuple(r) for r in R.diff_ranks(a, b).select("name", "episode_idx", "value_a", "value_b").collect())
    assert got == [("p", 1, "y", "w"), ("p", 7, "", "more")]
    people = sorted((r.name, r.medium_count, r.verdict) for r in R.summarize_indexed(a, b, ["rank"], [], rank_rule=True).collect())
    assert people == [("p", 2, "NEEDS_REVIEW"), ("r", 0, "PASS")]
    ctx = spark.createDataFrame([("p", 1, 5, "u", "o", None), ("q", 1, 5, "u", "o", "")], "name string, pos long, source_line long, unit string, position string, start string")
    got = sorted(tuple(r) for r in R.diff_ranks(a, b, ctx.withColumn("seq", F.col("pos"))).select("name", "episode_idx", "source_line", "unit", "start").collect())
    assert got == [("p", 1, 5, "u", ""), ("p", 7, 0, "", "")]
    d = spark.createDataFrame([("p", 1, 0, "采纳LLM2", ""), ("p", 9, 1, "自行修正", "new"), ("q", 1, 2, "采纳LLM2", ""), ("p", 8, 3, "采纳LLM1", "")],
                              "name string, episode_idx long, pos long, verdict string, correct_value string")
    got = sorted(tuple(r) for r in M.resolve_ranks(a, b, d).select("name", "episode_idx", "rank").collect())
    # an index that only B has stays out, one that only a correction has comes in
    assert got == [("p", 0, "x"), ("p", 1, "w"), ("p", 9, "new"), ("q", 1, "z"), ("r", 1, "same"), ("r", 2, "")]


def _merge_by_hand(a, b, decisions, keep_all):
    """What merge_groups says, person by person."""
    out = []
    for name in {r.name for r in a}:
        mine, theirs = [r for r in a if r.name == name], [r for r in b if r.name == name]
        plans = {d.source_line: d for d in decisions if d.name == name}
        rows = []
        for r in sorted(mine, key=lambda r: r.pos):
            first = min(x.pos for x in mine if x.line_zero == r.line_zero)
            d = plans.get(r.line_zero)
            judged = d is not None and bool(d.episodes)
            from_b = d is not None and d.adopt == "LLM2" and any(x.line_zero == r.line_zero for x in theirs)
            if d is None or (not judged and not from_b and (keep_all or r.pos == first)):
                rows.append((r.line_zero, 0, r.pos, 0, r.unit))
        for line, d in plans.items():
            seen = [x.pos for x in mine if x.line_zero == line]
            at = (0, min(seen)) if seen else (1, line)
            if d.episodes:
                rows += [(int(e.source_line) if e.source_line else line, *at, i, e.unit) for i, e in enumerate(d.episodes)]
            elif d.adopt == "LLM2":
                rows += [(line, *at, x.pos, x.unit) for x in theirs if x.line_zero == line]
        if plans:
            rows.sort(key=lambda r: r[:4])
        out += [(name, i + 1, r[0], r[4]) for i, r in enumerate(rows)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep_all", [False, True])
def test_group_merge_against_a_plain_loop(spark, keep_all):
    a, b = _versions(spark, 5)
    new = [("2", "1990", "1991", "判定", "")]
    d = spark.createDataFrame([("p2", 1, "LLM2", None), ("p2", 2, "LLM1", []), ("p3", 1, "LLM2", new), ("p3", 9, "LLM2", new), ("p4", 0, None, None),
                               ("p0", 1, "LLM2", None), ("p7", 1, "LLM2", new)], GD)
    want = _merge_by_hand(a.collect(), b.collect(), d.collect(), keep_all)
    for options in ({"large": False}, {"large": True, "chunk_rows": 4}):
        got = M.merge_groups(a, b, d, keep_all, **options).select("name", "seq", "source_line", "unit").collect()
        assert sorted((tuple(r) for r in got), key=repr) == want
    assert M.merge_groups(a.limit(0), b, d).count() == 0


def test_field_merge_null_keys(spark):
    e = spark.createDataFrame([("p", 1, 1, "1990", "1991", None, "q"), ("p", 2, None, "1990", "1991", "u", "q"), ("p", 3, 4, None, None, "u", "q"),
                               ("p", 4, 4, "1990", "1991", "u", "q")],
                              "name string, seq long, source_line long, start string, end string, unit string, position string")
    b = eps(spark, (1, 0, "2000", "2001", None, "q"), (4, 1, "2002", "2003", "u", "q"))
    d = spark.createDataFrame([("p", 1, None, "q", "1990", "start", "自行修正", "no", 0), ("p", None, "u", "q", "1990", "start", "自行修正", "no", 1),
                               ("p", 4, "u", "q", None, "start", "自行修正", "no", 2), ("p", 4, "u", "q", "1990", "end", "采纳LLM2", "", 3),
                               ("p", 4, "u", "q", "1990", "end", "采纳LLM1", "", 2)], FD)
    skip = spark.createDataFrame([("p", None)], "name string, source_line long")
    got = [(r.source_line, r.start, r.end) for r in M.merge_fields(e, b, d, skip).orderBy("seq").collect()]
    # null keys match nothing; of several verdicts on a field the last counts
    assert got == [(1, "1990", "1991"), (0, "1990", "1991"), (4, "", ""), (4, "1990", "2003")]


@pytest.mark.parametrize("weighted", [False, True])
def test_matching_of_small_people_matches_once_and_without_arrays_of_characters(spark, weighted):
    gold, pred = [spark.createDataFrame([("n", i, "省委", "书记") for i in range(3)] + [(None, 0, "省委", "书记")], "name string, pos int, unit string, position string") for _ in "ab"]
    m = Mt.match_episodes(gold, pred, ["unit", "position"], weighted=weighted)
    plan = m._jdf.queryExecution().analyzed().toString()
    assert plan.count("array_append") == 1 and "array_intersect" not in plan
    # null names match nothing
    got = sorted((r.name or "", -1 if r.g_no is None else r.g_no, r.pred is not None) for r in m.collect())
    assert got == [*([("", -1, True)] if weighted else []), ("", 1, False), ("n", 1, True), ("n", 2, True), ("n", 3, True)]


def test_legacy_comparison_matches_once(spark):
    rows = spark.createDataFrame([("n", 1, "1990.01", "省委", "书记", "a"), ("n", 2, "1995.06", "市府", "主席", "b")], "name string, pos int, start string, unit string, position string, org_tag string")
    other = rows.withColumns({"start": F.lit("1993.02"), "org_tag": F.lit("b")}).filter("pos = 1")
    m = Mt.match_episodes(rows, other, ["start", "unit", "position", "org_tag"], weighted=True)
    n = spark.createDataFrame([("n", 8, 1)], "name string, n_a long, n_b long")
    d = Ql.compare_legacy(m, n)
    assert d._jdf.queryExecution().analyzed().toString().count("array_append") == 1
    assert sorted(tuple(r) for r in d.select("field", "value_a", "value_b", "level").collect()) == [
        ("count", "8", "1", "HIGH"), ("org_tag", "a", "b", "MEDIUM"), ("start", "1990.01", "1993.02", "HIGH"), ("unmatched", "市府", None, None)]


def test_generated_code_of_verdicts_is_short_enough_to_be_compiled(spark):
    rows = spark.createDataFrame([("n", 1, 1, "1990.01", "", "省委", "书记")], "name string, line_pos long, pos long, start string, end string, unit string, position string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = R.summarize_episodes(R.both_sides(rows, rows, large=False))._jdf.queryExecution().executedPlan()
        parts = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenStringSeq(plan)
        # the JVM leaves methods of more than 8000 bytes to its interpreter
        assert max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())) < 8000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_short_ways_for_dates_and_organisations(spark):
    got = [r[0] for r in values(spark, ["1990.06", "1990.00", "1990.13", "1990.6", "1990.061", "199０.06", "1990.06\n", " 1990.06"], D.frac_year(F.col("t")))]
    assert got == [1990.5, 1990.0, 1990 + 13 / 12, 1990.5, 1990 + 61 / 12, 1990.5, 1990.5, 1990.5]
    got = [r[0] for r in values(spark, ["某委", "某市委", "中共市委　", "甲 乙　丙", "市人民政府", "省人民代表大会"], T.norm_org(F.col("t")))]
    assert got == ["某委", "中共某市委", "中共市委", "甲乙丙", "市人民政府", "省人大"]


def test_numbered_flags_are_those_of_the_wide_rows(spark):
    data = [("n", 1, "学习进修", "学员"), ("n", 2, "省长", "省长"), ("n", 4, "学校", "校长"), ("n", 5, "怪", "x"), ("m", 3, None, None), ("m", 7, "学校", "本科学生")]
    eps = spark.createDataFrame([(n, s, s, "1990.01", "", "u", p, "", f, "", "", "") for n, s, f, p in data],
                                "name string, seq long, source_line long, start string, end string, unit string, position string, org_tag string, flag string, prov string, city string, central string")
    labels = spark.createDataFrame([("n", "1950")], "name string, birth_year string")
    ranks = spark.createDataFrame([("n", 2, "正部级")], "name string, episode_idx long, rank string")
    wide = X.flatten(eps, labels, ranks, large=False).select("name", "seq", "flag")
    got = X.numbered_flags(eps, large=False)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wide.collect()))
    assert ("n", 1, "省长") in map(tuple, got.collect())
