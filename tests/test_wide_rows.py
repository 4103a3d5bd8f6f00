"""The wide rows by windows over rows that lie by name are those of joins, and take no aggregate that sorts lists twice."""

import os

import pytest
from pyspark.sql import functions as F

from twinledger import constants as K
from twinledger.functions import text as T
from twinledger.functions.ordered import gathered
from twinledger.operators import flatten as X
from twinledger.plans import bindings as B, q_flatten as QF

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def wide_inputs(spark):
    """Rows with null and repeated keys, lines with several rows, texts of rows, lines and persons, study rows."""
    eps = spark.createDataFrame(
        [(n, s, line, start, "2001.01", unit, post, "其他", flag, prov, city, "地方")
         for n in (1, 2, 3, None) for s, line, start, unit, post, flag, prov, city in (
             (1, 2, "2000.03", "浙江省政府", "省长", "省长", "浙江", "杭州"), (2, 1, None, "第1省人民政府", "书记", "学习进修", "青海", "沙"),
             (3, 1, "1990.01", "浙江省委", "省委书记", "省委书记", "内蒙", "广州天河"), (4, 3, "", "", "", "odd", " 广东", "广州"),
             (5, None, "2010.01", "x", "y", "学校", "", ""))],
        "name long, seq long, source_line long, start string, end string, unit string, position string, org_tag string, flag string, prov string, city string, central string")
    ranks = spark.createDataFrame([(1, 1, "正厅级"), (1, 2, "副国级"), (1, 3, "无"), (1, 3, "副厅级"), (2, 2, ""), (2, 4, " 正处级"), (None, 1, "正国级"), (3, 9, "正国级")],
                                  "name long, episode_idx long, rank string")
    labels = spark.createDataFrame([(1, "1950", "0"), (2, None, "1"), (9, "1960", "1"), (None, "1970", "1")], "name long, birth_year string, promo_gov string")
    lines = spark.createDataFrame([(1, 1, "one"), (1, 2, "two"), (3, 3, None), (None, 1, "none")], "name long, line_num long, raw_text string")
    texts = lambda *r: spark.createDataFrame(r, "name long, seq long, dpos long, text string")
    line_texts = spark.createDataFrame([(1, 1, 7, "[信心:84] l7"), (1, 1, 2, "[信心:99] l2"), (2, 1, 3, "[信心:85] l3"), (3, 9, 1, "[裁判被拦截] l"), (2, None, 1, "[信心:1]")],
                                       "name long, source_line long, dpos long, text string")
    own = {"judge1": texts((1, 3, 5, "[信心:90] r5"), (1, 3, 1, "[信心:91] r1"), (2, 3, 3, "same"), (None, 1, 1, "[信心:1] n")),
           "judge2": texts((1, 1, 2, "[信心:99999999999] big"), (1, 1, 1, "[信心:86] j2"), (2, 1, 1, "[裁判被拦截] b")),
           "judge3": texts((3, 4, 1, "[信心:-5] low"), (3, 3, 1, "[信心:99999999999] big")),
           "judge4": texts((1, 0, 2, "[信心:90] p"), (3, 0, 1, "[裁判被拦截] p"), (9, 0, 1, "none"))}
    return dict(episodes=eps, labels=labels, ranks=ranks, lines=lines, line_texts=line_texts, texts=own, target="浙江省", province="浙江省", start_year=1997, large=False)


def test_wide_rows_by_windows(spark):
    have = wide_inputs(spark)
    got, want = rows(X.flatten(**have, by_name=True)), rows(X.flatten(**have))
    assert got == want and len(got) == 16


def test_gathered_takes_own_rows_and_parts(spark):
    left = spark.createDataFrame([(1, 1, 5), (1, 1, 6), (2, 1, 7), (None, 1, 8)], "name long, k long, v int")
    part = spark.createDataFrame([(1, 1, "b"), (1, 1, "a"), (None, 1, "n"), (4, 4, "z")], "name long, k long, t string")
    got = gathered(left, ["name", "k"], [part], {"all": F.collect_list("t"), "most": F.max("v")})
    assert rows(got.withColumn("all", F.sort_array("all"))) == sorted(
        [(1, 1, 5, ["a", "b"], 6), (1, 1, 6, ["a", "b"], 6), (2, 1, 7, [], 7), (None, 1, 8, None, None)], key=str)


def test_places_by_lookup(spark):
    """What a chain of comparisons in the order of the entries says."""
    def province(t):
        s = t.strip()
        near = [f for k, f in K.PROVINCE_MAP.items() if s.startswith(k) or f.startswith(s)]
        return "" if t == "" else s if s in K.PROVINCE_MAP.values() else K.PROVINCE_MAP.get(s, near[0] if near else s)

    def city(t):
        s = t.strip()
        near = [f for k, f in K.CITY_MAP.items() if s.startswith(k)]
        return "" if t == "" else s if s[-1:] in tuple("市区县州盟") else K.CITY_MAP.get(s, near[0] if near else s)

    names = [*K.PROVINCE_MAP, *K.PROVINCE_MAP.values(), *K.CITY_MAP, *K.CITY_MAP.values(), "第三地", "青海", " "]
    texts = sorted({v for n in names for i in range(len(n) + 1) for v in (n[:i], n[:i] + "x", f" {n[:i]}　", n[i:])})
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.p, r.c) for r in df.select("t", T.norm_prov(F.col("t")).alias("p"), T.norm_city(F.col("t")).alias("c")).collect()}
    assert got == {t: (province(t), city(t)) for t in texts}
    # the text is not trimmed again for every name
    assert df.select(T.norm_prov(F.col("t")))._jdf.queryExecution().optimizedPlan().toString().count("trim(") < 10


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_wide_rows_sort_no_lists_twice(spark):
    plan = QF.final_rows(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan


def test_stored_rows_have_plain_positions(spark, tmp_path):
    """Equal rows share a position; one without an order column has none; order is that of the wide numbers."""
    import datetime
    day = datetime.date(2001, 2, 3)
    spark.createDataFrame([(1, 1, 5, 7, 1.0, "A", "O", day), (1, 1, 5, 7, 2.0, "A", "O", day), (1, 2, 1, 1, 3.0, "A", "O", day), (1, 1, 9, 1, 4.0, "A", "O", day),
                           (1, 3, None, 1, 5.0, "A", "O", day), (2, 1, 1, 1, 6.0, "A", "O", day)],
                          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate date"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    with B.written_once(spark, str(tmp_path), False, ("lineitem",)):
        a = B.episodes_a(spark, str(tmp_path)).select("name", "source_line", "k1", "k2", "pos")
        assert a.schema["pos"].dataType.simpleString() == "bigint"
        assert rows(a) == sorted([(1, 1, 5, 7, 2), (1, 1, 5, 7, 2), (1, 2, 1, 1, 4), (1, 1, 9, 1, 3), (1, 3, None, 1, None), (2, 1, 1, 1, 1)], key=str)
