"""Sectioned biography texts: sections, timeline lines, inferred ends, summaries.

A biography is one text cell, so every step works on arrays inside the row: no shuffle, and no key can become hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinledger import constants as K
from twinledger.functions import text as T
from twinledger.functions.dates import strip
from twinledger.functions.text import let

HEADER = r"^===\s*(.+?)\s*===$"


def _next(positions: Column, i: Column, end: Column) -> Column:
    """The position after number ``i`` (0-based), or ``end``."""
    return F.coalesce(F.try_element_at(positions, i + 2), end)


def _index_of(flags: Column) -> Column:
    """1-based positions of the true elements."""
    return F.filter(F.transform(flags, lambda f, i: F.when(f, i + 1)), lambda p: p.isNotNull())


def section_array(text: Column) -> Column:
    """Array of struct(pos, section, body) in text order; sections without lines are left out."""
    lines = F.split(text, "\n")

    def build(ls: Column) -> Column:
        starts = _index_of(F.transform(ls, lambda x: strip(x).rlike("(?Ud)" + HEADER)))
        return let(F.concat(F.array(F.lit(0)), starts), lambda bounds: cut(ls, bounds))

    def cut(ls: Column, bounds: Column) -> Column:
        n = F.size(ls) + 1

        def one(s: Column, i: Column) -> Column:
            body = F.slice(ls, s + 1, F.greatest(_next(bounds, i, n) - s - 1, F.lit(0)))
            title = F.when(s == 0, "_header").otherwise(
                F.regexp_extract(strip(F.try_element_at(ls, F.greatest(s, F.lit(1)))), "(?Ud)" + HEADER, 1))
            return F.struct(i.alias("pos"), title.alias("section"), F.array_join(body, "\n").alias("body"),
                            F.size(body).alias("n_lines"))

        return F.filter(F.transform(bounds, one), lambda x: x["n_lines"] > 0)

    return let(lines, build)


def section_body(sections: Column, name: str) -> Column:
    """Body of the last section with this title, or null."""
    return F.try_element_at(F.filter(sections, lambda x: x["section"] == name), F.lit(-1))["body"]


def split_sections(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, section, body); of equal titles in one text the last wins."""
    last = let(section_array(F.col(text)), lambda s: F.filter(
        s, lambda x: ~F.exists(s, lambda y: (y["section"] == x["section"]) & (y["pos"] > x["pos"]))))
    return df.select(key, F.explode(last).alias("x")).select(
        key, F.col("x.section").alias("section"), F.col("x.body").alias("body"))


def _career_body(sections: Column) -> Column:
    return F.coalesce(F.nullif(section_body(sections, "履历段落"), F.lit("")), section_body(sections, "人物履历"), F.lit(""))


def _summary(sections: Column) -> Column:
    intro = strip(F.coalesce(section_body(sections, "人物简介"), F.lit("")))
    info = F.coalesce(section_body(sections, "基本信息"), F.lit(""))
    return strip(F.concat(intro, F.when(info != "", F.concat(F.lit("\n"), strip(info))).otherwise("")))


def _number_lines(kinds: Column) -> Column:
    """struct(entries, extra) of the classified lines of one text."""

    def with_starts(k: Column, starts: Column) -> Column:
        n = F.size(k) + 1

        def entry(s: Column, i: Column) -> Column:
            block = F.filter(F.slice(k, s, _next(starts, i, n) - s), lambda x: x["k"] != "honor")
            return F.struct((i + 1).cast("int").alias("line_num"),
                            F.array_join(F.transform(block, lambda x: x["t"]), K.IDEOGRAPHIC_SPACE).alias("raw_text"))

        first = F.coalesce(F.try_element_at(starts, F.lit(1)), n)
        extra = F.array_compact(F.transform(k, lambda x, i: F.when((x["k"] == "honor") | (i + 1 < first), x["t"])))
        return F.struct(F.transform(starts, entry).alias("entries"), strip(F.array_join(extra, "\n")).alias("extra"))

    return let(kinds, lambda k: let(_index_of(F.transform(k, lambda x: x["k"] == "career")), lambda st: with_starts(k, st)))


def _with_ends(entries: Column) -> Column:
    """Entries with the start of the next dated entry where they have no end of their own."""
    dated = F.transform(entries, lambda e: F.struct(
        e["line_num"].alias("line_num"), e["raw_text"].alias("raw_text"), T.start_ym(e["raw_text"]).alias("ym"),
        T.has_end(e["raw_text"]).alias("ended")))

    def finish(all_: Column):
        def one(e: Column, i: Column) -> Column:
            # every entry opens with a dated line, so the next entry always has a start
            end = F.when(~e["ended"], T.ym_text(F.try_element_at(all_, i + 2)["ym"]))
            return F.struct(e["line_num"].alias("line_num"), e["raw_text"].alias("raw_text"), end.alias("inferred_end"),
                            F.lit(False).alias("undated"))

        return F.transform(all_, one)

    return let(dated, finish)


def preprocess(df: DataFrame, name: str = "name", text: str = "text") -> DataFrame:
    """One row per person: bio_summary, career_lines, extra_text, total_lines.

    A dated line opens a numbered entry; undated text joins the entry before it; honors and text before any entry go
    to ``extra_text``.  ``inferred_end`` is the start of the next entry unless the line has its own end.
    """
    def classified(body: Column) -> Column:
        lines = F.filter(F.transform(F.split(body, "\n"), lambda x: strip(x)), lambda x: x != "")
        return F.transform(lines, lambda x: F.struct(x.alias("t"), T.line_kind(x, stripped=True).alias("k")))

    def person(sections: Column) -> Column:
        return let(_number_lines(classified(_career_body(sections))), lambda r: F.struct(
            _summary(sections).alias("bio_summary"), _with_ends(r["entries"]).alias("career_lines"), r["extra"].alias("extra_text")))

    # the generator keeps later projections from repeating this work per use
    x = df.select(name, F.inline(F.array(let(section_array(F.col(text)), person))))
    return x.select(name, "bio_summary", "career_lines", "extra_text", F.lit("").alias("corruption_text"),
                    F.size("career_lines").alias("total_lines"))


def career_lines(pre: DataFrame, name: str = "name") -> DataFrame:
    """Flat form: one row per numbered line."""
    return pre.select(name, F.explode("career_lines").alias("c")).select(
        name, "c.line_num", "c.raw_text", "c.inferred_end", "c.undated")


def career_text() -> Column:
    """The numbered text of the ``career_lines`` column."""
    return F.array_join(F.transform(
        "career_lines", lambda c: T.numbered_line(c["line_num"], c["raw_text"], c["inferred_end"])), "\n")


def render_lines(pre: DataFrame, name: str = "name") -> DataFrame:
    """The numbered text of each person."""
    return pre.select(name, "total_lines", career_text().alias("career_text"))


def keyword_flags(df: DataFrame, text: str, short_lists: bool = False) -> DataFrame:
    """Which reference appendices a text calls for."""
    uni = K.UNIVERSITY_WORDS_SHORT if short_lists else K.UNIVERSITY_WORDS
    soe = K.ENTERPRISE_WORDS_SHORT if short_lists else K.ENTERPRISE_WORDS
    return df.withColumns({"needs_university": T.any_word(F.col(text), uni),
                           "needs_enterprise": T.any_word(F.col(text), soe)})


def identity_check(text: Column, province: str = "", city: str = "") -> Column:
    """Place and role words both present; true when no place is given."""
    import re

    if not province and not city:
        return F.lit(True)
    places = []
    if province:
        places += [province, re.sub("(省|自治区|回族自治区|维吾尔自治区|壮族自治区|特别行政区|市)$", "", province)]
    if city:
        places += [city, city + "市"]
    return T.any_word(text, places) & T.any_word(text, K.ROLE_WORDS)


def quality_score(text: Column) -> Column:
    """0-100: section markers plus two points per dated mention, at most 25."""
    score = F.least(F.size(F.regexp_extract_all(text, F.lit(r"(?U)\d{4}[年.．]"), 0)) * 2, F.lit(25))
    for title, points in K.CAREER_MARKERS.items():
        score = score + F.when(F.contains(text, F.lit(f"=== {title} ===")), points).otherwise(0)
    return score.cast("int")


def passes_quality(score: Column) -> Column:
    return score >= K.QUALITY_THRESHOLD


def name_mining(df: DataFrame, key: str, text: str, start_year: int) -> DataFrame:
    """(key, ord, name): 2-4 character Han runs of lines dated at or after ``start_year``, first mention only."""
    lines = F.split(F.col(text), "\n")
    year = lambda x: F.regexp_extract(x, r"((?:19|20)\d{2})", 1).try_cast("int")
    kept = F.filter(F.transform(lines, lambda x: strip(x)), lambda x: F.coalesce(year(x) >= start_year, F.lit(False)))
    runs = F.flatten(F.transform(kept, lambda x: F.regexp_extract_all(x, F.lit(r"[\x{4e00}-\x{9fff}]{2,4}"), 0)))
    names = F.array_distinct(F.filter(runs, lambda x: ~x.isin(K.NAME_STOP_WORDS)))
    return df.select(key, F.posexplode(names).alias("pos", "name")).select(
        key, (F.col("pos") + 1).alias("ord"), "name")
