"""Name lists: consolidation over sections and sources, preferences, coverage, cross-checks, list files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinledger import constants as K
from twinledger.functions import dates as D


def consolidate(entries: DataFrame, key: str = "province", city_rule: bool = False) -> DataFrame:
    """One row per (list, name): role text, dates of the first entry, ``needs_check`` false.

    ``entries`` has key, role_kind (governor or secretary), ord, name, acting, start, end, gov_title, sec_title.
    Governors come first.  A name keeps the role of its first entry; being a secretary too adds the secretary title
    once.  Under the city rule every further governor entry adds its title again.  All of it follows from counts and
    first entries, so a name's entries are never collected.
    """
    order = F.struct((F.col("role_kind") != "governor").cast("int").alias("s"), F.col("ord"))
    is_gov = F.col("role_kind") == "governor"
    g = entries.groupBy(key, "name").agg(
        F.min_by(F.struct("start", "end", "acting", "gov_title", "sec_title"), order).alias("f"),
        F.count_if(is_gov).alias("n_gov"), F.count_if(~is_gov).alias("n_sec"))
    gov_role = F.concat(F.when(F.col("f.acting"), "代").otherwise(""), F.col("f.gov_title"))
    if city_rule:
        gov_role = F.concat(gov_role, F.expr("repeat(concat('/', f.gov_title), cast(n_gov - 1 as int))"))
    also = (F.col("n_sec") > 0) & ~F.contains(F.col("f.gov_title"), F.lit("书记"))
    role = F.when(F.col("n_gov") == 0, F.col("f.sec_title")).otherwise(
        F.concat(gov_role, F.when(also, F.concat(F.lit("/"), F.col("f.sec_title"))).otherwise("")))
    return g.select(key, "name", role.alias("role"), F.col("f.start").alias("start"), F.col("f.end").alias("end"),
                    F.lit(False).alias("needs_check"))


def active_after(entries: DataFrame, year: int | None) -> DataFrame:
    """Entries whose end year is at least ``year``; open and unreadable ends pass."""
    if year is None:
        return entries
    end_year = D.to_int(F.element_at(F.split(F.col("end"), r"\."), 1))
    return entries.filter((F.col("end") == K.OPEN_END) | F.coalesce(end_year >= year, F.lit(True)))


def started_after(entries: DataFrame, year: Column) -> DataFrame:
    """Entries whose start year is at least ``year`` (null: no limit); unreadable starts pass."""
    y = D.to_int(F.element_at(F.split(F.col("start"), r"\."), 1))
    return entries.filter(year.isNull() | F.coalesce(y >= year, F.lit(True)))


def only(entries: DataFrame, name) -> DataFrame:
    """The entries of one name; raises when there is none."""
    out = entries.filter(F.col("name") == name)
    if out.isEmpty():
        raise ValueError(f"{name} is not on the list")
    return out


def consolidate_sources(sources: list[DataFrame]) -> DataFrame:
    """Union of lists: attributes of the first entry, the sources of a name, and whether it needs a check.

    A name on one list only, or marked by any list, needs a check.
    """
    u = None
    for i, s in enumerate(sources):
        s = s.withColumn("_list", F.lit(i))
        u = s if u is None else u.unionByName(s)
    order = F.struct("_list", "ord")
    g = u.filter(F.coalesce("name", F.lit("")) != "").groupBy("name").agg(
        F.min_by(F.struct("role", "start_year", "end_year"), order).alias("f"),
        F.sort_array(F.collect_set("source")).alias("sources"), F.count(F.lit(1)).alias("mentions"),
        F.max(F.coalesce("needs_check", F.lit(False))).alias("marked"))
    return g.select("name", "f.role", "f.start_year", "f.end_year", F.array_join("sources", ",").alias("sources"), "mentions",
                    (F.col("marked") | (F.size("sources") == 1)).alias("needs_check"))


def prefer_source(first: DataFrame, second: DataFrame, key: str = "province", enough: int = 5) -> DataFrame:
    """Rows of the first source where it has ``enough`` entries for the key, else those of the second."""
    good = first.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= enough).select(key)
    return first.join(good, key, "left_semi").withColumn("source", F.lit("first")).unionByName(
        second.join(good, key, "left_anti").withColumn("source", F.lit("second")))


def coverage(keys: DataFrame, governors: DataFrame, secretaries: DataFrame, key: str = "province", enough: int = 5) -> DataFrame:
    """Counts per key and a total row (key null), with the complete flags as 0/1 (their sum in the total row)."""
    g = governors.groupBy(key).agg(F.count(F.lit(1)).alias("governors"))
    s = secretaries.groupBy(key).agg(F.count(F.lit(1)).alias("secretaries"))
    j = keys.select(key).join(g, key, "left").join(s, key, "left").na.fill(0, ["governors", "secretaries"]).withColumn(
        "complete", ((F.col("governors") > 0) & (F.col("secretaries") >= enough)).cast("int"))
    return j.rollup(key).agg(F.sum("governors").alias("governors"), F.sum("secretaries").alias("secretaries"),
                             F.sum("complete").alias("complete"))


def cross_check(a: DataFrame, b: DataFrame, key: str = "name") -> DataFrame:
    """Names on one list only, with the side that has them."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return left.join(right, key, "left_anti").withColumn("only_in", F.lit("a")).unionByName(
        right.join(left, key, "left_anti").withColumn("only_in", F.lit("b")))


def list_lines(entries: DataFrame, key: str = "province") -> DataFrame:
    """Body of a list file per (key, role_kind), one row whatever its length: entries by start, unknown starts last, ties in list order."""
    e = F.struct(F.when(F.coalesce("start", F.lit("")) == "", "9999").otherwise(F.col("start")).alias("s"), F.col("ord").alias("o"),
                 D.format_entry(F.col("name"), F.coalesce("start", F.lit("")), F.coalesce("end", F.lit(""))).alias("l"))
    g = entries.groupBy(key, "role_kind").agg(F.sort_array(F.collect_list(e)).alias("_e"))
    return g.select(key, "role_kind", F.lit(0).alias("part"), F.array_join(F.transform("_e", lambda x: x["l"]), "\n").alias("body"))


def title_role(title: Column) -> Column:
    """governor, secretary or null from the title of a list of office holders; governor patterns first."""
    def hit(patterns: list[str]) -> Column:
        out = F.lit(False)
        for p in patterns:
            out = out | title.rlike("(?d)" + p)
        return out

    return F.when(hit(K.GOVERNOR_TITLE_PATTERNS), "governor").when(hit(K.SECRETARY_TITLE_PATTERNS), "secretary")


def first_titles(titles: DataFrame, key: str = "province") -> DataFrame:
    """The first title per (key, role) that names the key."""
    t = titles.withColumn("role", title_role(F.col("title"))).filter(F.col("role").isNotNull() & F.contains(F.col("title"), F.col(key)))
    return t.groupBy(key, "role").agg(F.min_by("title", "ord").alias("title"))
