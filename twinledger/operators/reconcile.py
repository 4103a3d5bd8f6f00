"""Comparing two versions of the same keyed, ordered records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from twinledger import constants as K
from twinledger.functions import dates as D, text as T
from twinledger.functions.ordered import CHUNK_ROWS, PART_ROWS, has_large_key, joined_text, ordinal

HIGH, MEDIUM = "HIGH", "MEDIUM"


def with_line_keys(eps: DataFrame, line: str = "source_line", pos: str = "pos") -> DataFrame:
    """A missing line means the 1-based position when comparing and 0 when merging: keep both."""
    return eps.withColumns({
        "line_pos": F.coalesce(F.col(line), F.col(pos)).cast("long"),
        "line_zero": F.coalesce(F.col(line), F.lit(0)).cast("long"),
    })


def people_in_both(a: DataFrame, b: DataFrame, name: str = "name") -> DataFrame:
    """Names that occur on both sides."""
    return (
        a.select(name).distinct().withColumns({"_a": F.lit(1), "_b": F.lit(0)})
        .unionByName(b.select(name).distinct().withColumns({"_a": F.lit(0), "_b": F.lit(1)}))
        .groupBy(name).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
        .filter("_a = 1 and _b = 1").select(name)
    )


def sides(a: DataFrame, b: DataFrame, only_shared_people: bool = True) -> DataFrame:
    """All rows of both sides with a ``side`` column, so that one exchange serves both."""
    cols = [F.col("name").alias("name"), "line_pos", "pos", *K.EPISODE_FIELDS]
    u = a.select(*cols).withColumn("side", F.lit("a")).unionByName(b.select(*cols).withColumn("side", F.lit("b")))
    return u.join(people_in_both(a, b), "name", "left_semi") if only_shared_people else u


def both_sides(a: DataFrame, b: DataFrame, large: bool | None = None, chunk_rows: int = CHUNK_ROWS,
               by_name: bool = False) -> DataFrame:
    """Rows of people on both sides with ``rn``, the rank by (unit, pos) inside (name, line, side), and the sizes
    ``n_a`` and ``n_b`` of the line's two sides.

    While people are small, one exchange by name and one sort serve the rank, the sizes, the check that the person is
    on both sides, and the pairing that follows; not even that if both tables lie partitioned ``by_name``.
    """
    keys, line = ["name", "line_pos", "side"], ["name", "line_pos"]
    u = sides(a, b, only_shared_people=False)
    if large is None:
        large = has_large_key(u.select("name"), ["name"], chunk_rows)
    if large:
        shared = u.join(people_in_both(a, b), "name", "left_semi")
        ranked = ordinal(shared, keys, ["unit", "pos"], "rn", chunk_rows)
        return ranked.join(group_sizes(shared), line)
    ranked = ordinal(u if by_name else u.repartition("name"), keys, ["unit", "pos"], "rn", large=False)
    is_a, is_b = F.col("side") == "a", F.col("side") == "b"
    per_line, person = W.partitionBy(*line), W.partitionBy("name")
    return ranked.withColumns({
        "n_a": F.count_if(is_a).over(per_line), "n_b": F.count_if(is_b).over(per_line),
        "_pa": F.max(is_a).over(person), "_pb": F.max(is_b).over(person)}).filter("_pa and _pb").drop("_pa", "_pb")


def group_sizes(u: DataFrame) -> DataFrame:
    """Rows per side of every (name, line): the full outer join of the two sides' groups."""
    return u.groupBy("name", "line_pos").agg(
        F.count_if(F.col("side") == "a").alias("n_a"), F.count_if(F.col("side") == "b").alias("n_b"))


def by_rank(u: DataFrame) -> DataFrame:
    """One row per (name, line, k): the k-th rows of both sides as structs ``a`` and ``b``, null beyond a side's end."""
    fields = F.struct("pos", *K.EPISODE_FIELDS)
    return u.groupBy("name", "line_pos", "rn").agg(
        F.max(F.when(F.col("side") == "a", fields)).alias("a"),
        F.max(F.when(F.col("side") == "b", fields)).alias("b"), F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"))


def pairs(u: DataFrame) -> DataFrame:
    """k-th row of side a with the k-th row of side b of the same line, up to the shorter side."""
    return by_rank(u).filter("a is not null and b is not null")


def date_level(va: Column, vb: Column, open_end: str = "reference", fa: Column | None = None,
               fb: Column | None = None) -> Column:
    """HIGH, MEDIUM or null for two different date texts; ``fa`` and ``fb`` are their fractional years, if at hand."""
    fa, fb = D.frac_year(va) if fa is None else fa, D.frac_year(vb) if fb is None else fb
    gap = F.abs(fa - fb)
    level = (
        F.when(fa.isNull() | fb.isNull(), MEDIUM).when(gap <= K.DATE_TOLERANCE, None)
        .when(gap > K.DATE_HIGH, HIGH).otherwise(MEDIUM)
    )
    if open_end == "equal_if_both_open":
        level = F.when((va == K.OPEN_END) & (vb == K.OPEN_END), None).otherwise(level)
    return level


def _differing(paired: Column | None = None) -> list[Column]:
    """One struct (field_no, field, value_a, value_b) for each field of a pair, null where both texts are the same."""
    rows = []
    for i, f in enumerate(K.EPISODE_FIELDS):
        va, vb = F.coalesce(F.col(f"a.{f}"), F.lit("")), F.coalesce(F.col(f"b.{f}"), F.lit(""))
        row = F.struct(F.lit(i).alias("field_no"), F.lit(f).alias("field"), va.alias("value_a"), vb.alias("value_b"))
        rows.append(F.when(va != vb if paired is None else paired & (va != vb), row))
    return rows


def _with_levels(rows: Column) -> Column:
    """The rows of ``_differing`` that are there, with their level, null where the difference does not count.

    Years and names are read of differing texts alone, and as lambdas: written out for every field they make generated
    code that is too long for the JVM to compile.
    """
    dated = lambda r: r["field"].isin("start", "end")
    years = lambda r: [F.when(dated(r), D.frac_year(r[f"value_{s}"])).alias(f"f{s}") for s in "ab"]

    def level(r: Column, x: Column) -> Column:
        return (
            F.when(dated(r), date_level(r["value_a"], r["value_b"], fa=x["fa"], fb=x["fb"]))
            .when(r["field"] == "unit", F.when(T.norm_org(r["value_a"]) != T.norm_org(r["value_b"]), MEDIUM))
            .otherwise(MEDIUM)
        )

    known = F.transform(F.array_compact(rows), lambda r: F.struct(r.alias("r"), *years(r)))
    return F.transform(known, lambda x: F.struct(
        *[x["r"][c].alias(c) for c in ("field_no", "field", "value_a", "value_b")], level(x["r"], x).alias("level")))


def field_diffs(p: DataFrame) -> DataFrame:
    """One row per differing field of each pair."""
    rows = F.filter(_with_levels(F.array(*_differing())), lambda r: r["level"].isNotNull())
    return p.select("name", F.col("line_pos").alias("source_line"), F.col("rn"), F.col("a.unit").alias("unit"), F.inline(rows)
                    ).withColumn("scope", F.lit("episode_field"))


def group_diffs(u: DataFrame, large: bool | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Lines whose two sides differ in size (episode_split) or that exist on one side only (episode_missing).

    Each side is written ``unit position; unit position; ...`` in arrival order; only rows of such lines are put in
    order.  A line is one row whatever its size (``part`` 0); ``part_rows`` only bounds what one task puts in order.
    """
    rows = u.filter("n_a <> n_b")
    text = F.concat(F.coalesce("unit", F.lit("")), F.lit(" "), F.coalesce("position", F.lit("")))
    texts = joined_text(rows, ["name", "line_pos", "side", "n_a", "n_b"], ["pos"], text, "; ", "desc", part_rows, large)

    def side(s: str) -> Column:
        every = F.sort_array(F.collect_list(F.when(F.col("side") == s, F.struct("part", "desc"))))
        return F.array_join(F.transform(every, lambda p: p["desc"]), "; ")

    j = texts.groupBy("name", "line_pos", "n_a", "n_b").agg(side("a").alias("da"), side("b").alias("db"))
    split = (F.col("n_a") > 0) & (F.col("n_b") > 0)

    def shown(n: str, d: str) -> Column:
        return (
            F.when(split, F.concat(F.col(n).cast("string"), F.lit("条: "), F.col(d)))
            .when(F.col(n) == 0, K.NONE_MARK).otherwise(F.col(d))
        )

    return j.select(
        "name", F.col("line_pos").alias("source_line"), F.lit(0).alias("part"),
        F.when(split, "episode_split").otherwise("episode_missing").alias("scope"),
        F.when(split, "拆分方式").when(F.col("n_a") == 0, "LLM1缺失").otherwise("LLM2缺失").alias("field"),
        shown("n_a", "da").alias("value_a"), shown("n_b", "db").alias("value_b"), F.lit(MEDIUM).alias("level"))


def diff_episodes(a: DataFrame, b: DataFrame, large: bool | None = None, chunk_rows: int = CHUNK_ROWS,
                  part_rows: int = PART_ROWS) -> DataFrame:
    """All differences of two episode tables: fields, split lines, missing lines."""
    u = both_sides(a, b, large, chunk_rows)
    fields, groups = diff_parts(pairs(u), u, large, part_rows)
    return fields.unionByName(groups)


def diff_parts(p: DataFrame, u: DataFrame, large: bool | None = None, part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame]:
    """The differences of the fields of the pairs ``p``, and those of the lines of ``u``, the rows of both sides."""
    fields = field_diffs(p).withColumn("part", F.lit(0)).drop("field_no")
    groups = group_diffs(u, large, part_rows).withColumns(
        {"rn": F.lit(None).cast("long"), "unit": F.lit(None).cast("string")})
    return fields, groups.select(*fields.columns)


def verdict(high: Column, medium: Column) -> Column:
    return (
        F.when((high >= 2) | ((high >= 1) & (medium >= 2)), "MAJOR_CONFLICT")
        .when((high >= 1) | (medium >= 2), "NEEDS_REVIEW").otherwise("PASS")
    )


def summarize(people: DataFrame, diffs: DataFrame, rank_rule: bool = False) -> DataFrame:
    """(name, high_count, medium_count, verdict) for every compared person, also those without differences."""
    if "part" in diffs.columns:
        diffs = diffs.filter("part = 0")
    counted = (
        people.select("name", F.lit(None).cast("string").alias("level"))
        .unionByName(diffs.select("name", "level")).groupBy("name").agg(
            F.count_if(F.col("level") == HIGH).alias("high_count"),
            F.count_if(F.col("level") == MEDIUM).alias("medium_count"))
    )
    v = verdict(F.col("high_count"), F.col("medium_count"))
    if rank_rule:
        v = F.when(F.col("high_count") + F.col("medium_count") > 0, "NEEDS_REVIEW").otherwise("PASS")
    return counted.withColumn("verdict", v)


def summarize_episodes(u: DataFrame) -> DataFrame:
    """What ``summarize`` says of ``diff_episodes``, from the rows of ``both_sides`` alone.

    Levels are counted inside each pair, and a line whose sides differ in size counts once, at its first rank; no
    difference is written out.  All of it follows the partitioning by person.
    """
    rows = F.array(*_differing(F.col("a").isNotNull() & F.col("b").isNotNull()))
    p = by_rank(u).select("name", F.transform(_with_levels(rows), lambda r: r["level"]).alias("levels"),
                          F.when((F.col("rn") == 1) & (F.col("n_a") != F.col("n_b")), 1).otherwise(0).alias("uneven"))
    found = lambda level: F.size(F.filter("levels", lambda x: x == level))
    counted = p.groupBy("name").agg(
        F.sum(found(HIGH)).alias("high_count"), F.sum(found(MEDIUM) + F.col("uneven")).alias("medium_count"))
    return counted.withColumn("verdict", verdict(F.col("high_count"), F.col("medium_count")))


def run_summary(summary: DataFrame) -> DataFrame:
    return summary.groupBy("verdict").agg(F.count(F.lit(1)).alias("people"))


def last_by_index(df: DataFrame, columns: list[str], idx: str = "episode_idx") -> DataFrame:
    """One row per (name, index): the last of duplicates by ``pos``.  A missing index is 0."""
    return (
        df.withColumn(idx, F.coalesce(F.col(idx), F.lit(0)))
        .groupBy("name", idx).agg(F.max_by(F.struct(*columns), F.col("pos")).alias("r"))
        .select("name", idx, *[F.col(f"r.{c}").alias(c) for c in columns])
    )


def by_index(a: DataFrame, b: DataFrame, fields: list[str], idx: str = "episode_idx",
             context: DataFrame | None = None) -> DataFrame:
    """(name, index, a, b, in_a, in_b): on each side the last of duplicates by ``pos``.  A missing index is 0.

    One union and one aggregate with map-side combining.  Comparing and merging the same two tables take the same rows,
    so inside one query the second finds the exchange of the first.  ``context`` rows travel along as a third side and
    come out as ``c``.
    """
    def side(df: DataFrame, s: str) -> DataFrame:
        return df.select(F.col("name").alias("name"), F.coalesce(F.col(idx), F.lit(0)).alias(idx), "pos", *fields, F.lit(s).alias("side"))

    u = side(a, "a").unionByName(side(b, "b"))
    extra = []
    if context is not None:
        c = context.select("name", F.coalesce("seq", "pos").alias(idx), "pos", "source_line", "unit", "position", "start")
        u = u.unionByName(c.withColumn("side", F.lit("c")), allowMissingColumns=True)
        extra = [_last_of("c", ["source_line", "unit", "position", "start"])]
    wide = u.groupBy("name", idx).agg(
        _last_of("a", fields), _last_of("b", fields), F.max(F.col("side") == "a").alias("in_a"),
        F.max(F.col("side") == "b").alias("in_b"), *extra)
    return wide.filter("in_a or in_b") if context is not None else wide


def _last_of(side: str, fields: list[str]) -> Column:
    mine = F.col("side") == side
    return F.max_by(F.when(mine, F.struct(*fields)), F.when(mine, F.col("pos"))).alias(side)


def _of_shared_people(wide: DataFrame) -> DataFrame:
    """Rows of people that occur on both sides.  A person's indices meet in one window, which spills if it must."""
    person = W.partitionBy("name")
    return wide.withColumns({"_pa": F.max("in_a").over(person), "_pb": F.max("in_b").over(person)}).filter(
        "_pa and _pb").drop("_pa", "_pb")


def _index_diffs(fields: list[str], high: list[str]) -> Column:
    """The differing fields of one row of ``by_index``, with both values and the level."""
    rows = []
    for f in fields:
        va, vb = F.coalesce(F.col(f"a.{f}"), F.lit("")), F.coalesce(F.col(f"b.{f}"), F.lit(""))
        rows.append(F.struct(F.lit(f).alias("field"), va.alias("value_a"), vb.alias("value_b"),
                             F.lit(HIGH if f in high else MEDIUM).alias("level")))
    return F.filter(F.array(*rows), lambda r: r["value_a"] != r["value_b"])


def diff_indexed(a: DataFrame, b: DataFrame, fields: list[str], high: list[str], scope: str,
                 context: DataFrame | None = None, idx: str = "episode_idx") -> DataFrame:
    """Differences of records keyed by (name, index); a missing side counts as empty values.

    ``context`` has one row per (name, seq), where ``seq`` may be missing and is ``pos`` then.
    """
    wide = _of_shared_people(by_index(a, b, fields, idx, context))
    ctx = []
    if context is not None:
        ctx = [F.coalesce("c.source_line", F.lit(0)).alias("source_line"),
               *[F.coalesce(f"c.{c}", F.lit("")).alias(c) for c in ("unit", "position", "start")]]
    return wide.select("name", idx, F.inline(_index_diffs(fields, high)), *ctx).withColumn("scope", F.lit(scope))


def summarize_indexed(a: DataFrame, b: DataFrame, fields: list[str], high: list[str], rank_rule: bool = False,
                      idx: str = "episode_idx") -> DataFrame:
    """What ``summarize`` says of ``diff_indexed``, without writing out the differences."""
    d = F.col("_d")
    wide = by_index(a, b, fields, idx).withColumn("_d", _index_diffs(fields, high))
    n_high = F.size(F.filter(d, lambda r: r["level"] == HIGH))
    counted = wide.groupBy("name").agg(
        F.sum(n_high).alias("high_count"), F.sum(F.size(d) - n_high).alias("medium_count"),
        F.max("in_a").alias("_pa"), F.max("in_b").alias("_pb")).filter("_pa and _pb").drop("_pa", "_pb")
    v = verdict(F.col("high_count"), F.col("medium_count"))
    if rank_rule:
        v = F.when(F.col("high_count") + F.col("medium_count") > 0, "NEEDS_REVIEW").otherwise("PASS")
    return counted.withColumn("verdict", v)


def diff_classes(a: DataFrame, b: DataFrame, fields: list[str] = K.CLASS_FIELDS, context: DataFrame | None = None):
    return diff_indexed(a, b, fields, K.CLASS_HIGH, "classify", context)


def diff_ranks(a: DataFrame, b: DataFrame, context: DataFrame | None = None) -> DataFrame:
    return diff_indexed(a, b, ["rank"], [], "rank", context)


def diff_people(a: DataFrame, b: DataFrame) -> DataFrame:
    """Person-level differences: biography fields, labels with both reasons, and the fell flag.

    Values are text; ``<field>_type`` columns, where present, record what type the value had, and a pair that agrees
    as text but not in type is a difference with ``type_mismatch`` true.
    """
    fa, fb = F.col, lambda c: F.col(f"_b_{c}")
    j = a.join(b.withColumnsRenamed({c: f"_b_{c}" for c in b.columns if c != "name"}), "name")
    rows = []

    def add(scope: str, f: str, level: str, cond: Column, ra: Column, rb: Column, mismatch: Column) -> None:
        rows.append(F.struct(
            F.lit(scope).alias("scope"), F.lit(f).alias("field"), fa(f).alias("value_a"), fb(f).alias("value_b"),
            ra.alias("reason_a"), rb.alias("reason_b"), F.when(cond, level).alias("level"), mismatch.alias("type_mismatch")))

    def typed(f: str) -> Column:
        if f"{f}_type" not in a.columns:
            return F.lit(False)
        return (fa(f) == fb(f)) & (fa(f"{f}_type") != fb(f"{f}_type"))

    empty = F.lit("")
    for f in K.BIO_FIELDS:
        if f in a.columns:
            add("bio", f, HIGH if f in K.BIO_HIGH else MEDIUM, (fa(f) != fb(f)) | typed(f), empty, empty, typed(f))
    for f in K.LABEL_FIELDS:
        if f in a.columns:
            add("label", f, HIGH, (fa(f) != fb(f)) | typed(f), F.coalesce(fa(f"{f}_reason"), empty),
                F.coalesce(fb(f"{f}_reason"), empty), typed(f))
    if "fell" in a.columns:
        add("corruption", "fell", HIGH, (fa("fell") != "") & (fb("fell") != "") & (fa("fell") != fb("fell")),
            empty, empty, F.lit(False))
    return j.select("name", F.inline(F.filter(F.array(*rows), lambda r: r["level"].isNotNull())))


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], rules: dict[str, dict]) -> DataFrame:
    """Generic comparison of two tables with unique ``keys``.

    ``rules`` maps a field to ``{"level": ..., "normalize": fn, "tolerance": (ok, high)}``.  With a tolerance the
    normalised values are numbers: a gap up to ``ok`` is no difference, above ``high`` is HIGH, else MEDIUM.
    Rows present on one side only come out with field ``_missing``.
    """
    a2 = a.select(*keys, F.struct(*rules).alias("_a"))
    b2 = b.select(*keys, F.struct(*rules).alias("_b"))
    j = a2.join(b2, keys, "full_outer")
    gone = F.col("_a").isNull() | F.col("_b").isNull()
    side = F.when(F.col("_a").isNull(), "a").otherwise("b")
    rows = [F.struct(F.lit("_missing").alias("field"), side.alias("value_a"), F.lit(None).cast("string").alias("value_b"),
                     F.when(gone, MEDIUM).alias("level"))]
    for f, rule in rules.items():
        norm = rule.get("normalize", lambda c: c)
        va, vb = F.col(f"_a.{f}"), F.col(f"_b.{f}")
        na, nb = norm(va), norm(vb)
        if "tolerance" in rule:
            ok, high = rule["tolerance"]
            gap = F.abs(na - nb)
            level = F.when(gap > high, HIGH).when(gap > ok, MEDIUM).when(na.isNull() != nb.isNull(), MEDIUM)
        else:
            level = F.when(~na.eqNullSafe(nb), rule.get("level", MEDIUM))
        rows.append(F.struct(F.lit(f).alias("field"), va.cast("string").alias("value_a"),
                             vb.cast("string").alias("value_b"), F.when(~gone, level).alias("level")))
    return j.select(*keys, F.inline(F.filter(F.array(*rows), lambda r: r["level"].isNotNull())))


def apply_corrections(df: DataFrame, keys: list[str], clear_city: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rule-based corrections of gold rows and the log of what changed."""
    org, flag, city = F.col("org_tag"), F.col("flag"), F.col("city")
    new = {
        "org_tag": F.when(org == "国务院组成部门", "国务院及其组成部门").otherwise(org),
        "flag": F.when(flag == "省委常委（其他)", "省委常委（其他）").otherwise(flag),
        "city": F.when(F.lit(clear_city) & (flag.isin(K.PROVINCE_FLAGS) | org.isin(K.CENTRAL_TAGS)), "").otherwise(city),
    }
    fixed = df.withColumns(new)
    log = df.select(*keys, F.inline(F.filter(F.array(*[
        F.struct(F.lit(f).alias("field"), F.col(f).alias("before"), e.alias("after")) for f, e in new.items()]),
        lambda r: r["before"] != r["after"])))
    return fixed, log


def focus(df: DataFrame, lines: list[int], line: str = "source_line") -> DataFrame:
    """Only the records of the given source lines."""
    return df.filter(F.col(line).isin(lines))
