"""Rule-based labels.

The rules come from written guidance that was meant for a reader; only the decidable part is computed and the rest is
left unknown (null, or -1 where the label has that value), never guessed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinledger import constants as K
from twinledger.functions import dates as D, text as T
from twinledger.functions.ordered import CHUNK_ROWS, following

# a rule table is written by people; one of more rules is taken for a mistake
MOST_RULES = 2_000


def classify_by_rules(rows: DataFrame, rules: DataFrame, unit: str = "unit", position: str = "position", level: str | None = None, most: int = MOST_RULES) -> DataFrame:
    """Adds a column for each ``kind`` of the rules: the value of the first rule by ``ord`` that holds, else null.

    ``rules``: kind, ord, value and the patterns level, unit, position, exclude (for the position), null or empty for
    any.  ``level`` names a column of the unit's level; without it, rules that ask for a level do not hold.  Null texts
    count as empty.  Rules are read once, their number is checked, and their patterns become constants of one
    expression, compiled once per task; more than ``most`` are refused.
    """
    found = rules.orderBy("kind", "ord").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} rules")
    texts = {"unit": unit, "position": position, "exclude": position} | ({"level": level} if level else {})
    out = {}
    for r in found:
        hit = F.lit(True)
        for field, pattern in ((f, r[f]) for f in ("level", "unit", "position", "exclude") if r[f]):
            if field not in texts:
                hit = F.lit(False)
                continue
            match = F.coalesce(F.col(texts[field]), F.lit("")).rlike(pattern)
            hit = hit & (~match if field == "exclude" else match)
        out[r["kind"]] = out[r["kind"]].when(hit, r["value"]) if r["kind"] in out else F.when(hit, r["value"])
    return rows.withColumns(out)


def unit_names(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """(unit, names): for distinct texts ``unit``, the rules whose ``unit_name`` they contain, longest first, then by ord.

    A name is found by its rarest two characters: a text is cut into all its pieces of two, which meet the names by
    equality; only then is the whole name looked for.  Names of one character are found by that character.
    """
    def pieces(c: str, least: int) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.char_length(c)), lambda i: F.substr(F.col(c), i, F.lit(2)))
        return F.array_distinct(F.filter(each, lambda p: F.char_length(p) >= least))

    named = rules.filter(F.coalesce("unit_name", F.lit("")) != "")
    keys = F.when(F.char_length("unit_name") == 1, F.array("unit_name")).otherwise(pieces("unit_name", 2))
    piece = named.select("unit_name", "ord", F.explode(keys).alias("piece"))
    common = piece.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    rarest = piece.join(common, "piece").groupBy("unit_name", "ord").agg(F.min_by("piece", F.struct("n", "piece")).alias("piece"))
    known = named.join(rarest, ["unit_name", "ord"])
    cut = texts.filter("unit is not null and unit <> ''").withColumn("piece", F.explode(F.array_distinct(F.concat(pieces("unit", 1), F.split("unit", "")))))
    met = cut.join(known, "piece").filter(F.contains("unit", "unit_name"))
    rule = F.struct((-F.char_length("unit_name")).alias("shorter"), "ord", "unit_name", "tag", "level", "central", "first_year", "last_year")
    return met.groupBy("unit").agg(F.sort_array(F.collect_set(rule)).alias("names"))


def unit_rules(eps: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds unit_tag, unit_level, unit_central: of the rule with the longest name contained in the unit and valid in the start year.

    ``rules``: ord, unit_name, tag, level, central, first_year, last_year (null: no bound).  A rule with a bound does
    not hold without a year.  Names are looked for in distinct units, so work grows with these and with the rules that
    share a piece with them, not with rows times rules.
    """
    year = D.parse_year(F.col("start"))
    valid = lambda r: (r["first_year"].isNull() | F.coalesce(year >= r["first_year"], F.lit(False))) & (r["last_year"].isNull() | F.coalesce(year <= r["last_year"], F.lit(False)))
    j = eps.join(unit_names(eps.select("unit").distinct(), rules), "unit", "left")
    j = j.withColumn("_rule", F.try_element_at(F.filter("names", valid), F.lit(1)))
    return j.select(*[eps[c] if c == "unit" else F.col(c) for c in eps.columns], *[F.col(f"_rule.{c}").alias(f"unit_{c}") for c in ("tag", "level", "central")])


def rule_check(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, violation): one row per broken rule of a final row."""
    unit, flag, org = F.col("unit"), F.col("flag"), F.col("org_tag")
    ok_ranks = [*K.RANKS, K.RANK_NONE, K.RANK_UNKNOWN]
    checks = {
        "city_not_empty": (flag.isin(K.PROVINCE_FLAGS) | org.isin(K.CENTRAL_TAGS)) & (F.col("city") != ""),
        "province_not_full": (F.col("prov") != "") & ~F.col("prov").isin(list(K.PROVINCE_MAP.values())),
        "line_missing": F.coalesce(F.col("source_line"), F.lit(0)) <= 0,
        "rank_not_allowed": ~F.coalesce(F.col("rank"), F.lit("")).isin(ok_ranks),
        "several_units": T.any_word(unit, K.FORBIDDEN_SEPARATORS["unit"]),
    }
    found = F.array_compact(F.array(*[F.when(c, n) for n, c in checks.items()]))
    return rows.select(*keys, F.explode(found).alias("violation"))


def concurrent_flags(eps: DataFrame, line: str = "source_line") -> DataFrame:
    """A deputy secretary becomes the "(governor)" or "(mayor)" variant if the same line also has that post.

    Whether a line has the post is an aggregate per (name, line), so hot lines are combined before they meet.
    """
    has = eps.groupBy("name", line).agg(F.max((F.col("flag") == "省长").cast("int")).alias("_gov"),
                                        F.max((F.col("flag") == "市长").cast("int")).alias("_mayor"))
    has = has.filter("_gov = 1 or _mayor = 1")
    f = F.col("flag")
    new = (
        F.when((f == "省委副书记（非省长）") & (F.col("_gov") == 1), "省委副书记（省长）")
        .when((f == "市委副书记（非市长）") & (F.col("_mayor") == 1), "市委副书记（市长）").otherwise(f)
    )
    return eps.join(has, ["name", line], "left").withColumn("flag", new).drop("_gov", "_mayor")


def backfill_end(eps: DataFrame, large: bool | None = None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """A missing end becomes the start of the next source line that has one."""
    lines = eps.groupBy("name", "source_line").agg(F.min(F.nullif(F.col("start"), F.lit(""))).alias("_start"))
    nxt = following(lines, ["name"], ["source_line"], "_next", F.col("_start"), chunk_rows, large)
    j = eps.join(nxt.select("name", "source_line", "_next"), ["name", "source_line"], "left")
    return j.withColumn("end", F.when(F.coalesce("end", F.lit("")) == "", F.coalesce("_next", F.lit(""))).otherwise(F.col("end"))).drop("_next")



def target_facts(eps: DataFrame, is_target: Column) -> DataFrame:
    """Per person: first and last line with a target post, and the end of the last one."""
    line = F.when(is_target, F.col("source_line"))
    return eps.groupBy("name").agg(
        F.min(line).alias("first_line"), F.max(line).alias("last_line"),
        F.max_by(F.when(is_target, F.col("end")), F.when(is_target, F.struct("source_line", "seq"))).alias("last_end"))


def next_posting(eps: DataFrame, is_target: Column, is_secretary: Column | None = None) -> DataFrame:
    """(name, label): what the posting right after the last target post was.

    Empty: never held it; -1: still in office, or the next level is unknown; 1: a promotion (a secretary post where
    ``is_secretary`` is given, or a level above provincial); 0: same level or lower; 2: nothing follows.  Death in
    office cannot be seen in the rows and is not claimed.  All steps are aggregates per person.
    """
    flagged = eps.withColumns({"_t": is_target, "_s": is_secretary if is_secretary is not None else F.lit(False), "_o": T.rank_ord(F.col("rank"))})
    facts = target_facts(flagged, F.col("_t"))
    later = flagged.join(facts.select("name", "last_line"), "name").filter("source_line > last_line")
    after = later.groupBy("name", "source_line").agg(F.max(F.col("_s").cast("int")).alias("s"), F.min("_o").alias("o"))
    nxt = after.groupBy("name").agg(F.min_by(F.struct("s", "o"), "source_line").alias("n"))
    label = (
        F.when(F.col("last_line").isNull(), "").when(F.col("last_end") == K.OPEN_END, "-1").when(F.col("n").isNull(), "2")
        .when(F.col("n.s") == 1, "1").when(F.col("n.o") <= 2, "1").when(F.col("n.o").isNotNull(), "0").otherwise("-1")
    )
    return facts.join(nxt, "name", "left").select("name", label.alias("label"))


def prior_posting(eps: DataFrame, is_target: Column, target_prov: str) -> DataFrame:
    """(name, label): 1 if any post on the line before the first target post is a provincial body of the province, 0 if
    known to be elsewhere, -1 if there is none or its place is unknown; empty without a target post."""
    facts = target_facts(eps.withColumn("_t", is_target), F.col("_t")).select("name", "first_line")
    before = eps.join(facts, "name").filter("source_line < first_line")
    local = (F.col("prov") == target_prov) & F.col("unit").rlike("省委|省政府|省人大|省政协|自治区")
    per_line = before.groupBy("name", "source_line").agg(F.max(F.coalesce(local, F.lit(False)).cast("int")).alias("l"),
                                                         F.max(((F.col("prov") != "") & F.col("prov").isNotNull()).cast("int")).alias("k"))
    last = per_line.groupBy("name").agg(F.max_by(F.struct("l", "k"), "source_line").alias("p"))
    label = (
        F.when(F.col("first_line").isNull(), "").when(F.col("p").isNull(), "-1").when(F.col("p.l") == 1, "1").when(F.col("p.k") == 1, "0").otherwise("-1")
    )
    return facts.join(last, "name", "left").select("name", label.alias("label"))


def prior_study(eps: DataFrame, is_target: Column, target_prov: str) -> DataFrame:
    """(name, label): 1 if a full-time study row in the province lies before the first target post, else 0."""
    facts = target_facts(eps.withColumn("_t", is_target), F.col("_t")).select("name", "first_line")
    study = F.col("position").rlike("本科生|研究生") & ~F.col("position").rlike("在职") & (F.col("prov") == target_prov)
    hit = eps.filter(study).groupBy("name").agg(F.min("source_line").alias("study_line"))
    j = facts.join(hit, "name", "left")
    return j.select("name", F.coalesce((F.col("study_line") < F.col("first_line")).cast("int"), F.lit(0)).cast("string").alias("label"))
