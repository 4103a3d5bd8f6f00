"""Text predicates and normalisers as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from twinledger import constants as K
from twinledger.functions.dates import strip, two_digits

FLAGS = "(?Ud)"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where ``body`` uses it inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def any_word(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(w)) for w in words])


def count_words(c: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.contains(c, F.lit(w)).cast("int") for w in words])


# ---- timeline lines

def is_honor(line: Column) -> Column:
    return line.rlike(FLAGS + K.HONOR_SHAPE)


def _dated(line: Column) -> Column:
    # all shapes begin with a year, one of them after 从: most undated lines stop at this first test
    return line.rlike("^从?[0-9０-９]") & reduce(lambda a, b: a | b, [line.rlike(FLAGS + p) for _, p in K.LINE_SHAPES])


def line_kind(line: Column, stripped: bool = False) -> Column:
    """career, honor, continuation or blank.  Honors win over dates."""
    s = line if stripped else strip(line)
    return (
        F.when(s == "", "blank").when(is_honor(s), "honor").when(_dated(s), "career").otherwise("continuation")
    )


def start_ym(line: Column) -> Column:
    """struct(y, m) of the first line shape that matches; month 0 when the shape has none or it is invalid."""
    def one(shape: str, pattern: str) -> Column:
        y = F.regexp_extract(line, FLAGS + pattern, 1).try_cast("int")
        if shape in K.SHAPES_WITHOUT_MONTH:
            m = F.lit(0)
        else:
            m0 = F.regexp_extract(line, FLAGS + pattern, 2).try_cast("int")
            m = F.when(m0.between(1, 12), m0).otherwise(0)
        return F.when(line.rlike(FLAGS + pattern), F.struct(y.alias("y"), m.alias("m")))

    return F.coalesce(*[one(s, p) for s, p in K.LINE_SHAPES])


def has_end(line: Column) -> Column:
    shapes = dict(K.LINE_SHAPES)
    return reduce(lambda a, b: a | b, [line.rlike(FLAGS + shapes[s]) for s in K.SHAPES_WITH_END])


def ym_text(ym: Column) -> Column:
    return F.when(ym["m"] > 0, F.concat(ym["y"].cast("string"), F.lit("年"), two_digits(ym["m"]), F.lit("月"))).when(
        ym.isNotNull(), F.concat(ym["y"].cast("string"), F.lit("年")))


def numbered_line(num: Column, raw: Column, inferred_end: Column) -> Column:
    tail = F.when(inferred_end.isNotNull() & (inferred_end != "") & ~has_end(raw),
                  F.concat(F.lit("  [至"), inferred_end, F.lit("止]"))).otherwise("")
    return F.concat(line_label(num), F.lit(": "), raw, tail)


def line_label(num: Column) -> Column:
    return F.format_string("L%02d", num.cast("int"))


# ---- names of organisations and places

def norm_org(c: Column) -> Column:
    """One spelling per organisation name; the rules apply in this order."""
    s = plain = F.when(F.contains(c, F.lit("委")) & ~c.startswith("中共") & c.rlike("(?:省|市|区|县|自治州|自治区)委"),
                       F.concat(F.lit("中共"), c)).otherwise(c)
    for pattern, new in [
        ("中共(.+?)委员会$", "中共$1委"),
        ("(.+?(?:省|自治区))人民政府", "$1政府"),
        ("(.+?(?:市|州|县|区|盟|旗))人民政府", "$1政府"),
        ("人民代表大会常务委员会", "人大常委会"),
        ("人民代表大会", "人大"),
        ("中国人民政治协商会议(.+?)委员会", "$1政协"),
    ]:
        s = F.regexp_replace(s, pattern, new)
    # each rule needs one of these words: names without any take the short way
    s = F.when(any_word(c, ["委员会", "人民政府", "人民代表大会"]), s).otherwise(plain)
    return F.translate(strip(s), "　 ", "")


def _looked_up(c: Column, known: dict[str, str], prefixes: dict[str, str]) -> Column:
    """``known[text]``, else the entry of the first of ``prefixes`` that the text begins with; null without either.

    Two lookups instead of a branch for each name: a chain of branches trims the text again in every one of them.
    """
    names = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    first = F.regexp_extract(c, "^(" + "|".join(prefixes) + ")", 1)
    return F.coalesce(F.try_element_at(names(known), c), F.try_element_at(names(prefixes), first))


def _known_provinces() -> dict[str, str]:
    """Full names and exact short names, then every beginning of a full name, by the first entry that has it."""
    known = {full: full for full in K.PROVINCE_MAP.values()} | {s: f for s, f in K.PROVINCE_MAP.items() if s not in K.PROVINCE_MAP.values()}
    for full in K.PROVINCE_MAP.values():
        for n in range(len(full)):
            known.setdefault(full[:n], full)
    return known


def norm_prov(c: Column) -> Column:
    """Full province name: itself, the exact short name, else the first entry sharing a prefix, else unchanged."""
    known, s = _known_provinces(), strip(c)
    # a text that begins with a short name and is the beginning of a full one has both in the same entry
    own = F.try_element_at(F.create_map(*[F.lit(x) for kv in known.items() for x in kv]), c)
    return F.when(c.isNull() | (c == ""), "").otherwise(F.coalesce(own, _looked_up(s, known, K.PROVINCE_MAP), s))


def norm_city(c: Column) -> Column:
    s = strip(c)
    return F.when(c.isNull() | (c == ""), "").otherwise(
        F.coalesce(F.when(s.rlike("[市区县州盟]$"), s), _looked_up(s, K.CITY_MAP, K.CITY_MAP), s))


def admin_short(c: Column) -> Column:
    """Place name without its administrative ending; trailing 地 and 区 go too."""
    for pattern in ["(壮族|回族|维吾尔)?自治区$", "特别行政区$", "省$", "[市州盟]$", "[地区]+$"]:
        c = F.regexp_replace(c, pattern, "")
    return c


def is_province(c: Column, compat_guizhou: bool = True) -> Column:
    """Whether the place is a province.  The short form of 贵州 loses its last character, so the default says no."""
    hit = admin_short(c).isin(K.PROVINCE_SHORT)
    return hit if compat_guizhou else hit | c.isin("贵州", "贵州省")


START_OR_BREAK = r"(^|[\s、，,])"


def role_match(position: Column, unit: Column, location: Column, target: Column, role: str) -> Column:
    """Whether a post is the governor, secretary, mayor or city_secretary post of the target place."""
    unit, location = F.coalesce(unit, F.lit("")), F.coalesce(location, F.lit(""))
    short = admin_short(target)
    context = F.concat(unit, location)
    in_place = (context == "") | F.contains(context, short)
    municipal = short.isin(K.MUNICIPALITIES)

    def post(p: str) -> Column:
        return position.rlike("(?U)" + START_OR_BREAK + p)

    def has(c: Column, *words: str) -> Column:
        return any_word(c, list(words))

    if role == "governor":
        hit = ~has(position, "副省长", "副主席", "常务副") & (
            post("(?:代)?省长")
            | (post("(?:代)?主席") & ~has(F.concat(unit, position), "政协", "人大"))
            | (~post("(?:代)?主席") & municipal & ~has(position, "副市长") & post("(?:代)?市长"))
        )
    elif role == "secretary":
        hit = ~has(position, "副书记") & (
            post("省委书记") | post("自治区党委书记") | (municipal & post("市委书记"))
            | (post("书记$") & (has(unit, "省委", "自治区党委") | (municipal & has(unit, "市委"))))
        )
    elif role == "mayor":
        hit = ~has(position, "副市长", "常务副") & post("(?:代)?市长")
    elif role == "city_secretary":
        hit = ~has(position, "副书记", "副市委") & (post("市委书记") | (post("书记$") & has(unit, "市委")))
    else:
        raise ValueError(f"unknown role {role}")
    return F.coalesce((position != "") & in_place & hit, F.lit(False))


# ---- scalar clean-up of values

def eval_norm(c: Column) -> Column:
    """Canonical text for scoring: trimmed, closing brackets repaired, aliases applied."""
    s = strip(F.coalesce(c, F.lit("")))
    repaired = F.regexp_replace(s, "（(" + "|".join(K.EVAL_BRACKETS) + r")\)", "（$1）")
    out = None
    for alias, name in K.EVAL_ALIASES.items():
        hit = repaired == alias
        out = F.when(hit, name) if out is None else out.when(hit, name)
    # every repair and alias has a closing bracket: plain values take the short way
    return F.when(~F.contains(s, F.lit(")")) & ~F.contains(s, F.lit("）")), s).otherwise(out.otherwise(repaired))


def char_set(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(c, ""), lambda x: x != ""))


def set_jaccard(a: Column, b: Column) -> Column:
    """Jaccard of two duplicate-free arrays; two empty ones are alike."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def char_jaccard(a: Column, b: Column) -> Column:
    return set_jaccard(char_set(a), char_set(b))


def enum_guard(c: Column, allowed: list[str], mark: str) -> Column:
    """Prefix a value outside the enumeration; empty stays empty."""
    return F.when((c == "") | c.isin(allowed), c).otherwise(F.concat(F.lit(f"[{mark}]"), c))


def decision_text(judge_model: Column, confidence: Column, reason: Column) -> Column:
    reason = F.coalesce(reason, F.lit(""))
    conf = F.trim(confidence).try_cast("int")
    return (
        F.when(judge_model == "blocked", F.concat(F.lit("[裁判被拦截] "), reason))
        .when(conf.isNull(), "")
        .otherwise(strip(F.concat(F.lit("[信心:"), conf.cast("string"), F.lit("] "), reason)))
    )


# ---- ranks

def rank_ord(c: Column) -> Column:
    """1 (highest) to 10; null for values that are not a level."""
    ordinals = F.create_map(*[F.lit(x) for kv in ((r, i) for i, r in enumerate(K.RANKS, 1)) for x in kv])
    return F.try_element_at(ordinals, strip(c))


def rank_name(o: Column) -> Column:
    return F.try_element_at(F.array(*[F.lit(r) for r in K.RANKS]), o.cast("int"))


def highest_rank(ranks: Column) -> Column:
    return F.coalesce(rank_name(F.array_min(F.transform(ranks, rank_ord))), F.lit(""))
