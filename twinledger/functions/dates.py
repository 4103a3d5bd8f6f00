"""Partial dates: ``YYYY.MM``, ``YYYY.00``, ``YYYY`` or an open end.  Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from twinledger import constants as K

FULL_WIDTH = "０１２３４５６７８９"


# every character Python and Java count as white space in a Unicode text
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0e), *range(0x1c, 0x21), 0x85, 0xa0, 0x1680, *range(0x2000, 0x200b), 0x2028,
                                0x2029, 0x202f, 0x205f, 0x3000]))


def strip(c: Column) -> Column:
    """Trim Unicode white space, which plain ``trim`` keeps.  No regular expression: this runs on every value."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def to_int(c: Column) -> Column:
    """Integer or null; accepts full-width digits and blanks around the number."""
    return F.translate(c, FULL_WIDTH + "　", "0123456789 ").try_cast("int")


def two_digits(c: Column) -> Column:
    return F.lpad(c.cast("int").cast("string"), 2, "0")


def norm_date(c: Column, open_words: list[str] = K.OPEN_WORDS_PROVINCE) -> Column:
    s = strip(c)
    year, month = F.regexp_extract(s, r"^(\d{4})\.(\d{1,2})$", 1), F.regexp_extract(s, r"^(\d{4})\.(\d{1,2})$", 2)
    return (
        F.when(s.isin(open_words), F.lit(K.OPEN_END))
        .when(s.rlike(r"^\d{4}\.\d{1,2}$"), F.concat(year, F.lit("."), F.lpad(month, 2, "0")))
        .when(s.rlike(r"^\d{4}$"), F.concat(s, F.lit(".00")))
        .otherwise(s)
    )


def frac_year(c: Column) -> Column:
    """Year as a fraction; null when absent, -1.0 when present but not a date (so also for an open end)."""
    s = strip(c)
    tail = F.substr(s, F.locate(".", s) + F.lit(1))
    month_text = F.when(F.contains(s, F.lit(".")), F.substring_index(tail, ".", 1)).otherwise("")
    year = to_int(F.substring_index(s, ".", 1))
    month = F.when(month_text.isin("00", ""), F.lit(0)).otherwise(to_int(month_text))
    # most texts are plain: they need no trimming
    plain = F.substring(c, 1, 4).cast("int") + F.substring(c, 6, 2).cast("int") / F.lit(12.0)
    return (
        F.when(c.rlike(r"^[0-9]{4}\.[0-9]{2}$"), plain)
        .when(c.isNull() | s.isin("", "None", "nan"), F.lit(None).cast("double"))
        .otherwise(F.coalesce(year + month / F.lit(12.0), F.lit(-1.0)))
    )


def frac_year_legacy(c: Column) -> Column:
    """Two-state variant: -1.0 for anything that is not a date."""
    return F.coalesce(frac_year(c), F.lit(-1.0))


def parse_ym(c: Column) -> Column:
    """struct(y, m): open end is (9999, 12), unknown month is 0, anything else null."""
    s = strip(c)
    y = F.regexp_extract(s, r"^(\d{4})", 1).try_cast("int")
    m = F.regexp_extract(s, r"^\d{4}\.(\d{2})$", 1).try_cast("int")
    return (
        F.when(s == K.OPEN_END, F.struct(F.lit(9999).alias("y"), F.lit(12).alias("m")))
        .when(s.rlike(r"^\d{4}\.\d{2}$"), F.struct(y.alias("y"), m.alias("m")))
        .when(s.rlike(r"^\d{4}$"), F.struct(y.alias("y"), F.lit(0).alias("m")))
    )


def parse_year(c: Column) -> Column:
    return F.regexp_extract(c, r"^(\d{4})", 1).try_cast("int")


CN_DATE = r"(\d{4})年(\d{1,2})?月?(\d{1,2})?日?"


def _cn_ym(c: Column) -> Column:
    month = F.regexp_extract(c, CN_DATE, 2)
    return F.concat(F.regexp_extract(c, CN_DATE, 1), F.lit("."),
                    F.lpad(F.when(month == "", "0").otherwise(month), 2, "0"))


def parse_term_cn(c: Column) -> Column:
    """struct(start, end) of a term written with year and month characters."""
    term = strip(F.replace(F.replace(c, F.lit("任期："), F.lit("")), F.lit("任期:"), F.lit("")))
    # what follows the first date; the separator of highest priority that occurs there starts the rest
    tail = F.regexp_extract(term, r"(?s)^.*?\d{4}年(?:\d{1,2})?月?(?:\d{1,2})?日?(.*)$", 1)
    rest = F.lit(None).cast("string")
    for sep in reversed(["—", "–", "-", "－"]):
        rest = F.when(F.contains(tail, F.lit(sep)),
                      strip(_after(tail, sep))).otherwise(rest)
    has = term.rlike(CN_DATE)
    end = (
        F.when(rest.isNull(), "")
        .when(rest.isin("", K.OPEN_END, "现任"), K.OPEN_END)
        .when(rest.rlike(CN_DATE), _cn_ym(rest))
        .otherwise(K.OPEN_END)
    )
    return F.struct(F.when(has, _cn_ym(term)).otherwise("").alias("start"),
                    F.when(has, end).otherwise("").alias("end"))


def _after(c: Column, sep: str) -> Column:
    """Text after the first ``sep``."""
    return F.substr(c, F.locate(sep, c) + F.lit(1))


def parse_term_list(c: Column) -> Column:
    """struct(start, end) of a term in list form; an acting date in the middle is skipped."""
    t = c
    for old, new in [("年", "."), ("月", ""), ("日", ""), ("—", "-"), ("－", "-")]:
        t = F.replace(t, F.lit(old), F.lit(new))
    t = F.regexp_replace(t, r"(?U)^任期[：:]?\s*", "")
    for era in ['"?文化大革命"?[初前]期', '"?文革"?[初前]期', '"?文化大革命"?', '"?文革"?']:
        t = F.regexp_replace(t, era, "1966")
    dates = F.regexp_extract_all(t, F.lit(r"(\d{4}[.\d]*)"), 1)
    n = F.size(dates)
    still = F.regexp_replace(t, r"(?U)\s+$", "").endswith("-")
    end = F.when(n == 1, K.OPEN_END).when(still, K.OPEN_END).otherwise(F.try_element_at(dates, F.lit(-1)))
    return F.struct(F.when(n == 0, "").otherwise(F.try_element_at(dates, F.lit(1))).alias("start"),
                    F.when(n == 0, "").otherwise(end).alias("end"))


def clean_date(c: Column) -> Column:
    s = F.regexp_replace(strip(c), r"\.+$", "")
    year, month = F.regexp_extract(s, r"^(\d{4})\.(\d{1,2})$", 1), F.regexp_extract(s, r"^(\d{4})\.(\d{1,2})$", 2)
    return (
        F.when((c == "") | (c == K.OPEN_END), c)
        .when(s.rlike(r"^\d{4}$"), F.concat(s, F.lit(".00")))
        .when(s.rlike(r"^\d{4}\.\d{1,2}$"), F.concat(year, F.lit("."), F.lpad(month, 2, "0")))
        .otherwise(s)
    )


def format_entry(name: Column, start: Column, end: Column) -> Column:
    """A null date counts as empty."""
    s, e = clean_date(F.coalesce(start, F.lit(""))), clean_date(F.coalesce(end, F.lit("")))
    term = F.when(s == "", "?-?").otherwise(F.concat(s, F.lit("-"), F.when(e == "", "?").otherwise(e)))
    return F.concat(name, F.lit(", "), term)


def sort_key(c: Column) -> Column:
    """year * 100 + month; 9999 stands for a missing year."""
    year = F.when(F.substring(c, 1, 4).rlike(r"^\d{4}$"), F.substring(c, 1, 4).try_cast("int"))
    month = F.when(F.substring(c, 6, 2).rlike(r"^\d{2}$"), F.substring(c, 6, 2).try_cast("int"))
    return (F.coalesce(year, F.lit(9999)) * 100 + F.coalesce(month, F.lit(0))).cast("int")


def int_or_text(c: Column) -> Column:
    """Canonical integer text when the value is an integer, else the text itself."""
    return F.coalesce(F.trim(c).try_cast("int").cast("string"), c)
