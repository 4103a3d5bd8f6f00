"""SQL fragments for the DuckDB oracles.  Written from the definitions, independent of the Spark expressions."""

from __future__ import annotations

from twinledger import constants as K

WS = "[\\s\\x{3000}]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def to_int(x: str) -> str:
    return f"TRY_CAST({x} AS INTEGER)"


def matches(x: str, p: str) -> str:
    return f"regexp_matches({x}, {q(p)})"


def any_word(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, {q(w)})" for w in words) + ")"


def one_of(x: str, words: list[str]) -> str:
    return f"{x} IN ({', '.join(q(w) for w in words)})"


def norm_org(x: str) -> str:
    s = (f"CASE WHEN NOT starts_with({x}, '中共') AND regexp_matches({x}, '(省|市|区|县|自治州|自治区)委') "
         f"THEN concat('中共', {x}) ELSE {x} END")
    for p, r in [("中共(.+?)委员会$", "中共\\1委"), ("(.+?(?:省|自治区))人民政府", "\\1政府"),
                 ("(.+?(?:市|州|县|区|盟|旗))人民政府", "\\1政府"), ("人民代表大会常务委员会", "人大常委会"),
                 ("人民代表大会", "人大"), ("中国人民政治协商会议(.+?)委员会", "\\1政协")]:
        s = f"regexp_replace({s}, '{p}', '{r}', 'g')"
    return f"replace(replace({strip(s)}, '　', ''), ' ', '')"


def frac_year(x: str) -> str:
    s = strip(x)
    mo = f"split_part({s}, '.', 2)"
    return (f"CASE WHEN {x} IS NULL OR {s} IN ('', 'None', 'nan') THEN NULL ELSE coalesce({to_int(f'split_part({s}, chr(46), 1)')} + "
            f"CAST(CASE WHEN {mo} IN ('00', '') THEN 0 ELSE {to_int(mo)} END AS DOUBLE) / 12, -1.0) END")


def sort_key(x: str) -> str:
    return (f"CAST(CASE WHEN regexp_matches(substring({x}, 1, 4), '^\\d{{4}}$') THEN CAST(substring({x}, 1, 4) AS INT) ELSE 9999 END * 100 + "
            f"CASE WHEN regexp_matches(substring({x}, 6, 2), '^\\d\\d$') THEN CAST(substring({x}, 6, 2) AS INT) ELSE 0 END AS INTEGER)")


def mapped(x: str, table: dict[str, str], default: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + f" ELSE {default} END"


def rank_ord(x: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {q(r)} THEN {i}" for i, r in enumerate(K.RANKS, 1)) + " END"


def rank_name(x: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN {i} THEN {q(r)}" for i, r in enumerate(K.RANKS, 1)) + " ELSE '' END"


def norm_prov(x: str) -> str:
    s = strip(x)
    exact = " ".join(f"WHEN {s} = {q(k)} THEN {q(v)}" for k, v in K.PROVINCE_MAP.items())
    near = " ".join(f"WHEN starts_with({s}, {q(k)}) OR starts_with({q(v)}, {s}) THEN {q(v)}" for k, v in K.PROVINCE_MAP.items())
    return (f"CASE WHEN coalesce({x}, '') = '' THEN '' WHEN {one_of(s, list(K.PROVINCE_MAP.values()))} THEN {s} {exact} {near} ELSE {s} END")


def norm_city(x: str) -> str:
    s = strip(x)
    exact = " ".join(f"WHEN {s} = {q(k)} THEN {q(v)}" for k, v in K.CITY_MAP.items())
    near = " ".join(f"WHEN starts_with({s}, {q(k)}) THEN {q(v)}" for k, v in K.CITY_MAP.items())
    return (f"CASE WHEN coalesce({x}, '') = '' THEN '' WHEN {matches(s, '[市区县州盟]$')} THEN {s} {exact} {near} ELSE {s} END")


def decision_text(model: str, conf: str, reason: str) -> str:
    c = f"TRY_CAST({conf} AS INTEGER)"
    return (f"CASE WHEN {model} = 'blocked' THEN concat('[裁判被拦截] ', {reason}) WHEN {c} IS NULL THEN '' "
            f"ELSE trim(concat('[信心:', {c}, '] ', {reason})) END")


def date_level(va: str, vb: str) -> str:
    fa, fb = frac_year(va), frac_year(vb)
    return (f"CASE WHEN ({fa}) IS NULL OR ({fb}) IS NULL THEN 'MEDIUM' WHEN abs(({fa}) - ({fb})) <= 1 THEN NULL "
            f"WHEN abs(({fa}) - ({fb})) > 2 THEN 'HIGH' ELSE 'MEDIUM' END")


def verdict(h: str, m: str) -> str:
    return (f"CASE WHEN {h} >= 2 OR ({h} >= 1 AND {m} >= 2) THEN 'MAJOR_CONFLICT' WHEN {h} >= 1 OR {m} >= 2 THEN 'NEEDS_REVIEW' ELSE 'PASS' END")


# line shapes without look-ahead
SHAPES = [(n, p.replace("(?!\\d{1,2}月)", "")) for n, p in K.LINE_SHAPES]


def spaced(pattern: str) -> str:
    """The pattern with white space that includes the ideographic space, inside and outside of character classes."""
    return pattern.replace("[，,\\s]", "[，,\\s\\x{3000}]").replace("\\s*", WS + "*")


def shape_hit(x: str, name: str, pattern: str) -> str:
    hit = matches(x, spaced(pattern))
    if name == "year_only":
        hit = f"({hit} AND NOT {matches(x, '^从?[0-9]{4}年[0-9]{1,2}月')})"
    return hit


def line_kind(x: str) -> str:
    s = strip(x)
    dated = " OR ".join(shape_hit(s, n, p) for n, p in SHAPES)
    return (f"CASE WHEN {s} = '' THEN 'blank' WHEN {matches(s, K.HONOR_SHAPE)} THEN 'honor' WHEN {dated} THEN 'career' ELSE 'continuation' END")


def start_part(x: str, part: str) -> str:
    out = "CASE "
    for n, p in SHAPES:
        p2 = spaced(p)
        if part == "y":
            v = f"CAST(regexp_extract({x}, {q(p2)}, 1) AS INTEGER)"
        elif n in K.SHAPES_WITHOUT_MONTH:
            v = "0"
        else:
            m = f"CAST(regexp_extract({x}, {q(p2)}, 2) AS INTEGER)"
            v = f"CASE WHEN {m} BETWEEN 1 AND 12 THEN {m} ELSE 0 END"
        out += f"WHEN {shape_hit(x, n, p)} THEN {v} "
    return out + "END"


def has_end(x: str) -> str:
    return "(" + " OR ".join(shape_hit(x, n, p) for n, p in SHAPES if n in K.SHAPES_WITH_END) + ")"
