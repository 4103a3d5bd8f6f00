"""Stored pages: field extraction, candidate links and their scores, names in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinledger import constants as K
from twinledger.functions import text as T
from twinledger.functions.dates import strip

CITATION = r"\[\d+(?:-\d+)?\]"


def plain_text(html: Column) -> Column:
    return strip(F.regexp_replace(html, "<[^>]*>", ""))


def page_fields(pages: DataFrame, key: str = "page_id", html: str = "html", min_chars: int = 10, max_paragraphs: int | None = None) -> DataFrame:
    """(key, title, paragraphs): title and the paragraphs of at least ``min_chars`` characters, citation marks removed; all
    of them, unless ``max_paragraphs`` asks for the first ones."""
    title = plain_text(F.regexp_extract(F.col(html), r"(?is)<title[^>]*>(.*?)</title>", 1))
    paras = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<p>(.*?)</p>"), 1)
    clean = F.filter(F.transform(paras, lambda p: F.regexp_replace(plain_text(p), CITATION, "")), lambda p: F.length(p) >= min_chars)
    kept = clean if max_paragraphs is None else F.slice(clean, 1, max_paragraphs)
    return pages.select(key, title.alias("title"), kept.alias("paragraphs"))


def links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, pos, href, text) of every link with text longer than two characters."""
    all_ = F.regexp_extract_all(F.col(html), F.lit(r'(?is)(<a\s[^>]*href="[^"]*"[^>]*>.*?</a>)'), 1)
    x = pages.select(key, F.posexplode(all_).alias("pos", "a"))
    return x.select(key, "pos", F.regexp_extract("a", r'(?is)href="([^"]*)"', 1).alias("href"),
                    plain_text(F.regexp_replace("a", "(?is)^<a[^>]*>", "")).alias("text")).filter(F.length("text") > 2)


def candidate_links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Links of an ambiguous page: those marked as disambiguation, else those to numbered items."""
    marked = F.contains(F.col("href"), F.lit("disambiguation"))
    item = F.col("href").rlike(r"^/item/.+/\d+")
    ambiguous = pages.filter(F.contains(F.col(html), F.lit("多义词")) | F.contains(F.col(html), F.lit("义项")))
    # one page is one row, so its links are filtered as an array inside the row
    l = links(ambiguous, key, html).withColumns({"_m": marked, "_i": item}).filter("_m or _i")
    any_marked = l.filter("_m").select(key).distinct().withColumn("_any", F.lit(True))
    return l.join(any_marked, key, "left").filter(F.col("_m") | F.col("_any").isNull()).select(key, "pos", "href", "text")


def score_candidates(candidates: DataFrame, key: str = "page_id", province: str = "", role: str = "") -> DataFrame:
    """The best candidate per page: keyword count, +5 for the province, +3 for the role; the first wins ties, and with
    no score at all the first candidate is taken."""
    t = F.col("text")
    score = T.count_words(t, K.CANDIDATE_WORDS)
    if province:
        score = score + F.when(F.contains(t, F.lit(province)), 5).otherwise(0)
    if role:
        score = score + F.when(F.contains(t, F.lit(role)), 3).otherwise(0)
    c = candidates.withColumn("score", score)
    best = c.groupBy(key).agg(F.max_by(F.struct("href", "text", "score"), F.struct("score", -F.col("pos"))).alias("b"))
    return best.select(key, F.regexp_replace("b.href", r"\?fromModule=disambiguation", "").alias("href"), "b.text", "b.score")


def table_names(pages: DataFrame, key: str = "page_id", html: str = "html", table_class: str = "wikitable") -> DataFrame:
    """(key, table_no, row_no, name): per row of a list table after its header, the first cell of 2-4 Han characters."""
    tables = F.regexp_extract_all(F.col(html), F.lit(rf'(?is)<table[^>]*class="[^"]*{table_class}[^"]*"[^>]*>(.*?)</table>'), 1)
    x = pages.select(key, F.posexplode(tables).alias("table_no", "t"))
    x = x.select(key, "table_no", F.posexplode(F.regexp_extract_all("t", F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), 1)).alias("row_no", "r")).filter("row_no > 0")
    cells = F.transform(F.regexp_extract_all("r", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), 1), plain_text)
    name = F.try_element_at(F.filter("c", lambda c: c.rlike(r"^[\x{4e00}-\x{9fff}]{2,4}$")), F.lit(1))
    return x.withColumn("c", cells).filter(F.size("c") >= 2).select(key, "table_no", "row_no", name.alias("name")).filter("name is not null")


#: Elements whose text is not part of a page's body, and the elements that carry citation marks.
HIDDEN = ["script", "style", "nav", "header", "footer", "iframe", "aside"]
MARKS = ["sup", "span", "a"]
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": " ", "&amp;": "&"}


def block(word: str) -> str:
    """Pattern of a div with the word in its class, up to the first end of a div; its body is group 1."""
    return rf"""(?is)<div[^>]*class=["'][^"']*{word}[^"']*["'][^>]*>(.*?)</div>"""


def _pieces(html: Column) -> Column:
    """The texts between tags, without the empty ones."""
    def piece(text: Column) -> Column:
        text = strip(text)
        for entity, char in ENTITIES.items():
            text = F.replace(text, F.lit(entity), F.lit(char))
        return text

    return F.filter(F.transform(F.split(html, "<[^>]*>"), piece), lambda t: t != "")


def _joined(html: Column, sep: str = "") -> Column:
    return F.array_join(_pieces(html), sep)


def extract_pages(pages: DataFrame, key: str = "page_id", html: str = "html", name: str | None = None) -> DataFrame:
    """(key, text): the biography text of each page in sections: title (if it has the name), summary, info box,
    paragraphs of the content, tables headed by words of tenure.

    Pages without such paragraphs give those of their ``p``, ``li``, ``td`` and ``dd`` that hold a year or a role.  Marks of
    citations go.  Paragraph divs are made flat first; a block ends at the first end of a div after that.  A missing page
    has an empty text; nothing is cut at a length.
    """
    body = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), "(?s)<!--.*?-->", "")
    for tag in HIDDEN:
        body = F.regexp_replace(body, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    for tag in MARKS:
        body = F.regexp_replace(body, rf"""(?is)<{tag}\s[^>]*class=["'][^"']*(?:lemmaref|reference)[^"']*["'][^>]*>.*?</{tag}\s*>""", "")
    x = pages.select(key, (F.col(name) if name else F.lit("")).alias("_name"), F.regexp_replace(body, block("para"), '<p class="para">$1</p>').alias("_h"))
    h = F.col("_h")
    cited = lambda t: F.regexp_replace(t, CITATION, "")
    blocks = lambda word: F.array_join(F.regexp_extract_all(h, F.lit(block(word)), F.lit(1)), "<br>")
    content = F.regexp_extract(h, r"""(?is)<div[^>]*class=["'][^"']*j-lemma-content[^"']*["'][^>]*>(.*)$""", 1)
    own = F.transform(F.regexp_extract_all(content, F.lit('(?is)<p class="para">(.*?)</p>'), F.lit(1)), lambda t: cited(_joined(t)))
    loose = F.transform(F.regexp_extract_all(h, F.lit(r"(?is)<(?:p|li|td|dd)(?:\s[^>]*)?>(.*?)</(?:p|li|td|dd)>"), F.lit(1)), lambda t: _joined(t))
    x = x.select(key, "_name", "_h",
                 _joined(F.regexp_extract(h, r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("_title"),
                 cited(_joined(blocks("lemmasummary"))).alias("_summary"),
                 _joined(blocks("(?:basicinfo|j-basic-info)"), " | ").alias("_info"),
                 F.filter(own, lambda t: F.length(t) >= 10).alias("_own"),
                 F.filter(loose, lambda t: (F.length(t) >= 10) & (t.rlike(r"(?:19|20)\d{2}") | T.any_word(t, K.ROLE_WORDS))).alias("_loose"),
                 F.regexp_extract_all(h, F.lit(r"(?is)<table[^>]*>(.*?)</table>"), F.lit(1)).alias("_tables"))
    heads = lambda t: F.array_join(F.transform(F.regexp_extract_all(t, F.lit(r"(?is)<th(?:\s[^>]*)?>(.*?)</th>"), F.lit(1)), lambda t: _joined(t)), "")
    tables = F.filter("_tables", lambda t: T.any_word(heads(t), K.TENURE_HEADER_WORDS))
    paras = F.when(F.size("_own") > 0, F.col("_own")).otherwise(F.col("_loose"))
    section = lambda head, text: F.concat(F.lit(f"=== {head} ===\n"), text)
    parts = F.array(
        F.when((F.col("_title") != "") & F.contains("_title", F.coalesce("_name", F.lit(""))), section("词条标题", F.col("_title"))),
        F.when(F.length("_summary") > 20, section("人物简介", F.col("_summary"))),
        F.when(F.length("_info") > 20, section("基本信息", F.col("_info"))),
        F.when(F.size(paras) > 0, section("履历段落", F.array_join(paras, "\n"))))
    return x.select(key, F.array_join(F.concat(parts, F.transform(tables, lambda t: section("履历表格", _joined(t, "\t")))), "\n\n").alias("text"))
