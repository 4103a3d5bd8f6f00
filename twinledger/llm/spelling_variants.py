"""Spelling variants: words one edit apart, found by comparing dense blocks of words.

A block of words is a matrix of code points, padded to the longer length L of a comparison.  Two words are one insertion,
deletion or replacement apart if their common prefix and common suffix together reach L - 1; for a pair of blocks both
are counted column by column.

Which blocks meet: the edit of a pair is at the place where their common prefix ends, 0 to L - 1.  For an interval
[lo, hi) of places, both words have the same first `lo` and the same last L - hi characters, so blocks are cut from
groups of words that agree in these.  Groups start with the two halves of all places; one that is too large is divided
by halving its interval, down to a single place, where a group holds no more than one word for each character.  A pair
is counted in the one interval in which its place lies.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import cut, utf8

LETTERS = "A-Za-zÀ-ÿ"
#: Distinct words that a task counts before it sends them on.
HELD = 250_000
#: Words of a group that one task takes, of a group that is compared densely, and code points compared at a time.
GROUP, DENSE, CELLS = 50_000, 512, 4_000_000


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typo: int | None = None) -> DataFrame:
    """word, n: runs of letters of all whole texts, A-Z lower-cased, and how often they occur.

    With `typo`, a run loses its character number h % length in a document where h, the crc32 of `<id>:<run>`, is a
    multiple of it; not where the id is null.  A run of one letter that loses it is no word.
    """
    find = re.compile(f"[{LETTERS}]+").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def sent() -> pa.RecordBatch:
            seen.pop("", None)
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), utf8(batch.column("text"))):
                if not text:
                    continue
                own = Counter(find(text.lower().decode()))  # of bytes, lower() changes A-Z alone
                if typo and key is not None:
                    salt = zlib.crc32(f"{key}:".encode())
                    hit = [(w, h) for w in own if (h := zlib.crc32(w.encode(), salt)) % typo == 0]
                    for w, n, k in [(w, own.pop(w), h % len(w)) for w, h in hit]:  # all are taken out before any comes in
                        own[w[:k] + w[k + 1:]] += n
                seen.update(own)
                if len(seen) >= HELD:
                    yield sent()
                    seen.clear()
        yield sent()

    slim = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _agreeing(words: DataFrame, length: Column, lo: Column, hi: Column) -> DataFrame:
    """words with longest, lo, hi and what words of one group share: the first lo and the last longest - hi characters."""
    tail = length - hi
    return words.select("word", "n", length.alias("longest"), lo.alias("lo"), hi.alias("hi"), F.substring("word", F.lit(1), lo).alias("head"),
                        F.when(tail > 0, F.substring("word", F.char_length("word") - tail + 1, tail)).otherwise("").alias("tail"))


SHARED = ["longest", "lo", "hi", "head", "tail"]


def grouped(words: DataFrame, most: int = GROUP) -> DataFrame:
    """word, n, longest, lo, hi, head, tail: every group that a word is in, none with more than `most` words unless its interval is one place."""
    both = words.withColumn("longest", F.explode(F.array(F.char_length("word"), F.char_length("word") + 1)))
    both = both.withColumn("half", F.expr("longest div 2"))
    first = both.withColumn("ends", F.explode(F.array(F.struct(F.lit(0).alias("lo"), F.col("half").alias("hi")), F.struct(F.col("half").alias("lo"), F.col("longest").alias("hi")))))
    rows = _agreeing(first.where("ends.lo < ends.hi"), F.col("longest"), F.col("ends.lo"), F.col("ends.hi"))
    done = None
    while True:
        large = cut(rows.groupBy(*SHARED).agg(F.count("*").alias("held")).where(F.col("held") > most).where("hi - lo > 1").select(*SHARED))
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        rows = cut(rows)
        kept = rows.join(large, SHARED, "left_anti").select(*rows.columns)
        done = kept if done is None else done.unionByName(kept)
        mid = F.expr("(lo + hi) div 2")
        halves = F.explode(F.array(F.struct(F.col("lo").alias("a"), mid.alias("b")), F.struct(mid.alias("a"), F.col("hi").alias("b")))).alias("ends")
        rows = _agreeing(rows.join(large, SHARED, "left_semi").select("word", "n", "longest", halves), F.col("longest"), F.col("ends.a"), F.col("ends.b"))


def _matrix(words: list[str], width: int) -> np.ndarray:
    return np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width)


def _tile(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How long the common prefix of each row of a and each of b is."""
    total = np.zeros((len(a), len(b)), np.int32)
    live = np.ones((len(a), len(b)), bool)
    for k in range(a.shape[1]):
        live &= a[:, k, None] == b[None, :, k]
        if not live.any():
            break
        total += live
    return total


def compare(words: list[str], longest: int, lo: int, hi: int, note) -> None:
    """note(i, count, best) for words that have near ones: how many, and the first of them in the order given.

    The words share their first lo and last longest - hi characters; pairs of at least one word of the longest length
    are compared, and those count whose edit lies in [lo, hi).
    """
    def go(own: list[int], lo: int, hi: int) -> None:
        long = [i for i in own if len(words[i]) == longest]
        if not long or len(own) < 2:
            return
        if len(own) > DENSE and hi - lo > 1:
            mid = (lo + hi) // 2
            for a, b, part in ((lo, mid, lambda w: w[len(w) - longest + mid:]), (mid, hi, lambda w: w[:mid])):
                parts = defaultdict(list)
                for i in own:
                    parts[part(words[i])].append(i)
                for group in parts.values():
                    go(group, a, b)
            return
        short = [i for i in own if len(words[i]) < longest]
        side = max(1, min(DENSE, math.isqrt(CELLS // longest)))
        for x in range(0, len(long), side):
            left = long[x:x + side]
            ahead, back = _matrix([words[i] for i in left], longest), _matrix([words[i][::-1] for i in left], longest)
            for others in (long, short):
                for y in range(0, len(others), side):
                    right = others[y:y + side]
                    prefix = _tile(ahead, _matrix([words[i] for i in right], longest))
                    # where an equal word is met with itself, prefix and suffix are of its whole length
                    suffix = _tile(back, _matrix([words[i][::-1] for i in right], longest))
                    near = (prefix + suffix >= longest - 1) & (prefix < longest) & (prefix >= lo) & (prefix < hi)
                    for matrix, of, to in ((near, left, right), (near.T, right, left))[:1 + (others is short)]:
                        count = matrix.sum(1)
                        for r in np.flatnonzero(count):
                            note(of[r], int(count[r]), to[int(matrix[r].argmax())])

    go(list(range(len(words))), lo, hi)


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, form, form_n for words that have near ones: how many, and the most frequent (ties: the smallest)."""
    rows = grouped(words)
    buckets = max(1, math.ceil(4 * words.count() / GROUP))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in SHARED] + [("n", "descending"), ("word", "ascending")])
        columns = [table[c].to_pylist() for c in SHARED]
        words, n = table["word"].to_pylist(), table["n"].to_pylist()
        out: dict[int, list] = {}

        def note(i: int, count: int, best: int) -> None:
            had = out.setdefault(i, [0, best])
            had[0] += count
            had[1] = min(had[1], best)

        start = 0
        keys = list(zip(*columns))
        for end in range(1, len(keys) + 1):
            if end == len(keys) or keys[end] != keys[start]:
                if end - start > 1:
                    compare(words[start:end], *keys[start][:3], lambda i, count, best, start=start: note(start + i, count, start + best))
                start = end
        return pa.Table.from_arrays([
            pa.array([words[i] for i in out], pa.string()), pa.array([c for c, _ in out.values()], pa.int64()),
            pa.array([words[b] for _, b in out.values()], pa.string()), pa.array([n[b] for _, b in out.values()], pa.int64())],
            names=["word", "near", "form", "form_n"])

    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(*SHARED), F.lit(buckets)))
    found = dealt.groupBy("bucket").applyInArrow(run, "word string, near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("rank"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", "best.form", (-F.col("best.rank")).alias("form_n"))


def roots_of(links: DataFrame) -> DataFrame:
    """word, root for links (word, form): the end of the forms.  Each round doubles the steps, so rounds are few."""
    links = cut(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def group_variants(words: DataFrame, times: int = 2) -> DataFrame:
    """word, n, n_near, form, form_n, root for distinct words (word, n).

    Near words differ by one inserted, deleted or replaced code point.  A word's form is its near word of largest n
    (ties: the smallest by code points) if that n is at least `times` its own, and null otherwise; root is where forms
    lead from the word, itself if it has none.  Words may be of any length; an empty table gives no rows.
    """
    words = cut(words.select("word", "n"))
    found = words.join(near_words(words), "word", "left")
    has = F.col("form_n") >= times * F.col("n")
    found = cut(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n")))
    return found.join(roots_of(found.where("form is not null")), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3, times: int = 2, typo: int | None = None) -> DataFrame:
    """`group_variants` of the words of all texts with at least min_length code points that occur min_count times.

    Null and empty texts have no words.  Null ids have no typos and repeated rows count as often as they stand there.
    A very long text is held by one task.  Other columns are left out, whatever their names.
    """
    words = count_words(docs, id_col, text_col, typo).where((F.char_length("word") >= min_length) & (F.col("n") >= min_count))
    return group_variants(words, times)
