"""Language identification by rank-order profiles.

A profile is the list of a text's most frequent letter n-grams (1 to 3 letters, words padded by a blank).  A document
takes the language whose profile is nearest by out-of-place distance: the sum, over the document's n-grams, of the
difference in rank, and the full profile length for those that the language lacks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NOT_LETTERS = regex.compile(r"\P{L}+")
UNDETERMINED = "und"
BLANK = 32
#: N-grams with their counts that a task holds before it adds them up.
HELD = 1 << 19


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and their counts; an n-gram is three 21-bit letters, the last one lowest."""
    padded = f" {NOT_LETTERS.sub(' ', (text or '').lower()).strip()} "
    if padded == "  ":
        return np.empty(0, np.int64), np.empty(0, np.int64)
    c = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    two = c[:-1] << 21 | c[1:]
    three = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[c[1:-1] != BLANK]
    return np.unique(np.concatenate([c[c != BLANK], two, three]), return_counts=True)


def most_frequent(grams: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent, most frequent first, ties by value; grams come in ascending order."""
    return grams[np.argsort(-counts, kind="stable")[:k]]


def added(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of several lists, ascending, and the sums of their counts."""
    grams, at = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
    return grams, np.bincount(at, np.concatenate([c for _, c in found]), len(grams)).astype(np.int64)


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = 400) -> DataFrame:
    """One row for each n-gram of each language's profile: lang, gram, place (from 0).

    Counts cover every row whose text and language are not null.  Each task adds them up first, so what is shuffled is
    some ten thousand counts a task, whatever share of the rows a language has.  A task holds some HELD n-grams, however
    many texts a batch has.
    """

    def rows(held: dict[str, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for lang, found in held.items():
            g, n = added(found)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)], names=["lang", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        n = 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                grams, counts = ngrams(text.as_py())
                if not len(grams):
                    continue
                held.setdefault(lang.as_py(), []).append((grams, counts))
                n += len(grams)
                if n >= HELD:
                    held = {k: [added(v)] for k, v in held.items()}
                    n = sum(len(g) for ((g, _),) in held.values())
                    if 2 * n >= HELD:
                        yield from rows(held)
                        held, n = {}, 0
        yield from rows(held)

    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    counts = known.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    return counts.select("lang", "gram", place.alias("place")).where(F.col("place") < size)


def identify(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 400) -> DataFrame:
    """Per row: id, lang_pred, score.

    score is 1 less the distance over its largest value (0 to 1).  Ties go to the language that comes first by name.
    A null text, one without a letter, or no learned language gives `und` and 0.  Repeated rows stay.  The profiles are
    at most `size` rows a language; they are all that passes through the driver.
    """
    spark = docs.sparkSession
    by: dict[str, dict[int, int]] = {}
    for lang, gram, place in profiles.select("lang", "gram", "place").collect():
        by.setdefault(lang, {})[gram] = place
    names = sorted(by)
    grams = np.array(sorted({g for p in by.values() for g in p}), np.int64)
    places = np.full((len(names), len(grams) + 1), -1, np.int64)
    for i, name in enumerate(names):
        places[i, np.searchsorted(grams, list(by[name]))] = list(by[name].values())
    model = spark.sparkContext.broadcast((names, grams, places))
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, grams, places = model.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(1).to_pylist():
                own = most_frequent(*ngrams(text), size)
                if not len(own) or not names:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                at = np.searchsorted(grams, own)
                at[(at == len(grams)) | (grams[np.minimum(at, len(grams) - 1)] != own)] = len(grams)
                theirs = places[:, at]
                off = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(own)))).sum(axis=1)
                best = int(np.argmin(off))
                langs.append(names[best])
                scores.append(1.0 - float(off[best]) / (size * len(own)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["id", "lang_pred", "score"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return slim.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether a document is kept out of learning; a null id counts as an empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold
