"""Removal of passages that occur earlier: hashes of every window of `width` words, counted in Spark.

A task hashes the windows of a few hundred thousand words at a time by a rolling polynomial, settles repeats among
them on the spot, and sends the rest packed into buckets of the hash.  A bucket finds which windows occur earlier
elsewhere and answers with their starts; starts merge into maximal spans of words, which are cut from the text.
A window that is repeated everywhere thus sends one entry a slice, not one an occurrence.  Entries and answers travel as
packed columns.  With n parts of the documents, a bucket answers once for each of some sqrt(n) groups of parts, and the
answers of some sqrt(n) buckets to one group are dealt out to its parts together: n ** 1.5 rows, not n ** 2.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import Memo, partitions, slices, utf8

BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
SLICE = 400_000
FIRST_ID = np.iinfo(np.int64).min


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of values[i:i+width] for each i at which a window fits; values are unsigned 64-bit."""
    n = len(values)
    if n < width:
        return np.empty(0, np.uint64)
    powers, backs = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, b, np.uint64)]), dtype=np.uint64)
                     for b in (BASE, pow(BASE, -1, 1 << 64)))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * powers, dtype=np.uint64)])
    return mixed((sums[width:] - sums[: n - width + 1]) * backs[: n - width + 1])


def windows(held: list[tuple], word_hash, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, index of document, start) of every window that lies within one document."""
    sizes = np.array([len(w) for _, w in held])
    values = np.fromiter((word_hash(w) for _, words in held for w in words), np.uint64, int(sizes.sum()))
    hashes = rolling(values, width)
    doc = np.repeat(np.arange(len(held)), sizes)[: len(hashes)]
    start = np.arange(len(hashes)) - (np.cumsum(sizes) - sizes)[doc]
    whole = start + width <= sizes[doc]
    return hashes[whole], doc[whole], start[whole]


def _blocks(key: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """(keys, for each column its packed values) with a row for each key; key and then columns are in order."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, int)
    return key[cuts[:-1]], [[pack(_planes(c[a:b])) for a, b in zip(cuts, cuts[1:])] for c in columns]


def _answers(key: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
    """key, ids, places: packed for each key, a part of the documents or a group of parts."""
    order = np.lexsort((starts, ids, key))
    key, (i, s) = _blocks(key[order], ids[order], starts[order].astype(np.int32))
    return [pa.array(key.astype(np.int32)), pa.array(i, pa.binary()), pa.array(s, pa.binary())]


def prime_from(n: int) -> int:
    while any(n % k == 0 for k in range(2, int(n ** 0.5) + 1)):
        n += 1
    return n


SENT = pa.schema([("bucket", pa.int32()), ("family", pa.int32()), ("hashes", pa.binary()), ("ids", pa.binary()), ("places", pa.binary())])
ANSWER = pa.schema([("family", pa.int32()), ("ids", pa.binary()), ("places", pa.binary())])


def repeated_starts(docs: DataFrame, width: int, parts: int) -> DataFrame:
    """part, ids, places: the windows whose words also start earlier; part is the document's id modulo `parts`."""
    buckets = 8 * partitions(docs.sparkSession)
    families = math.isqrt(parts) + 1

    def family(ids: np.ndarray) -> np.ndarray:
        return np.mod(ids, parts) % families

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_hash = words_hashed.__getitem__
        for held in slices(batches, "id", "text", SLICE):
            held = sorted(((FIRST_ID if k is None else k, w) for k, w in held), key=lambda x: x[0])
            hashes, doc, start = windows(held, word_hash, width)
            if not len(hashes):
                continue
            ids = np.array([k for k, _ in held], np.int64)[doc]
            order = np.argsort(hashes, kind="stable")
            h, i, s = hashes[order], ids[order], start[order]
            first = np.concatenate([[True], h[1:] != h[:-1]])
            lead = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
            rest = (i == i[lead]) & (s == s[lead])  # the first, and those of repeated rows, which are as early
            to, *settled = _answers(family(i[~rest]), i[~rest], s[~rest])
            if len(to):
                # any bucket may pass them on
                via = (to.to_numpy() * families + int(h[0] >> np.uint64(33))) % buckets
                yield pa.RecordBatch.from_arrays([pa.array(via.astype(np.int32)), to, pa.nulls(len(to), pa.binary()), *settled], schema=SENT)
            h, i, s = h[rest], i[rest], s[rest]
            bucket = (h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            order = np.lexsort((s, i, bucket))
            key, (hs, packed_ids, places) = _blocks(bucket[order], h[order], i[order], s[order].astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.nulls(len(key), pa.int32()), *(pa.array(c, pa.binary()) for c in (hs, packed_ids, places))], schema=SENT)

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        found = found_in(table)
        return found.append_column("lane", pa.array(np.full(len(found), key[0].as_py() % families, np.int32)))

    def found_in(table: pa.Table) -> pa.Table:
        settled = table.filter(table["hashes"].is_null()).select(ANSWER.names)
        rest = table.filter(table["hashes"].is_valid())
        h = _joined(rest["hashes"], np.uint64)
        order = np.argsort(h)
        same = h[order][1:] == h[order][:-1]
        pick = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(h) else order
        if not len(pick):
            return settled.cast(ANSWER)
        h, i, s = h[pick], _joined(rest["ids"], np.int64)[pick], _joined(rest["places"], np.int32)[pick]
        order = np.lexsort((s, i, h))
        h, i, s = h[order], i[order], s[order]
        first = np.concatenate([[True], h[1:] != h[:-1]])
        lead = np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
        later = (i != i[lead]) | (s != s[lead])
        return pa.concat_tables([settled.cast(ANSWER), pa.Table.from_arrays(_answers(family(i[later]), i[later], s[later]), schema=ANSWER)])

    def deal(table: pa.Table) -> pa.Table:
        ids, starts = _joined(table["ids"], np.int64), _joined(table["places"], np.int32)
        return pa.Table.from_arrays(_answers(np.mod(ids, parts), ids, starts), names=["part", "ids", "places"])

    sent = docs.mapInArrow(send, "bucket int, family int, hashes binary, ids binary, places binary")
    answers = sent.groupBy("bucket").applyInArrow(answer, "family int, ids binary, places binary, lane int")
    return answers.groupBy("family", "lane").applyInArrow(deal, "part int, ids binary, places binary")


#: Shared by all tasks of a Python worker.
words_hashed = Memo(xxhash.xxh3_64_intdigest)


def _planes(a: np.ndarray) -> bytes:
    """The bytes of the numbers, all lowest bytes first: high bytes are mostly zero and pack to nothing."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes()


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return np.concatenate([np.empty(0, kind), *(_whole(unpack(x), kind) for x in column.to_pylist())])


def _whole(data: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 20) -> DataFrame:
    """Per row: id, n_words, n_removed, spans (array of start, end in words), kept_text (words joined by one space).

    A word goes if a window over it has a word sequence that also starts earlier (smaller id, or same id and earlier
    start).  Ids are integers; a null id comes first.  Null and empty texts have no words and stay empty.  Rows that
    repeat an id and a text tie, so neither removes the other's words; rows of one id with different texts share their
    removals.  Equal windows are told by 64-bit hashes of 64-bit word hashes.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # ids often come in steps, which a prime number of parts deals out evenly
    parts = prime_from(8 * partitions(docs.sparkSession))
    found = repeated_starts(slim, width, parts)
    dealt = slim.withColumn("part", F.pmod(F.coalesce("id", F.lit(int(FIRST_ID))), F.lit(parts)).cast("int"))

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids, places = _joined(answers["ids"], np.int64), _joined(answers["places"], np.int32)
        order = np.argsort(ids, kind="stable")
        ids, places = ids[order], places[order]
        n_words, n_removed, spans, kept = [], [], [], []
        for key, text in zip(docs["id"].to_pylist(), utf8(docs["text"])):
            words = text.split() if text else []
            key = FIRST_ID if key is None else key
            a, b = np.searchsorted(ids, key), np.searchsorted(ids, key, "right")
            left, own = words, []
            if b > a:
                at = places[a:b]
                at = at[at + width <= len(words)]
                depth = np.zeros(len(words) + 1, np.int32)
                np.add.at(depth, at, 1)
                np.add.at(depth, at + width, -1)
                gone = np.cumsum(depth) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)))
                own = [{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])]
                left = list(compress(words, ~gone[:-1]))
            n_words.append(len(words))
            spans.append(own)
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left).decode())
        return pa.Table.from_arrays([
            docs["id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.string())],
            names=["id", "n_words", "n_removed", "spans", "kept_text"])

    out = dealt.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(run, "id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string")
    return out.withColumnRenamed("id", id_col)
