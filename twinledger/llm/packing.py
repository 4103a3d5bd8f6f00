"""Best-fit packing of token pieces into sequences, under several capacities at once.

A piece needs tokens, one document place, and attention (its length squared).  A sequence has a residual capacity of
each.  Pieces go, longest first, to the open sequence that fits under every capacity and is best by score: the largest
weighted dot product of need and residual, or the smallest weighted norm of what would be left.
"""

from __future__ import annotations

import functools
import json
import math
import os
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import Memo, cut
from twinledger.llm.token_counts import byte_of_char

PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])
DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


#: Fixed value: how byte-level vocabularies of this kind split a text.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
SPACE = regex.compile(r"\s")
#: Text bytes that are encoded together.
SLICE = 24 << 20


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    Byte-level splitting always cuts before a single space between two other characters, so texts are taken apart there,
    and each distinct part of a batch is looked up once.  The ids of parts, and of the pieces that new parts split into,
    are remembered.  A text with other white space next to a blank or at an end, or with one of the tokenizer's added
    tokens in it, is encoded whole; so is every text if the tokenizer does more than byte-level splitting.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.pieces = Memo(self._piece, 500_000)
        # the parts of a text that follow a blank, and the one before the first
        self.parts, self.firsts = Memo(lambda w: self._part(" ", w), 1_500_000), Memo(lambda w: self._part("", w), 100_000)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        self.plain = (spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
                      and not split.get("add_prefix_space"))
        self.byte_chars = {b: c for c, b in byte_of_char().items()}

    def _piece(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.byte_chars))]).tobytes()

    def _part(self, blank: str, part: str) -> bytes | None:
        """None if a text that has this part cannot be taken apart."""
        if part.isalpha():
            return self._piece(blank + part)
        if not part or part[0].isspace() or part[-1].isspace() or SPACE.search(part[0] + part[-1]) or any(t in part for t in self.added):
            return None
        return b"".join(map(self.pieces.__getitem__, SPLIT.findall(blank + part)))

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _together(self, texts: pa.Array) -> Iterator[bytes]:
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        known = pa.array(list(map(self.parts.__getitem__, coded.dictionary.to_pylist())), pa.binary())
        firsts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        ids = known.take(coded.indices)
        mask = np.zeros(len(ids), bool)
        mask[firsts] = True
        words = coded.dictionary.take(coded.indices.take(pa.array(firsts))).to_pylist()
        ids = pc.replace_with_mask(ids, pa.array(mask), pa.array(list(map(self.firsts.__getitem__, words)), pa.binary()))
        offsets = pa.array(np.append(firsts, len(ids)).astype(np.int32))
        # a part that is None makes its whole text null
        for text, found in zip(texts, pc.binary_join(pa.ListArray.from_arrays(offsets, ids), b"")):
            yield self.whole(text.as_py()) if found.as_py() is None else found.as_py()

    def batch(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; null counts as empty."""
        texts = pc.fill_null(texts, "")
        if not self.plain or any(" " in t for t in self.added):
            yield from map(self.whole, texts.to_pylist())
            return
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(texts):
            # as many texts as fill a slice, at least one
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + SLICE, "right")))
            if end == start + 1 and sizes[start] - before > SLICE:
                yield self.whole(texts[start].as_py())
            else:
                yield from self._together(texts.slice(start, end - start))
            start = end

    def __call__(self, text: str) -> bytes:
        return next(self.batch(pa.array([text], pa.string())))


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    """One for all tasks of a Python worker, so that what it remembers serves the next task too."""
    return Encoder(path)


def pieces_of(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    A document is its ids and `end_id`; null counts as empty.  Longer documents are cut so that all pieces but the
    first are full.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for key, ids in zip(batch.column(0).to_pylist(), encode.batch(batch.column(1))):
                ids += end
                n = len(ids) // 4
                start, k = 0, 0
                while start < n:
                    length = (n - start) % capacity or capacity
                    part = ids[4 * start: 4 * (start + length)]
                    rows.append((key, k, start, length, zlib.crc32(part), part if with_ids else None))
                    start, k = start + length, k + 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), PIECE)], schema=PIECE)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, DDL)


def best_fit(lengths: np.ndarray, capacity: int, most_docs: int, most_cost: int, weights: Sequence[float], rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece."""
    caps = np.array([capacity, most_docs, most_cost], float)
    w = np.asarray(weights, float)
    left = np.empty((len(lengths), 3))
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    order = np.argsort(-lengths, kind="stable")
    # pieces that fill a sequence leave no choice
    opened = int(np.count_nonzero(lengths == capacity))
    sequence[order[:opened]], offset[order[:opened]] = np.arange(opened), 0
    live = np.empty(0, np.int64)
    for k in order[opened:]:
        need = np.array([lengths[k], 1, lengths[k] ** 2], float)
        rest = left[live] - need
        fits = (rest >= 0).all(axis=1)
        if fits.any():
            at = np.flatnonzero(fits)
            if rule == "dot":
                score = -(w * need / caps * left[live[at]] / caps).sum(axis=1)
            else:
                score = (w * (rest[at] / caps) ** 2).sum(axis=1)
            b = live[at[np.argmin(score)]]
        else:
            b = opened
            left[b] = caps
            opened += 1
            live = np.append(live, b)
        sequence[k], offset[k] = b, capacity - left[b][0]
        left[b] -= need
        if left[b][0] < 1 or left[b][1] < 1 or left[b][2] < 1:
            live = live[live != b]
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = 1024, most_docs: int = 1024, most_cost: int = 1024 * 1024, weights: Sequence[float] = (1.0, 0.001, 0.001),
         rule: str = "norm", group_rows: int = 10_000) -> DataFrame:
    """The pieces with sequence_id and offset.

    Pieces are dealt evenly into groups of about `group_rows`, whatever their documents, and each group is packed on its
    own, which leaves a few sequences a group partly open.  Every piece must fit an empty sequence.
    """
    kept = cut(pieces.select("doc_id", "piece", "start", "length", "ids_crc32"))
    groups = max(1, math.ceil(kept.count() / group_rows))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        sequence, offset = best_fit(table["length"].to_numpy(), capacity, most_docs, most_cost, weights, rule)
        base = table["grp"][0].as_py() << 32
        return table.drop_columns(["grp"]).append_column("sequence_id", pa.array(sequence + base)).append_column("offset", pa.array(offset))

    # the order of rows in a checkpoint is fixed, so a task that runs again deals them out as before
    dealt = kept.withColumn("grp", F.monotonically_increasing_id() % groups)
    return dealt.groupBy("grp").applyInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def sequences(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, little-endian 32-bit, from pieces with ids and their places."""
    keys = ["doc_id", "piece"]
    both = packed.select(*keys, "sequence_id", "offset").join(pieces.select(*keys, "ids"), keys)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return both.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x.ids)).alias("ids"))
