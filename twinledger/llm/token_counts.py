"""Token counts by greedy longest match, without building the pieces.

The vocabulary is a trie of the pieces that may start a word and one of those that may continue it.  Each node knows
how many pieces to pop and where to go on when the next byte does not match, so a word is read once, byte by byte.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import Memo, utf8

START, CONTINUE, NONE = 0, 1, -1


class Automaton:
    """starts: pieces that begin a word, with `prefix` in front; continues: pieces that follow another piece."""

    def __init__(self, starts: Iterable[bytes], continues: Iterable[bytes], prefix: bytes = b""):
        self.prefix = prefix
        self.goto: dict[int, int] = {}
        self.fail, self.pops = [NONE, NONE], [0, 0]
        ends, depth = set(), [[START, CONTINUE]]
        children: dict[int, list[int]] = {}
        for root, pieces in ((START, starts), (CONTINUE, continues)):
            for piece in pieces:
                u = root
                for c in piece:
                    v = self.goto.get(u << 8 | c)
                    if v is None:
                        v = self.goto[u << 8 | c] = len(self.fail)
                        self.fail.append(NONE)
                        self.pops.append(0)
                        children.setdefault(u, []).append(c)
                    u = v
                if u > CONTINUE:
                    ends.add(u)
        while level := depth.pop():
            below = []
            for u in level:
                for c in children.get(u, ()):
                    v = self.goto[u << 8 | c]
                    below.append(v)
                    self._link(u, c, v, v in ends)
            depth.append(below)

    def _link(self, u: int, c: int, v: int, end: bool) -> None:
        if end:
            self.fail[v], self.pops[v] = CONTINUE, 1
            return
        z, popped = self.fail[u], self.pops[u]
        while z != NONE and (z << 8 | c) not in self.goto:
            popped += self.pops[z]
            z = self.fail[z]
        if z != NONE:
            self.fail[v], self.pops[v] = self.goto[z << 8 | c], popped

    def count(self, word: bytes) -> int:
        """Number of pieces, or -1 if the word has no such split."""
        goto, fail, pops, u, n = self.goto, self.fail, self.pops, START, 0
        for c in self.prefix + word:
            while (v := goto.get(u << 8 | c)) is None:
                n += pops[u]
                u = fail[u]
                if u == NONE:
                    return -1
            u = v
        while u != CONTINUE:
            n += pops[u]
            u = fail[u]
            if u == NONE:
                return -1
        return n


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def vocabulary(path: str) -> tuple[list[bytes], list[bytes], bytes]:
    """(starts, continues, prefix).  A .json file is a byte-level vocabulary, where pieces with a leading space start a
    word; any other file has a piece a line, and ## marks those that continue a word."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            byte = byte_of_char()
            pieces = [bytes(byte[c] for c in p) for p in json.load(f)["model"]["vocab"] if all(c in byte for c in p)]
        pieces = [p for p in pieces if len(p[1:].split()) <= 1 and not p[1:].strip() != p[1:]]
        return [p for p in pieces if p[:1] == b" "], [p for p in pieces if p[:1].strip()], b" "
    with open(path, encoding="utf-8") as f:
        pieces = f.read().split("\n")
    return ([p.encode() for p in pieces if p and not p.startswith("##")], [p[2:].encode() for p in pieces if p.startswith("##")], b"")


@functools.lru_cache(2)
def counter(path: str) -> Memo:
    """One for all tasks of a Python worker."""
    return Memo(Automaton(*vocabulary(path)).count)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", unknown_tokens: int = 1) -> DataFrame:
    """Per row: id, n_words, n_tokens, n_unknown.

    A word that no pieces cover counts as unknown and as `unknown_tokens` tokens.  A null or empty text has no words.
    Rows are counted one by one, so repeated rows stay; other columns are not read.  No shuffle.
    """
    fields = docs.select(F.col(id_col).alias("id")).schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path).__getitem__
        for batch in batches:
            words, tokens, unknown = [], [], []
            for text in utf8(batch.column("text")):
                found = list(map(count, text.split())) if text else []
                missed = found.count(-1)
                words.append(len(found))
                tokens.append(sum(found) + missed * (1 + unknown_tokens))
                unknown.append(missed)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x, pa.int64()) for x in (words, tokens, unknown))],
                                             names=["id", "n_words", "n_tokens", "n_unknown"])

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = slim.mapInArrow(run, f"id {fields.simpleString()}, n_words long, n_tokens long, n_unknown long")
    return out.withColumnRenamed("id", id_col)
