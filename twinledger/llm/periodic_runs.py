"""Periodic runs of words by sparse diagonals.

A word that also stands `lag` words earlier lies on the diagonal of that lag.  Words come in order; an earlier
occurrence adds one to the match length of its lag's diagonal, and a diagonal that ends long enough is a run.  A
frequent word has many earlier occurrences, so lags are looked at by scale: at scale k a word's earlier occurrence is
the nearest one where the 2**k words up to it are the same, and counts if its lag is in (2**(k-1), 2**k].

Nothing is lost by that.  A run is at least four periods long.  Let q be its smallest period, 2**(k-1) < q <= 2**k:
blocks of 2**k words, at least q and less than 2q, fit in it twice over, and two equal blocks in it are a multiple of q
apart; so the nearest earlier occurrence is q words back for every block but those that reach over the run's start.
For the same reason a lag seen in a run is its smallest period.  Each word takes one step a scale, and scales end where
no block repeats: n log n steps for a text of n words, however often they repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import slices

#: Words that a task holds at a time, or one text if that has more.
SLICE = 300_000


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers for equal values, the order that sorts them (earlier places first), and how many there are."""
    order = np.argsort(values, kind="stable")
    new = np.concatenate([[True], values[order][1:] != values[order][:-1]])
    numbers = np.empty(len(values), np.int64)
    numbers[order] = np.cumsum(new) - 1
    return numbers, order, int(new.sum())


def runs_of(words: np.ndarray, min_length: int = 6, min_periods: int = 4) -> np.ndarray:
    """Rows (start, length, period) of the runs in an array of word numbers, by start, then period; min_periods >= 4."""
    found = []
    at, block, width = np.arange(len(words)), words, 1  # `block` names the `width` words that end at place `at`
    while len(at) > 1:
        block, order, kinds = _numbered(block)
        same = block[order][1:] == block[order][:-1]
        lag = np.zeros(len(at), np.int64)
        lag[order[1:]] = np.where(same, np.diff(at[order]), 0)
        live = (lag > width // 2) & (lag <= width)
        # a diagonal goes on while the next word has the same lag
        go_on = live[1:] & live[:-1] & (lag[1:] == lag[:-1]) & (np.diff(at) == 1)
        starts = np.flatnonzero(live & ~np.concatenate([[False], go_on]))
        ends = np.flatnonzero(live & ~np.concatenate([go_on, [False]]))
        period = lag[starts]
        length = at[ends] - at[starts] + width + period
        enough = length >= np.maximum(min_length, min_periods * period)
        found.append(np.stack([at[ends] + 1 - length, length, period], 1)[enough])
        # a block of twice the width repeats only if both its halves do
        again = np.zeros(len(at), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        at, block = at[again], block[again]
        left = np.searchsorted(at, at - width)
        whole = at[np.minimum(left, len(at) - 1)] == at - width if len(at) else np.zeros(0, bool)
        at, block, width = at[whole], block[left[whole]] * kinds + block[whole], 2 * width
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _structs(runs: np.ndarray, counts: np.ndarray) -> pa.Array:
    fields = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in range(3)], fields=list(RUN))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), fields)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_periods: int = 4) -> DataFrame:
    """Per row: id, n_words, runs (array of start, length, period), n_dropped, collapsed_text.

    Words are runs of anything but ASCII white space, numbered from 0, and are the same if their bytes are.  A run is a
    stretch of words with smallest period q, at least min_length and min_periods (4 or more) times q long, that no word
    beside it goes on with; runs are ordered by start, then period.  Words that a run holds after its first q are
    dropped; the others are joined by one space.  Null, empty and blank texts have no runs and an empty collapsed_text.
    Each row is judged by itself, so null and repeated ids and repeated rows each give their own row.  A very long text
    is held by one task, with some 100 bytes a word.  An empty table gives no rows.  Other columns are left out,
    whatever their names.
    """
    if min_periods < 4:
        raise ValueError("min_periods must be 4 or more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in slices(batches, "id", "text", SLICE):
            flat = [w for _, words in held for w in words]
            sizes = np.array([len(words) for _, words in held], np.int64)
            known = {w: i for i, w in enumerate(set(flat))}
            doc = np.repeat(np.arange(len(held)), sizes)
            # words of different documents have different numbers, so no run crosses from one to the next
            runs = runs_of(doc * len(known) + np.fromiter(map(known.__getitem__, flat), np.int64, len(flat)), min_length, min_periods)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            depth = np.zeros(len(flat) + 1, np.int64)
            np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
            np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
            keep = np.cumsum(depth)[:-1] == 0
            owner = doc[runs[:, 0]]
            counts = np.bincount(owner, minlength=len(held))
            runs[:, 0] -= edges[owner]
            texts, dropped = [], []
            for (_, words), a, b in zip(held, edges, edges[1:]):
                own = keep[a:b]
                left = words if own.all() else list(compress(words, own))
                texts.append(b" ".join(left).decode())
                dropped.append(len(words) - len(left))
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k, _ in held], pa.int64()), pa.array(sizes), _structs(runs, counts), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())],
                names=["id", "n_words", "runs", "n_dropped", "collapsed_text"])

    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    out = slim.mapInArrow(run, "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, n_dropped long, collapsed_text string")
    return out.withColumnRenamed("id", id_col)


def strongest(runs: str = "runs") -> str:
    """SQL: the run with the greatest length / period (ties: smallest start, then period), or null."""
    return (f"aggregate({runs}, cast(null as struct<start:bigint,length:bigint,period:bigint>), (best, r) -> "
            "if(best is null or r.length * best.period > best.length * r.period, r, best))")
