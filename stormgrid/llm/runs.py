"""Periodic runs: stretches of a text that repeat one block of words at least three times, found by seeds on diagonals.

A run of smallest period q has at least ``max(24 - q, 2 * q)`` words that equal the word q places on, and never fewer than
``SEED`` = 16. Lags are taken in classes: 1 to 16, 17 to 32, 33 to 64 and so on; a class with largest lag k is searched with
k-grams. Such a gram is no longer than what every run of the class guarantees, and no shorter than the run's period, so
inside a run its next occurrence stands exactly one period on (two occurrences at a smaller distance would give
the whole run a smaller period). Only neighbouring occurrences are paired, at most one pair a word and class, and a word
repeated a million times costs a million pairs, not their square.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_ranges

SEED = 16               # words of the shortest gram
LEAST = 24              # words of the shortest run
TIMES = 3               # periods of the shortest run
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense rank of every key and how often each rank stands."""
    _, rank, count = np.unique(keys, return_inverse=True, return_counts=True)
    return rank, count


def _extent(ids: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on, forwards or backwards, equal the word ``lag`` places on."""
    n, width, found = len(ids) - lag, 64, 0
    while True:
        lo, hi = (at + found, min(n, at + found + width)) if step > 0 else (max(0, at + 1 - found - width), at + 1 - found)
        if lo >= hi:
            return found
        differ = np.flatnonzero(ids[lo:hi] != ids[lo + lag:hi + lag])
        if len(differ):
            return found + int(differ[0] if step > 0 else hi - lo - 1 - differ[-1])
        found, width = found + hi - lo, 2 * width


def diagonals(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of a sequence whose parts (texts) have no id in common.

    ``longest`` is the number of words of the longest part. The k-grams of a class are ranks of pairs of half as long
    grams, kept only where they stand twice, so ranks are exact and what goes on to the next class shrinks.
    """
    found, k = [], 1
    rank = ids.astype(np.int64)
    keep = np.bincount(rank, minlength=1)[rank] > 1
    at = np.flatnonzero(keep)
    rank = np.where(keep, rank, -1)
    while len(at) and (k <= SEED or TIMES * (k // 2 + 1) <= longest):
        if k >= SEED:
            found += _seeded(ids, rank, at, k)
        at = at[at + k < len(rank)]
        at = at[rank[at + k] >= 0]
        wide, count = _ranked(rank[at] * len(rank) + rank[at + k])
        rank = np.full(len(rank), -1, np.int64)
        keep = count[wide] > 1
        at = at[keep]
        rank[at] = wide[keep]
        k *= 2
    return found


def _seeded(ids, rank, at, k):
    """Runs with a lag of the class that ends at ``k``, from pairs of neighbouring occurrences of one gram."""
    place = at[np.argsort(rank[at], kind="stable")]
    lag = np.diff(place)
    pair = (rank[place[1:]] == rank[place[:-1]]) & (lag <= k) & (lag > (0 if k == SEED else k // 2))
    first, lag = place[:-1][pair], lag[pair]
    order = np.lexsort((first, lag))
    first, lag = first[order], lag[order]
    head = np.flatnonzero(np.r_[True, (np.diff(first) != 1) | (np.diff(lag) != 0)]) if len(first) else []
    tail = [*(np.array(head[1:]) - 1), len(first) - 1]
    covered: dict[int, int] = {}        # per lag the first word behind the diagonals followed so far
    out = []
    for h, t in zip(head, tail):
        q, i, end = int(lag[h]), int(first[h]), int(first[t]) + k
        if end <= covered.get(q, 0):
            continue
        end += _extent(ids, end, q, 1)
        start = i - _extent(ids, i - 1, q, -1)
        covered[q] = end
        length = end - start + q
        if length >= max(LEAST, TIMES * q):
            out.append((start, length, q))
    return out


def text_runs(texts: list[bytes]) -> list[tuple[list[bytes], list[tuple[int, int, int]]]]:
    """Words and runs, by start then period, of every text."""
    words = [t.split() for t in texts]
    ids, size, base = [], [], 0
    for w in words:
        seen: dict[bytes, int] = {}
        ids.append(np.fromiter((seen.setdefault(x, len(seen)) for x in w), np.int64, len(w)) + base)
        base += len(seen)
        size.append(len(w))
    begin = np.cumsum([0, *size])
    runs: list[list] = [[] for _ in texts]
    if base:
        for start, length, q in diagonals(np.concatenate(ids), max(size)):
            of = int(np.searchsorted(begin, start, "right")) - 1
            runs[of].append((start - int(begin[of]), length, q))
    return [(w, sorted(r, key=lambda x: (x[0], x[2]))) for w, r in zip(words, runs)]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of runs and those of each run's first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)``, one row per row of ``docs``: runs by start then period, and the text in
    which every run is cut to its first period.

    Words are what stands between ASCII blanks. A null, empty or blank text has no words, no runs and an empty
    collapsed text. Repeated rows and null ids stay as they are; an empty table gives an empty one; other columns are not
    looked at. Texts are taken whole, a worker holds about 150 bytes a word of the longest. One narrow pass, no shuffle.
    """
    rows_in = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows_in.schema["doc_id"].dataType.simpleString()
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def rows(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).fill_null("").cast(pa.binary())
            for lo, hi in row_ranges(texts):
                found = text_runs(texts[lo:hi].to_pylist())
                yield pa.RecordBatch.from_arrays([
                    ids[lo:hi], pa.array([len(w) for w, _ in found], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for _, rs in found], runs_type),
                    pa.array([collapsed(*x) for x in found], pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return rows_in.mapInArrow(rows, f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")
