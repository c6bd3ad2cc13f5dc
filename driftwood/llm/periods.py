"""Periodic runs of words: seed-and-extend on diagonals, one document at a time.

A run is a stretch of consecutive words whose smallest period is q (words q apart are identical), at least
``max(MIN_LENGTH, MIN_EXPONENT * q)`` words long, that no neighbouring word extends. On the diagonal of lag q such a run
is a stretch of at least 3q equal pairs (5 for q = 1). So periods are taken in levels [lo, 3 * lo], the first [1, 5]:
every run of a level holds two occurrences, q apart, of one k-gram with k = 3 * lo >= q (k = 5 at first), and as k >= q
nothing between them equals that k-gram, or the run had a smaller period. The index of a level lists the
document's k-grams; each occurrence is paired with the next one of the same document; neighbouring pairs of one lag are one
seed; a seed is extended both ways over equal words, unless the lag's table says that an earlier extension covered it.
Only stretches of repeated k-grams long enough for the next level go on to it, so ordinary text ends at the first.

Documents are independent: there is no shuffle, and no key, source or group of copies meets in one task.

Defined results: null, empty or white text has no words, no runs and an empty collapsed text; a null id is as any other
id but is never rewritten; repeated rows give a row each; an empty table gives an empty result; columns other than id and text
are ignored. Equal k-grams are found by 64-bit hash, equal words by the words themselves. A very long text costs O(n log n)
time and about a hundred bytes a word, in one task: rows are read a few at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, mix64

MIN_EXPONENT, MIN_LENGTH = 4, 6
#: Words of the shortest k-gram: a run of period 1 has at least MIN_LENGTH - 1 equal pairs.
FIRST_GRAM = MIN_LENGTH - 1
RUNS = "array<struct<start:long,length:long,period:long>>"


class _Ids(dict):
    """Word -> number in order of first sight."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


class _Grams:
    """64-bit hashes of the k-grams of a sequence, made from those of 1, 2, 4, ... words."""

    def __init__(self, ids: np.ndarray):
        self.size, self.hash = 1, mix64(ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))

    def of(self, k: int) -> np.ndarray:
        while self.size * 2 <= k:
            self.hash = self._pair(self.size)
            self.size *= 2
        return self.hash if self.size == k else self._pair(k - self.size)

    def _pair(self, shift: int) -> np.ndarray:
        return mix64(self.hash[:len(self.hash) - shift] * np.uint64(0xD6E8FEB86659FD93) + self.hash[shift:])


def _equal_until(ids: np.ndarray, i: int, lag: int, step: int) -> int:
    """How many pairs (j, j + lag) of equal words follow each other from j = i in direction ``step``."""
    room = len(ids) - lag - i if step > 0 else i + 1
    done, size = 0, 64
    while done < room:
        m = min(size, room - done)
        a = i + done * step
        x, y = (ids[a:a + m], ids[a + lag:a + lag + m]) if step > 0 else (ids[a - m + 1:a + 1], ids[a - m + 1 + lag:a + 1 + lag])
        off = np.flatnonzero(x != y)
        if len(off):
            return done + int(off[0] if step > 0 else m - 1 - off[-1])
        done, size = done + m, size * 4
    return done


def find_runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period."""
    n, runs = len(ids), []
    if n < MIN_LENGTH:
        return runs
    grams, lo, k = _Grams(ids), 1, FIRST_GRAM
    places = np.arange(n - k + 1)
    while True:
        keys = grams.of(k)[places]
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        here, there = places[order[:-1][same]], places[order[1:][same]]
        lag = there - here
        fits = (lag >= lo) & (lag <= k)
        at, lag = here[fits], lag[fits]
        by = np.lexsort((at, lag))
        at, lag = at[by], lag[by]
        head = np.ones(len(at), bool)
        head[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
        covered: dict[int, int] = {}
        for i, q in zip(at[head].tolist(), lag[head].tolist()):
            if i < covered.get(q, 0):
                continue
            end = i + _equal_until(ids, i, q, 1)
            start = i + 1 - _equal_until(ids, i, q, -1)
            covered[q] = end
            length = end - start + q
            if length >= max(MIN_LENGTH, MIN_EXPONENT * q):
                runs.append((start, length, q))
        # what can hold a run of the next level: stretches of places with repeated k-grams
        nxt = k + 1
        if not len(here) or MIN_EXPONENT * nxt > n:
            break
        again = np.unique(np.concatenate([here, there]))
        cut = np.flatnonzero(np.diff(again) != 1) + 1
        edges = np.concatenate([[0], cut, [len(again)]])
        sizes = np.diff(edges)
        again = again[np.repeat(sizes >= MIN_EXPONENT * nxt - k + 1, sizes)]
        lo, k = nxt, 3 * nxt
        places = again[again <= n - k]
        if not len(places):
            break
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay when each run keeps its first period only."""
    step = np.zeros(n + 1, np.int64)
    for start, length, q in runs:
        step[start + q] += 1
        step[start + length] -= 1
    return np.cumsum(step[:-1]) == 0


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a tail that repeats, for one document in ten by the CRC of its id (others: as they are)."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(int(doc_id)).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _runs(rewrite: Callable | None):
    def one(doc_id, text):
        words = text.encode("utf-8", "replace").split() if text else []
        if rewrite is not None:
            words = rewrite(None if pd.isna(doc_id) else doc_id, words)
        number = _Ids()
        runs = find_runs(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        if runs:
            kept = [w for w, k in zip(words, collapse(len(words), runs)) if k]
        return len(words), runs, b" ".join(kept if runs else words).decode()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [one(*x) for x in zip(pdf["doc_id"], pdf["text"])]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "n_words": [x[0] for x in out],
                                "runs": [[dict(zip(("start", "length", "period"), r)) for r in x[1]] for x in out],
                                "collapsed": [x[2] for x in out]})
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: Callable | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and the collapsed text of every row.

    ``rewrite(doc_id, words)`` may change the words (bytes) of a document before they are searched.
    """
    bounded_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInPandas(_runs(rewrite), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def summarize(runs: DataFrame) -> DataFrame:
    """One row per document: number of runs, the run of greatest exponent, digests of the runs and of the collapsed text.

    Of equal exponents the first run in order (start, period) counts; exponents are compared as exact fractions.
    """
    lead = F.reduce("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"),
                    lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r)
                    .otherwise(best))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return runs.withColumn("lead", lead).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("lead.start").alias("start"),
        F.col("lead.length").alias("length"), F.col("lead.period").alias("period"),
        F.expr("1000 * lead.length div lead.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
