"""Exact repeated passages: counts of sampled suffixes (anchors), kept in levels, in place of suffix arrays.

A suffix is indexed where it begins with the least hash of some window (a minimiser): of each WINDOW bytes,
the least of the hashes of their ANCHOR-byte strings marks the suffix that stands for that window. Equal windows
mark equal places, so two long matches always meet at a common anchor, and about one suffix in 65 is
enough. (An array of every suffix would take eight bytes and more for each byte of text.)

All neighbouring windows with one anchor form a run; its entry is (anchor hash, hash of the whole run, place).
No suffix array is built: a level holds anchor hashes with their counts and neither suffixes nor an order, since
only equal beginnings matter. When the last two levels have a similar size they become one, by adding the counts of equal
anchors, so an entry is rewritten a logarithmic number of times; two equal batches always end as one level.

An anchor that occurs once ends there. Of the others, a run that occurs twice is repeated as a whole. Anchors
with several different runs are where matches begin and end: there the windows of one representative of each
run are compared one by one.

Defined results: null text is empty; matches never cross documents; equal texts of WINDOW bytes or more
repeat each other as a whole, whatever their ids (a text is known by a 64-bit hash); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, consecutive, materialize, mix64, release

WINDOW, SPAN = 200, 128
ANCHOR = WINDOW - SPAN + 1
CHUNK = 1 << 20
_POS = np.uint64((1 << 22) - 1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i up to n."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = max(n + 1, CHUNK + 4 * WINDOW)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k:k + 1] = [np.multiply.accumulate(p)]
    return _POWERS[0], _POWERS[1]


def prefix_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = powers(len(raw))
    c = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=c[1:])
    return c, down


def runs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of equal anchors in a buffer of segments: first window, last window, anchor hash, run hash."""
    n = len(raw)
    c, down = prefix_hashes(raw)
    k = mix64((c[ANCHOR:] - c[:-ANCHOR]) * down[:n - ANCHOR + 1])
    v = (k & ~_POS) | np.arange(len(k), dtype=np.uint64)
    s = 1
    while s < SPAN:
        v = np.minimum(v[:-s], v[s:])
        s *= 2
    at = (v & _POS).astype(np.int64)
    seg = np.repeat(np.arange(len(starts)), ends - starts)[:len(at)]
    ok = np.arange(len(at)) + WINDOW <= ends[seg]
    new = ok.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~ok[:-1]
    first = np.flatnonzero(new)
    stop = ok.copy()
    stop[:-1] &= (at[1:] != at[:-1]) | ~ok[1:]
    last = np.flatnonzero(stop)
    anchor = at[first]
    whole = mix64((c[last + WINDOW] - c[first]) * down[first])
    whole = mix64(whole + (anchor - first).astype(np.uint64) * np.uint64(0x51D7) + (last - first).astype(np.uint64))
    return first, last, k[anchor], whole


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def flush() -> pd.DataFrame:
        raw = np.frombuffer(b"".join(x[2] for x in held), np.uint8)
        lens = np.array([len(x[2]) for x in held])
        ends = np.cumsum(lens)
        first, last, key, run = runs(raw, ends - lens, ends)
        seg = np.searchsorted(ends, first, side="right")
        shift = np.array([x[1] for x in held]) - (ends - lens)
        return pd.DataFrame({"rid": np.array([x[0] for x in held])[seg], "at": first + shift[seg],
                             "n": (last - first + 1).astype(np.int32), "key": key.view(np.int64),
                             "run": run.view(np.int64)})

    for pdf in batches:
        for rid, text in zip(pdf["rid"], pdf["text"]):
            raw = text.encode("utf-8", "replace")
            for start in range(0, max(len(raw) - WINDOW + 1, 0), CHUNK):
                part = raw[start:start + CHUNK + WINDOW - 1]
                held.append((rid, start, part))
                size += len(part)
                if size >= CHUNK:
                    yield flush()
                    held, size = [], 0
    if held:
        yield flush()


def _contexts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of runs: all windows of a run lie in its context."""
    for pdf in batches:
        rows = []
        for rid, text, spots in zip(pdf["rid"], pdf["text"], pdf["spots"]):
            raw = text.encode("utf-8", "replace")
            rows += [(x["key"], x["times"], x["n_runs"], rid, x["at"], x["n"], raw[x["at"]:x["at"] + x["n"] + WINDOW - 1])
                     for x in spots]
        yield pd.DataFrame(rows, columns=["key", "times", "n_runs", "rid", "at", "n", "context"])


def _hashes(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and number in its run of each window of the runs in ``pdf``."""
    raw = np.frombuffer(b"".join(pdf["context"]), np.uint8)
    n = pdf["n"].to_numpy(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    first = np.cumsum(n + WINDOW - 1) - (n + WINDOW - 1)
    c, down = prefix_hashes(raw)
    at = first[row] + nth
    h = mix64((c[at + WINDOW] - c[at]) * down[at])
    return mix64(h + pdf["key"].to_numpy(np.int64).view(np.uint64)[row]), row, nth


def _stretches(pdf: pd.DataFrame, row: np.ndarray, nth: np.ndarray) -> pd.DataFrame:
    """Stretches of neighbouring windows, given by row and number in order, as (rid, at, n)."""
    if not len(row):
        return pd.DataFrame({"rid": [], "at": [], "n": []}).astype({"rid": "int64", "at": "int64", "n": "int32"})
    new = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (nth[1:] != nth[:-1] + 1)))
    n = np.diff(np.append(new, len(row)))
    r = row[new]
    return pd.DataFrame({"rid": pdf["rid"].to_numpy()[r], "at": pdf["at"].to_numpy()[r] + nth[new], "n": n.astype(np.int32)})


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Windows of runs that occur in another run of the same anchor; rows come sorted by anchor."""
    def found(pdf: pd.DataFrame) -> pd.DataFrame:
        h, row, nth = _hashes(pdf)
        _, at, times = np.unique(h, return_inverse=True, return_counts=True)
        hit = (times[at] > 1) & (pdf["times"].to_numpy() == 1)[row]
        return _stretches(pdf, row[hit], nth[hit])

    held: list[pd.DataFrame] = []
    size = 0
    for group in consecutive(batches, ["key"]):
        held.append(group)
        size += len(group)
        if size >= 4000:
            yield found(pd.concat(held, ignore_index=True))
            held, size = [], 0
    if held:
        yield found(pd.concat(held, ignore_index=True))


def _windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for each window of the runs: its hash and place, and whether its run is the only one of its kind."""
    for pdf in batches:
        h, row, nth = _hashes(pdf)
        yield pd.DataFrame({"h": h.view(np.int64), "rid": pdf["rid"].to_numpy()[row],
                            "at": pdf["at"].to_numpy()[row] + nth, "open": (pdf["times"].to_numpy() == 1)[row]})


class SuffixLevels:
    """The index: levels of anchors with their number of occurrences, each level about twice the next."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []

    @staticmethod
    def _merge(entries: DataFrame) -> DataFrame:
        return materialize(entries.groupBy("key").agg(F.sum("times").alias("times")), "sa-level")

    def add(self, entries: DataFrame) -> None:
        """Merge a batch of entries into the family."""
        level = self._merge(entries.select("key", F.lit(1).cast("long").alias("times")))
        self.levels.append((level.count(), level))
        while len(self.levels) > 1 and self.levels[-2][0] < 2 * self.levels[-1][0]:
            (_, a), (_, b) = self.levels[-2:]
            merged = self._merge(a.unionByName(b))
            self.levels[-2:] = [(merged.count(), merged)]
            release(a, b)

    def matches(self) -> DataFrame:
        """Anchors that occur more than once, over all levels."""
        tables = [t for _, t in self.levels]
        if len(tables) == 1:
            return tables[0].where("times > 1").select("key")
        both = tables[0]
        for t in tables[1:]:
            both = both.unionByName(t)
        return both.groupBy("key").agg(F.sum("times").alias("times")).where("times > 1").select("key")

    def close(self) -> None:
        release(*[t for _, t in self.levels])


def repeated_spans(docs: DataFrame, n_batches: int = 2, group_rows: int = 20_000) -> DataFrame:
    """rid, spans: for each different text (rid, text) with repeats, the windows [at, at + n) that repeat.

    ``group_rows``: runs with one anchor that a task compares at once; beyond that windows are counted one by one.
    """
    entries = materialize(docs.where(F.octet_length("text") >= WINDOW)
                          .mapInPandas(_entries, "rid long, at long, n int, key long, run long"), "sa-entries")
    index = SuffixLevels()
    for i in range(n_batches):
        index.add(entries.where(F.pmod(F.col("rid"), F.lit(n_batches)) == i))
    # what has a match, once for each text: copies of a text only add to the count
    hits = materialize(entries.join(index.matches().hint("merge"), "key", "left_semi")
                       .groupBy("rid", "at", "n", "key", "run").agg(F.count(F.lit(1)).alias("times")), "sa-hits")
    index.close()
    release(entries)
    by_run = materialize(hits.groupBy("key", "run").agg(F.sum("times").alias("times")), "sa-runs")
    # whole runs that occur more than once
    whole = hits.select("rid", "at", "n", "key", "run").join(by_run.where("times > 1"), ["key", "run"], "left_semi")
    # anchors with different runs: windows of one representative of each
    mixed = by_run.groupBy("key").agg(F.count(F.lit(1)).alias("n_runs")).where("n_runs > 1")
    spots = (hits.select("rid", "at", "n", "key", "run").join(by_run.join(mixed, "key"), ["key", "run"])
             .dropDuplicates(["key", "run"]).groupBy("rid")
             .agg(F.collect_list(F.struct("at", "n", "key", "times", "n_runs")).alias("spots")))
    contexts = materialize(docs.dropDuplicates(["rid"]).join(spots.hint("merge"), "rid").mapInPandas(
        _contexts, "key long, times long, n_runs long, rid long, at long, n int, context binary"), "sa-contexts")
    small = (contexts.where(F.col("n_runs") <= group_rows).repartition("key").sortWithinPartitions("key")
             .mapInPandas(_compare, "rid long, at long, n int"))
    single = contexts.where(F.col("n_runs") > group_rows).mapInPandas(_windows, "h long, rid long, at long, open boolean")
    seen = single.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h")
    large = single.where("open").join(seen, "h", "left_semi").select("rid", "at", F.lit(1).alias("n"))
    spans = materialize(whole.select("rid", "at", "n").unionByName(small).unionByName(large).distinct().groupBy("rid")
                        .agg(F.collect_list(F.struct("at", "n")).alias("spans")), "sa-spans")
    release(hits, by_run, contexts)
    return spans


def merge_spans(at: np.ndarray, n: np.ndarray) -> list[tuple[int, int]]:
    """Maximal covered byte ranges of windows beginning at ``at`` .. ``at + n - 1``."""
    if not len(at):
        return []
    order = np.argsort(at, kind="stable")
    a, e = at[order], np.maximum.accumulate((at + n + WINDOW - 1)[order])
    new = np.flatnonzero(np.append(True, a[1:] > e[:-1]))
    return list(zip(a[new].tolist(), e[np.append(new[1:], len(a)) - 1].tolist()))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        all_spans, kept = [], []
        for text, spans in zip(pdf["text"], pdf["spans"]):
            raw = text.encode("utf-8", "replace")
            got = [] if spans is None else merge_spans(np.array([x["at"] for x in spans], np.int64),
                                                       np.array([x["n"] for x in spans], np.int64))
            out, last = [], 0
            for a, b in got:
                out.append(raw[last:a])
                last = b
            kept.append(b"".join([*out, raw[last:]]))
            all_spans.append([{"start": a, "stop": b} for a, b in got])
        yield pdf[["doc_id", "rid"]].assign(spans=all_spans, n_bytes=[len(t.encode("utf-8", "replace")) for t in pdf["text"]],
                                            kept=kept)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_batches: int = 2) -> DataFrame:
    """doc_id, rid, spans (byte ranges), n_bytes, kept (the remaining bytes) of every document."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("rid", F.xxhash64("text"))
    spans = repeated_spans(base.select("rid", "text"), n_batches)
    return base.join(spans.hint("merge"), "rid", "left").mapInPandas(
        _cut, f"doc_id {kind}, rid long, spans array<struct<start: long, stop: long>>, n_bytes long, kept binary")


def _rewritten(text_col: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = []
            for text, spans in zip(pdf[text_col], pdf.pop("__spans")):
                if spans is None or text is None:
                    texts.append(text)
                    continue
                raw = text.encode("utf-8", "replace")
                out, last = [], 0
                for a, b in merge_spans(np.array([x["at"] for x in spans], np.int64), np.array([x["n"] for x in spans], np.int64)):
                    while a < b and raw[a] & 0xC0 == 0x80:  # a character that is cut stays whole
                        a += 1
                    while a < b < len(raw) and raw[b] & 0xC0 == 0x80:
                        b -= 1
                    out.append(raw[last:a])
                    last = b
                texts.append(b"".join([*out, raw[last:]]).decode("utf-8"))
            pdf[text_col] = texts
            yield pdf
    return run


def without_repeats(docs: DataFrame, text_col: str = "text", n_batches: int = 2) -> DataFrame:
    """``docs`` with the repeated passages taken out of the texts; only whole characters go."""
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = repeated_spans(docs.select(F.xxhash64(text).alias("rid"), text.alias("text")), n_batches)
    spans = spans.select(F.col("rid").alias("__rid"), F.col("spans").alias("__spans"))
    return (docs.join(spans.hint("merge"), F.xxhash64(text) == F.col("__rid"), "left").drop("__rid")
            .mapInPandas(_rewritten(text_col), docs.schema))
