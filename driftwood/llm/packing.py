"""Packing of documents into fixed-length sequences by length patterns.

Tokenised documents are cut into pieces of at most ``length`` tokens; only longer documents are cut. The
histogram of piece lengths, one count per length, is all that the plan needs:

1. patterns of up to three coarse lengths that fill a sequence are enumerated;
2. non-negative least squares fits how often each pattern is used so that the uses add up to the histogram;
3. the counts are rounded down and the patterns carried out on the exact lengths, each place taking the
   longest length that is left and fits;
4. the residual pieces are packed best-fit, longest first, into the space that patterns left and into
   new sequences.

All of this works on groups of equal sequences, so its size depends on the number of lengths and not
on the number of documents. Each piece then finds its place by its rank among the pieces of its length.

Defined results: null text is empty; an empty document is one piece with the end token alone; repeated rows are
separate documents; an empty table gives an empty result. Columns other than id and text are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialize

#: Words whose token ids a worker keeps, from task to task, before it starts afresh.
CACHE_IDS = 1_000_000
_KEPT: dict[str, "WordIds"] = {}
COARSE = 128


class WordIds:
    """Token ids of texts through a cache of white-space separated words.

    The tokenizer drops white space and its normaliser never reaches across it, so a text's ids are its words'
    ids one after the other.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self._reset()

    def _reset(self) -> None:
        self.at: dict[bytes, int] = {}
        self.pool, self.ends = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _encode(self, words: list[bytes]) -> None:
        """Add the ids of new words to the pool, many words in one call. A word of letters only is one unit of the
        tokenizer, whose last id closes it; the ids of other words are told apart by their places in the text."""
        text = [w.decode("utf-8") for w in words]
        plain = [t.isalpha() and (t.isascii() or t.lower().isalpha() and len(t.lower()) == len(t)) for t in text]
        groups = [[i for i, p in enumerate(plain) if p], [i for i, p in enumerate(plain) if not p]]
        ids, sizes, order = [self.pool], [], []
        for simple, group in zip((True, False), groups):
            for k in range(0, len(group), 200):
                chunk = group[k:k + 200]
                encoded = self.tokenizer.encode(" ".join([text[i] for i in chunk]), add_special_tokens=False)
                got = np.array(encoded.ids, np.uint32)
                cuts = np.flatnonzero(self.closes[got]) + 1 if simple else None
                if not simple or len(cuts) != len(chunk) or cuts[-1] != len(got):
                    starts = np.cumsum([0, *[len(text[i]) + 1 for i in chunk]])
                    cuts = np.searchsorted([o[0] for o in encoded.offsets], starts[1:])
                ids.append(got)
                sizes.append(np.diff(cuts, prepend=0))
                order += chunk
        first = len(self.ends) - 1
        self.at.update(zip([words[i] for i in order], range(first, first + len(order))))
        self.pool = np.concatenate(ids)
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes)))

    def batch(self, texts) -> list[np.ndarray]:
        split = [t.encode("utf-8", "replace").split() if t else [] for t in texts]
        if len(self.at) > CACHE_IDS:
            self._reset()
        new = set().union(*split).difference(self.at)
        if new:
            self._encode(list(new))
        out = []
        for ws in split:
            if not ws:
                out.append(np.empty(0, np.uint32))
                continue
            at = np.fromiter(map(self.at.__getitem__, ws), np.int64, len(ws))
            n = self.ends[at + 1] - self.ends[at]
            stop = np.cumsum(n)
            where = np.repeat(self.ends[at] - stop + n, n) + np.arange(stop[-1])
            out.append(self.pool[where])
        return out


def word_ids(path: str) -> WordIds:
    """The worker's own word cache for a tokenizer."""
    if path not in _KEPT:
        _KEPT[path] = WordIds(path)
    return _KEPT[path]


def _pieces(path: str, length: int, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        from driftwood.llm import packing
        part, seen = TaskContext.get().partitionId(), np.zeros(length + 1, np.int64)
        ids_of = packing.word_ids(path)
        for pdf in batches:
            rows = []
            for doc, ids in zip(pdf["doc_id"], ids_of.batch(pdf["text"])):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), length)):
                    cut = ids[start:start + length]
                    rows.append((doc, piece, start, len(cut), cut.tobytes(), part, int(seen[len(cut)])))
                    seen[len(cut)] += 1
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids", "part", "nth"])
    return run


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, length: int = 4096, end_id: int = 1,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit), and part and nth: the piece's rank
    among those of its length in the task that made it."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInPandas(_pieces(tokenizer_path, length, end_id),
                         f"doc_id {kind}, piece int, start long, length long, ids binary, part int, nth long"))


def nnls(a: np.ndarray, b: np.ndarray, max_steps: int = 400) -> np.ndarray:
    """Non-negative least squares by active sets: min |a x - b| with x >= 0."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    slope = a.T @ b
    tol = 1e-9 * max(1.0, float(np.abs(slope).max(initial=0.0)))
    for _ in range(max_steps):
        rest = np.where(active, -np.inf, slope)
        j = int(rest.argmax())
        if rest[j] <= tol:
            break
        active[j] = True
        while True:
            on = np.flatnonzero(active)
            y = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if (y > 0).all():
                x[:] = 0
                x[on] = y
                break
            low = y <= 0
            old = x[on]
            step = np.min(old[low] / np.maximum(old[low] - y[low], 1e-300))
            x[on] = np.maximum(old + step * (y - old), 0)
            drop = on[low & (x[on] <= 1e-12 * max(1.0, float(x.max(initial=0.0))))]
            active[drop if len(drop) else on[low]] = False
            x[~active] = 0
        slope = a.T @ (b - a @ x)
    return x


def fit_patterns(hist: np.ndarray, length: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of up to three coarse lengths that fill a sequence, with the rounded-down number of uses."""
    unit = max(1, length // COARSE)
    n = length // unit
    coarse = np.bincount(np.clip(np.rint(np.arange(length + 1) / unit).astype(int), 1, n), weights=hist, minlength=n + 1)
    triples = [(n,)] + [(a, n - a) for a in range((n + 1) // 2, n)]
    triples += [(a, b, n - a - b) for a in range(1, n - 1) for b in range(1, min(a, n - a - 1) + 1) if 1 <= n - a - b <= b]
    triples = [t for t in triples if all(coarse[i] for i in t)]
    if not triples:
        return []
    a = np.zeros((n + 1, len(triples)))
    for j, t in enumerate(triples):
        for i in t:
            a[i, j] += 1
    scale = coarse.max()
    uses = np.floor(nnls(a, coarse / scale) * scale + 1e-6).astype(np.int64)
    return [(tuple(min(length, i * unit) for i in t), int(u)) for t, u in zip(triples, uses) if u > 0]


def plan_sequences(hist: np.ndarray, length: int, tolerance: float = 0.01) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of one sequence, number of such sequences) for the histogram ``hist[0..length]``."""
    left = hist.astype(np.int64).copy()
    done: list[tuple[tuple[int, ...], int]] = []
    if left[length]:
        done.append(((length,), int(left[length])))
        left[length] = 0
    unit = max(1, length // COARSE)
    for target, uses in sorted(fit_patterns(left, length), key=lambda t: -t[1]):
        while uses > 0:
            lengths, room = [], length
            for i, t in enumerate(target):
                top = min(room, t + unit) if i < len(target) - 1 else room
                have = np.flatnonzero(left[:top + 1] - np.bincount(lengths, minlength=top + 1)[:top + 1])
                if not len(have):
                    break
                lengths.append(int(have[-1]))
                room -= lengths[-1]
            if not lengths or room > tolerance * length:
                break
            need = np.bincount(lengths, minlength=length + 1)
            times = min(uses, int((left[need > 0] // need[need > 0]).min()))
            left -= need * times
            uses -= times
            done.append((tuple(lengths), times))
    # best fit, longest first; groups of equal sequences by free space
    free: dict[int, list[list]] = {}
    for lengths, times in done:
        if sum(lengths) < length:
            free.setdefault(length - sum(lengths), []).append([lengths, times])
    full = [(p, t) for p, t in done if sum(p) == length]
    rooms = sorted(free)
    for size in range(length, 0, -1):
        count = int(left[size])
        while count:
            i = bisect.bisect_left(rooms, size)
            if i == len(rooms):
                per = min(count, length // size)
                pattern, times, room = (size,) * per, count // per, length - per * size
                count -= per * times
            else:
                room = rooms[i]
                group = free[room]
                base, have = group[-1]
                per = max(1, min(count // have, room // size)) if count >= have else 1
                times = min(have, count)
                count -= per * times
                if times == have:
                    group.pop()
                    if not group:
                        del free[room]
                        rooms.pop(i)
                else:
                    group[-1][1] -= times
                pattern, room = base + (size,) * per, room - per * size
            if room:
                if room not in free:
                    free[room] = []
                    bisect.insort(rooms, room)
                free[room].append([pattern, times])
            else:
                full.append((pattern, times))
    return full + [(p, t) for groups in free.values() for p, t in groups]


def _segments(plan: list[tuple[tuple[int, ...], int]], length: int) -> tuple[np.ndarray, ...]:
    """For each length, ranges of ranks: (length, first rank, first sequence, places a sequence, offset)."""
    rank, rows, base = np.zeros(length + 1, np.int64), [], 0
    for pattern, times in plan:
        offset = 0
        sizes, counts = np.unique(np.array(pattern), return_counts=True)
        for size, per in zip(sizes[::-1].tolist(), counts[::-1].tolist()):
            rows.append((size, rank[size], base, per, offset))
            rank[size] += per * times
            offset += per * size
        base += times
    rows.sort(key=lambda r: (r[0], r[1]))
    return tuple(np.array(c, np.int64) for c in zip(*rows))


def _place(segments):
    size, first, base, per, offset = segments.value if hasattr(segments, "value") else segments
    key = size * (1 << 48) + first

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = pdf["length"].to_numpy(np.int64)
            r = pdf.pop("nth").to_numpy(np.int64)
            at = np.searchsorted(key, n * (1 << 48) + r, side="right") - 1
            j = r - first[at]
            yield pdf.assign(sequence_id=base[at] + j // per[at], offset=offset[at] + j % per[at] * n)
    return run


def pack(pieces: DataFrame, length: int = 4096) -> DataFrame:
    """``pieces`` (length, part, nth and other columns) with sequence_id and offset in place of part and nth.

    ``pieces`` is read twice and must not change between: give a written table.
    """
    counts = materialize(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("c")), "pack-counts")
    hist = np.zeros(length + 1, np.int64)
    for size, c in counts.groupBy("length").agg(F.sum("c")).collect():  # at most ``length`` rows
        hist[size] = c
    if not hist.any():
        return pieces.drop("part", "nth").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    segments = _segments(plan_sequences(hist, length), length)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    ranked = (pieces.join(offsets, ["part", "length"]).withColumn("nth", F.col("nth") + F.col("before"))
              .select(*[c for c in pieces.columns if c != "part"]))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "nth"]
    return ranked.mapInPandas(_place(segments), ", ".join([*fields, "sequence_id long", "offset long"]))
