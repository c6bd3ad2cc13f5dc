"""Quality grades by ordinal regression: one weight vector over hashed text, ordered thresholds.

Graded ratings come from ``labels``: 0 toxic, 1 poor but not toxic, 2 good. The cumulative-link model
P(grade >= k) = sigmoid(w x - t_k), t_1 <= t_2, is fitted on a bounded sample of labelled documents
(``per_grade`` of each grade, chosen by hash over the whole table) and scores every whole text. x has one for
each distinct word and shape mark of the text, found by its 64-bit hash. The absolute penalty L1 leaves most words
without weight, so that words of single training documents say nothing about others.

Defined results: null or empty text has shape marks only; labels with a null are left out; without two grades among the
labelled documents every document is kept with probability 1; repeated rows are scored alike; an empty
table gives an empty result. Other columns pass through ``keep_good`` unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CACHE_WORDS, bounded_batches, bounded_sample

PER_GRADE, LEAST_DOCS, STEPS, L1 = 2000, 3, 300, 1e-3
#: Words: ASCII letters and digits and all bytes of other letters; the rest parts words.
_PLAIN = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_SYMBOL, _UPPER, _DIGIT = (bytes(c for c in range(256) if f(chr(c)) and c < 128) for f in (
    lambda x: not x.isalnum() and not x.isspace(), str.isupper, str.isdigit))
_RUNS = re.compile(rb"[!-/:-@\[-`{-~]{2,4}|\s[!-/:-@\[-`{-~]\s")


def _steps(name: bytes, share: float, n: int = 20) -> list[bytes]:
    """One mark for each step that a share has passed, so that neighbouring shares have most marks in common."""
    return [b"\0%s%d" % (name, k) for k in range(1 + min(n, int(share * n)))]


def text_marks(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """Distinct words, and shape marks, of a text."""
    raw = (text or "").encode("utf-8", "replace")
    n = max(len(raw), 1)
    w = raw.lower().translate(_PLAIN).split()
    kinds = set(w)
    symbols, upper, digits = (len(raw) - len(raw.translate(None, c)) for c in (_SYMBOL, _UPPER, _DIGIT))
    marks = [b"\0" + x for x in set(_RUNS.findall(raw))]
    marks += _steps(b"symbols", 2 * symbols / n) + _steps(b"upper", 2 * upper / n) + _steps(b"digits", 2 * digits / n)
    marks += _steps(b"same", 1 - len(kinds) / max(len(w), 1)) + _steps(b"size", len(w).bit_length() / 20)
    return list(kinds), marks


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for t in pdf["text"]:
            w, m = text_marks(t)
            rows.append(np.array([xxhash.xxh3_64_intdigest(x) for x in w + m], np.uint64).tobytes())
        yield pd.DataFrame({"grade": pdf["grade"], "marks": rows})


class OrdinalModel:
    """Weights of the known marks (sorted hashes) and thresholds."""

    def __init__(self, marks: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.marks, self.weights, self.thresholds = marks, weights, thresholds

    def tails(self, z: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 ..: one column for each threshold."""
        return 1 / (1 + np.exp(-np.clip(z[:, None] - self.thresholds[None, :], -50, 50)))


def fit(grades: np.ndarray, marks: list[np.ndarray], least_docs: int = LEAST_DOCS, steps: int = STEPS) -> OrdinalModel | None:
    """Maximum likelihood of the cumulative-link model with a quadratic and an absolute penalty, by Adam on the whole sample."""
    if len(set(grades.tolist())) < 2:
        return None
    n_grades = int(grades.max()) + 1
    row = np.repeat(np.arange(len(marks)), [len(m) for m in marks])
    known, col, docs = np.unique(np.concatenate(marks), return_inverse=True, return_counts=True)
    use = docs >= least_docs
    number = np.cumsum(use) - 1
    ok = use[col]
    row, col, known = row[ok], number[col[ok]], known[use]
    w, t = np.zeros(len(known)), np.linspace(-1, 1, n_grades - 1)
    weight = (1 / np.maximum(np.bincount(grades, minlength=n_grades), 1))[grades]
    weight = weight / weight.sum()
    m, v = np.zeros(len(w) + len(t)), np.zeros(len(w) + len(t))
    for step in range(1, steps + 1):
        z = np.bincount(row, w[col], minlength=len(grades))
        upper = 1 / (1 + np.exp(-np.clip(z[:, None] - t[None, :], -50, 50)))  # P(grade >= k)
        # the likelihood of a grade is the difference of two neighbouring tails
        tail = np.hstack([np.ones((len(z), 1)), upper, np.zeros((len(z), 1))])
        slope = np.hstack([np.zeros((len(z), 1)), upper * (1 - upper), np.zeros((len(z), 1))])
        i = np.arange(len(z))
        p = np.maximum(tail[i, grades] - tail[i, grades + 1], 1e-9)
        lo, hi = slope[i, grades] / p * weight, slope[i, grades + 1] / p * weight
        gz = hi - lo  # gradient of the negative log-likelihood by z
        gt = np.zeros(n_grades + 1)
        np.add.at(gt, grades, lo)
        np.add.at(gt, grades + 1, -hi)
        g = np.append(np.bincount(col, gz[row], minlength=len(w)) + 2e-4 * w, gt[1:-1])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        w -= move[:len(w)]
        w = np.sign(w) * np.maximum(np.abs(w) - 0.08 * L1 / (np.sqrt(v[:len(w)] / (1 - 0.99**step)) + 1e-6), 0)
        t = np.maximum.accumulate(t - move[len(w):])
    return OrdinalModel(known, w, t)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          per_grade: int = PER_GRADE) -> OrdinalModel | None:
    """Fit on at most ``per_grade`` labelled documents of each grade."""
    graded = (labels.where("quality is not null and toxic is not null and doc_id is not null")
              .select(F.col("doc_id").alias("__id"), F.when(F.col("toxic") > 0, 0).otherwise(F.when(F.col("quality") > 0, 2)
                                                            .otherwise(1)).cast("int").alias("grade")).distinct())
    known = docs.select(F.col(id_col).alias("__doc"))
    chosen = bounded_sample(graded.join(known, graded["__id"] == known["__doc"], "left_semi"), "grade", "__id", per_grade)
    texts = (docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("text"))
             .join(F.broadcast(chosen.select("__id", "grade")), F.col("__doc") == F.col("__id")))  # 3 * per_grade rows
    rows = texts.select("grade", "text").mapInPandas(_features, "grade int, marks binary").toPandas()
    if not len(rows):
        return None
    return fit(rows["grade"].to_numpy(np.int64), [np.frombuffer(m, np.uint64) for m in rows["marks"]])


class Scorer:
    """Scores texts; remembers the weight of each word it has met."""

    def __init__(self, model: OrdinalModel):
        self.model, self.cache = model, {}

    def weight(self, mark: bytes) -> float:
        if mark not in self.cache:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            h = np.uint64(xxhash.xxh3_64_intdigest(mark))
            i = int(np.searchsorted(self.model.marks, h))
            hit = i < len(self.model.marks) and self.model.marks[i] == h
            self.cache[mark] = float(self.model.weights[i]) if hit else 0.0
        return self.cache[mark]

    def tails(self, texts) -> np.ndarray:
        z = np.zeros(len(texts))
        get = self.cache.get
        for i, t in enumerate(texts):
            w, m = text_marks(t)
            got = [get(x) for x in w]
            z[i] = sum(self.weight(x) if g is None else g for x, g in zip(w, got)) + sum(map(self.weight, m))
        return self.model.tails(z)


def grade(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, expected_grade, p_good (probability of the best grade), kept."""
    bounded_batches(docs.sparkSession)
    model = train(docs, labels, id_col, text_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model) if model else None
        for pdf in batches:
            tails = scorer.tails(pdf["text"]) if scorer else np.ones((len(pdf), 2))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "expected_grade": tails.sum(axis=1), "p_good": tails[:, -1],
                                "kept": tails[:, -1] >= threshold})

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInPandas(run, f"doc_id {kind}, expected_grade double, p_good double, kept boolean"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose probability of the best grade reaches the threshold, unchanged."""
    bounded_batches(docs.sparkSession)
    model = train(docs, labels, id_col, text_col)
    if model is None:
        return docs

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        scorer = Scorer(model)
        for batch in batches:
            good = scorer.tails(batch.column(text_col).to_pylist())[:, -1] >= threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
