"""Language of a text: the family first, then one-versus-one linear machines inside the family.

A text is the square-rooted shares of its hashed letter trigrams. Linear support vector machines are
trained on a bounded sample of labelled rows (``sample_rows`` in all, spread evenly over the languages by hash): one
for each pair of families, and one for each pair of languages of one family. A text goes to the family that wins
most of its duels (then largest sum of margins), and to the language that does so inside it.

Defined results: null text or text without a letter is ``und`` with score 0; rows with a null language or id are not
learned from; with no labelled row every text is ``und``; repeated rows are predicted alike; an empty table
gives an empty result. Only the text decides a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, bounded_sample

BUCKETS, SAMPLE_ROWS = 4096, 4000
#: Families of common languages; any other language is a family of its own.
FAMILY = {"en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
          "is": "germanic", "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance",
          "ca": "romance", "ru": "slavic", "uk": "slavic", "pl": "slavic", "cs": "slavic", "bg": "slavic",
          "sk": "slavic", "sr": "slavic", "hr": "slavic"}
_LETTER = re.compile(r"[^\W\d_]")
#: Bytes of letters, lowered; all else is one blank.
_FOLD = bytes(ord(chr(c).lower()) if chr(c).isalpha() and c < 128 else (c if c >= 128 else 32) for c in range(256))


def trigrams(text: str) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams, without those inside blanks."""
    raw = np.frombuffer((" " + text + " ").encode("utf-8", "replace").translate(_FOLD), np.uint8).astype(np.uint32)
    h = raw[:-2] * np.uint32(0x9E3779B1) + raw[1:-1] * np.uint32(0x85EBCA6B) + raw[2:] * np.uint32(0xC2B2AE35)
    h = h[(raw[1:-1] != 32)]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    counts = np.bincount(h >> np.uint32(20), minlength=BUCKETS).astype(np.float32)
    return np.sqrt(counts / max(len(h), 1))


def svm(x: np.ndarray, y: np.ndarray, passes: int = 12, c: float = 10.0) -> np.ndarray:
    """Linear support vector machine with a bias weight by dual coordinate ascent; y is -1 or 1."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    norm = (x * x).sum(axis=1)
    w, a = np.zeros(x.shape[1]), np.zeros(len(x))
    order = np.random.default_rng(1)
    for _ in range(passes):
        for i in order.permutation(len(x)):
            new = min(max(a[i] - (y[i] * (x[i] @ w) - 1) / norm[i], 0.0), c)
            if new != a[i]:
                w += (new - a[i]) * y[i] * x[i]
                a[i] = new
    return w


class Duels:
    """One-versus-one machines among some names."""

    def __init__(self, names: list[str], x: np.ndarray, rows: dict[str, np.ndarray]):
        self.names = names
        self.pairs = list(combinations(range(len(names)), 2))
        self.w = np.array([svm(x[np.append(rows[names[i]], rows[names[j]])],
                               np.repeat([1.0, -1.0], [len(rows[names[i]]), len(rows[names[j]])])) for i, j in self.pairs])

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winner and its score for each row: the mean of its squashed margins."""
        if len(self.names) == 1:
            return np.zeros(len(x), int), np.ones(len(x))
        m = x @ self.w[:, :-1].T + self.w[:, -1]
        wins, total = np.zeros((len(x), len(self.names))), np.zeros((len(x), len(self.names)))
        for k, (i, j) in enumerate(self.pairs):
            wins[:, i] += m[:, k] >= 0
            wins[:, j] += m[:, k] < 0
            for name, sign in ((i, 1), (j, -1)):
                total[:, name] += 1 / (1 + np.exp(-np.clip(4 * sign * m[:, k], -50, 50)))
        best = (wins + total / (len(self.names) + 1)).argmax(axis=1)
        return best, total[np.arange(len(x)), best] / (len(self.names) - 1)


class LanguageModel:
    """Machines of families and of their languages; rows come in an order that says nothing of their texts. Of each language
    of a family the family's machines take equally many, 2 * per_lang in all."""

    def __init__(self, x: np.ndarray, langs: np.ndarray, per_lang: int):
        names = sorted(set(langs.tolist()))
        family = np.array([FAMILY.get(n, n) for n in langs])
        self.families = sorted(set(family.tolist()))
        own = {n: np.flatnonzero(langs == n)[:per_lang] for n in names}
        members = {f: [n for n in names if FAMILY.get(n, n) == f] for f in self.families}
        self.first = Duels(self.families, x, {
            f: np.sort(np.concatenate([own[n][:max(1, 2 * per_lang // len(m))] for n in m])) for f, m in members.items()})
        self.within = [Duels(m, x, own) for m in members.values()]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        fam, score = self.first.decide(x)
        out, total = np.empty(len(x), object), np.zeros(len(x))
        for f in np.unique(fam):
            rows = np.flatnonzero(fam == f)
            best, s = self.within[f].decide(x[rows])
            out[rows] = np.array(self.within[f].names, object)[best]
            total[rows] = score[rows] * s
        return list(out), total


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"lang": pdf["lang"], "x": [trigrams(t).astype(np.float16).tobytes() for t in pdf["text"]],
                            "at": pdf["at"]})


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, learn: Column, sample_rows: int) -> LanguageModel | None:
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    n_langs = rows.select("lang").distinct().count()
    if not n_langs:
        return None
    per_lang = max(2, sample_rows // n_langs)
    chosen = bounded_sample(rows.select("id", "lang"), "lang", "id", per_lang)
    sample = (rows.join(F.broadcast(chosen.select("id").distinct()), "id")  # sample_rows ids at most
              .select("lang", "text", F.xxhash64("id", F.lit(13)).alias("at"))
              .mapInPandas(_features, "lang string, x binary, at long").toPandas())
    x = np.array([np.frombuffer(b, np.float16) for b in sample["x"]], np.float32)
    order = np.lexsort([sample["x"], sample["lang"], sample["at"]])  # by id hash: the order of rows must not decide the training
    return LanguageModel(x[order], sample["lang"].to_numpy()[order], per_lang)


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, lang_pred, score for every row; learns from labelled rows where ``learn`` holds."""
    bounded_batches(docs.sparkSession)
    model = train(docs, id_col, text_col, lang_col, learn, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            has = np.array([m is not None and t is not None and _LETTER.search(t) is not None for t in pdf["text"]], bool)
            lang, score = np.full(len(pdf), "und", object), np.zeros(len(pdf))
            if has.any():
                x = np.array([trigrams(t) for t in pdf["text"][has]])
                names, s = m.predict(x)
                lang[has], score[has] = names, s
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "lang_pred": lang, "score": score})

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .mapInPandas(run, f"doc_id {kind}, lang_pred string, score double"))
