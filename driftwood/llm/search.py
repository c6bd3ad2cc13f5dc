"""Exact top-k search by BM25 over sharded inverted indexes with block-max pruning.

Each task indexes its documents into shards: terms, postings in document order, term counts and lengths.
Documents of a shard are ordered by their most frequent term and length, so that neighbours are alike; BLOCK of them
form a block. A shard takes queries in batches. Postings of terms of few documents are added up for all queries of a batch at
once; a block's bound is the greatest of these sums and of the other terms' weights in the block, as products of matrices over
the queries. The FIRST blocks of the greatest bounds are scored, then all whose bound comes to the k-th best score, which a task
takes from shard to shard. Weights use the counts and mean length of all
documents, so scores of different shards compare, and the best k of each task's best k are the best of all.

A term is a word (A-Z lowered, parted by ASCII white space), known by its 64-bit hash. score = sum over the distinct
terms of the query of ln(1 + (N - df + 0.5) / (df + 0.5)) * tf (K1 + 1) / (tf + K1 (1 - B + B len / mean len)), rounded to
six places; equal scores rank by smaller id. Only documents that share a term are results.

Defined results: null or empty text has no terms; rows with a null id are not searched; rows with one id are separate results
and one query, of the greatest text; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, bounded_batches, materialize, release, word_hashes

K1, B = 1.2, 0.75
BLOCK, SHARD_DOCS, SHARD_POSTINGS = 16, 12_288, 600_000
#: Words whose hashes a task keeps.
CACHE = 60_000
#: About how many query terms, of 4 bytes each and 16 for each distinct one, and queries, of k results each, are broadcast at once.
QUERY_TERMS, QUERIES = 1_000_000, 50_000
#: Postings, and pairs of a query and a document, that a shard takes at once; blocks of each query that it scores first.
BATCH_POSTINGS, BATCH_CELLS, FIRST = 600_000, 3_000_000, 8
#: Terms in more than one of OFTEN documents of a shard have tables, of TABLE_CELLS numbers at most.
OFTEN, TABLE_CELLS = 24, 4_000_000
#: A bound this far below a score cannot come to it by rounding; bounds are raised by the error of their single-precision sums.
SLACK, RAISE = 1e-5, 1 + 1e-4
_INDEX = "ids binary, lens binary, terms binary, ends binary, docs binary, counts binary"


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on in the fewest bytes that hold the greatest, after a byte with their size: a shard is one row, of which
    Spark and Arrow hold several copies at once."""
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    return bytes([kind.itemsize]) + numbers.astype(kind).tobytes()


def _numbers(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"u{packed[0]}", offset=1).astype(np.int64)


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache = WordHashes(CACHE)
    held: list[tuple[int, np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> pd.DataFrame:
        lens = np.array([int(c.sum()) for _, _, c in held], np.int64)
        top = np.array([int(t[c.argmax()]) if len(t) else 0 for _, t, c in held], np.uint64)
        order = np.lexsort([lens, top])
        docs = np.repeat(np.arange(len(held), dtype=np.int32), [len(held[i][1]) for i in order])
        terms = np.concatenate([held[i][1] for i in order])
        counts = np.concatenate([held[i][2] for i in order])
        by = np.argsort(terms, kind="stable")
        known, first = np.unique(terms[by], return_index=True)
        return pd.DataFrame({
            "ids": [np.array([held[i][0] for i in order], np.int64).tobytes()], "lens": [_packed(lens[order])],
            "terms": [known.tobytes()], "ends": [_packed(np.append(first, len(terms)))],
            "docs": [_packed(docs[by])], "counts": [_packed(counts[by])]})

    for pdf in batches:
        for doc, text in zip(pdf["doc_id"], pdf["text"]):
            t, c = np.unique(word_hashes(text, cache), return_counts=True)
            held.append((doc, t, c.astype(np.int32)))
            size += len(t)
            if len(held) >= SHARD_DOCS or size >= SHARD_POSTINGS:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for terms, ends in zip(pdf["terms"], pdf["ends"]):
            yield pd.DataFrame({"term": np.frombuffer(terms, np.int64), "df": np.diff(_numbers(ends))})


def _terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache = WordHashes(CACHE)
    for pdf in batches:
        yield pd.DataFrame({"query_id": pdf["query_id"],
                            "terms": [np.unique(word_hashes(t, cache)).view(np.int64) for t in pdf["text"]]})


class Queries(NamedTuple):
    """Queries of one broadcast: query ``i`` asks for ``terms[index[ends[i]:ends[i + 1]]]``."""

    ids: np.ndarray
    ends: np.ndarray
    index: np.ndarray
    terms: np.ndarray
    idf: np.ndarray

    @classmethod
    def of(cls, rows: pd.DataFrame) -> Queries:
        asked, idf = (np.concatenate([np.empty(0, kind), *rows[c]]).astype(kind) for c, kind in (("terms", np.int64), ("idf", np.float64)))
        terms, first, index = np.unique(asked.view(np.uint64), return_index=True, return_inverse=True)
        return cls(rows["query_id"].to_numpy(np.int64), np.append(0, np.cumsum([len(t) for t in rows["terms"]], dtype=np.int64)),
                   index.astype(np.int32), terms, idf[first])


class Shard:
    """One shard's postings, ready for queries."""

    def __init__(self, row, mean: float):
        self.ids, lens = np.frombuffer(row.ids, np.int64), _numbers(row.lens)
        self.terms, self.ends = np.frombuffer(row.terms, np.uint64), _numbers(row.ends)
        self.docs = _numbers(row.docs).astype(np.int32)
        tf = _numbers(row.counts).astype(np.float64)
        self.weight = tf * (K1 + 1) / (tf + (K1 * (1 - B + B * lens / mean))[self.docs])
        self.n_blocks = -(-len(self.ids) // BLOCK)
        # terms of many documents: tables of their weights by block, term and document, and of the greatest by term and block
        df = np.diff(self.ends)
        often = np.flatnonzero(df > max(4, len(self.ids) // OFTEN))
        often = often[np.argsort(-df[often], kind="stable")][:TABLE_CELLS // max(1, BLOCK * self.n_blocks)]
        self.row = np.full(len(self.terms), -1, np.int32)
        self.row[often] = np.arange(len(often))
        posts, n = _ranges(self.ends[often], self.ends[often + 1])
        docs = self.docs[posts]
        self.table = np.zeros((self.n_blocks, len(often), BLOCK))
        self.table[docs // BLOCK, np.repeat(np.arange(len(often)), n), docs % BLOCK] = self.weight[posts]
        self.max_at = self.table.max(axis=2, initial=0).T.astype(np.float32)

    def top(self, asked: Queries, ids: np.ndarray, scores: np.ndarray) -> None:
        """Put this shard's documents among the best of each query: a row of ids and scores (-1: none), the best first."""
        if not len(self.terms):
            return
        at = np.minimum(np.searchsorted(self.terms, asked.terms), len(self.terms) - 1)
        hit = self.terms[at] == asked.terms
        row = np.where(hit, self.row[at], -1)
        few = np.where(hit & (row < 0), self.ends[at + 1] - self.ends[at], 0)
        # batches of queries, bounded by their postings and by the documents
        work = np.append(0, np.cumsum(few[asked.index]))[asked.ends]
        most, a = max(1, BATCH_CELLS // (BLOCK * self.n_blocks)), 0
        while a < len(ids):
            b = min(a + most, max(a + 1, int(np.searchsorted(work, work[a] + BATCH_POSTINGS, "right")) - 1), len(ids))
            t = asked.index[asked.ends[a]:asked.ends[b]]
            of = np.repeat(np.arange(b - a), np.diff(asked.ends[a:b + 1]))
            there, rest = np.flatnonzero(row[t] >= 0), np.flatnonzero(few[t])
            share = np.zeros((b - a, len(self.max_at)))
            share[of[there], row[t[there]]] = asked.idf[t[there]]
            of, t = of[rest], t[rest]
            posts, n = _ranges(self.ends[at[t]], self.ends[at[t] + 1])
            cell = np.repeat(of * (self.n_blocks * BLOCK), n)
            cell += self.docs[posts]
            score = np.repeat(asked.idf[t], n)
            score *= self.weight[posts]
            score = np.bincount(cell, score, (b - a) * self.n_blocks * BLOCK).astype(np.float64, copy=False)  # whole numbers if none
            self._best(share, score.reshape(b - a, self.n_blocks, BLOCK), ids[a:b], scores[a:b])
            a = b

    def _best(self, share, few, ids, scores) -> None:
        """``share`` has each query's weights of the terms of many documents, ``few`` the scores by the others, by block and document."""
        bounds = few.max(axis=2)
        bounds += share.astype(np.float32) @ self.max_at
        bounds *= RAISE
        # the blocks of the greatest bounds first, then all that can still hold a result
        first, some = np.zeros(bounds.shape, bool), min(FIRST, self.n_blocks)
        np.put_along_axis(first, np.argpartition(bounds, self.n_blocks - some, axis=1)[:, self.n_blocks - some:], True, axis=1)
        for now in (first, ~first):
            of_block, of = np.nonzero((now & (bounds >= np.maximum(scores[:, -1:] - SLACK, 1e-300))).T)
            score = few[of, of_block]
            cuts = np.searchsorted(of_block, np.arange(self.n_blocks + 1)).tolist()
            for j in np.unique(of_block).tolist():
                at = slice(cuts[j], cuts[j + 1])
                score[at] += share[of[at]] @ self.table[j]
            new, slot = np.nonzero((score > 0) & (score >= scores[of, -1:] - SLACK))
            own = np.append(np.repeat(np.arange(len(ids)), ids.shape[1]), of[new])
            all_ids = np.append(ids.ravel(), self.ids[of_block[new] * BLOCK + slot])
            all_scores = np.append(scores.ravel(), np.round(score[new, slot], 6))
            by = np.lexsort([all_ids, -all_scores, own])
            by = by[np.searchsorted(own[by], np.arange(len(ids)))[:, None] + np.arange(ids.shape[1])]
            ids[...], scores[...] = all_ids[by], all_scores[by]


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each start to before its end, one range after the other, and the ranges' sizes."""
    n = end - start
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum()), n


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """query_id, rank, doc_id, score: the k best documents for each row of ``queries(query_id, text)``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    base = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n_docs = base.count()
    index = materialize(base.coalesce(max(1, -(-n_docs // SHARD_DOCS))).mapInPandas(_shards, _INDEX), "bm25-index")
    df = index.select("terms", "ends").mapInPandas(_document_counts, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))

    def lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"words": [int(_numbers(b).sum()) for b in pdf["lens"]]})

    total = index.select("lens").mapInPandas(lengths, "words long").agg(F.sum("words")).first()[0] or 0
    one = queries.where("query_id is not null").groupBy("query_id").agg(F.max("text").alias("text"))
    asked = (one.mapInPandas(_terms, "query_id long, terms array<long>").select("query_id", F.explode("terms").alias("term"))
             .join(df, "term").select("query_id", "term", F.log1p((F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")))
    asked = materialize(asked.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("term", "idf"))).alias("t"))
                        .select("query_id", F.col("t.term").alias("terms"), F.col("t.idf").alias("idf")), "bm25-queries")
    n_terms, n_queries = asked.agg(F.sum(F.size("terms")), F.count(F.lit(1))).first()
    n_blocks = max(1, -(-int(n_terms or 0) // QUERY_TERMS), -(-n_queries // QUERIES))
    results = None
    for i in range(n_blocks):
        rows = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == i).toPandas()
        block = spark.sparkContext.broadcast(Queries.of(rows))
        best = index.mapInPandas(_answers(block, max(total, 1) / max(n_docs, 1), k), "query_id long, doc_id long, score double")
        best = materialize(best, "bm25-best") if n_blocks > 1 else best
        results = best if results is None else results.unionByName(best)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    out = results.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
    out = materialize(out, "bm25-result")
    release(index, asked)
    return out


def _answers(block, mean: float, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = block.value
        ids, scores = np.zeros((len(asked.ids), k), np.int64), np.full((len(asked.ids), k), -1.0)
        for pdf in batches:
            for row in pdf.itertuples():
                Shard(row, mean).top(asked, ids, scores)
        of, rank = np.nonzero(scores >= 0)
        if len(of):
            yield pd.DataFrame({"query_id": asked.ids[of], "doc_id": ids[of, rank], "score": scores[of, rank]})
    return run
