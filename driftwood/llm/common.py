"""Helpers shared by the corpus operators: text sets, scratch tables, bounded label samples, components."""

from __future__ import annotations

import atexit
import gc
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_table_path, ship_package

#: Words cached per Python task before the cache starts afresh.
CACHE_WORDS = 300_000
_scratch: dict[str, SparkSession] = {}


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches small by rows and bytes, so that long texts do not add up in one batch; give the workers this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: later steps recompute nothing,
    and a lost executor costs at most one task of the step that reads it."""
    spark = df.sparkSession
    path = new_table_path(spark, name)
    df.write.parquet(path)
    if not _scratch:
        atexit.register(lambda: [drop_table(s, p) for p, s in list(_scratch.items())])
    _scratch[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop_table(spark: SparkSession, path: str | None) -> None:
    """Delete a scratch table whose readers have all finished."""
    _scratch.pop(path, None)
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session may have ended; the shared folder is then the owner's to clear
        pass


def release(*tables: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more. Spark removes the shuffle files of finished steps
    when the driver's heap is collected, which a small heap in a long job may put off for long: ask for it."""
    for t in tables:
        if getattr(t, "_scratch_path", None):
            drop_table(t.sparkSession, t._scratch_path)
    if tables:
        gc.collect()
        tables[0].sparkSession.sparkContext._jvm.System.gc()


def n_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, filled on first sight and bounded in size."""

    def __init__(self, most: int = CACHE_WORDS):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words(text: str | None) -> list[bytes]:
    """Words of a text: A-Z lowered, split at ASCII white space."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def word_hashes(text: str | None, cache: WordHashes) -> np.ndarray:
    w = words(text)
    return np.fromiter(map(cache.__getitem__, w), np.uint64, len(w))


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, cache: WordHashes, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; shorter texts are one shingle, no words give none."""
    h = word_hashes(text, cache)
    if len(h) == 0:
        return h
    if len(h) < k:
        return mix64(np.array([int(sum((2 * i + 3) * int(x) for i, x in enumerate(h)) + len(h)) & (2**64 - 1)], np.uint64))
    n = len(h) - k + 1
    s = np.zeros(n, np.uint64)
    for i in range(k):
        s = mix64(s + h[i:i + n] + np.uint64(i + 1))
    return np.unique(s)


def hash_share(key: Column, seed: int) -> Column:
    """Pseudo-random share in [0, 1) of a key."""
    return (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) / F.lit(1 << 30)).cast("double")


#: Labels up to which their counts are broadcast.
MOST_LABELS = 10_000


def bounded_sample(df: DataFrame, label: str, key: str, per_label: int, seed: int = 11) -> DataFrame:
    """At most ``per_label`` rows of each label, chosen by a hash of the key, spread over the whole table.

    The share kept is set per label from its count, so the final ranking only sees about
    ``2 * per_label`` rows of a label however many it has: the counts, a row a label, are broadcast where there are at most
    MOST_LABELS (checked), and no row moves before the share is taken. Rows without a label are left out.
    """
    share = hash_share(F.col(key), seed)
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    few = counts.limit(MOST_LABELS + 1).collect()
    if len(few) <= MOST_LABELS:
        counts = F.broadcast(df.sparkSession.createDataFrame(few, counts.schema))
    near = (df.join(counts, label)
            .where(share < F.lit(2.0 * per_label) / F.col("__n"))
            .withColumn("__share", share))
    from pyspark.sql import Window
    w = Window.partitionBy(label).orderBy("__share", key)
    return near.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= per_label).drop("__r", "__n", "__share")


def components(links: DataFrame, name: str = "components", max_rounds: int = 40) -> DataFrame:
    """(node, component) for the nodes of ``links(a, b)``: component is the smallest node reachable.

    Alternates two star contractions: every node hands its larger neighbours, then its smaller ones,
    to the smallest node it knows. Minima are taken with map-side combining and joined back, so a node
    with a third of all links is not gathered anywhere.
    """
    edges = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .where("a < b").distinct(), name)
    mark = None
    for _ in range(max_rounds):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        best = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(best, "u")
        nxt = materialize(small.select(F.col("m").alias("a"), F.col("u").alias("b"))
                          .union(small.select(F.col("m").alias("a"), F.col("v").alias("b")))
                          .where("a < b").distinct(), name)
        release(edges)
        edges = nxt
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(new) == mark:
            break
        mark = tuple(new)
    else:
        raise RuntimeError("components did not settle")
    own = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(own)


def consecutive(batches: Iterator[pd.DataFrame], by: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of rows with equal ``by`` in sorted batches, each whole, also across batches."""
    rest = None
    for pdf in batches:
        if rest is not None:
            pdf = pd.concat([rest, pdf], ignore_index=True)
        if not len(pdf):
            continue
        keys = pdf[by].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist()]
        for a, b in zip(edges, edges[1:]):
            yield pdf.iloc[a:b]
        rest = pdf.iloc[edges[-1]:]
    if rest is not None and len(rest):
        yield rest
