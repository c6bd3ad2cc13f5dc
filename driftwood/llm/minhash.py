"""Near-duplicate classes: one-permutation hashing with optimal densification, banded buckets, star edges.

Each document's set of five-word shingles is hashed once; the hash range is cut into SLOTS equal bins and
the least hash of each bin is the slot's value. An empty bin takes the value of the first non-empty bin in
a fixed random order of its own, so two sets agree in each slot with probability equal to their similarity.
ROWS slots make a band key. A bucket (equal band key) is a star: its edges go from one hub to the others,
so a bucket of g members gives g - 1 candidates. Candidates are confirmed on the full sets.

A star can hide a link between two members that are both unlike the hub. Buckets whose members are
still in different components after the stars are compared exactly, blocks of a bucket against each other inside
a task, which gives a spanning forest of the links it finds and no pairs. Before that, nodes go of whose shingles over a quarter occur in no
other node of these buckets: they cannot reach the similarity with any of them.

Defined results: null or wordless text has an empty set and is linked with nothing; equal sets are one class
before any bucket is made, and a node is such a class, known by the digest of its set: a repeated doc_id with equal text
is one node, with unlike texts several; a component is named by the smallest id in it; rows with a null doc_id are never
linked and keep a null component; an empty table gives an empty result. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, bounded_batches, components, consecutive, materialize, mix64, release, shingle_set

SLOTS, ROWS = 240, 5
#: (1 - 0.75 ** 5) ** 48 < 3e-6: the chance that a pair at the threshold shares no bucket.
BANDS = SLOTS // ROWS
#: Documents of a bucket that one task holds from each side when it compares them exactly.
BLOCK = 512
_ORDERS = np.random.default_rng(20240).permuted(np.tile(np.arange(SLOTS), (SLOTS, 1)), axis=1)
_EDGES = (np.arange(SLOTS, dtype=object) * (2**64 // SLOTS)).astype(np.uint64)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Slot values of a sorted non-empty set of 64-bit hashes."""
    at = np.searchsorted(hashes, _EDGES)
    end = np.append(at[1:], len(hashes))
    full = end > at
    source = np.arange(SLOTS)
    empty = np.flatnonzero(~full)
    if len(empty):
        source[empty] = _ORDERS[empty, full[_ORDERS[empty]].argmax(axis=1)]
    return hashes[at[source]]


def band_keys(values: np.ndarray) -> np.ndarray:
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(ROWS):
        key = mix64(key + values[i::ROWS] + np.uint64(i))
    return key.view(np.int64)


def _sketches(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHashes()
        for pdf in batches:
            n, hi, lo, bands = [], [], [], []
            for text in pdf["text"]:
                s = shingle_set(text, cache, k)
                d = xxhash.xxh3_128_digest(s.tobytes())
                n.append(len(s))
                hi.append(int.from_bytes(d[:8], "little", signed=True))
                lo.append(int.from_bytes(d[8:], "little", signed=True))
                bands.append(band_keys(sketch(s)) if len(s) else np.empty(0, np.int64))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "tid": pdf["tid"], "n_shingles": n, "hi": hi, "lo": lo, "bands": bands})
    return run


def _shingles(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHashes()
        for pdf in batches:
            yield pd.DataFrame({"node": pdf["node"],
                                "shingles": [shingle_set(t, cache, k).view(np.int64) for t in pdf["text"]]})
    return run


def _confirm(k: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, sets = WordHashes(), {}

        def of(node, text):
            if node not in sets:
                if len(sets) >= 256:
                    sets.clear()
                sets[node] = shingle_set(text, cache, k)
            return sets[node]

        for pdf in batches:
            keep = []
            for a, b, x, y in zip(pdf["a"], pdf["b"], pdf["text_a"], pdf["text_b"]):
                s, t = of(a, x), of(b, y)
                inter = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * inter >= percent * (len(s) + len(t) - inter))
            yield pdf.loc[keep, ["a", "b"]]
    return run


def _blocks(k: int, percent: int):
    def links(nodes: np.ndarray, comps: np.ndarray, sets: list[np.ndarray]) -> pd.DataFrame:
        n = np.array([len(s) for s in sets])
        codes, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times[at] > 1
        rank = (np.cumsum(times > 1) - 1)[at[shared]]
        owner = np.repeat(np.arange(len(sets)), n)[shared]
        inter = np.zeros((len(sets), len(sets)), np.float32)
        for start in range(0, int((times > 1).sum()), 4096):
            part = (rank >= start) & (rank < start + 4096)
            m = np.zeros((len(sets), 4096), np.float32)
            m[owner[part], rank[part] - start] = 1
            inter += m @ m.T
        near = 100 * inter >= percent * (n[:, None] + n[None, :] - inter)
        near |= comps[:, None] == comps[None, :]  # already known to be one
        a, b = [], []
        todo = np.ones(len(n), bool)
        for root in range(len(n)):
            front = [root] if todo[root] else []
            todo[root] = False
            while front:
                i = front.pop()
                new = np.flatnonzero(near[i] & todo)
                todo[new] = False
                front += new.tolist()
                own = new[comps[new] != comps[i]]
                a += [nodes[i]] * len(own)
                b += nodes[own].tolist()
        return pd.DataFrame({"a": a, "b": b}, dtype="int64")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, known = WordHashes(), {}

        def of(node, text):
            if node not in known:
                if len(known) >= 4 * BLOCK:
                    known.clear()
                known[node] = shingle_set(text, cache, k)
            return known[node]

        for group in consecutive(batches, ["key", "i", "j"]):
            if group["component"].nunique() > 1:
                yield links(group["node"].to_numpy(), group["component"].to_numpy(),
                            [of(a, t) for a, t in zip(group["node"], group["text"])])
    return run


def _labelled(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """doc_id, tid (hash of the text), n_shingles, component (a number; null for empty sets), component_id for every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("tid", F.xxhash64("text"))
    sketched = materialize(base.mapInPandas(
        _sketches(k), "doc_id long, tid long, n_shingles long, hi long, lo long, bands array<long>"), "nd-sketch")
    # a node is a different set; its smallest id and a text of that id stand for it
    classes = materialize(sketched.where("n_shingles > 0 and doc_id is not null").groupBy("hi", "lo", "n_shingles")
                          .agg(F.min(F.struct("doc_id", "tid")).alias("first"))
                          .select(F.xxhash64("hi", "lo", "n_shingles").alias("node"), "hi", "lo", "n_shingles", "first.doc_id", "first.tid"),
                          "nd-classes")
    reps = materialize(sketched.select("doc_id", "tid", "hi", "lo", "n_shingles", "bands")
                       .join(classes, ["doc_id", "tid", "hi", "lo", "n_shingles"])
                       .dropDuplicates(["node"])
                       .select("node", "n_shingles", "bands"), "nd-reps")
    rows = reps.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    buckets = (rows.groupBy("key").agg(F.min(F.struct("node", "n")).alias("hub"), F.max("node").alias("top"))
               .where("hub.node < top").select("key", "hub"))
    members = materialize(rows.join(buckets.hint("merge"), "key")
                          .select("key", "node", "n", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n")),
                          "nd-members")

    # the texts of all nodes in buckets, read once
    wanted = classes.select("node", "doc_id", "tid").join(members.select("node").distinct().hint("merge"), "node", "left_semi")
    have = materialize(base.join(wanted.hint("merge"), ["doc_id", "tid"]).dropDuplicates(["node"]).select("node", "text"), "nd-texts")

    def confirm(pairs: DataFrame, name: str) -> DataFrame:
        """pairs(a, b) of nodes -> those that are links, on the full sets."""
        return materialize(
            pairs.join(have.select(F.col("node").alias("a"), F.col("text").alias("text_a")).hint("merge"), "a")
            .join(have.select(F.col("node").alias("b"), F.col("text").alias("text_b")).hint("merge"), "b")
            .mapInPandas(_confirm(k, percent), "a long, b long"), name)

    def near(n, m):
        return (F.least(n, m) * 100 >= F.greatest(n, m) * percent)

    tried = materialize(members.where((F.col("node") != F.col("hub")) & near(F.col("n"), F.col("hub_n")))
                        .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "nd-tried")
    links = confirm(tried, "nd-links")
    groups = materialize(components(links, "nd-comp"), "nd-groups")

    def reopen(rows: DataFrame, groups: DataFrame) -> DataFrame:
        """Of bucket rows those, with their component, whose bucket still holds more than one component."""
        marked = (rows.select("key", "node", "n").join(groups, "node", "left")
                  .withColumn("component", F.coalesce("component", "node")))
        mixed = (marked.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                           F.count(F.lit(1)).alias("size"))
                 .where("x < y and size > 2").select("key"))
        return materialize(marked.join(mixed, "key"), "nd-open")

    def prune(left: DataFrame) -> DataFrame:
        """Without nodes that cannot have a link: of their shingles more than the allowed part are in no
        other node of these buckets."""
        nodes = left.select("node", "n").distinct()
        own = (have.join(nodes, "node", "left_semi")
               .mapInPandas(_shingles(k), "node long, shingles array<long>")
               .select("node", F.explode("shingles").alias("s")))
        alone = (own.groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("node")).where("c = 1")
                 .groupBy("node").agg(F.count(F.lit(1)).alias("u")))
        able = (nodes.join(alone, "node", "left")
                .where((F.col("n") - F.coalesce("u", F.lit(0))) * 100 >= F.col("n") * percent).select("node"))
        out = materialize(left.join(able, "node"), "nd-able")
        release(left)
        return out

    left = prune(reopen(members, groups))
    # whatever is still apart in one bucket is compared exactly, block against block inside a task
    sizes = left.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("nb"))
    own = (left.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("nb")).cast("int"))
           .withColumn("p", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
           .select("key", F.least("own", "p").alias("i"), F.greatest("own", "p").alias("j"), "node", "component"))
    last = materialize(own.join(have, "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
                       .mapInPandas(_blocks(k, percent), "a long, b long").distinct(), "nd-last")
    if not last.isEmpty():
        groups = materialize(components(links.union(last), "nd-comp"), "nd-groups")
    release(reps, members, have, left, last, tried, links)
    ids = classes.select("node", F.col("doc_id").alias("least"))
    names = groups.join(ids, "node").groupBy("component").agg(F.min("least").alias("name"))
    named = classes.join(groups.join(names, "component"), "node", "left").select(
        "hi", "lo", "n_shingles", F.coalesce("component", "node").alias("component"), F.coalesce("name", "doc_id").alias("c"))
    return (sketched.select("doc_id", "tid", "n_shingles", "hi", "lo").join(named, ["hi", "lo", "n_shingles"], "left")
            .select("doc_id", "tid", "n_shingles", "component",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id")).alias("component_id")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: classes of documents linked at ``percent`` similarity or more."""
    return (_labelled(docs, id_col, text_col, k, percent).select("doc_id", "n_shingles", "component_id")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of ``docs``, one of each group: the one with the smallest id.

    A repeated id stays once for each of its groups; rows with a null id all stay.
    """
    keep = (_labelled(docs, id_col, text_col, 5, 75).where("doc_id = component_id").groupBy("doc_id", "component")
            .agg(F.min("tid").alias("__tid")).select(F.col("doc_id").alias("__keep"), "__tid").distinct())
    own = docs.where(F.col(id_col).isNotNull()).withColumn("__tid", F.xxhash64(text_col))
    kept = (own.join(keep, (own[id_col].cast("long") == F.col("__keep")) & (own["__tid"] == keep["__tid"]), "left_semi")
            .dropDuplicates([id_col, "__tid"]).drop("__tid"))
    return kept.unionByName(docs.where(F.col(id_col).isNull()))
