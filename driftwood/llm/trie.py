"""Prefix trie of conversations by whole-sequence collapse.

Conversations that are equal turn by turn are grouped to one weighted sequence with the list of those that end there.
Sequences that are proper prefixes of others are found by anti-join; what remains are the leaves. Then every prefix of
the distinct sequences is a row that carries its sequence's weight, and one aggregation by prefix gives the nodes.

A prefix is known by its length and a 128-bit digest (two running XORs of 64-bit hashes of (position, role, text)), so no
row holds a text or a list of turns. Positions and running values are exact prefix sums over ranges of rows: a conversation with a
third of all turns is spread over many tasks, and so is a node with a third of all conversations:

* turns are numbered by a range partitioning of (conversation, turn), with per-range counts carried over;
* running values are taken in chunks of ``CHUNK`` turns, with chunk totals carried over;
* a node's smallest conversation owns it, and the nodes that a sequence owns are the last ones of its path; so what a node
  saves is joined back by (sequence, depth), a unique key, and sums over subtrees are sums of running sums by prefix;
* a node's parent is owned by the same sequence but for one node a sequence; for that one the parent is looked up, busy
  parents (at most ``BUSY`` of them, by count) by broadcast, all others by an ordinary join;
* the list of conversations that end at a node goes to its digest in packets of up to ``PACKET`` ids.

Defined results: rows with a null conversation id belong to no conversation; null roles and texts are empty; a null turn
comes first; rows of one turn number are ordered by role, then by the MD5 of the text; repeated rows are turns of their own; an empty
table has no nodes, not even a root; very long texts are hashed whole and go no further; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import materialize, n_partitions, release

#: Turns of a sequence that one window holds.
CHUNK = 4096
#: Conversation ids in one packet of an end list.
PACKET = 4096
#: Parents with more than 1 / BUSY of all looked-up rows: there are at most so many, and these are broadcast.
BUSY = 2000
WORDS = r"[^\x20\x09-\x0D]+"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _turn_numbers(turns: DataFrame) -> DataFrame:
    """conv, pos (from 0), mark (digest of role and text), words: one row a turn, in order."""
    n = n_partitions(turns)
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = (turns.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), F.md5(text).alias("md5"),
                    F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long").alias("words"))
            .repartitionByRange(n, "conv", F.asc_nulls_first("turn"), "role", "md5")
            .sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "md5")
            .select("conv", F.monotonically_increasing_id().alias("at"), F.concat_ws(":", "md5", "role").alias("mark"), "words"))
    rows = materialize(rows, "trie-turns")
    part = F.shiftright("at", 33)
    spans = rows.groupBy("conv", part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select("conv", "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"))
    return (rows.withColumn("part", part).join(spans, ["conv", "part"])
            .select("conv", (F.col("at") + F.col("shift")).alias("pos"), "mark", "words"))


def _running(df: DataFrame, group: str, at: str, value, name: str, fold, descending: bool = False) -> DataFrame:
    """Adds the running ``fold`` of ``value`` along ``at`` (0, 1, 2, ...) in each group, chunk by chunk with carried totals.

    ``value`` and ``name`` are lists of the same length; ``fold(column)`` aggregates, ``fold(a, b)`` puts two results together.
    """
    order = F.desc if descending else F.asc
    df = df.withColumn("__chunk", F.expr(f"{at} div {CHUNK}"))
    totals = df.groupBy(group, "__chunk").agg(*[fold(F.col(v)).alias(f"__t{i}") for i, v in enumerate(value)])
    earlier = Window.partitionBy(group).orderBy(order("__chunk")).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(group, "__chunk", *[F.coalesce(fold(F.col(f"__t{i}")).over(earlier), F.lit(0)).alias(f"__c{i}")
                                               for i in range(len(value))])
    inside = Window.partitionBy(group, "__chunk").orderBy(order(at)).rowsBetween(Window.unboundedPreceding, 0)
    out = df.join(totals, [group, "__chunk"])
    for i, (v, x) in enumerate(zip(value, name)):
        out = out.withColumn(x, fold(fold(F.col(v)).over(inside), F.col(f"__c{i}")))
    return out.drop("__chunk", *[f"__c{i}" for i in range(len(value))])


def _xor(a: Column, b: Column | None = None) -> Column:
    return F.bit_xor(a) if b is None else a.bitwiseXOR(b)


def _add(a: Column, b: Column | None = None) -> Column:
    return F.sum(a) if b is None else a + b


def _packets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (k1, k2, len, conv) -> packets of ids of one sequence, with their first id and number."""
    for pdf in batches:
        if not len(pdf):
            continue
        k1, k2, size, conv = (pdf[c].to_numpy() for c in ("k1", "k2", "len", "conv"))
        cut = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (size[1:] != size[:-1])) + 1
        edges = [0, *cut.tolist(), len(pdf)]
        at = [i for a, b in zip(edges, edges[1:]) for i in range(a, b, PACKET)]
        ends = [*at[1:], len(pdf)]
        text = conv.astype(str).tolist()
        yield pd.DataFrame({"k1": k1[at], "k2": k2[at], "len": size[at], "conv": conv[at], "n": np.subtract(ends, at),
                            "ids": [",".join(text[a:b]) for a, b in zip(at, ends)]})


def _end_lists(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted packets -> a row a sequence: smallest conversation, number, SHA-256 of all ids joined by commas."""
    now, state, done = None, None, []

    def frame():
        out = pd.DataFrame(done, columns=["k1", "k2", "len", "seq", "weight", "ends"])
        done.clear()
        return out

    for pdf in batches:
        for k1, k2, n, conv, many, ids in zip(*(pdf[c] for c in ("k1", "k2", "len", "conv", "n", "ids"))):
            if now != (k1, k2, n):
                if now is not None:
                    done.append((*now, state[0], state[1], state[2].hexdigest()))
                now, state = (k1, k2, n), [conv, 0, hashlib.sha256()]
            else:
                state[2].update(b",")
            state[1] += many
            state[2].update(ids.encode())
        if done:
            yield frame()
    if now is not None:
        done.append((*now, state[0], state[1], state[2].hexdigest()))
        yield frame()


def collapse_sequences(convs: DataFrame) -> DataFrame:
    """(conv, len, k1, k2) -> (k1, k2, len, seq, weight, ends): equal conversations as one weighted sequence."""
    n, key = n_partitions(convs), ["k1", "k2", "len"]
    packets = (convs.select(*key, "conv").repartitionByRange(n, *key, "conv").sortWithinPartitions(*key, "conv")
               .mapInPandas(_packets, "k1 long, k2 long, len long, conv long, n long, ids string"))
    return (packets.repartition(n, *key).sortWithinPartitions(*key, "conv")
            .mapInPandas(_end_lists, "k1 long, k2 long, len long, seq long, weight long, ends string"))


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie of sequences ``turns`` (conv, pos, mark, words; pos 0, 1, ...) of all ``convs`` (conv).

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    ship_package(turns.sparkSession)
    turns = materialize(turns.select("conv", "pos", F.xxhash64("pos", "mark").alias("x1"),
                                     F.xxhash64("mark", F.lit("second"), "pos").alias("x2"), "words"), "trie-rebuilt")
    whole = turns.groupBy("conv").agg(F.bit_xor("x1").alias("k1"), F.bit_xor("x2").alias("k2"), F.count(F.lit(1)).alias("len"))
    ends = convs.select("conv").join(whole, "conv", "left").na.fill(0, ["k1", "k2", "len"])
    seqs = materialize(collapse_sequences(ends), "trie-sequences")
    # every proper or whole prefix of the distinct sequences, the root included
    path = _running(turns.join(seqs.select(F.col("seq").alias("conv")), "conv", "left_semi"), "conv", "pos",
                    ["x1", "x2"], ["k1", "k2"], _xor)
    path = path.select(F.col("conv").alias("seq"), (F.col("pos") + 1).alias("depth"), "k1", "k2", "words")
    zero = F.lit(0).cast("long")
    path = materialize(path.unionByName(seqs.select("seq", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("words"))),
                       "trie-prefixes")
    key = ["depth", "k1", "k2"]
    own = seqs.select("seq", "len", "weight", "ends")
    proper = path.join(own.select("seq", "len"), "seq").where("depth < len").select(*key).distinct()
    leaves = (seqs.join(proper.withColumnRenamed("depth", "len"), ["len", "k1", "k2"], "left_anti")
              .select("seq", F.lit(1).cast("long").alias("leaf")))
    own = materialize(own.join(leaves, "seq", "left").na.fill(0, ["leaf"]), "trie-weights")

    owners = (path.join(own, "seq").groupBy(*key)
              .agg(F.min("seq").alias("seq"), F.sum("weight").alias("n_convs"), F.max("words").alias("words"))
              .select("seq", "depth", "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("saves")))
    owners = materialize(owners, "trie-owners")
    marked = path.select("seq", *key).join(owners.select("seq", "depth", "saves"), ["seq", "depth"], "left").na.fill(0, ["saves"])
    rest = _running(marked, "seq", "depth", ["saves"], ["below"], _add, descending=True)
    last = F.col("depth") == F.col("len")
    nodes = materialize(rest.join(own, "seq").groupBy(*key).agg(
        F.min("seq").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        F.sum("below").alias("saved_tokens"), F.max(F.when(last, F.col("ends"))).alias("ends")), "trie-nodes")

    # the first node that a sequence owns hangs from another's node (or is the root): the prefix one turn shorter
    first = nodes.groupBy("conv_id").agg(F.min("depth").alias("top"))
    above = (path.select("seq", *key).join(first, F.col("seq") == F.col("conv_id")).where("depth = top - 1")
             .select("seq", *key))
    above = materialize(above, "trie-above")
    inner = nodes.join(first, "conv_id").where("depth > top").select("conv_id", (F.col("depth") - 1).alias("depth"))
    busy = above.groupBy(*key).agg(F.count(F.lit(1)).alias("branches"))
    busy = materialize(busy, "trie-branches")
    heavy = busy.where(F.col("branches") > F.lit(max(1000, above.count() // BUSY))).select(*key)
    names = nodes.select(*key, F.col("conv_id").alias("parent"))
    few = F.broadcast(names.join(F.broadcast(heavy), key))
    parents = (above.join(few, key).select("seq", "parent")
               .unionByName(above.join(F.broadcast(heavy), key, "left_anti").join(names, key).select("seq", "parent")))
    # children: those owned by the same sequence one turn on (one at most), and the branches of others
    children = inner.withColumn("n", F.lit(1).cast("long"))
    out = (nodes.join(busy, key, "left").join(children, ["conv_id", "depth"], "left").join(first, "conv_id")
           .join(parents.withColumnRenamed("seq", "conv_id"), "conv_id", "left"))
    out = out.select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs", (F.coalesce("branches", F.lit(0)) + F.coalesce("n", F.lit(0))).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
    out = materialize(out, "trie-out")
    release(turns, seqs, path, own, owners, nodes, above, busy)
    return out


def swap_heads(turns: DataFrame, span: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, turn, role, text) whose first h = crc32(id) % ``most`` turns are replaced by the first h of
    the conversation ``id - id % span``: rebuilt turns and the ids of all conversations."""
    own = materialize(_turn_numbers(turns), "trie-own")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = own.groupBy("conv").agg(F.count(F.lit(1)).alias("turns")).withColumn("h", h)
    convs = materialize(convs.withColumn("donor", F.col("conv") - F.col("conv") % span), "trie-convs")
    given = own.where(F.col("pos") < most - 1)
    heads = (convs.where("h > 0").select("conv", "h", "donor").join(given.withColumnRenamed("conv", "donor"), "donor")
             .where("pos < h").select("conv", "pos", "mark", "words"))
    size = convs.select(F.col("conv").alias("donor"), F.col("turns").alias("has"))
    shift = convs.join(size, "donor", "left").select("conv", "h", (F.least("h", F.coalesce("has", F.lit(0))) - F.col("h")).alias("shift"))
    rest = (own.join(shift, "conv").where("pos >= h").select("conv", (F.col("pos") + F.col("shift")).alias("pos"), "mark", "words"))
    return heads.unionByName(rest), convs.select("conv")
