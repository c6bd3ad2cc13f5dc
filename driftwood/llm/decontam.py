"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask keeps WEIGHT of SPAN neighbouring tokens and ignores the rest, so a substitution under a hole does not
break the match. Every position of every benchmark item and of every document is hashed under each mask and the
hashes are joined. Hits fix an alignment (document, item, distance of positions); along it the tokens are
compared, and an alignment counts when some WINDOW neighbouring tokens (all, where the overlap is shorter)
agree in at least SHARE of the places.

The benchmark's seeds are broadcast only when they are counted to be at most BROADCAST_ROWS; above that the join is
an ordinary shuffled one. Likewise the ids of documents with hits, written once: no other document's tokens are shuffled.

Defined results: null or empty text has no tokens and no hits; items or overlaps of fewer than SPAN tokens are too
short to count; repeated items each count; an empty benchmark leaves all documents clean; documents are told apart
by (id, text); an empty table gives an empty result. Columns other than id and text are ignored. A very long text is held
in one row as its tokens and SPAN shifted copies of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

MASKS = ((0, 1, 2, 4, 7), (0, 1, 3, 5, 6), (0, 2, 3, 4, 6), (0, 1, 2, 3, 4))
SPAN, WINDOW, SHARE = 8, 16, 0.6
BROADCAST_ROWS = 200_000


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def seeds(df: DataFrame, keys: list[str], words: str = "words") -> DataFrame:
    """keys, pos, seed: a row for each position and mask."""
    n = F.greatest(F.size(words) - F.lit(SPAN - 1), F.lit(0))
    slices = [F.slice(words, k + 1, n).alias(f"t{k}") for k in range(SPAN)]
    at = df.select(*keys, F.posexplode(F.arrays_zip(*slices)).alias("pos", "t"))
    hashes = F.array(*[F.xxhash64(F.lit(i), *[F.col(f"t.t{k}") for k in mask]) for i, mask in enumerate(MASKS)])
    return at.select(*keys, "pos", F.explode(hashes).alias("seed"))


def alignments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """rid, item_id, matched, compared: verified alignments of docs(rid, words) with items(item_id, words)."""
    wanted = seeds(items, ["item_id"]).withColumnRenamed("pos", "item_pos")
    n_seeds = wanted.count()
    if n_seeds <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    hits = materialize(seeds(docs, ["rid"]).join(wanted, "seed")
                       .select("rid", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct(), "dc-hits")
    # only documents with a hit go on: their ids are broadcast where they are counted to be few
    found = hits.select("rid").distinct()
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    docs = docs.join(found, "rid", "left_semi")
    pairs = (hits.join(docs.dropDuplicates(["rid"]).hint("merge"), "rid")
             .join(items.select("item_id", F.col("words").alias("item_words")), "item_id"))
    a, b = F.greatest(F.col("shift"), F.lit(0)), F.greatest(-F.col("shift"), F.lit(0))
    n = F.least(F.size("words") - a, F.size("item_words") - b)
    same = F.zip_with(F.slice("words", a + 1, n), F.slice("item_words", b + 1, n),
                      lambda x, y: F.when(x == y, 1).otherwise(0))
    w = F.least(F.lit(WINDOW), F.size("same"))
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.size("same") - w + 1),
                                   lambda i: F.aggregate(F.slice("same", i, w), F.lit(0), lambda s, x: s + x)))
    total = F.aggregate("same", F.lit(0), lambda s, x: s + x)
    return (pairs.select("rid", "item_id", same.alias("same"))
            .select("rid", "item_id", total.cast("long").alias("matched"), F.size("same").cast("long").alias("compared"),
                    best.alias("best"), w.alias("w"))
            .where((F.col("w") >= SPAN) & (F.col("best") >= F.col("w") * SHARE))
            .select("rid", "item_id", "matched", "compared"))


def _prepared(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(id_col, text_col).alias("rid"),
                       tokens(F.col(text_col)).alias("words"))
    items = benchmark.where("item_id is not null").select("item_id", tokens(F.col("text")).alias("words"))
    return base, items


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_items, matched_tokens, item_ids, contaminated: one row for each document."""
    base, items = _prepared(docs, benchmark, id_col, text_col)
    per_item = (alignments(base.select("rid", "words"), items).groupBy("rid", "item_id")
                .agg(F.max("matched").alias("matched")))
    found = per_item.groupBy("rid").agg(F.count(F.lit(1)).alias("n"), F.max("matched").alias("m"),
                                        F.array_sort(F.collect_list("item_id")).alias("ids"))
    return (base.select("doc_id", "rid").join(found, "rid", "left")
            .select("doc_id", F.coalesce("n", F.lit(0)).alias("n_items"),
                    F.coalesce("m", F.lit(0)).alias("matched_tokens"),
                    F.coalesce(F.array_join(F.transform("ids", lambda x: x.cast("string")), ","), F.lit("")).alias("item_ids"),
                    F.col("n").isNotNull().alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that hold no benchmark passage."""
    base, items = _prepared(docs, benchmark, id_col, text_col)
    bad = alignments(base.select("rid", "words"), items).select(F.col("rid").alias("__rid")).distinct()
    return docs.join(bad, F.xxhash64(docs[id_col], docs[text_col]) == F.col("__rid"), "left_anti")
