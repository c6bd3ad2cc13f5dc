"""Contiguous shards of nearly equal size by global prefix sums.

Rows are put into id order by range partitions. Each task sums the sizes of its own rows; the partitions'
totals, one row each, are summed up to offsets; offset plus the sum inside the partition is the number of
bytes before a row, and equal targets cut that line into shards. No row is gathered in one place: the
only global step sees one row per partition.

Defined results: null text has no bytes; rows with equal ids follow each other by text hash; null ids come
first; an empty table gives an empty result; other columns are ignored by ``shard_by_bytes``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import materialize, n_partitions


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext
    part, size, row = TaskContext.get().partitionId(), 0, 0
    for pdf in batches:
        ends = size + np.cumsum(pdf["size"].to_numpy(np.int64))
        yield pdf.assign(part=part, before=ends - pdf["size"], row=row + np.arange(len(pdf)))
        if len(pdf):
            size, row = int(ends[-1]), row + len(pdf)


def shard_by_bytes(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
                   overhead: int = 16, crc: Column | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: rows in id order, cut into shards of nearly equal bytes.

    A row goes to the shard in which its middle byte lies; slot counts from 0 inside the shard.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    kind = docs.schema[id_col].dataType.simpleString()
    placed = materialize(
        rows.repartitionByRange(n_partitions(docs), "doc_id", "text_crc32").sortWithinPartitions("doc_id", "text_crc32")
        .mapInPandas(_running, f"doc_id {kind}, size long, text_crc32 long, part int, before long, row long"),
        "shard-rows")
    totals = placed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    # one row per partition: its number is the only thing that grows here
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("bytes").over(w), F.lit(0)).alias("b0"),
                            F.coalesce(F.sum("rows").over(w), F.lit(0)).alias("r0"))
    total = totals.agg(F.sum("bytes").alias("total"))
    middle = F.col("before") + F.col("b0") + F.col("size") / F.lit(2.0)
    cut = (placed.join(offsets, "part").crossJoin(F.broadcast(total))
           .withColumn("shard", F.least(F.lit(n_shards - 1), F.floor(middle / F.col("total") * n_shards)).cast("int"))
           .withColumn("at", F.col("row") + F.col("r0")))
    firsts = cut.groupBy("shard").agg(F.min("at").alias("first"))  # n_shards rows
    return (cut.join(F.broadcast(firsts), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("at") - F.col("first")).alias("slot")))


def write_shards(docs: DataFrame, path: str, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows of ``docs`` to one folder for each shard, in slot order inside a file."""
    place = shard_by_bytes(docs, n_shards, id_col, text_col).select(
        F.col("doc_id").alias("__id"), F.col("text_crc32").alias("__crc"), "shard", "slot").dropDuplicates(["__id", "__crc"])
    crc = F.crc32(F.encode(F.coalesce(docs[text_col], F.lit("")), "UTF-8"))
    (docs.join(place, docs[id_col].eqNullSafe(F.col("__id")) & (crc == F.col("__crc"))).drop("__id", "__crc")
     .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
