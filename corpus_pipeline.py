"""The corpus pipeline: filter, deduplicate, decontaminate and pack the documents.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of
``documents``, but for the last, which returns the packed pieces. Nulls, empty texts, repeated rows, empty tables and
extra columns are treated as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood.llm.common import materialize
from driftwood.llm.decontam import drop_contaminated
from driftwood.llm.minhash import drop_near_duplicates
from driftwood.llm.quality import keep_good
from driftwood.llm.queries import pack_query
from driftwood.llm.suffixes import without_repeats


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model grades as good."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur more than once."""
    out = without_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in sequences of 4096 tokens."""
    return pack_query(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("passage_dedup", passage_dedup),
          ("decontaminate", decontaminate), ("packing", packing)]

#: A trained classifier and a tokenizer are no SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
