"""Registered queries of the corpus operators and their DuckDB SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .common import materialize
from .decontam import contamination
from .html import extract
from .jaccard import jaccard_components
from .langid import identify
from .minhash import near_duplicates
from .packing import pack, tokenize_pieces
from .periods import periodic_runs, repeat_tail, summarize
from .quality import grade
from .rnnlm import score_texts
from .search import search
from .sharding import shard_by_bytes
from .suffixes import remove_repeats
from .trie import prefix_trie, swap_heads

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def add(fn):
        QUERIES[name] = fn
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op3_minhash")
def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@register("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_query(table(spark, sf_dir, "documents"))


def pack_query(docs: DataFrame) -> DataFrame:
    pieces = tokenize_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    digests = materialize(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pack-pieces")
    return pack(digests)


@register("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@register("op8_suffixes")
def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_decontamination")
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def crc_mod(column: str, n: int):
    """crc32 of a number as text, modulo n; null gives -1."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(-1))


@register("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = crc_mod("doc_id", 5) == 0
    return identify(table(spark, sf_dir, "documents"), ~held).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@register("op10_search")
def op10_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    asked = docs.where(F.col("doc_id") % 100 == 0).select(F.col("doc_id").alias("query_id"), "text")
    return search(docs, asked)


@register("op4_language_model")
def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = crc_mod("doc_id", 7) == 2
    return score_texts(table(spark, sf_dir, "documents"), ~held).withColumn("held_out", held)


@register("op9_html")
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages.select("page_id", "url", "html")).withColumn("n_chars", F.length("text").cast("long"))


@register("op11_periods")
def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(periodic_runs(table(spark, sf_dir, "documents"), rewrite=repeat_tail))


@register("op12_trie")
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*swap_heads(table(spark, sf_dir, "conversations")))


@register("op13_jaccard")
def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


ORACLES: dict[str, str] = oracles.SQL
