"""Scoring request payloads as JSON text: encode rows into batches, decode logged payloads into rows.

Three layouts: ``dataframe_split`` (columns, index, data rows), ``dataframe_records`` (one
object per row) and column-wise ``inputs``. Encoding groups rows by a caller-given batch id
whose size the caller bounds (e.g. key div 100); decoding is ``from_json`` + ``posexplode``,
all native. NaN is written as null, never as the non-JSON token NaN.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _json_safe(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    out = []
    types = dict(df.dtypes)
    for c in cols:
        col = F.col(c)
        if types[c] in ("double", "float"):
            col = F.when(~F.isnan(col), col)
        out.append(col.alias(c))
    return out


def _json_value(c: Column) -> Column:
    """JSON text of one scalar (quoted string, number, true/false, null)."""
    return F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1)


def encode_split(df: DataFrame, batch_col: str, index_col: str, cols: Sequence[str],
                 out_col: str = "request") -> DataFrame:
    """One ``{"dataframe_split": {...}}`` text per batch, rows ordered by the index column."""
    safe = df.select(F.col(batch_col).alias("__dw_batch"), F.col(index_col).alias("__dw_idx"), *_json_safe(df, cols))
    row_text = F.concat(F.lit("["), F.concat_ws(",", *[_json_value(F.col(c)) for c in cols]), F.lit("]"))
    rows = safe.select("__dw_batch", F.struct(F.col("__dw_idx").alias("i"), row_text.alias("r")).alias("x"))
    g = rows.groupBy(F.col("__dw_batch").alias(batch_col)).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    names = F.to_json(F.array(*[F.lit(c) for c in cols]))
    text = F.concat(F.lit('{"dataframe_split":{"columns":'), names,
                    F.lit(',"index":'), F.to_json(F.transform("xs", lambda s: s["i"])),
                    F.lit(',"data":['), F.concat_ws(",", F.transform("xs", lambda s: s["r"])), F.lit("]}}"))
    return g.select(batch_col, F.size("xs").alias("n_rows"), text.alias(out_col))


def encode_records(df: DataFrame, batch_col: str, index_col: str, cols: Sequence[str],
                   out_col: str = "request") -> DataFrame:
    safe = df.select(F.col(batch_col).alias("__dw_batch"), F.col(index_col).alias("__dw_idx"), *_json_safe(df, cols))
    rows = safe.select("__dw_batch", F.struct(F.col("__dw_idx").alias("i"),
                                              F.to_json(F.struct(*[F.col(c) for c in cols])).alias("r")).alias("x"))
    g = rows.groupBy(F.col("__dw_batch").alias(batch_col)).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    text = F.concat(F.lit('{"dataframe_records":['), F.concat_ws(",", F.transform("xs", lambda s: s["r"])),
                    F.lit("]}"))
    return g.select(batch_col, F.size("xs").alias("n_rows"), text.alias(out_col))


def encode_inputs(df: DataFrame, batch_col: str, index_col: str, cols: Sequence[str],
                  out_col: str = "request") -> DataFrame:
    safe = df.select(F.col(batch_col).alias("__dw_batch"), F.col(index_col).alias("__dw_idx"), *_json_safe(df, cols))
    rows = safe.select("__dw_batch", F.struct(F.col("__dw_idx").alias("__i"), *[F.col(c) for c in cols]).alias("x"))
    g = rows.groupBy(F.col("__dw_batch").alias(batch_col)).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    body = F.struct(*[F.col("xs").getField(c).alias(c) for c in cols])
    return g.select(batch_col, F.size("xs").alias("n_rows"),
                    F.to_json(F.struct(body.alias("inputs"))).alias(out_col))


def decode_split(df: DataFrame, payload_col: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Rows from ``dataframe_split`` payloads; values are picked by column name, then cast."""
    js = T.StructType([T.StructField("dataframe_split", T.StructType([
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("index", T.ArrayType(T.LongType())),
        T.StructField("data", T.ArrayType(T.ArrayType(T.StringType())))]))])
    p = df.select(*keep, F.from_json(payload_col, js)["dataframe_split"].alias("p"))
    e = p.select(*keep, F.col("p.columns").alias("cols"), F.col("p.index").alias("idx"),
                 F.posexplode("p.data").alias("pos", "row"))
    out = [F.element_at("idx", F.col("pos") + 1).alias("index")]
    for f in schema.fields:
        at = F.array_position("cols", F.lit(f.name)).cast("int")
        out.append(F.when(at > 0, F.element_at("row", F.greatest(at, F.lit(1))))
                   .cast(f.dataType).alias(f.name))
    return e.select(*keep, *out)


def decode_records(df: DataFrame, payload_col: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    js = T.StructType([T.StructField("dataframe_records", T.ArrayType(schema))])
    return df.select(*keep, F.inline(F.from_json(payload_col, js)["dataframe_records"]))


def decode_inputs(df: DataFrame, payload_col: str, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    js = T.StructType([T.StructField("inputs", T.StructType(
        [T.StructField(f.name, T.ArrayType(f.dataType)) for f in schema.fields]))])
    p = df.select(*keep, F.from_json(payload_col, js)["inputs"].alias("p"))
    zipped = F.arrays_zip(*[F.col("p")[f.name].alias(f.name) for f in schema.fields])
    return p.select(*keep, F.inline(zipped))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A stored log of requests, a JSON text a line: ``request`` as VARIANT (NULL where the line is no JSON) and the line itself."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.try_parse_json("value").alias("request"))


def decode_log(log: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of the ``dataframe_split`` requests of a log, picked by column name and cast; a value that cannot be cast is NULL.
    Lines that are no JSON or no such request give no rows: count them with ``malformed``."""
    at = lambda path, kind: F.try_variant_get("request", f"$.dataframe_split.{path}", kind)
    p = log.select(at("columns", "array<string>").alias("cols"), F.posexplode(at("data", "array<array<string>>")).alias("pos", "row"))
    out = [F.expr(f"try_cast(get(row, cast(array_position(cols, '{f.name}') as int) - 1) as {f.dataType.simpleString()})").alias(f.name)
           for f in schema.fields]
    return p.select(*out)


def malformed(log: DataFrame) -> DataFrame:
    """Lines of a log that hold no ``dataframe_split`` request with columns and data."""
    part = lambda path, kind: F.try_variant_get("request", f"$.dataframe_split.{path}", kind)
    return log.where(part("columns", "array<string>").isNull() | part("data", "array<array<string>>").isNull()).select("line")
