"""Scans and sinks: parquet tables, typed CSV, schema building."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()

_TYPE_NAMES = {
    "string": T.StringType(), "str": T.StringType(),
    "int": T.IntegerType(), "int32": T.IntegerType(), "Int32": T.IntegerType(),
    "long": T.LongType(), "int64": T.LongType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "float64": T.DoubleType(),
    "float": T.FloatType(), "float32": T.FloatType(),
    "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
    "date": T.DateType(), "binary": T.BinaryType(),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table; Catalyst pushes filters and prunes columns into this scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def schema_from_pairs(pairs: Iterable[tuple[str, str | T.DataType]],
                      nullable: bool = True) -> T.StructType:
    """Fold (name, type) pairs into a StructType; type may be a name or a DataType."""
    st = T.StructType()
    for name, typ in pairs:
        dt = typ if isinstance(typ, T.DataType) else _TYPE_NAMES[typ]
        st = st.add(name, dt, nullable)
    return st


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             sep: str = ",", header: bool = True, null_value: str = "") -> DataFrame:
    """CSV scan. With a schema: declared types, empty field -> NULL. Without: inferred types. Where ``null_value`` is a mark
    of its own, empty text stays empty text."""
    reader = spark.read.option("header", header).option("sep", sep).option("nullValue", null_value).option("escape", '"')
    if schema is None:
        reader = reader.option("inferSchema", True)
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_csv_permissive(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True,
                        corrupt_col: str = "_corrupt_record") -> DataFrame:
    """CSV scan that keeps every line: one that does not fit the schema has what could be read, and its text in ``corrupt_col``."""
    full = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
    return (spark.read.schema(full).option("header", header).option("sep", sep).option("nullValue", "")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col).csv(path))


def write_csv(df: DataFrame, path: str, sep: str = ",", null_value: str = "") -> str:
    """CSV sink. Complex columns (arrays, maps, structs) are serialised as JSON text first (read them with ``from_json``)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    (df.select(*cols).write.mode("overwrite").option("header", True).option("sep", sep).option("nullValue", null_value)
     .option("escape", '"').csv(path))
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
