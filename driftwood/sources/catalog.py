"""Feature tables in the session catalog: bucketed by their keys, keys and description in table properties.

A feature table is a view ``name`` over its current data table ``name__v<n>``, which is bucketed and sorted by the keys. Lookups and
merges by key therefore read the table where it lies, without an exchange. A merge writes the next data table and then
moves the view, one catalog step, so readers see the old or the new rows and a failed merge leaves the old ones; the data table
before the current one stays for readers that began earlier. Tables lie in the shared folder, never in a local warehouse.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import assert_primary_key
from ..session import new_table_path

_PROPERTY = "driftwood.keys"


def _names(x: str | Sequence[str] | None) -> list[str]:
    return [] if x is None else [x] if isinstance(x, str) else list(x)


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


class FeatureCatalog:
    def __init__(self, spark: SparkSession, buckets: int | None = None):
        """``buckets`` of new tables: the session's shuffle partitions, so that the other side of a join is dealt to them."""
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name)

    def properties(self, name: str) -> dict:
        """primary_keys, timestamp_keys, description, version, buckets of a feature table."""
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {_quoted(name)}").collect()  # a handful of properties
        held = {r["key"]: r["value"] for r in rows}
        if _PROPERTY not in held:
            raise KeyError(f"{name} is no feature table")
        return json.loads(held[_PROPERTY])

    def _data(self, name: str, version: int) -> str:
        return f"{name}__v{version}"

    def _write(self, name: str, df: DataFrame, meta: dict) -> None:
        data = self._data(name, meta["version"])
        keys = meta["primary_keys"] + meta["timestamp_keys"]
        (df.write.format("parquet").option("path", new_table_path(self.spark, data.replace(".", "_")))
         .bucketBy(meta["buckets"], *meta["primary_keys"]).sortBy(*keys).mode("errorifexists").saveAsTable(data))
        self._point(name, meta)

    def _point(self, name: str, meta: dict) -> None:
        text = json.dumps(meta).replace("\\", "\\\\").replace("'", "\\'")
        comment = meta["description"].replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE OR REPLACE VIEW {_quoted(name)} COMMENT '{comment}' TBLPROPERTIES ('{_PROPERTY}' = '{text}') "
                       f"AS SELECT * FROM {_quoted(self._data(name, meta['version']))}")

    def create(self, name: str, df: DataFrame, primary_keys: str | Sequence[str],
               timestamp_keys: str | Sequence[str] | None = None, description: str = "") -> None:
        """Register a feature table with its first rows; the keys must be there, not NULL and unique."""
        pk, tk = _names(primary_keys), _names(timestamp_keys)
        missing = [k for k in pk + tk if k not in df.columns]
        if missing:
            raise ValueError(f"keys {missing} not in schema")
        if self.exists(name):
            raise ValueError(f"{name} already exists")
        assert_primary_key(df, pk + tk)
        meta = {"primary_keys": pk, "timestamp_keys": tk, "description": description, "version": 0, "buckets": self.buckets}
        self._write(name, df.repartition(self.buckets, *pk), meta)  # a file a bucket

    def create_empty(self, name: str, columns: str, primary_keys: str | Sequence[str],
                     timestamp_keys: str | Sequence[str] | None = None, description: str = "") -> None:
        """Register a feature table from a column list in SQL (``id BIGINT, value DOUBLE``), without rows."""
        pk, tk = _names(primary_keys), _names(timestamp_keys)
        meta = {"primary_keys": pk, "timestamp_keys": tk, "description": description, "version": 0, "buckets": self.buckets}
        data, path = self._data(name, 0), new_table_path(self.spark, self._data(name, 0).replace(".", "_"))
        keys = ", ".join(f"`{k}`" for k in pk)
        order = ", ".join(f"`{k}`" for k in pk + tk)
        self.spark.sql(f"CREATE TABLE {_quoted(data)} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({order}) "
                       f"INTO {self.buckets} BUCKETS LOCATION '{path}'")
        self._point(name, meta)

    def merge(self, name: str, updates: DataFrame) -> None:
        """Upsert by the table's keys: an update's columns replace those of its row (a NULL too), columns it lacks stay,
        new keys are inserted, new columns are added. The table side of both joins is read bucket by bucket."""
        meta = self.properties(name)
        keys = meta["primary_keys"] + meta["timestamp_keys"]
        assert_primary_key(updates, keys)
        old = self.spark.table(name)
        kinds = dict(old.dtypes)
        unlike = [c for c, k in updates.dtypes if kinds.get(c, k) != k]
        if unlike:
            raise TypeError(f"columns {unlike} of {name} have another type")
        new = updates.select(*keys, *[F.col(c).alias(f"__dw_u_{c}") for c in updates.columns if c not in keys], F.lit(True).alias("__dw_hit"))
        joined = old.join(new, keys, "left")
        cols = [*old.columns, *[c for c in updates.columns if c not in kinds]]

        def value(c):
            if c in keys or c not in updates.columns:
                return F.col(c)
            if c not in kinds:
                return F.col(f"__dw_u_{c}").alias(c)
            return F.when(F.col("__dw_hit"), F.col(f"__dw_u_{c}")).otherwise(F.col(c)).alias(c)

        fresh = updates.repartition(meta["buckets"], *meta["primary_keys"]).join(old.select(*keys), keys, "left_anti")
        fresh = fresh.select(*[F.col(c) if c in updates.columns else F.lit(None).cast(kinds[c]).alias(c) for c in cols])
        self._write(name, joined.select(*[value(c) for c in cols]).unionByName(fresh), meta | {"version": meta["version"] + 1})
        self._drop_data(name, meta["version"] - 1)

    def overwrite(self, name: str, df: DataFrame) -> None:
        """Replace all rows."""
        meta = self.properties(name)
        assert_primary_key(df, meta["primary_keys"] + meta["timestamp_keys"])
        self._write(name, df.repartition(meta["buckets"], *meta["primary_keys"]), meta | {"version": meta["version"] + 1})
        self._drop_data(name, meta["version"] - 1)

    def _drop_data(self, name: str, version: int) -> None:
        if version < 0 or not self.exists(self._data(name, version)):
            return
        data = _quoted(self._data(name, version))
        place = [r["data_type"] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {data}").collect() if r["col_name"] == "Location"]
        self.spark.sql(f"DROP TABLE {data}")  # the files are ours, but the catalog keeps those of a table with a path
        for path in place:
            p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def drop(self, name: str) -> None:
        version = self.properties(name)["version"]
        self.spark.sql(f"DROP VIEW {_quoted(name)}")
        for v in (version, version - 1):
            self._drop_data(name, v)


def append_partitioned(spark: SparkSession, name: str, df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Append rows to a catalog table partitioned by some columns, made on first use; returns the table."""
    w = df.write.format("parquet").mode("append").partitionBy(*partition_by)
    if not spark.catalog.tableExists(name):
        w = w.option("path", new_table_path(spark, name.replace(".", "_")))
    w.saveAsTable(name)
    return spark.table(name)
