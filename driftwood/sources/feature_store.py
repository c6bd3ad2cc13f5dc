"""Feature tables on shared storage: registration with keys, versioned writes, merge, read, drop.

Each write lands in a fresh version folder ``v<n>``; readers pick the highest version whose
Spark commit marker (``_SUCCESS``) exists, so a merge never overwrites the files it reads and
a failed job leaves the previous version current. Metadata (keys, timestamp keys,
description) is a one-row JSON written with Spark. Paths go through the Hadoop FileSystem of
the session, so the same code runs on local disk, HDFS or object stores.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.tables import assert_primary_key, merge_frames
from ..session import shared_dir


@dataclass
class FeatureTable:
    name: str
    primary_keys: list[str]
    timestamp_keys: list[str] = field(default_factory=list)
    description: str = ""

    @property
    def all_keys(self) -> list[str]:
        return self.primary_keys + self.timestamp_keys


class FeatureStore:
    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = (root or f"{shared_dir(spark).rstrip('/')}/driftwood/feature_store").rstrip("/")

    # -- file system helpers (Hadoop FS of the session) --
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return bool(fs.exists(p))

    def _versions(self, name: str, committed: bool = True) -> list[int]:
        base = f"{self.root}/{name}"
        if not self._exists(base):
            return []
        fs, p = self._fs(base)
        out = []
        for st in fs.listStatus(p):
            m = re.fullmatch(r"v(\d+)", st.getPath().getName())
            if m and (not committed or self._exists(f"{base}/{st.getPath().getName()}/_SUCCESS")):
                out.append(int(m.group(1)))
        return sorted(out)

    # -- catalog-like API --
    def table_exists(self, name: str) -> bool:
        return self._exists(f"{self.root}/{name}/_meta/_SUCCESS")

    def create_table(self, name: str, primary_keys: str | Sequence[str], df: DataFrame | None = None,
                     schema: T.StructType | None = None, timestamp_keys: str | Sequence[str] | None = None,
                     description: str = "", exist_ok: bool = True) -> FeatureTable:
        pk = [primary_keys] if isinstance(primary_keys, str) else list(primary_keys)
        tk = [] if timestamp_keys is None else ([timestamp_keys] if isinstance(timestamp_keys, str)
                                                 else list(timestamp_keys))
        if self.table_exists(name):
            if not exist_ok:
                raise ValueError(f"feature table {name} already exists")
            return self.get_table(name)
        if df is None and schema is None:
            raise ValueError("need df or schema")
        sch = df.schema if df is not None else schema
        missing = [k for k in pk + tk if k not in sch.fieldNames()]
        if missing:
            raise ValueError(f"keys {missing} not in schema")
        meta = {"name": name, "primary_keys": pk, "timestamp_keys": tk,
                "description": description, "schema": sch.json()}
        # the data first: a table whose first write failed does not exist
        self._write_version(name, df if df is not None else self.spark.createDataFrame([], sch), pk + tk)
        (self.spark.createDataFrame([(json.dumps(meta),)], "meta string")
         .coalesce(1).write.mode("overwrite").text(f"{self.root}/{name}/_meta"))
        return self.get_table(name)

    def get_table(self, name: str) -> FeatureTable:
        if not self.table_exists(name):
            raise KeyError(name)
        meta = json.loads(self.spark.read.text(f"{self.root}/{name}/_meta").first()[0])
        return FeatureTable(meta["name"], meta["primary_keys"], meta["timestamp_keys"], meta["description"])

    def read_table(self, name: str) -> DataFrame:
        vs = self._versions(name)
        if not vs:
            raise KeyError(name)
        return self.spark.read.parquet(f"{self.root}/{name}/v{vs[-1]}")

    def _write_version(self, name: str, df: DataFrame, keys: list[str], validate: bool = True) -> str:
        if validate:
            assert_primary_key(df, keys)
        vs = self._versions(name, committed=False)  # a lost driver may have left a folder without its marker
        path = f"{self.root}/{name}/v{(vs[-1] + 1) if vs else 0}"
        df.write.mode("errorifexists").parquet(path)
        return path

    def write_table(self, name: str, df: DataFrame, mode: str = "merge", validate: bool = True) -> str:
        """mode='merge': upsert by the table keys (see ``merge_frames``); 'overwrite': replace."""
        ft = self.get_table(name)
        keys = ft.all_keys
        if mode == "overwrite":
            return self._write_version(name, df, keys, validate)
        if mode != "merge":
            raise ValueError(mode)
        if validate:
            assert_primary_key(df, keys)
        merged = merge_frames(self.read_table(name), df, keys)
        return self._write_version(name, merged, keys, validate=False)

    def drop_table(self, name: str) -> None:
        fs, p = self._fs(f"{self.root}/{name}")
        if fs.exists(p):
            fs.delete(p, True)
