"""Session helpers: building a session for tests/bench and locating shared scratch storage."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "driftwood", driver_memory: str = "16g",
                  event_log_dir: str | None = None) -> SparkSession:
    """Session for tests and the benchmark. Production jobs use the cluster's own session."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Base folder for lineage cuts and written tables.

    On a cluster this is the shared folder named by ``spark.checkpoint.dir``. Only when the
    session names none (local tests) do we create one and register it.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises in Spark Connect / classic alike
            base = None
    if not base:
        current = sc.getCheckpointDir()
        if current:
            base = os.path.dirname(current.rstrip("/"))
    if not base and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not base:
        base = tempfile.mkdtemp(prefix="driftwood-ckpt-")
        sc.setCheckpointDir(base)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def new_table_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder (writers never overwrite what they read)."""
    return f"{shared_dir(spark).rstrip('/')}/driftwood/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, whatever folder they start in: once a session, as a zip in the shared folder."""
    sc = spark.sparkContext
    if getattr(sc, "_driftwood_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(home):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(home)))
    to = sc._jvm.org.apache.hadoop.fs.Path(f"{new_table_path(spark, 'package')}/driftwood-package.zip")
    out = to.getFileSystem(sc._jsc.hadoopConfiguration()).create(to, True)
    out.write(bytearray(held.getvalue()))
    out.close()
    sc.addPyFile(to.toString())
    sc._driftwood_shipped = True


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder; survives executor loss (never localCheckpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
