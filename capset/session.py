"""Session helpers.

The library never creates a session on its own inside an operator; these helpers are for
scripts, tests and the benchmark.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
session (the shared folder a cluster names) and only falls back to a local folder when the
setting is unset and the session runs on one machine, as in tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.parquet.aggregatePushdown": "true",
    # Arrow batches of image rows are large; keep pandas batches bounded (image jobs may go lower)
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    # streaming dedup keeps every hash seen: keep that state in RocksDB, not on the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "capset",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set a local one only where none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: executors need a checkpoint folder that all of them share")
        current = tempfile.mkdtemp(prefix="capset-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint dir for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    if ":" not in base and not base.startswith("/"):
        base = os.path.abspath(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``capset`` importable in Python workers (data sources, pandas UDFs).

    The package is zipped once per driver and added with ``addPyFile`` (what ``--py-files``
    does); executors fetch it from the driver.  No-op when already shipped to this context.
    """
    import zipfile

    sc = spark.sparkContext
    ident = id(sc._jsc)
    if ident in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, zpath = tempfile.mkstemp(prefix="capset-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(ident)
