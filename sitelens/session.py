"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the library expects. AQE re-plans joins from real shuffle sizes
# (turns a small side into a broadcast only after measuring it) and splits
# skewed shuffle partitions; the rest keep local runs quiet and deterministic.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sitelens") -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster the master and shuffle partitions come from the submit
    configuration; locally we size shuffles to the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # a submitted job has its driver memory already; only a local master started here gets a default
    memory = os.environ.get("SITELENS_DRIVER_MEMORY") or ("8g" if (master or "").startswith("local") else None)
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sitelens`` importable in Python workers (Arrow UDF plans pickle
    references to it): zip the package once per SparkContext and add it with
    ``addPyFile``, which Spark distributes to every executor."""
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="sitelens-pkg-"), "sitelens.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it (a shared file system every executor can read). Only a
    local master, whose executors are the driver, gets one of our own if it is
    unset; elsewhere that raises.
    """
    ship_package(spark)
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="sitelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sitelens-scratch/{name}-{uuid.uuid4().hex[:12]}"
