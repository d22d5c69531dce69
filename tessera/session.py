"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the session is created by the platform; we only read its settings.
``scratch_dir`` returns the shared folder named by ``spark.checkpoint.dir`` and
sets a private one only when the setting is absent (local tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Bytes of a batch of rows on its way to a Python worker.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

_LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
}


def local_session(cpus: str | int = "*", app: str = "tessera") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in _LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh sub-folder of the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session; only when it is unset on a local
    master (as in tests) a private folder is created and registered as the checkpoint dir.
    On a cluster an unset folder is an error: executors would not share a local one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    sub = f"{name or 'tbl'}-{uuid.uuid4().hex[:12]}"
    path = base.rstrip("/") + "/" + sub
    _MADE.add(path)
    return path


#: Scratch folders that this process named and has not removed.
_MADE: set[str] = set()


def remove_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders (all that are left without ``paths``).  Only folders that
    scratch_dir named are touched; DataFrames that still read them must be done with."""
    for path in paths or sorted(_MADE):
        if path in _MADE:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
            _MADE.discard(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of about BATCH_BYTES, unless the session has its own
    limit: with Spark's 64 MB a batch of wide rows takes several times as much, in the executor's
    JVM outside its heap and in the worker, for each core."""
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in executor Python workers (once per session), and see that
    these get small batches.

    Needed where Python code runs on executors by reference (the shapefile data
    source, the shapefile writer); zips the package on the driver and hands it to
    ``SparkContext.addPyFile``, which distributes it with the job.
    """
    import zipfile
    small_batches(spark)
    sc = spark.sparkContext
    if spark.conf.get("tessera.shipped", "false") == "true":
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-pkg-"), "tessera.zip")
    with zipfile.ZipFile(out, "w") as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    spark.conf.set("tessera.shipped", "true")
