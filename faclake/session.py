"""Session settings and shared scratch space.

Nothing here runs at import time: callers pass a session in.  ``build_session``
is for tests, the bench and command-line use; on a cluster the session comes
from ``spark-submit`` and only ``scratch_path`` is used.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes (it
# turns a sort-merge join into a broadcast only when the measured side is under
# the threshold), coalesces small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Broadcast only sides measured below 32 MB; larger sides shuffle.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    # Parquet on disk is several times smaller than the rows in memory; scale
    # file sizes into size estimates so a "small" compressed fact table is not
    # collected and broadcast (the measured dimension is broadcast explicitly).
    "spark.sql.sources.fileCompressionFactor": "5",
    "spark.sql.parquet.filterPushdown": "true",
    # Runtime bloom filter: before shuffling a large fact (scan > 10 GB, the
    # default) for a join, drop the rows whose key is not on the dimension
    # side; built for dimensions up to 256 MB, its size is capped by
    # spark.sql.optimizer.runtime.bloomFilter.maxNumBits (8 MB).
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    # zstd: a third smaller than snappy on these text-heavy tables, so less
    # storage and scan I/O at scale; it also wrote faster here.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(master: str | None = None, app: str = "faclake",
                  shuffle_partitions: int = 8, driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    """Local/test session.  The Spark UI stays off (no web server)."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the operator to a shared file system; we
    read it from the session.  Only a local master (tests, local runs) may leave
    it unset: then we pick a fresh local folder and register it.  On a cluster
    each executor would write to a folder of its own, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- remote session: no SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="faclake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/faclake/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the Python workers (once per context).

    ``spark-submit --py-files`` does the same for a deployed job; sessions that
    were started without it get the package through ``addPyFile``.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_faclake_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="faclake-zip-"), "faclake.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("faclake", os.path.relpath(full, here)))
    sc.addPyFile(path)
    sc._faclake_shipped = True
