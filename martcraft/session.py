"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings every job relies on.  They are plain Spark knobs: AQE for
# runtime re-planning (coalescing, skew-join splitting, SMJ -> BHJ when the
# measured side is small), dynamic partition overwrite for the write modes and
# a UTC session zone so timestamp <-> date conversions are reproducible.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "martcraft", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_SCRATCH: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediates and staged writes.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is read from the session and never changed.  Where it is unset,
    a single-process session (``local[...]``, as in tests) gets a private
    folder; any other master is an error, because a driver-local folder would
    be invisible to the executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    sc = spark.sparkContext
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
    if sc.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="martcraft-ckpt-")
    return _LOCAL_SCRATCH[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), name)


def materialize(df):
    """Cut lineage of a small intermediate that several branches reuse.

    The rows are written once as parquet into the shared checkpoint folder
    (``spark.checkpoint.dir``, never a machine-local path on a cluster) and
    read back: one computation, columnar I/O, and lost executors re-read
    the files instead of recomputing the upstream joins.  (RDD-style
    ``checkpoint()`` computes the plan twice unless cached, so it is not
    used here.)"""
    import uuid
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "materialized", uuid.uuid4().hex)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
