"""Session settings and scratch storage."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. Partition counts are left to adaptive execution: start wide, then
# coalesce to the advisory size, and split skewed join partitions at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "creditlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the default settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder named in ``spark.checkpoint.dir``.

    Without that setting it lies in a folder of the warehouse, the other store that all executors reach, which goes
    when the session's JVM ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch-{spark.sparkContext.applicationId}"
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(root)
        store = folder.getFileSystem(conf)
        store.mkdirs(folder)
        store.deleteOnExit(folder)
    return f"{root.rstrip('/')}/creditlake-{name}-{uuid.uuid4().hex}"
