"""SparkSession construction and lineage cutting.

On a cluster the session comes from the platform; we only add settings that
are safe everywhere (AQE, skew-join splitting, UTC).  ``spark.checkpoint.dir``
is read from the session; a scratch directory is created only when it is
unset, which happens in local tests and benchmarks.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  AQE coalesces small shuffle partitions and
# splits skewed ones at runtime (a hot order_id may hold a third of all rows);
# the broadcast threshold is Spark's own size check on estimated plan size.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    # the check suite compiles well over 100 generated classes; with the
    # default cache of 100 they are recompiled on every run (measured 1.4x
    "spark.sql.codegen.cache.maxEntries": "2000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


LOCAL_DRIVER_MEMORY = "12g"


def build_session(
    master: str | None = None,
    app_name: str = "emporium",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if master and master.startswith("local"):
        # local mode runs every task inside the driver JVM: its heap is the
        # executor memory (default 1g would spill the aggregations)
        settings["spark.driver.memory"] = LOCAL_DRIVER_MEMORY
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Uses the folder the cluster names in ``spark.checkpoint.dir``.  A local
    master without one gets a fresh folder of its own; on a cluster that is an
    error, as each executor would write to its own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.path.join(tempfile.gettempdir(), f"run-{uuid.uuid4().hex}")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so shared (non-local)
    folders such as HDFS or object stores work too."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def file_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` is read from, 0 if there are none; no Spark
    job runs for it."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)
