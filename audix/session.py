"""Spark session settings shared by the library, the tests and the bench.

Everything here is ordinary session configuration: UTC time, adaptive query
execution (runtime partition coalescing, skew-join splitting and size-checked
broadcast conversion), dynamic partition overwrite for idempotent reruns, and a
checkpoint directory taken from the cluster when it names one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE decides broadcast vs. shuffle at runtime
# from measured stage sizes, which is the size check for joins whose small side
# is not provably bounded.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Iterative jobs checkpoint every round: let Spark delete the files of
    # rounds that are no longer referenced instead of filling shared storage.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "audix",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("AUDIX_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of BASE_CONF to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.ui") or k.startswith("spark.cleaner"):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session
            pass
    # A session built elsewhere: checkpoints read this when they are written.
    spark.sparkContext._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (spark.checkpoint.dir).

    Only when the session names none (tests, the bench on one machine) is a
    scratch folder created and registered; on a cluster the setting is always
    read from the session, never invented.
    """
    sc = spark.sparkContext
    d = sc._jsc.sc().getCheckpointDir()
    if d.isDefined():
        return d.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(a machine-local scratch folder would not survive executor loss)")
        conf_dir = tempfile.mkdtemp(prefix="audix-ckpt-", dir=os.environ.get("AUDIX_SCRATCH", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc._jsc.sc().getCheckpointDir().get()


def write_shared(df, name: str):
    """``df`` written once as Parquet into the shared checkpoint folder and read again."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def drop_shared(df) -> None:
    """Delete a table of ``write_shared`` that nothing reads any more."""
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(df.shared_path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared checkpoint dir (survives executor loss).

    The frame is persisted first so the checkpoint write reads the computed
    blocks instead of running the plan a second time; the cache is released
    once the files are written."""
    from pyspark import StorageLevel
    spark = spark or df.sparkSession
    checkpoint_dir(spark)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist(blocking=False)
    return out
