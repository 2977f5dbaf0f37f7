"""Session defaults: UTC, ANSI on, AQE on, Spark UI off, checkpoint dir."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "notaflow") -> SparkSession:
    """Local/test session. On a cluster the submitter's session is used as is."""
    builder = (
        SparkSession.builder.master(master or os.environ.get("NOTAFLOW_MASTER", "local[8]"))
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        # Keys of stateful streams live on local disk, not on the executors' heap.
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("NOTAFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Wide projections (document parsing / building) generate methods over
        # the JVM's 8 KB JIT limit; let the JIT compile them instead of
        # interpreting them.
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: Bytes of a generated method beyond which HotSpot only interprets it.
JIT_LIMIT = 8000


def bound_methods(spark: SparkSession) -> None:
    """Wide projections (document parsing / building) fused into one generated method
    pass the JIT's limit and run interpreted, several times as slow. Given the limit, Spark
    evaluates those stages in many small methods. In a session that someone else started
    this is what can be set (``get_spark`` also sets the JVM's flag)."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(JIT_LIMIT))


@contextmanager
def set_while(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for what is written within the block."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``. Only a local session (tests, bench)
    may go without: it gets a folder of its own, which its executors share."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="notaflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared checkpoint dir for written tables."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/notaflow/{name}-{uuid.uuid4().hex[:12]}"


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Scratch tables go when the application ends."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
