"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def get_spark(app: str = "tranche", cores: int | str | None = None,
              shuffle_partitions: int | None = None,
              driver_memory: str = "8g") -> SparkSession:
    """Local session with the settings the library relies on.

    On a cluster the session is created by the platform; only the UTC time
    zone matters for correctness (dates are cast from timestamps).
    """
    cores = cores or os.environ.get("BENCH_CPUS") or "*"
    parts = shuffle_partitions or (8 if cores == "*" else max(2, int(cores) * 2))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        # wide aggregates generate methods above the JIT's default size limit
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.executor.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Dates are derived from timestamps; the library's semantics are UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_compiled(spark: SparkSession) -> None:
    """The JVM never compiles a method of over 8,000 bytes, and wide plans
    generate such methods: those stages run by operators, whose expressions
    are cut into small methods.  A limit that the session sets stays."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, None) in (None, "65535"):
        spark.conf.set(key, "8000")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used when the cluster
    sets one.  Unset, a scratch folder is made for a local master only: on a
    cluster its executors could not read each other's files there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not local_master(sc.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {sc.master})")
        current = tempfile.mkdtemp(prefix="tranche-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def local_master(master: str) -> bool:
    """True for ``local`` and ``local[...]``: one process, one disk."""
    return re.fullmatch(r"local(\[[^\]]*\])?", master) is not None


class Intermediates:
    """The files that one run has written with ``materialize``."""

    def __init__(self):
        self.paths: list[str] = []

    def release(self, spark: SparkSession) -> int:
        """Delete them (on whatever file system they live), once the results
        that read them have been consumed; other runs' files stay."""
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        n = 0
        while self.paths:
            p = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            n += bool(p.getFileSystem(conf).delete(p, True))
        return n


_CURRENT: ContextVar[Intermediates] = ContextVar("intermediates", default=Intermediates())


@contextmanager
def run_intermediates():
    """What is materialised inside the block belongs to the handle it gives."""
    handle = Intermediates()
    token = _CURRENT.set(handle)
    try:
        yield handle
    finally:
        _CURRENT.reset(token)


def materialize(df, name: str = "stage", partition_by: str | None = None):
    """Write ``df`` once as parquet under the shared checkpoint folder and
    return a DataFrame reading it back (in folders by ``partition_by``).

    This cuts the lineage (later jobs read files, not the plan), computes
    the plan exactly once (an eager ``checkpoint()`` of a DataFrame runs it
    twice), keeps columnar pruning / pushdown on the re-read, and survives
    executor loss because the files live on shared storage.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tranche-{name}-{uuid.uuid4().hex}"
    _CURRENT.get().paths.append(path)
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)
    # with its schema: a table without rows has no partition folder to tell it
    return spark.read.schema(df.schema).parquet(path) if partition_by else spark.read.parquet(path)


def release_materialized(spark: SparkSession) -> int:
    """Delete what was materialised outside any ``run_intermediates`` block."""
    return _CURRENT.get().release(spark)
