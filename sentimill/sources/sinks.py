"""Result tables (S9-S13, S17): create, append per micro-batch, scan.

Two back ends behind the same calls, both exact under retries.

**Folder** (parquet in the shared storage). An append writes its rows aside, in a folder of
its own (``rows/attempt=...``), and then publishes them with one row of the log
(``published``): batch, attempt. A scan takes the log first and reads the newest attempt of
each batch, so it never sees a half-written or half-replaced batch, and rows of a failed
attempt are never seen. ``merge`` writes the rows of many small batches into few files and
publishes them, again with one row, in place of the attempts that it covers; ``vacuum``
removes what no scan can see any more.

**JDBC** (any database with a driver on the classpath). Rows carry the name of their batch,
and a ledger table (``<table>_batches``) has a row for each batch that is complete. An append
whose batch is in the ledger does nothing; otherwise it deletes what a failed attempt left,
inserts (Spark's tasks do, each in its own transaction), counts, and enters the batch. So a
batch that is tried again, after a failure anywhere, is in the table once, and ``scan``
shows complete batches only.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NB_RESULT_SCHEMA = T.StructType([
    T.StructField("gt", T.IntegerType()), T.StructField("predicted", T.IntegerType())])

KMEANS_RESULT_SCHEMA = T.StructType([
    T.StructField("x", T.FloatType()), T.StructField("y", T.FloatType()),
    T.StructField("gt", T.IntegerType()), T.StructField("predicted", T.IntegerType())])

_LOG = "batch string, attempt string, covers array<string>, at bigint"
_LEDGER = "batch string, n bigint"
_BATCH_TYPE = "batch VARCHAR(200)"
INSERTS = 3  # times that a batch is inserted before its count is given up on


def run_table_name(prefix: str) -> Column:
    """``prefix_dd_HH_MM_SS`` from the current time (one name per run)."""
    return F.concat(F.lit(prefix + "_"), F.date_format(F.current_timestamp(), "dd_HH_mm_ss"))


def create_table(spark: SparkSession, schema: T.StructType, path: str | None = None,
                 jdbc_url: str | None = None, table: str | None = None,
                 properties: dict | None = None) -> None:
    """Create an empty result table; fails if it already exists."""
    empty = spark.createDataFrame([], schema)
    if jdbc_url:
        made = ((table, empty.withColumn("batch", F.lit(None).cast("string"))), (f"{table}_batches", spark.createDataFrame([], _LEDGER)))
        for name, rows in made:
            rows.write.option("createTableColumnTypes", _BATCH_TYPE).jdbc(jdbc_url, name, mode="errorifexists", properties=properties or {})
    else:
        empty.write.mode("errorifexists").parquet(f"{path}/rows/attempt=created")
        _publish(spark, path, "created", "created")


def append(df: DataFrame, path: str | None = None, jdbc_url: str | None = None,
           table: str | None = None, properties: dict | None = None,
           skip_empty: bool = True, batch: str | None = None) -> bool:
    """Append rows by column name; empty batches are skipped. Returns whether it wrote.

    ``batch`` names the append. In a folder the same name again replaces its rows, unless they
    are merged by then; in a database it adds nothing once the batch is complete.
    """
    if skip_empty and df.isEmpty():
        return False
    name = batch or uuid.uuid4().hex
    if jdbc_url:
        return _append_jdbc(df, jdbc_url, table, properties or {}, name)
    spark = df.sparkSession
    if _merged(_log(spark, path)).where(F.col("batch") == name).count():
        return False
    _publish(spark, path, name, _write_aside(df, path))
    return True


def scan(spark: SparkSession, path: str | None = None, jdbc_url: str | None = None,
         table: str | None = None, properties: dict | None = None) -> DataFrame:
    """The rows of all complete batches."""
    if jdbc_url:
        done = spark.read.jdbc(jdbc_url, f"{table}_batches", properties=properties or {})
        rows = spark.read.jdbc(jdbc_url, table, properties=properties or {})
        return rows.join(done, "batch", "left_semi").drop("batch")
    live = _live(_log(spark, path))  # its files are listed before those of the rows
    return _rows(spark, path).join(live.select("attempt"), "attempt", "left_semi").drop("attempt")


# ------------------------------------------------------------------ folder

def _write_aside(df: DataFrame, path: str) -> str:
    attempt = f"a{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/rows/attempt={attempt}")
    return attempt


def _publish(spark: SparkSession, path: str, batch: str, attempt: str, covers: list[str] | None = None) -> None:
    row = spark.createDataFrame([(batch, attempt, covers or [], time.time_ns())], _LOG)
    row.coalesce(1).write.mode("append").parquet(f"{path}/published")


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_LOG).parquet(f"{path}/published")


def _newest(log: DataFrame) -> DataFrame:
    """(batch, attempt): the newest attempt of each batch."""
    return log.groupBy("batch").agg(F.max_by("attempt", "at").alias("attempt"))


def _merged(log: DataFrame) -> DataFrame:
    """(batch, attempt) of attempts that a merge covers."""
    covered = log.select(F.explode("covers").alias("attempt")).distinct()
    return log.select("batch", "attempt").join(covered, "attempt", "left_semi")


def _live(log: DataFrame) -> DataFrame:
    return _newest(log).join(_merged(log).select("attempt"), "attempt", "left_anti")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their ``attempt``, by the columns that the table was created with."""
    schema = spark.read.parquet(f"{path}/rows/attempt=created").schema
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("attempt", T.StringType())])).parquet(f"{path}/rows")


def merge(spark: SparkSession, path: str, files: int = 1) -> int:
    """Rewrite the rows of all batches published so far into ``files`` files; returns how many
    attempts they came from. The merge shows at once, by one row of the log; batches that are
    published meanwhile are not touched. One merge at a time."""
    live = _live(_log(spark, path))
    old = [r.attempt for r in live.collect()]  # a row for each batch since the last merge
    if len(old) < 2:
        return 0
    rows = _rows(spark, path).where(F.col("attempt").isin(old)).drop("attempt")
    attempt = _write_aside(rows.repartition(files), path)
    _publish(spark, path, f"merge-{attempt}", attempt, old)
    return len(old)


def vacuum(spark: SparkSession, path: str, older_than_s: float) -> int:
    """Remove the folders of attempts that no scan sees (covered, replaced or failed) and that
    are older than ``older_than_s`` seconds: longer than any scan or append takes."""
    live = {r.attempt for r in _live(_log(spark, path)).collect()} | {"created"}
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{path}/rows")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone, limit = 0, (time.time() - older_than_s) * 1000
    for found in fs.listStatus(root):
        name = found.getPath().getName()
        if name.startswith("attempt=") and name[8:] not in live and found.getModificationTime() <= limit:
            gone += bool(fs.delete(found.getPath(), True))
    return gone


# ------------------------------------------------------------------ database

def _execute(spark: SparkSession, url: str, statement: str, properties: dict) -> None:
    """One statement, committed, over a connection of the driver's."""
    jvm = spark._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        props.setProperty(k, str(v))
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        connection.createStatement().executeUpdate(statement)
        if not connection.getAutoCommit():
            connection.commit()
    finally:
        connection.close()


def _append_jdbc(df: DataFrame, url: str, table: str, properties: dict, batch: str) -> bool:
    spark = df.sparkSession
    column = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier("batch")
    is_batch = "{} = '{}'".format(column, batch.replace("'", "''"))
    if not spark.read.jdbc(url, f"(SELECT {column} FROM {table}_batches WHERE {is_batch}) b", properties=properties).isEmpty():
        return False
    rows = df.withColumn("batch", F.lit(batch)).persist()
    try:
        n = rows.count()
        for _ in range(INSERTS):
            _execute(spark, url, f"DELETE FROM {table} WHERE {is_batch}", properties)
            rows.write.jdbc(url, table, mode="append", properties=properties)
            # a task whose executor is lost behind its commit inserts its rows twice
            if spark.read.jdbc(url, f"(SELECT COUNT(*) AS n FROM {table} WHERE {is_batch}) b", properties=properties).first()[0] == n:
                break
        else:
            raise RuntimeError(f"batch {batch} does not have its {n} rows in {table}")
    finally:
        rows.unpersist()
    spark.createDataFrame([(batch, n)], _LEDGER).write.jdbc(url, f"{table}_batches", mode="append", properties=properties)
    return True
