"""Evaluation of classifier / clustering result tables.

Result tables have the columns ``gt`` (actual class) and ``predicted``. Class codes are
0 (negative) and 4 (positive); clustering tables also carry 2.

Every metric of a class is one cell of the confusion table over the sum of two. The cells
are counted in one scan (partial counts per task, one row shuffled per task), and the
metrics are read off that row. A metric has no row for a class whose numerator is zero.
Two quirks are kept on purpose: the false-discovery-rate and fall-out rows carry the
*actual* class of the errors they count (the row ``gt = 4`` counts those predicted 0), and
equal rows appear once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLASSES = (0, 4)
CLUSTER_CLASSES = (0, 2, 4)

#: (counted cell, other cell of the denominator) for the row of a class; a cell is (actual,
#: predicted), where True stands for the row's class and False for the other one
METRICS = {
    "precision": ((True, True), (False, True)),
    "recall": ((True, True), (True, False)),
    "false_discovery_rate": ((True, False), (False, False)),
    "fall_out": ((True, False), (True, True)),
}

SCAN_SQL = "SELECT * FROM {t}"


def run(spark: SparkSession, sql: str, results: DataFrame) -> DataFrame:
    """Run a statement with ``{t}`` bound to ``results``."""
    return spark.sql(sql, t=results)


def _cell(own: int, cell: tuple[bool, bool]) -> str:
    other = next(c for c in CLASSES if c != own)
    return "n{}{}".format(*(own if same else other for same in cell))


def confusion(results: DataFrame) -> DataFrame:
    """One row with the counts n00, n04, n40, n44 (actual class, then predicted)."""
    return results.agg(*[F.count_if((F.col("gt") == g) & (F.col("predicted") == p)).alias(f"n{g}{p}")
                         for g in CLASSES for p in CLASSES])


def _ratio(name: str, own: int) -> Column:
    counted, rest = (F.col(_cell(own, c)) for c in METRICS[name])
    return F.try_divide(counted.cast("double"), (counted + rest).cast("double"))


def metric(spark: SparkSession, results: DataFrame, name: str) -> DataFrame:
    """(gt, <name>) for the classes with something to count."""
    rows = F.array(*[F.struct(F.lit(c).alias("gt"), _ratio(name, c).alias(name)) for c in CLASSES])
    return confusion(results).select(F.inline(F.filter(rows, lambda r: r[name] > 0)))


def contingency(spark: SparkSession, results: DataFrame) -> DataFrame:
    """(gt, predicted, C1): sizes of the groups of actual class and cluster."""
    return results.where(F.col("gt").isin(*CLUSTER_CLASSES)).groupBy("gt", "predicted").agg(F.count("*").alias("C1"))


def metrics_one_pass(results: DataFrame) -> DataFrame:
    """All metrics for classes 0 and 4; undefined ratios are NULL."""
    rows = F.array(*[F.struct(F.lit(c).alias("gt"), *[_ratio(m, c).alias(m) for m in METRICS]) for c in CLASSES])
    return confusion(results).select(F.inline(rows))
