"""Row numbering and positional joins.

``zip_with_index`` numbers rows 0..n-1 in a given order without a single-partition
window: the data is range-partitioned and sorted, each partition's rows are counted
(one row per partition), the running offsets are broadcast back (bounded by the number
of partitions), and ``idx = offset + position in partition``. The sorted data is
checkpointed to the shared folder first, so both passes see the same partitions and a
lost executor does not renumber anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir


def zip_with_index(df: DataFrame, order_by: Sequence[str], idx_col: str = "idx") -> DataFrame:
    shared_dir(df.sparkSession)  # make sure a checkpoint folder is set
    s = (df.orderBy(*order_by)
           .withColumn("_p", F.spark_partition_id())
           .withColumn("_m", F.monotonically_increasing_id())
           .checkpoint(eager=True))
    counts = s.groupBy("_p").agg(F.count("*").alias("_n"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_o"))
    # position inside the partition: the low 33 bits of monotonically_increasing_id
    pos = F.col("_m") - F.shiftleft(F.col("_p").cast("bigint"), 33)
    return (s.join(F.broadcast(offsets), "_p")
             .withColumn(idx_col, F.col("_o") + pos)
             .drop("_p", "_m", "_o"))


def positional_join(left: DataFrame, right: DataFrame, left_order: Sequence[str],
                    right_order: Sequence[str], idx_col: str = "idx") -> DataFrame:
    """Pair the i-th row of ``left`` with the i-th row of ``right`` (inner join on i)."""
    a = zip_with_index(left, left_order, idx_col)
    b = zip_with_index(right, right_order, idx_col)
    return a.join(b, idx_col, "inner")


def unique_ids(df: DataFrame, col: str = "uid") -> DataFrame:
    """A unique (not contiguous) id per row, computed locally in each task."""
    return df.withColumn(col, F.monotonically_increasing_id())
