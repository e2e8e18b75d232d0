"""k-means with streaming updates.

A model is a small table ``(cluster int, center array<double>, weight double)`` of
``k`` rows. Data rows carry a dense ``array<double>`` feature column.

* ``assign``: the centres (k x dim numbers) are one constant of the expression; each row
  picks the nearest centre by squared Euclidean distance, ties to the lowest cluster. No
  join, no shuffle. ``assign_sparse`` does the same for (keys, bucket, value) rows.
* ``update``: per-cluster counts and vector sums are one grouped aggregate (combined
  inside each task first, so a cluster holding most rows still moves one partial row per
  task), then
  ``c' = (c * w * a + sum) / (w * a + m)``, ``w' = w * a + m`` with ``a`` the decay
  (``a ** m_total`` for time unit "points"); clusters that receive no point keep their
  centre and get weight ``w * a``. A cluster whose weight falls below 1e-8 of the
  largest is re-seeded by splitting the largest one.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .features import small

CENTER_SCHEMA = T.StructType([
    T.StructField("cluster", T.IntegerType()),
    T.StructField("center", T.ArrayType(T.DoubleType())),
    T.StructField("weight", T.DoubleType()),
])


def random_centers(spark: SparkSession, k: int, dim: int, weight: float = 1.0,
                   seed: int = 0) -> DataFrame:
    """Initial model as in ``StreamingKMeans.setRandomCenters(dim, weight, seed)``."""
    rng = np.random.RandomState(seed)
    c = rng.randn(k, dim)
    return spark.createDataFrame([(i, [float(x) for x in c[i]], float(weight)) for i in range(k)],
                                 CENTER_SCHEMA)


def collect_centers(centers: DataFrame) -> list[list[float]]:
    """The model's centres, ordered by cluster (k rows)."""
    return [list(r.center) for r in centers.orderBy("cluster").collect()]


def squared_distance(v: Column, c: Column) -> Column:
    sq = F.zip_with(v, c, lambda a, b: (a - b) * (a - b))
    return F.aggregate(sq, F.lit(0.0), lambda s, x: s + x)


def nearest(v: Column, centers: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest centre (ties: lowest index).

    The centres enter the plan as one JSON literal that the optimizer folds into one array
    constant, so planning time does not follow their number of coordinates.
    """
    text = json.dumps([[float(x) for x in c] for c in centers])
    table = F.from_json(F.lit(text), "array<array<double>>")
    d = F.transform(table, lambda c: squared_distance(v, c))
    return F.transform(F.array(d), lambda x: (F.array_position(x, F.array_min(x)) - 1).cast("int"))[0]


def assign(df: DataFrame, centers: DataFrame | Sequence[Sequence[float]],
           features_col: str = "features", out_col: str = "predicted") -> DataFrame:
    cs = collect_centers(centers) if isinstance(centers, DataFrame) else centers
    v = F.col(features_col).cast("array<double>")
    return df.withColumn(out_col, nearest(v, cs))


def batch_stats(assigned: DataFrame, features_col: str = "features",
                cluster_col: str = "predicted") -> DataFrame:
    """``(cluster, m, sum array<double>)`` of one batch.

    Each task adds up its rows as vectors; a row for each cluster and task is shuffled.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    x = assigned.select(F.col(cluster_col).alias("cluster"), array_to_vector(F.col(features_col).cast("array<double>")).alias("v"))
    g = x.groupBy("cluster").agg(F.count("*").alias("m"), Summarizer.sum(F.col("v")).alias("v"))
    return g.select("cluster", "m", vector_to_array("v").alias("sum"))


def wide_centers(centers: Sequence[Sequence[float]], spark: SparkSession) -> DataFrame:
    """(bucket, c0.., ) one row per coordinate, from the centres."""
    rows = [(j, *[float(c[j]) for c in centers]) for j in range(len(centers[0]))]
    return spark.createDataFrame(rows, "bucket int, " + ", ".join(f"c{i} double" for i in range(len(centers))))


def assign_sparse(features: DataFrame, keys: Sequence[str], centers: Sequence[Sequence[float]],
                  value_col: str = "tfidf") -> DataFrame:
    """``keys`` plus ``predicted``: nearest centre of each document's sparse features.

    |x - c|^2 is ordered like |c|^2 - 2 x.c, so only the buckets a document has are read.
    A document without features has a row with a null bucket.
    """
    k, dim = len(centers), len(centers[0])
    wide = small(wide_centers(centers, features.sparkSession), dim, k + 1)
    dots = [F.coalesce(F.sum(F.col(value_col) * F.col(f"c{i}")), F.lit(0.0)).alias(f"s{i}") for i in range(k)]
    g = features.join(wide, "bucket", "left").groupBy(*keys).agg(*dots)
    far = [F.struct((F.lit(float(np.dot(c, c))) - 2 * F.col(f"s{i}")).alias("d"), F.lit(i).alias("i"))
           for i, c in enumerate(centers)]
    best = F.least(*far) if k > 1 else far[0]
    return g.select(*keys, best["i"].alias("predicted"))


def sparse_stats(features: DataFrame, assigned: DataFrame, keys: Sequence[str], dim: int,
                 value_col: str = "tfidf") -> DataFrame:
    """``(cluster, m, sum array<double>)`` of sparse features and their clusters."""
    x = features.join(assigned, list(keys)).where("bucket is not null")
    sums = x.groupBy(F.col("predicted").alias("cluster"), "bucket").agg(F.sum(value_col).alias("s"))
    found = sums.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "s"))).alias("at"))
    counts = assigned.groupBy(F.col("predicted").alias("cluster")).agg(F.count("*").alias("m"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda j: F.coalesce(F.col("at")[j], F.lit(0.0)))
    return counts.join(found, "cluster", "left").select(
        "cluster", "m", F.when(F.col("at").isNull(), F.array_repeat(F.lit(0.0), dim)).otherwise(filled).alias("sum"))


def update(centers: DataFrame, stats: DataFrame, decay: float = 1.0,
           time_unit: str = "batches") -> DataFrame:
    """New model from the old one and a batch's statistics (k rows in, k rows out)."""
    if time_unit == "points":
        total = stats.select(F.coalesce(F.sum("m"), F.lit(0))).scalar()
        a = F.pow(F.lit(float(decay)), total)
    else:
        a = F.lit(float(decay))
    j = centers.join(stats, "cluster", "left")
    m = F.coalesce(F.col("m"), F.lit(0)).cast("double")
    wa = F.col("weight") * a
    new_w = wa + m
    new_c = F.when(
        F.col("m").isNull(), F.col("center")).otherwise(
        F.zip_with("center", "sum", lambda c, s: (c * wa + s) / new_w))
    step = j.select("cluster", new_c.alias("center"), new_w.alias("weight"))
    return _split_dying(step)


def _split_dying(model: DataFrame) -> DataFrame:
    """Re-seed the lightest cluster from the heaviest when it weighs < 1e-8 of it."""
    from pyspark.sql import Window

    w = Window.partitionBy()
    big = F.max_by(F.struct("cluster", "center", "weight"), F.col("weight")).over(w)
    small_w = F.min("weight").over(w)
    small_c = F.min_by("cluster", F.col("weight")).over(w)
    m = model.select("*", big.alias("_big"), small_w.alias("_sw"), small_c.alias("_sc"))
    dying = F.col("_sw") < F.lit(1e-8) * F.col("_big.weight")
    half = (F.col("_big.weight") + F.col("_sw")) / 2.0

    def nudged(sign: float) -> Column:
        return F.transform("_big.center", lambda x: x + F.lit(sign) * F.lit(1e-14)
                           * F.greatest(F.abs(x), F.lit(1.0)))

    is_big = F.col("cluster") == F.col("_big.cluster")
    is_small = F.col("cluster") == F.col("_sc")
    center = (F.when(dying & is_big, nudged(1.0)).when(dying & is_small, nudged(-1.0))
              .otherwise(F.col("center")))
    weight = F.when(dying & (is_big | is_small), half).otherwise(F.col("weight"))
    return m.select("cluster", center.alias("center"), weight.alias("weight"))
