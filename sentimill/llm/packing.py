"""Packing into optimal length buckets.

1. The lengths of all documents are counted on Spark into an exact histogram, a row for each
   length that occurs: their number is bounded by the longest text, not by the rows.
2. Dynamic programming on the driver over this histogram chooses the bucket boundaries that
   minimise padding: a bucket costs ``longest * documents - tokens``. For a given end of a
   bucket that cost is a line in its start's counts, so each layer is the lower envelope of
   lines: one pass over the lengths, in whole numbers.
3. Inside a bucket, documents are numbered without gaps in the order of a hash of their id,
   and every run of ``max(1, budget // bucket length)`` documents is one batch, which
   padded holds at most ``budget`` tokens (a longer document is a batch of its own).

The numbering is a count within (bucket, slice of the hash) plus the sizes of the slices
before it, so a bucket with a third of all documents is spread over ``slices`` tasks. Rows
that share an id more than ``HOT_ID`` times (a null id, say) are hashed with their number
in the table of lengths, so that they spread too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 8
BUDGET = 65_536
HOT_ID = 1000
BROADCAST_IDS = 100_000


def token_count(text: Column) -> Column:
    """Words: maximal runs without [\\x20\\x09-\\x0D]; 0 for a null or empty text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def boundaries(count: Sequence, tokens: Sequence, longest: Sequence, k: int) -> list[int]:
    """Last bin of each bucket: the partition into at most ``k`` runs of bins that pads least.

    Bins are in ascending order of length. Of equal partitions, the one with fewer buckets.
    """
    n = len(count)
    if n == 0:
        return []
    docs, toks = [0], [0]
    for c, t in zip(count, tokens):
        docs.append(docs[-1] + int(c))
        toks.append(toks[-1] + int(t))
    top = [int(x) for x in longest]
    best: list[int | None] = [0] + [None] * n  # least padding of the first j bins in the buckets so far
    back, results = [], []
    for _ in range(min(k, n)):
        new: list[int | None] = [None] * (n + 1)
        cut = [0] * (n + 1)
        # a start i is the line  x -> best[i] + toks[i] - docs[i] x;  an end j asks at x = top[j - 1]
        hull: list[tuple[int, int, int]] = []  # (slope, height, start), slopes falling
        front = 0
        for j in range(1, n + 1):
            i = j - 1
            if best[i] is not None:
                line = (-docs[i], best[i] + toks[i], i)
                while len(hull) - front >= 2:
                    (m1, b1, _), (m2, b2, _) = hull[-2:]
                    if (line[1] - b1) * (m1 - m2) > (b2 - b1) * (m1 - line[0]):
                        break
                    hull.pop()
                hull.append(line)
            x = top[j - 1]
            while len(hull) - front >= 2 and hull[front + 1][0] * x + hull[front + 1][1] < hull[front][0] * x + hull[front][1]:
                front += 1
            if len(hull) > front:
                m, h, cut[j] = hull[front]
                new[j] = m * x + h + x * docs[j] - toks[j]
        back.append(cut)
        best = new
        results.append(best[n])
    used = min((r, i) for i, r in enumerate(results) if r is not None)[1] + 1
    ends, j = [], n
    for step in range(used - 1, -1, -1):
        ends.append(j - 1)
        j = back[step][j]
    return ends[::-1]


def length_buckets(lengths: DataFrame, k: int = BUCKETS) -> list[int]:
    """Padded length of each bucket, ascending, for a table with ``n_tokens``."""
    rows = lengths.groupBy("n_tokens").agg(F.count("*").alias("n")).orderBy("n_tokens").collect()
    size = [r.n_tokens for r in rows]
    return [size[e] for e in boundaries([r.n for r in rows], [r.n * r.n_tokens for r in rows], size, k)]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
         budget: int = BUDGET, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, n_tokens, bucket, bucket_length, batch, slot), one row per row of ``docs``.

    ``bucket`` counts from 0 by length, ``batch`` from 0 within the bucket, ``slot`` from 0
    within the batch. A null or empty text has 0 tokens and is packed like any other.
    Texts of any length are counted whole. Repeated rows are packed separately, in any order
    among themselves; ids may be null or repeat. An empty table gives an empty table.
    Columns are read by name, so others may have any name.
    """
    from ..session import materialize

    spark = docs.sparkSession
    n = token_count(F.col(f"`{text_col}`"))
    t = docs.select(F.col(f"`{id_col}`").alias("id"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carry])
                    .alias("carried"), n.alias("n_tokens"), F.monotonically_increasing_id().alias("_row"))
    t = materialize(t, "lengths")
    bucket, padded, per = F.lit(None).cast("int"), F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
    for i, length in reversed(list(enumerate(length_buckets(t, buckets)))):
        fits = F.col("n_tokens") <= length
        bucket = F.when(fits, F.lit(i)).otherwise(bucket)
        padded = F.when(fits, F.lit(length).cast("bigint")).otherwise(padded)
        per = F.when(fits, F.lit(max(1, budget // max(1, length))).cast("bigint")).otherwise(per)
    slices = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text_id = F.coalesce(F.col("id").cast("string"), F.lit(""))
    hot = materialize(t.groupBy(F.col("id").alias("_hot")).agg(F.count("*").alias("_times")).where(F.col("_times") > HOT_ID), "hot-ids")
    n_hot = hot.count()
    if n_hot:
        side = F.broadcast(hot) if n_hot <= BROADCAST_IDS else hot
        t = t.join(side, F.col("id").eqNullSafe(F.col("_hot")), "left")
        text_id = F.concat(text_id, F.when(F.col("_times").isNotNull(), F.concat(F.lit(":"), F.col("_row"))).otherwise(F.lit("")))
    key = F.md5(text_id)
    t = t.select("id", "carried", "n_tokens", bucket.alias("bucket"), padded.alias("bucket_length"), per.alias("_per"), key.alias("_key"))
    part = F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("bigint") * F.lit(slices) / F.lit(1 << 32))
    t = t.withColumn("_slice", part.cast("int"))
    sizes = t.groupBy("bucket", "_slice").agg(F.count("*").alias("_n"))  # at most buckets x slices rows
    before = Window.partitionBy("bucket").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("bucket").alias("_b"), F.col("_slice").alias("_s"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("bucket", "_slice").orderBy("_key", "n_tokens")) - 1
    t = t.withColumn("_place", place)
    t = t.join(F.broadcast(offsets), (F.col("bucket") == F.col("_b")) & (F.col("_slice") == F.col("_s")))
    rank = F.col("_before") + F.col("_place")
    return t.select(F.col("id").alias(id_col), *[F.col(f"carried.`{c}`").alias(c) for c in carry], "n_tokens",
                    "bucket", "bucket_length", F.floor(rank / F.col("_per")).cast("bigint").alias("batch"),
                    (rank % F.col("_per")).cast("bigint").alias("slot"))
