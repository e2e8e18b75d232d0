"""Exact dedup with a two-pass Bloom filter, in DataFrame functions only.

Texts are equal when they are identical after each run of blanks, tabs and line ends is
replaced by one space. Pass 1 counts the rows that fall on each of the filter's positions
(one for each text hash: a grouped count of one number a row, which combines inside the
tasks) and keeps a bit for the positions that were hit twice. Pass 2 tests every row against these bits: a row with
an unset bit has no equal, and passes straight through; only the others shuffle by their
hash. There are no false negatives, so the result is exact for any filter size.

The bits are a table of 4 KB bitmaps. It is broadcast: 32 to 64 bits a row, so 3 % of the rows
without an equal at most share a position, in at most ``MAX_BITS`` (64 MB) at any input
size. Beyond ``MAX_BITS / 32`` rows (16.7 million) the rows are dealt by ranges of their hash
to folders, and each range, with a filter of its own, is deduplicated after the other; so
neither the broadcast nor the share of rows that shuffle without need grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

BITS_PER_ROW = 32
MAX_BITS = 1 << 29
MIN_BITS = 1 << 15
_MAP_BITS = 32768  # bits of one bitmap


def normalised(text: Column) -> Column:
    """Each run of [\\x20\\x09-\\x0D] as one space; null as empty."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D]", " ")
    return F.regexp_replace(t, r"\x20\x20+", " ")


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def _position(digest: Column, n_bits: int) -> Column:
    return F.pmod(F.xxhash64(digest, F.lit(1)), F.lit(n_bits).cast("bigint"))


def repeated_bits(digests: DataFrame, digest: str, n_bits: int) -> DataFrame:
    """(map, bits): bitmaps of the filter positions that at least two rows fall on."""
    at = digests.select(_position(F.col(digest), n_bits).alias("at"))
    twice = at.groupBy("at").agg(F.count("*").alias("n")).where("n > 1")
    return twice.groupBy(F.expr(f"at div {_MAP_BITS}").alias("map")).agg(
        F.bitmap_construct_agg(F.expr(f"at % {_MAP_BITS}")).alias("bits"))


def filter_bits(n_rows: int) -> int:
    """Size of the filter: a power of two from 2**15 to MAX_BITS."""
    want = max(MIN_BITS, BITS_PER_ROW * n_rows)
    return min(MAX_BITS, 1 << (want - 1).bit_length())


def with_maybe_repeated(df: DataFrame, digest: str, bits: DataFrame, n_bits: int,
                        out: str = "_maybe") -> DataFrame:
    """``df`` plus a flag: false where no other row can have the same digest."""
    side = F.broadcast(bits.select(F.col("map").alias("_map"), F.col("bits").alias("_bits")))
    df = df.withColumn("_at", _position(F.col(digest), n_bits)).withColumn("_key", F.expr(f"_at div {_MAP_BITS}"))
    df = df.join(side, F.col("_key") == F.col("_map"), "left")
    byte = F.expr(f"conv(hex(substring(_bits, cast((_at % {_MAP_BITS}) div 8 as int) + 1, 1)), 16, 10)")
    set_ = F.getbit(byte.cast("bigint"), F.expr("cast(_at % 8 as int)")) == 1
    return df.withColumn(out, F.coalesce(set_, F.lit(False))).drop("_at", "_key", "_map", "_bits")


def n_ranges(n_rows: int) -> int:
    """Ranges of hashes that have a filter each."""
    return max(1, -(-n_rows * BITS_PER_ROW // MAX_BITS))


def _by_range(rows: DataFrame, digest: Column, ranges: int, one) -> DataFrame:
    """``one(part)`` of the rows of each range of hashes; equal digests are in one range."""
    spark = rows.sparkSession
    dealt, done = scratch_path(spark, "ranges"), scratch_path(spark, "deduplicated")
    held = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"),
                       F.pmod(F.xxhash64(digest, F.lit(2)), F.lit(ranges)).alias("_range"))
    held.write.partitionBy("_range").parquet(dealt)
    for r in range(ranges):
        part = spark.read.parquet(dealt).where(F.col("_range") == r)
        part = part.select(*[F.col(f"_row.`{c}`").alias(c) for c in rows.columns])
        one(part).write.mode("append").parquet(done)
    return spark.read.parquet(done)


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, keep_id, group_size, kept, text_sha256).

    Null texts count as empty. Of rows with the same text and id exactly one is kept; a
    null id counts as larger than any other; of repeated rows any one stays. Texts of any
    length are read whole, and once: their digests are written to the shared folder, and both
    passes read those. An empty table gives an empty table; other columns are not looked at.
    """
    h = materialize(docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("sha"),
                                F.monotonically_increasing_id().alias("row")), "digests")
    n = h.count()
    out = _by_range(h, F.col("sha"), n_ranges(n), _reported) if n_ranges(n) > 1 else _reported(h, n)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def _reported(h: DataFrame, n: int | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept, sha) of rows (id, sha, row), by one filter."""
    n_bits = filter_bits(h.count() if n is None else n)
    flagged = with_maybe_repeated(h, "sha", repeated_bits(h, "sha", n_bits), n_bits)
    alone = flagged.where("not _maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    maybe = flagged.where("_maybe").select("id", "sha", "row")
    # written, so that both sides of the join have exchanges of their own, which the
    # adaptive skew join can split for a hot group
    first = materialize(maybe.groupBy("sha").agg(
        F.min(F.struct(F.isnull("id").alias("no_id"), "id", "row")).alias("first"), F.count("*").alias("group_size")), "groups")
    grouped = maybe.join(first, "sha").select(
        "id", F.col("first.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "sha")
    return alone.unionByName(grouped)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    As in ``dedup_report``; of rows equal in text and id, the smallest by raw text stays.
    Rows that have no equal are neither shuffled nor sorted. Columns may have any name.
    """
    n = docs.count()
    if n_ranges(n) > 1:
        return _by_range(docs, text_digest(F.col(f"`{text_col}`")), n_ranges(n),
                         lambda part: _kept(part, part.count(), id_col, text_col))
    return _kept(docs, n, id_col, text_col)


def _kept(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """``keep_first`` by one filter."""
    cols = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("_row"))
    rows = rows.withColumn("_sha", text_digest(F.col(f"_row.`{text_col}`")))
    n_bits = filter_bits(n)
    bits = materialize(repeated_bits(rows.select("_sha"), "_sha", n_bits), "bits")
    flagged = with_maybe_repeated(rows, "_sha", bits, n_bits)
    order = F.struct(F.isnull(f"_row.`{id_col}`").alias("no_id"), F.col(f"_row.`{id_col}`").alias("id"),
                     F.col(f"_row.`{text_col}`").alias("text"))
    alone = flagged.where("not _maybe").select("_row")
    first = flagged.where("_maybe").groupBy("_sha").agg(F.min_by("_row", order).alias("_row")).select("_row")
    return alone.unionByName(first).select(*[F.col(f"_row.`{c}`").alias(c) for c in cols])
