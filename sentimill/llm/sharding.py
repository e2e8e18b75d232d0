"""Sharding along a Hilbert curve, in DataFrame functions only.

Source, language and size are quantised to cells of a cube, documents are ordered by the
index of their cell on the Hilbert curve, and the order is cut into runs of equal length.
Neighbours on the curve are neighbours in the cube, so every shard covers few sources,
languages and sizes, and a reader that filters on any of them can skip shards.

Law ``rows``: the numbers of rows of two shards differ by one at most. Equal texts stand
next to each other: they take the cell of the one with the smallest id, so that only the
cuts themselves (one fewer than shards) can part a group that fits a shard.

The order is total, and positions in it come from a range-partitioned sort with the
counts of the partitions before it, not from one window over everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.positional import zip_with_index
from ..session import materialize

BITS = 6  # cells of each dimension: 2 ** BITS


def curve_table(dims: int) -> tuple[list[int], list[int]]:
    """(digit, next state) of the Hilbert curve by ``state * 2**dims + label``.

    A state is (entry corner, direction) as entry * dims + direction; a label has one bit
    of each dimension. Follows from the Gray code: a cell is rotated and reflected so that
    the curve enters it at the corner where it left the cell before.
    """
    size, mask = 1 << dims, (1 << dims) - 1

    def right(x: int, by: int) -> int:  # rotate the bits of x
        by %= dims
        return ((x >> by) | (x << (dims - by))) & mask

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def trailing_ones(i: int) -> int:
        return (~i & (i + 1)).bit_length() - 1

    rank = {gray(i): i for i in range(size)}
    digits, states = [], []
    for entry in range(size):
        for direction in range(dims):
            for label in range(size):
                w = rank[right(label ^ entry, direction + 1)]
                corner = 0 if w == 0 else gray(2 * ((w - 1) // 2))
                axis = 0 if w == 0 else trailing_ones(w if w % 2 else w - 1) % dims
                digits.append(w)
                states.append((entry ^ right(corner, -(direction + 1))) * dims + (direction + axis + 1) % dims)
    return digits, states


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index on the curve of a cell, given by one number of ``bits`` bits per dimension."""
    dims = len(cells)
    digits, states = curve_table(dims)
    digit, state = F.array(*[F.lit(x) for x in digits]), F.array(*[F.lit(x) for x in states])

    def label(level: Column) -> Column:
        out = F.lit(0)
        for k, c in enumerate(cells):
            out = out + F.pmod(F.floor(c / F.pow(F.lit(2), level)), F.lit(2)).cast("int") * (1 << k)
        return out

    def step(acc: Column, level: Column) -> Column:
        at = acc["s"] * (1 << dims) + label(level) + 1
        return F.struct((acc["h"] * (1 << dims) + F.element_at(digit, at)).cast("bigint").alias("h"),
                        F.element_at(state, at).cast("int").alias("s"))

    start = F.struct(F.lit(0).cast("bigint").alias("h"), F.lit(0).cast("int").alias("s"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step)["h"]


def shard(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", lang_col: str = "lang", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, size, text_crc32, law, curve, shard, slot), one row per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1; a null text counts as empty, and a null
    source or language is a cell of its own. Repeated rows get places of their own, in any
    order among themselves. Shards may be empty when there are fewer rows than shards; an
    empty table gives an empty table.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in carry]).alias("carried"),
        F.col(f"`{source_col}`").alias("source"), F.col(f"`{lang_col}`").alias("lang"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("crc"),
        F.xxhash64(text).alias("text_key"))
    base = materialize(base, "shard-rows")
    # written, so that the adaptive skew join can split a hot group of equal texts
    first = materialize(base.groupBy("text_key").agg(F.min(F.struct("id", "source", "lang")).alias("first")), "shard-groups")
    rows = base.drop("source", "lang").join(first, "text_key")
    n_cells = 1 << BITS

    def hashed(name: str) -> Column:
        return F.pmod(F.xxhash64(F.coalesce(F.col(f"first.{name}"), F.lit("\0"))), F.lit(n_cells)).cast("int")

    scaled = F.least(F.floor(F.log2(F.col("size").cast("double")) * (n_cells / 32.0)), F.lit(n_cells - 1)).cast("int")
    rows = rows.withColumn("c0", hashed("source")).withColumn("c1", hashed("lang")).withColumn("c2", scaled)
    rows = rows.withColumn("curve", hilbert_index([F.col("c0"), F.col("c1"), F.col("c2")]))
    rows = zip_with_index(rows.drop("first", "c0", "c1", "c2"), ["curve", "text_key", "id"], "idx")
    n = base.count()
    s = F.expr(f"cast((idx * {n_shards}) div {max(n, 1)} as int)")
    start = F.expr(f"(shard * {n}L + {n_shards - 1}) div {n_shards}")
    return (rows.withColumn("shard", s).withColumn("slot", F.col("idx") - start)
            .select(F.col("id").alias(id_col), *[F.col(f"carried.`{c}`").alias(c) for c in carry], "size",
                    F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "curve", "shard", "slot"))
