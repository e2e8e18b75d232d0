"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Each source has a target share of the result; its mean repetition rate is
``share * result size / rows of the source``. Every document draws a number of copies by
inverting the Poisson distribution of its source's rate at a number in [0, 1) taken from a
hash of seed and id, so the draw depends neither on partitions nor on other documents, and
a repeated task draws the same. Where an id is null or occurs more than once, each of its
rows is hashed with a row number of its own, so they draw apart and spread like others. The copies are exploded, and the result is dealt out and
ordered by a hash of (seed, id, copy): a global shuffle.

A rate above ``PART`` is drawn as the sum of independent parts of at most ``PART`` each, so
the table of cumulative probabilities stays short at any rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

SEED = 17
PART = 32.0
TERMS = 160  # P(Poisson(32) > 160) < 1e-50
BROADCAST_CELLS = 1 << 23  # numbers in the table of rates that are broadcast (64 MB); a larger one is joined by a shuffle
BROADCAST_IDS = 1 << 20    # repeated ids that are broadcast; more are joined by a shuffle


def unit(*parts: Column) -> Column:
    """A number in [0, 1) with 52 random bits from the MD5 of the parts."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def rates(docs: DataFrame, source_col: str = "source", weights: dict | None = None,
          temperature: float = 2.0, epochs: float = 1.0) -> DataFrame:
    """(source, n, rate): mean repetitions of each source's documents.

    ``weights`` gives target weights by source (normalised over the sources present; a
    source without one gets none). By default the weight of a source is
    ``n ** (1 / temperature)``. The result has ``epochs`` times the rows of ``docs`` in the
    mean. A null source is a source of its own, with the weight under ``None``.
    """
    n = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        w = F.pow(F.col("n").cast("double"), F.lit(1.0 / temperature))
    else:
        w = F.when(F.col("source").isNull(), F.lit(float(weights.get(None, 0.0))))
        for name, value in weights.items():
            if name is not None:
                w = w.when(F.col("source") == F.lit(name), F.lit(float(value)))
        w = w.otherwise(F.lit(0.0))
    weighed = n.withColumn("w", w)
    total = weighed.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    scale = epochs * (total["n"] or 0) / total["w"] if total["w"] else 0.0
    return weighed.select("source", "n", (F.col("w") * F.lit(float(scale)) / F.col("n")).alias("rate"))


def _cumulative(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of a Poisson variable with a mean of at most PART."""
    step = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf")),
        lambda s, k: F.struct((s["p"] * rate / k).alias("p"),
                              F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * rate / k)).alias("cdf")))
    return step["cdf"]


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", weights: dict | None = None,
        temperature: float = 2.0, epochs: float = 1.0, seed: int = SEED) -> DataFrame:
    """All columns of ``docs`` plus (mix_rate, mix_copy, mix_key), a row for each copy.

    ``mix_copy`` counts from 0; ``mix_key`` is the shuffle order. Columns of ``docs`` with
    these names are replaced. Rows without an id, or with one that other rows have too, draw
    a number each, by their place in the table. An empty table gives an empty table. Texts
    are not looked at.
    """
    r = rates(docs, source_col, weights, temperature, epochs)
    parts = F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int")
    table = r.select(F.col("source").alias("_source"), "rate", parts.alias("_parts"),
                     _cumulative(F.col("rate") / parts).alias("_cdf"))
    side = F.broadcast(table) if r.count() * (TERMS + 4) <= BROADCAST_CELLS else table
    kept = [c for c in docs.columns if c not in ("mix_rate", "mix_copy", "mix_key")]
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.monotonically_increasing_id().alias("_at"))
    j = d.join(side, F.col(f"_row.`{source_col}`").eqNullSafe(F.col("_source")))
    ident = F.coalesce(F.col(f"_row.`{id_col}`").cast("string"), F.lit(""))
    again = docs.groupBy(F.col(f"`{id_col}`").alias("_again")).agg(F.count("*").alias("_times"))
    again = materialize(again.where("_times > 1 or _again is null"), "repeated-ids")
    n_again = again.count()
    if n_again:
        j = j.join(F.broadcast(again) if n_again <= BROADCAST_IDS else again,
                   F.col(f"_row.`{id_col}`").eqNullSafe(F.col("_again")), "left")
        ident = F.concat(ident, F.when(F.col("_times").isNotNull(), F.concat(F.lit(":"), F.col("_at"))).otherwise(F.lit("")))
    j = j.withColumn("_ident", ident)
    ident = F.col("_ident")
    draws = F.transform(F.sequence(F.lit(1), F.col("_parts")), lambda k: unit(F.lit(seed), ident, k))
    count = F.aggregate(draws, F.lit(0), lambda total, u: total + F.size(F.filter("_cdf", lambda c: c <= u)))
    j = j.withColumn("_n", count).where("_n > 0")
    j = j.select("_row", "_ident", F.col("rate").alias("mix_rate"),
                 F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("mix_copy"))
    key = F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), ident, F.col("mix_copy").cast("string")))
    j = j.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], "mix_rate", "mix_copy", key.alias("mix_key"))
    return j.repartition("mix_key").sortWithinPartitions("mix_key")
