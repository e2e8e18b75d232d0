"""Document fingerprints by content-defined chunking.

A gear hash (each byte shifts the hash left by one and adds a table value, so the hash
depends on the last 32 bytes) marks possible chunk boundaries. Chunking is normalised: up
to ``NORMAL`` bytes a boundary needs 8 zero bits, beyond that 4, with ``LEAST`` and ``MOST``
as bounds, which keeps sizes close together. Boundaries depend on nearby bytes only, so an
insertion changes the chunks around it and no others.

A fingerprint is the set of chunk digests with the number of bytes they stand for. The
containment of one text in another is the share of its bytes in chunks that the other has
too, each digest counted as often as both have it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, NORMAL, MOST = 24, 56, 192
STRICT, LOOSE = 8, 4  # zero bits before and after the normal size

_GEAR = np.frombuffer(hashlib.shake_128(b"gear").digest(4 * 256), dtype=np.uint32)


def gear_hash(raw: np.ndarray) -> np.ndarray:
    """The gear hash after each byte: the sum of the last 32 table values, shifted by age."""
    h = _GEAR[raw]
    for k in (1, 2, 4, 8, 16):
        older = h[:-k] << np.uint32(k)
        h = h.copy()
        h[k:] += older
    return h


def chunks(data: bytes) -> list[tuple[int, int]]:
    """(start, end) of the chunks; none for an empty text."""
    n = len(data)
    if n <= LEAST:
        return [(0, n)] if n else []
    h = gear_hash(np.frombuffer(data, np.uint8))
    at = np.flatnonzero(h >> np.uint32(32 - LOOSE) == 0)
    loose = (at + 1).tolist()
    strict = (at[h[at] >> np.uint32(32 - STRICT) == 0] + 1).tolist()
    out, start = [], 0
    while n - start > LEAST:
        k = bisect_left(strict, start + LEAST)
        if k < len(strict) and strict[k] < start + NORMAL:
            end = strict[k]
        else:
            k = bisect_left(loose, start + NORMAL)
            end = min(loose[k] if k < len(loose) else n, start + MOST, n)
        out.append((start, end))
        start = end
    if start < n:
        out.append((start, n))
    return out


def weights(data: bytes) -> dict[str, int]:
    """Digest of each chunk -> bytes in chunks with this digest."""
    out: dict[str, int] = {}
    view = memoryview(data)
    for a, b in chunks(data):
        d = xxhash.xxh3_64_hexdigest(view[a:b])
        out[d] = out.get(d, 0) + b - a
    return out


def as_text(w: dict[str, int]) -> str:
    return ",".join(f"{d}:{n}" for d, n in sorted(w.items()))


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    """Share of a's bytes in chunks of b; for an empty a 1 if b is empty too, else 0."""
    total = sum(a.values())
    if not total:
        return float(not b)
    return sum(min(n, b[d]) for d, n in a.items() if d in b) / total


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [as_text(weights((t or "").encode())) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], names=["id", "fingerprint"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint), one row per row of ``docs``; a null or empty text has an empty one."""
    t = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = t.mapInArrow(_printed, f"id {t.schema['id'].dataType.simpleString()}, fingerprint string")
    return out.withColumnRenamed("id", id_col)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next text."""
    k = len(text) // 4
    return text[:len(text) - k] + following[:k] if k else text


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (part, extra, id, text): each row that is not extra against the row behind it."""
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    rows: list[tuple] = []
    held = None  # (part, id, text, weights) that waits for the next text
    for batch in batches:
        for part, extra, ident, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            own = weights(text.encode())
            if held is not None and held[0] == part:
                e = edited(held[2], text).encode()
                w = weights(e)
                rows.append((held[1], len(held[2]), hashlib.sha256(e).hexdigest(), as_text(held[3]), as_text(w),
                             containment(held[3], w), containment(held[3], own)))
            held = None if extra else (part, ident, text, own)
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


_LAST = (1 << 63) - 1


def _edges(t: DataFrame, parts: int) -> list[tuple[int, int]]:
    """At most ``parts`` - 1 cuts of the rows by (key, h): quantiles of the key, and within a key
    that holds several of them quantiles of h. A row for each such key reaches the driver."""
    if parts < 2:
        return []
    grid, exact = [i / parts for i in range(1, parts)], max(10_000, 20 * parts)
    cuts = t.agg(F.percentile_approx("key", grid, exact)).first()[0] or []
    times = Counter(cuts)
    hot = [k for k, n in times.items() if n > 1]
    edges = {(k, _LAST) for k in times}
    if hot:
        inner = t.where(F.col("key").isin(hot)).groupBy("key").agg(F.percentile_approx("h", grid, exact).alias("cuts"))
        for k, own in inner.collect():
            edges |= {(k, own[i * len(own) // times[k]]) for i in range(times[k])}
    return sorted(edges)


def _number_below(key: Column, h: Column, edges: list[tuple[int, int]]) -> Column:
    """How many of the sorted ``edges`` are below (key, h), by binary search."""
    if not edges:
        return F.lit(0)
    keys, hashes = (F.array(*[F.lit(e[i]).cast("bigint") for e in edges]) for i in (0, 1))
    steps = F.sequence(F.lit(len(edges).bit_length() - 1), F.lit(0), F.lit(-1))

    def step(at: Column, k: Column) -> Column:
        to = at + F.pow(F.lit(2.0), k).cast("int")
        i = F.least(to, F.lit(len(edges))) - 1
        below = (F.get(keys, i) < key) | ((F.get(keys, i) == key) & (F.get(hashes, i) < h))
        return F.when((to <= len(edges)) & below, to).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    Each text is compared with its edited form and with the next text, in ascending order
    of id (an integer; null first), then of a hash of the text. A null text counts as empty;
    the last one's next is the first; repeated rows follow each other. A single row is its
    own next; texts of any length are compared whole; an empty table gives an empty table.
    Other columns are not looked at.

    Quantiles of the ids, and of the hashes within an id that many rows share, cut the order
    into parts; a part goes to one task, sorted, along with the first row of the part behind
    it. So every text is shuffled once.
    """
    t = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(-(1 << 63)).cast("bigint")).alias("key"),
                    F.col(f"`{id_col}`").cast("bigint").alias("id"),
                    F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    t = t.withColumn("h", F.xxhash64("text"))
    edges = _edges(t, max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    part = _number_below(F.col("key"), F.col("h"), edges).cast("int")
    # a row for each part
    firsts = {r.part: tuple(r.first) for r in t.select(part.alias("part"), F.struct("key", "h").alias("row")).groupBy("part")
              .agg(F.min("row").alias("first")).collect()}
    order = sorted(firsts)
    also = F.lit(None).cast("int")
    if order:
        ahead = F.create_map(*[x for i, p in enumerate(order) for x in (F.lit("{}:{}".format(*firsts[p])), F.lit(order[i - 1]))])
        also = F.element_at(ahead, F.concat_ws(":", "key", "h"))
    rows = t.select("id", "key", "h", "text", F.explode(F.filter(
        F.array(F.struct(part.alias("part"), F.lit(False).alias("extra")), F.struct(also.alias("part"), F.lit(True).alias("extra"))),
        lambda x: x["part"].isNotNull())).alias("to"))
    rows = rows.select(F.col("to.part").alias("part"), F.col("to.extra").alias("extra"), "key", "h", "id", "text")
    dealt = rows.repartitionById(max(1, len(edges) + 1), "part").sortWithinPartitions("part", "extra", "key", "h", "text")
    out = dealt.select("part", "extra", "id", "text").mapInArrow(
        _compare, "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                  "near_edited double, near_next double")
    return out.withColumnRenamed("id", id_col)
