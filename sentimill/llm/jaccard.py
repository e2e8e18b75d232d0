"""N-gram Jaccard join with Bayesian candidate pruning.

Texts are sets of shingles of five words. Steps:

1. every text gets a key of its word sequence (texts with one key are copies and enter the
   join once) and the keys of its MinHash bands;
2. texts that share a band are linked to the smallest text of the band (a star, not all
   pairs), and the connected components of these links, computed on Spark, are the
   candidate groups. Every pair that shares a band lies inside one group;
3. a group is cut into blocks of bounded size by a hash of the key, and each pair of blocks
   is one unit of work, so a hot group spreads over many tasks. Inside a unit the MinHash
   values of a pair are compared ``STEP`` at a time; a pair is dropped when the posterior
   probability that its similarity reaches the threshold falls below ``tolerance``
   (uniform prior: Beta(m + 1, n - m + 1) after m of n matches). What is left is verified
   exactly on the shingle sets. A unit returns a row for each linked text: its number of
   links in the unit and one link towards the smallest text of its local group, so rows
   out do not grow with the square of a group;
4. link counts are summed by text, and components of the returned links are the classes.

A pair at similarity 0.8 misses all 32 bands of 4 values with probability 5e-8, and is
pruned with a probability of about ``tolerance`` at each step. Keys and shingles are 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import words as W
from .components import components

THRESHOLD = 0.8
BANDS, ROWS = 32, 4
PERMS = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-7
BLOCK_TEXTS, BLOCK_SHINGLES = 256, 200_000  # a block has about so many texts or shingles

_rng = np.random.RandomState(20)
_A = (_rng.randint(0, 1 << 31, PERMS).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.randint(0, 1 << 31, PERMS).astype(np.uint32)


def minhash(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """[texts, PERMS] MinHash values (uint32); every text must have a shingle."""
    h = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    out = np.empty((len(offsets) - 1, PERMS), np.uint32)
    for p in range(PERMS):
        out[:, p] = np.minimum.reduceat(h * _A[p] + _B[p], offsets[:-1])
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """[texts, BANDS] signed 64-bit keys of the bands."""
    v = sig.astype(np.uint64).reshape(len(sig), BANDS, ROWS)
    k = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), (len(sig), BANDS))
    for r in range(ROWS):
        k = W.mix(k * np.uint64(0x9E3779B97F4A7C15) + v[:, :, r])
    return k.view(np.int64)


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """After STEP, 2 STEP, ... values: the fewest matches that keep a pair.

    P(J >= t | m of n) under a uniform prior is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, PERMS + 1, STEP):
        p, m = 0.0, -1
        while p < tolerance:
            m += 1
            p += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _groups(column) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, word keys, word counts, shingles, shingle offsets) of runs of texts."""
    for first, h, off in W.groups(column):
        s, s_off = W.shingles(h, off)
        yield first, W.sequence_keys(h, off), np.diff(off), s, s_off


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (id, key, bands); key and bands are null for a text without words."""
    for batch in batches:
        for first, keys, n_words, s, s_off in _groups(batch.column(1)):
            some = n_words > 0
            at = np.concatenate([s_off[:-1][some], [len(s)]])
            bands = band_keys(minhash(s, at)) if some.any() else np.zeros((0, BANDS), np.int64)
            off = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(keys)), pa.array(keys, mask=~some),
                 pa.ListArray.from_arrays(pa.array(off), pa.array(bands.ravel()))],
                names=["id", "key", "bands"])


def _with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, cluster, text) -> (key, cluster, sig, shingles) with distinct sorted shingles."""
    for batch in batches:
        for first, keys, n_words, s, s_off in _groups(batch.column(2)):
            some = n_words > 0
            rows = np.flatnonzero(some)
            if not len(rows):
                continue
            sig = minhash(s, np.concatenate([s_off[:-1][some], [len(s)]]))
            sets = [np.unique(s[s_off[r]:s_off[r + 1]]).tobytes() for r in rows]
            picked = pa.array(rows + first)
            want = batch.column(0).take(picked)
            out = pa.RecordBatch.from_arrays(
                [want, batch.column(1).take(picked), pa.array([x.tobytes() for x in sig], pa.binary()),
                 pa.array(sets, pa.binary())], names=["key", "cluster", "sig", "shingles"])
            # an id may stand for several texts: only the text of this key counts
            yield out.filter(pa.array(np.asarray(want) == keys[rows]))


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs of sets."""
    if len(left) < 2000:
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                         for i, j in zip(left, right)], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, often = np.unique(flat, return_inverse=True, return_counts=True)
    keep = often[column] > 1  # a shingle of one text is in no intersection
    rank = np.cumsum(often > 1) - 1
    column, owner = rank[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = 2048
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[lo:hi], column[lo:hi] - at] = 1
        total += m @ m.T
    return np.rint(total[left, right]).astype(np.int64)


def similar_pairs(sig: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray,
                  threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """The candidate pairs that reach the threshold: pruned step by step, then verified."""
    matches = np.zeros(len(left), np.int32)
    for k, least in enumerate(least_matches(threshold, tolerance)):
        part = slice(k * STEP, (k + 1) * STEP)
        matches += (sig[left, part] == sig[right, part]).sum(axis=1, dtype=np.int32)
        alive = matches >= least
        left, right, matches = left[alive], right[alive], matches[alive]
    size = np.array([len(x) for x in sets], np.int64)
    both = _shared(sets, left, right) if len(left) else np.zeros(0, np.int64)
    ok = both >= threshold * (size[left] + size[right] - both) - 1e-9
    return left[ok], right[ok]


def _local_groups(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member of the connected group of each of 0..n-1."""
    label = np.arange(n)
    while True:
        was = label.copy()
        least = np.minimum(label[left], label[right])
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        label = label[label]
        if (label == was).all():
            return label


def _compare(threshold: float, tolerance: float):
    def compare(table: pa.Table) -> pa.Table:
        """One pair of blocks of a group -> (key, towards, links) of its linked texts."""
        key = np.asarray(table.column("key"))
        _, first = np.unique(key, return_index=True)  # sorted by key; a repeated row counts once
        key, block = key[first], np.asarray(table.column("block"))[first]
        sig = np.frombuffer(b"".join(table.column("sig").take(first).to_pylist()), np.uint32).reshape(-1, PERMS)
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").take(first).to_pylist()]
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        if lo == hi:
            left, right = np.triu_indices(len(key), 1)
        else:
            a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
            left, right = np.repeat(a, len(b)), np.tile(b, len(a))
        left, right = similar_pairs(sig, sets, left, right, threshold, tolerance)
        links = np.bincount(left, minlength=len(key)) + np.bincount(right, minlength=len(key))
        root = _local_groups(len(key), left, right)
        some = links > 0
        return pa.table({"key": key[some], "towards": key[root[some]], "links": links[some].astype(np.int64)})
    return compare


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One row per row of ``docs``: (id, copy_id, copies, class_id, n_links).

    * ``copy_id``: smallest id among the texts with the same word sequence, ``copies``
      their number of rows;
    * ``n_links``: number of *different* texts (word sequences) with Jaccard similarity of
      at least ``threshold``;
    * ``class_id``: smallest id of the connected component of these links.

    A null or wordless text is a class of its own (class_id and copy_id its id, copies 1,
    0 links). Rows with a null id take the class of a copy that has an id, or null, and
    give no links of their own. Repeated rows count as copies. An empty table gives an
    empty table; other columns of ``docs`` are not looked at.
    """
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    keyed = materialize(base.mapInArrow(_keyed, f"id {id_type}, key bigint, bands array<bigint>"), "bands")
    texts = keyed.where("key is not null").groupBy("key").agg(
        F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"))
    texts = materialize(texts, "texts")
    in_band = texts.select("key", F.explode("bands").alias("band"))
    stars = in_band.groupBy("band").agg(F.min("key").alias("centre"), F.count("*").alias("n")).where("n > 1")
    near = components(in_band.join(stars, "band").select("key", "centre"), "key", "centre")
    cand = near.select(F.col("node").alias("key"), F.col("component").alias("cluster")).join(
        texts.where("rep is not null").select("key", "rep"), "key")
    sets = (base.join(cand, base["id"] == cand["rep"]).select("key", "cluster", "text")
            .mapInArrow(_with_sets, "key bigint, cluster bigint, sig binary, shingles binary"))
    sets = materialize(sets, "sets")
    blocks = sets.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / F.lit(BLOCK_TEXTS)),
                   F.ceil(F.sum(F.length("shingles")) / F.lit(8 * BLOCK_SHINGLES))).cast("int").alias("n_blocks"))
    cut = sets.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("key"), F.col("n_blocks")).cast("int"))
    units = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other"))
    units = units.select("cluster", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                         "block", "key", "sig", "shingles")
    links = materialize(units.groupBy("cluster", "lo", "hi").applyInArrow(
        _compare(threshold, tolerance), "key bigint, towards bigint, links bigint"), "linked")
    counts = links.groupBy("key").agg(F.sum("links").alias("n_links"))
    groups = components(links, "key", "towards")
    linked = (groups.select(F.col("node").alias("key"), "component")
              .join(texts.select("key", "rep"), "key"))
    least = linked.groupBy("component").agg(F.min("rep").alias("class_id"))
    classes = linked.join(least, "component").select("key", "class_id").join(counts, "key")
    # written, so that the adaptive skew join can split the rows of a hot group of copies
    per_text = materialize(texts.select("key", "rep", "copies").join(classes, "key", "left"), "per-text")
    out = keyed.select("id", "key").join(per_text, "key", "left")
    return out.select(
        F.col("id").alias(id_col), F.coalesce("rep", "id").alias("copy_id"),
        F.coalesce("copies", F.lit(1)).cast("bigint").alias("copies"),
        F.coalesce("class_id", "rep", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) whose id is the smallest of its class.

    Rows that share an id stay or go together; a row with a null id stays.
    """
    gone = near_duplicates(docs, id_col, text_col, threshold).where(
        F.col(id_col) != F.col("class_id")).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
