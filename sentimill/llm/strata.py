"""Ranked lexical search over a length-stratified index.

A document's score for a term depends on its occurrences tf and its normaliser m only, and
m takes few values (about a thousand, up to very long texts). So the index groups documents
by equal m (a stratum; a large one is cut into segments of about ``SEGMENT`` documents), and
holds each term's postings by tf within the segment: the impact of a (m, tf) is computed
once for all documents that share it.

Search. The largest tf of each term in a stratum bounds what any of its documents can score
for a query. Each query first visits the strata with the highest bounds, ``FIRST`` documents
or a little more; the k-th best score found there is a threshold. Then it visits all other
strata whose bound reaches it, and within a task segments whose own bound reaches the best
threshold so far. Nothing that could rank is skipped, so the result is exact.

Terms are 64-bit hashes (about n^2 / 2^65 pairs of n different terms share one). Queries are
taken in blocks of ``QUERIES``; what goes to the tasks is a block's terms, never documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .words import groups

SEGMENT = 4096         # documents in a segment, about
FIRST = 2000           # documents that a query visits before it has a threshold, at least
QUERIES = 2000         # queries in a block
VOCABULARY = 1 << 20   # query terms that are sent to the tasks (8 MB); beyond, all terms are indexed
STRATA = 100_000       # rows of a table of strata that are broadcast
TOP = 20
ROW_GROUP = 16 << 20
NO_ID = (1 << 63) - 1


# ------------------------------------------------------------------ terms of documents

def _terms(vocabulary):
    """(row, id, n, terms, tfs) of (row, id, text): n counts all terms; terms (sorted hashes, 64
    bits) and tfs (32 bits) are those in the vocabulary."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, h, offsets in groups(batch.column(2)):
                size = np.diff(offsets)
                h = h.view(np.int64)
                doc = np.repeat(np.arange(len(size)), size)
                if vocabulary is None:
                    known, place = np.unique(h, return_inverse=True)
                else:
                    known = vocabulary.value
                    place = np.searchsorted(known, h)
                    found = known[np.minimum(place, len(known) - 1)] == h if len(known) else np.zeros(len(h), bool)
                    doc, place = doc[found], place[found]
                key, tf = np.unique(doc * np.int64(max(1, len(known))) + place, return_counts=True)
                doc, place = np.divmod(key, max(1, len(known)))
                ends = np.searchsorted(doc, np.arange(len(size) + 1))
                cols = [pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends * a.itemsize), pa.py_buffer(a)])
                        for a in (np.ascontiguousarray(known[place]), tf.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(size)), batch.column(1).slice(at, len(size)), pa.array(size.astype(np.int64)),
                     *[c.cast(pa.binary()) for c in cols]], names=["row", "id", "n", "terms", "tfs"])
    return parse


def term_lists(docs: DataFrame, id_col: str, text_col: str, vocabulary=None) -> DataFrame:
    """(row, id, n, terms, tfs), written to the shared folder; ``row`` tells equal rows apart."""
    t = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("bigint").alias("id"),
                    F.col(f"`{text_col}`").alias("text"))
    return materialize(t.mapInArrow(_terms(vocabulary), "row bigint, id bigint, n bigint, terms binary, tfs binary"), "terms")


# ------------------------------------------------------------------ index

def _segment(key, table):
    """One segment from its documents' term lists."""
    ids = np.array([NO_ID if i is None else i for i in table.column("id").to_pylist()], np.int64)
    order = np.lexsort((table.column("row").to_numpy(), ids))
    terms = [np.frombuffer(b, np.int64) for b in table.column("terms").to_pylist()]
    tfs = [np.frombuffer(b, np.int32) for b in table.column("tfs").to_pylist()]
    term = np.concatenate([terms[i] for i in order])
    tf = np.concatenate([tfs[i] for i in order])
    doc = np.repeat(np.arange(len(order)), [len(terms[i]) for i in order]).astype(np.int32)
    by = np.lexsort((doc, tf, term))
    term, tf, doc = term[by], tf[by], doc[by]
    new_term = np.concatenate([[True], term[1:] != term[:-1]])
    new_tf = new_term | np.concatenate([[True], tf[1:] != tf[:-1]])
    first = np.flatnonzero(new_tf)                       # postings with the same term and tf: a list
    lists = np.append(np.flatnonzero(new_term[first]), len(first))
    cols = [term[new_term], lists.astype(np.int32), tf[first], np.append(first, len(term)).astype(np.int32), doc, ids[order]]
    return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([len(order)], pa.int64()),
                     *[pa.array([c.tobytes()], pa.binary()) for c in cols]],
                    names=["m", "docs", "terms", "lists", "tf", "ends", "postings", "ids"])


_INDEX = "m bigint, docs bigint, terms binary, lists binary, tf binary, ends binary, postings binary, ids binary"


@dataclass
class Index:
    """The segments, the number of documents with a term, and of their terms with repeats."""
    segments: DataFrame  # _INDEX
    n_docs: int
    n_terms: int
    peaks: DataFrame     # (m, term, df, tf): of each stratum, documents with a term and its largest tf


def _peaks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for m, terms, lists, tf, ends in zip(*(batch.column(i).to_pylist() for i in range(5))):
            terms, lists, tf, ends = _arrays(terms, lists, tf, ends)
            df = ends[lists[1:]] - ends[lists[:-1]]
            # lists of a term stand in ascending order of tf
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(terms), m)), pa.array(terms), pa.array(df.astype(np.int64)),
                                              pa.array(tf[lists[1:] - 1].astype(np.int64))], names=["m", "term", "df", "tf"])


def _arrays(terms: bytes, *rest: bytes) -> list[np.ndarray]:
    return [np.frombuffer(terms, np.int64), *[np.frombuffer(r, np.int32) for r in rest]]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary=None) -> Index:
    """The index of all documents that hold a term (of the vocabulary, where one is given).

    ``vocabulary`` is a broadcast sorted array of term hashes; the statistics count all
    terms. Null and empty texts have no terms and are not indexed; texts of any length are
    read whole; repeated rows are documents of their own. An empty table has an empty index.
    """
    lists = term_lists(docs, id_col, text_col, vocabulary)
    stats = lists.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = stats.docs, stats.terms or 0
    m = F.expr(f"75 + (25 * n * {n_docs}L) div {max(1, n_terms)}L")
    held = lists.where("length(terms) > 0").select(m.alias("m"), "row", "id", "terms", "tfs")
    cuts = materialize(held.groupBy("m").agg(F.ceil(F.count("*") / SEGMENT).alias("cuts")), "strata")
    side = cuts.select(F.col("m").alias("_m"), "cuts")
    held = held.join(F.broadcast(side) if side.count() <= STRATA else side, F.col("m") == F.col("_m"))
    cut = F.pmod(F.xxhash64("row"), F.col("cuts")).alias("cut")
    segments = held.select("m", cut, "row", "id", "terms", "tfs").groupBy("m", "cut").applyInArrow(_segment, _INDEX)
    path = scratch_path(docs.sparkSession, "index")
    segments.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    segments = docs.sparkSession.read.parquet(path)
    tops = segments.select("m", "terms", "lists", "tf", "ends").mapInArrow(_peaks, "m bigint, term bigint, df bigint, tf bigint")
    peaks = materialize(tops.groupBy("m", "term").agg(F.sum("df").alias("df"), F.max("tf").alias("tf")), "peaks")
    return Index(segments, n_docs, n_terms, peaks)


# ------------------------------------------------------------------ search

@dataclass
class Block:
    """A block of queries: distinct terms (sorted hashes), their weights, and the queries' terms
    (places in ``terms``) with repeats, one query behind the other."""
    items: list
    terms: np.ndarray
    weight: np.ndarray
    ends: np.ndarray   # of each query's terms; one more than there are queries
    term: np.ndarray
    times: np.ndarray


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf.astype(np.int64) + 12 * m)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _sums(block: Block, best: np.ndarray) -> np.ndarray:
    """For each query the sum of ``best`` (by place of the term) over its terms."""
    total = np.concatenate([[0], np.cumsum(best[block.term] * block.times)])
    return total[block.ends[1:]] - total[block.ends[:-1]]


def _bounds(block):
    """(item, m, bound) of a stratum's peaks for the queries that have a bound above 0."""
    def bound(key, table):
        b, m = block.value, key[0].as_py()
        term, tf = table.column("term").to_numpy(), table.column("tf").to_numpy()
        place = np.searchsorted(b.terms, term)
        known = b.terms[np.minimum(place, len(b.terms) - 1)] == term
        best = np.zeros(len(b.terms), np.int64)
        best[place[known]] = b.weight[place[known]] * impact(tf[known], m)
        sums = _sums(b, best)
        item = np.flatnonzero(sums > 0)
        return pa.table([pa.array(item.astype(np.int32)), pa.array(np.full(len(item), m)), pa.array(sums[item])], names=["item", "m", "bound"])
    return bound


class _Best:
    """The best documents of each query that a task has seen."""

    def __init__(self, floor: np.ndarray, k: int):
        self.k, self.floor = k, np.maximum(floor, 1)
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, item: int, score: np.ndarray, ids: np.ndarray) -> None:
        if item in self.rows:
            score, ids = np.concatenate([self.rows[item][0], score]), np.concatenate([self.rows[item][1], ids])
        if len(score) > self.k:
            keep = np.lexsort((ids, -score))[:self.k]
            score, ids = score[keep], ids[keep]
        self.rows[item] = score, ids
        if len(score) == self.k:
            self.floor[item] = max(self.floor[item], score.min())


def _searched(block, floor, k: int):
    """(item, id, score): a task's best documents of each query, from (segment, visiting queries)."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, best = block.value, _Best(floor.value.copy(), k)
        for batch in batches:
            for m, docs, terms, lists, tf, ends, postings, ids, items in zip(*(c.to_pylist() for c in batch.columns)):
                terms, lists, tf, ends, postings = _arrays(terms, lists, tf, ends, postings)
                ids = np.frombuffer(ids, np.int64)
                place = np.searchsorted(terms, b.terms)
                held = terms[np.minimum(place, len(terms) - 1)] == b.terms
                # impacts once for each list; a term's postings lie between these two
                value = np.repeat(impact(tf, m), np.diff(ends))
                lo, hi = np.zeros(len(b.terms), np.int64), np.zeros(len(b.terms), np.int64)
                lo[held], hi[held] = ends[lists[place[held]]], ends[lists[place[held] + 1]]
                peak = np.zeros(len(b.terms), np.int64)
                peak[held] = b.weight[held] * impact(tf[lists[place[held] + 1] - 1], m)
                bound = _sums(b, peak)
                for item in items:
                    if bound[item] < best.floor[item]:
                        continue
                    score = np.zeros(docs, np.int64)
                    for i in range(b.ends[item], b.ends[item + 1]):
                        t = b.term[i]
                        if peak[t]:
                            score[postings[lo[t]:hi[t]]] += value[lo[t]:hi[t]] * (b.weight[t] * b.times[i])
                    over = np.flatnonzero(score >= best.floor[item])
                    if len(over):
                        best.add(item, score[over], ids[over])
        for item, (score, ids) in best.rows.items():
            found = pa.array(ids, mask=ids == NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), item, np.int32)), found, pa.array(score)], names=["item", "id", "score"])
    return search


def _block(rows: list, index: Index) -> Block:
    terms = [np.frombuffer(r.terms, np.int64) for r in rows]
    distinct = np.unique(np.concatenate([*terms, np.zeros(0, np.int64)]))
    spark = index.segments.sparkSession
    asked = spark.createDataFrame([(int(t),) for t in distinct], "term bigint")
    counts = index.peaks.groupBy("term").agg(F.sum("df").alias("df")).join(asked, "term", "left_semi").collect()  # rows of asked
    df = {r.term: r.df for r in counts}
    return Block([r.id for r in rows], distinct, np.array([weight(index.n_docs, df.get(int(t), 0)) for t in distinct], np.int64),
                 np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64),
                 np.searchsorted(distinct, np.concatenate([*terms, np.zeros(0, np.int64)])),
                 np.concatenate([np.zeros(0, np.int64), *[np.frombuffer(r.tfs, np.int32).astype(np.int64) for r in rows]]))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _search_block(index: Index, rows: list, k: int) -> DataFrame:
    """(item, id, score, rank) of a block of queries, given as (id, terms, tfs)."""
    spark = index.segments.sparkSession
    sc = spark.sparkContext
    block = sc.broadcast(_block(rows, index))
    bounds = index.peaks.groupBy("m").applyInArrow(_bounds(block), "item int, m bigint, bound bigint")
    sizes = index.segments.groupBy("m").agg(F.sum("docs").alias("docs"))
    bounds = materialize(bounds.join(sizes, "m"), "bounds")  # at most queries of the block x strata
    before = Window.partitionBy("item").orderBy(F.col("bound").desc(), "m").rowsBetween(Window.unboundedPreceding, -1)
    visits = bounds.withColumn("early", F.coalesce(F.sum("docs").over(before), F.lit(0)) < FIRST)
    visits = materialize(visits, "visits")
    n_strata = sizes.count()

    def visit(which: DataFrame, floor: np.ndarray) -> DataFrame:
        who = which.groupBy(F.col("m").alias("_m")).agg(F.collect_list("item").alias("items"))
        who = F.broadcast(who) if n_strata * len(rows) <= 40 * STRATA else who
        met = index.segments.join(who, F.col("m") == F.col("_m"))
        cols = ["m", "docs", "terms", "lists", "tf", "ends", "postings", "ids", "items"]
        return met.select(*cols).mapInArrow(_searched(block, sc.broadcast(floor), k), "item int, id bigint, score bigint")

    first = materialize(_ranked(visit(visits.where("early"), np.zeros(len(rows), np.int64)), k), "first")
    floor = np.zeros(len(rows), np.int64)
    for r in first.where(F.col("rank") == k).select("item", "score").collect():  # at most a row for each query
        floor[r.item] = r.score
    asked = spark.createDataFrame([(i, int(max(s, 1))) for i, s in enumerate(floor)], "i int, floor bigint")
    late = visits.where("not early").join(F.broadcast(asked), F.col("item") == F.col("i")).where("bound >= floor")
    rest = visit(late, floor)
    return _ranked(first.select("item", "id", "score").unionByName(rest), k)


def search(docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = TOP) -> DataFrame:
    """(item, rank, id, score): each query's ``k`` highest-scoring documents with a score above 0.

    Equal scores go by ascending id, a null id last; documents that share an id are ranked
    one by one. Every row of ``queries`` is a query of its own; one with a null or empty
    text, or none of whose terms occurs, has no rows. Terms that a query repeats count each
    time. Ids must be integers; the queries' ids may be of any type. Texts are read whole.
    Without documents or queries the result is empty. Other columns are not looked at.
    """
    spark = docs.sparkSession
    kind = queries.schema[item_col].dataType.simpleString()
    asked = queries.select(F.monotonically_increasing_id().alias("q"), F.col(f"`{item_col}`").alias("item"),
                           F.col(f"`{item_text_col}`").alias("text"))
    asked = materialize(asked, "queries")
    lists = term_lists(asked, "q", "text").where("length(terms) > 0")
    n_queries = lists.count()
    hashes = materialize(lists.select("terms").mapInArrow(_each_term, "term bigint").distinct(), "query-terms")
    vocabulary = None
    if hashes.count() <= VOCABULARY:
        vocabulary = spark.sparkContext.broadcast(np.sort(hashes.toArrow().column(0).to_numpy()))
    index = build_index(docs, id_col, text_col, vocabulary)
    n_blocks = -(-n_queries // QUERIES)
    out = None
    for b in range(n_blocks):
        rows = lists.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == b).select("id", "terms", "tfs").collect()
        if not rows:
            continue
        found = _search_block(index, rows, k)
        named = spark.createDataFrame([(i, r.id) for i, r in enumerate(rows)], "i int, q bigint")
        found = found.join(F.broadcast(named), F.col("item") == F.col("i")).select("q", "rank", "id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], f"`{item_col}` {kind}, rank int, `{id_col}` bigint, score bigint")
    return out.join(asked.select("q", "item"), "q").select(
        F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def _each_term(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        terms = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(terms))], names=["term"])
