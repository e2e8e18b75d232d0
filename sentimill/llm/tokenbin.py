"""Token ids in binary files, packed with Simple-8b.

``write`` orders the documents by id with a range partitioning, so each task holds one
run of the order, and lets it tokenise its texts and pack their ids. A file is a sequence
of segments (Parquet rows, uncompressed: the binary columns are the words themselves); a
segment holds the ids of whole documents one after the other, each document closed by the
end id, and says where each document ends. The tasks know no place but their own: the ids
before a file are the sum over the files before it, which ``read`` takes from the counts
that the segments carry. So no id passes through the driver, a task that is repeated
writes the same file, and a reader may start at any segment (or, with its block offsets,
at any block of 512 ids).

Tokenising: a byte-level BPE parts a text before each space that a letter follows and
behind each letter that an ASCII character other than a letter follows, so the pieces
between these cuts have the same ids wherever they stand. Each distinct piece is tokenised once, and
one that is a single word by the library's BPE model alone. Other tokenizers, and texts that
hold one of the tokenizer's added tokens, are tokenised whole.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import simple8b
from .words import buffers, ranges

END_ID = 0
RUN = 12 << 20       # bytes of text that are tokenised together
SEGMENT = 4 << 20    # bytes of text in a segment (a longer text is a segment of its own)
KNOWN = 600_000      # distinct pieces whose ids a worker remembers, and as many older ones
ROW_GROUP = 16 << 20

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_OTHER = ~_LETTER & (np.arange(256) < 128)
# letters of two bytes, U+00C0 to U+00FF without the signs for times and divided by
_SECOND = (np.arange(256) >= 0x80) & (np.arange(256) < 0xC0) & ~np.isin(np.arange(256), (0x97, 0xB7))
_WORD = re.compile(" ?[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
# a byte-level model writes each byte as a character: printable ones of Latin-1 as themselves,
# the others, in order, from U+0100 on
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_AS_CHARACTER = dict(zip([b for b in range(256) if b not in _PRINTABLE], range(0x100, 0x200)))


class Encoder:
    """A tokenizer that remembers the ids of pieces."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        kind = json.loads(model)
        pre = kind.get("pre_tokenizer") or {}
        self.cuts = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                     and not kind.get("normalizer") and kind["model"].get("type") == "BPE")
        self.added = [t["content"].encode() for t in kind.get("added_tokens") or []]
        self.known = {}
        self._forget()

    def _forget(self) -> None:
        """The pieces known so far become the older ones; what was older is forgotten."""
        self.older = (self.known, self.begin, self.flat) if self.known else ({}, array("q", [0]), array("I"))
        self.known: dict[str, int] = {}
        self.begin = array("q", [0])  # of the ids of each known piece in flat; and the end
        self.flat = array("I")

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _places(self, pieces: list[str], whole: bool) -> np.ndarray:
        """Number of each (distinct) piece among the known ones; new ones are tokenised."""
        if whole or len(self.known) + len(pieces) > KNOWN:
            self._forget()
        known, begin, flat = self.known, self.begin, self.flat
        old, old_begin, old_flat = self.older
        words, rest = [], []
        for p in [p for p in pieces if p not in known]:
            i = -1 if whole else old.get(p, -1)
            if i >= 0:
                known[p] = len(begin) - 1
                flat.extend(old_flat[old_begin[i]:old_begin[i + 1]])
                begin.append(len(flat))
            else:
                (words if not whole and _WORD.fullmatch(p) else rest).append(p)
        tokenize = self.tokenizer.model.tokenize if words else None
        # a word is one unit of the model, which writes the space before it as a letter
        found = ([t.id for t in tokenize(w.replace(" ", "\u0120") if w.isascii() else
                                         w.encode().decode("latin-1").translate(_AS_CHARACTER))] for w in words)
        for piece, ids in chain(zip(words, found), zip(rest, self._encode(rest))):
            known[piece] = len(begin) - 1
            flat.extend(ids)
            begin.append(len(flat))
        return np.fromiter(map(known.__getitem__, pieces), np.int32, len(pieces))

    def ids(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids end) of UTF-8 texts one behind the other."""
        lo, hi = int(offsets[0]), int(offsets[-1])
        data, own = raw[lo:hi], offsets - lo
        held = data.tobytes()
        whole = not self.cuts or any(t in held for t in self.added)
        cut = np.zeros(len(data) + 1, bool)
        if not whole and len(data):
            two = np.zeros(len(data) + 1, bool)  # where a letter of two bytes begins
            two[:-2] = (data[:-1] == 0xC3) & _SECOND[data[1:]]
            begins, ends = _LETTER[data] | two[:-1], _LETTER[data]
            ends[1:] |= two[:-2]
            cut[:-2] = (data[:-1] == 32) & begins[1:]
            cut[own[own > 0] - 1] = False  # the letter belongs to the next text
            cut[1:-1] |= ends[:-1] & _OTHER[data[1:]]
        cut[own] = True  # an empty text adds no piece
        bounds = np.flatnonzero(cut)
        pieces = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(held))
        distinct = pieces.dictionary_encode()
        place = self._places(distinct.dictionary.to_pylist(), whole)[distinct.indices.to_numpy()]
        begin, flat = np.array(self.begin, np.int32), np.array(self.flat)
        first, size = begin[place], begin[place + 1] - begin[place]
        ends = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=ends[1:])
        # the ids of a piece lie together: from one id to the next it is one step, or a jump to the next piece
        step = np.ones(ends[-1], np.int32)
        some = size > 0
        first, size = first[some], size[some]
        step[ends[:-1][some]] = first - np.concatenate([[1], first + size])[:-1] + 1
        return flat[np.cumsum(step, dtype=np.int32)], ends[np.searchsorted(bounds, own[1:])]


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """The ids with the end id behind each document, and where documents end then."""
    return np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)


_encoders: dict[int, Encoder] = {}  # of this worker, by the checksum of the model


def _segments(model, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = model.value
        key = zlib.crc32(text.encode())
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = Encoder(text)
        encoder, part, seq, start = _encoders[key], TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            for i, j in ranges(offsets, RUN):
                every, stops = with_end(*encoder.ids(raw, offsets[i:j + 1]), end_id)
                stops = np.concatenate([[0], stops])
                for a, b in ranges(offsets[i:j + 1], SEGMENT):
                    ids, ends = every[stops[a]:stops[b]], stops[a + 1:b + 1] - stops[a]
                    words, blocks, escapes = simple8b.to_bytes(simple8b.pack(ids))
                    docs = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), batch.column(0).slice(i + a, b - a))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([start], pa.int64()),
                         pa.array([len(ids)], pa.int64()), docs, pa.array([ends.astype("<i8").tobytes()], pa.binary()),
                         *[pa.array([x], pa.binary()) for x in (words, blocks, escapes)]],
                        names=["part", "seq", "start", "n_ids", "docs", "ends", "words", "blocks", "escapes"])
                    seq += 1
                    start += len(ids)
    return write


def write(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
          end_id: int = END_ID) -> None:
    """Tokenise ``docs`` and write their ids, in ascending order of id, under ``path``.

    Every row is a document of its own, closed by ``end_id``; a null or empty text has the
    end id only. Null ids come first; rows that share an id follow each other by a hash of
    the text, and rows equal in both in any order (their ids are the same), spread over
    tasks like any others. A text is never cut, however long: it is a segment of its own.
    Other columns are not looked at. An empty table writes no segment. The tokenizer file is
    read on the driver and sent to the tasks.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        model = spark.sparkContext.broadcast(f.read())
    t = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    t = t.select("*", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("u"))
    order = [F.col("id").asc_nulls_first(), F.col("h"), F.col("u")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = t.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "text")
    kind = dealt.schema["id"].dataType.simpleString()
    out = dealt.mapInArrow(_segments(model, end_id), f"part int, seq bigint, start bigint, n_ids bigint, docs array<{kind}>, "
                           "ends binary, words binary, blocks binary, escapes binary")
    out.write.option("compression", "uncompressed").option("parquet.block.size", ROW_GROUP).parquet(path)


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, int]]:
    """(document ids, token ids, where each document ends, ids before) of each segment."""
    col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
    for k in range(batch.num_rows):
        p = simple8b.from_bytes(*(col[c][k].as_py() for c in ("n_ids", "words", "blocks", "escapes")))
        ends = np.frombuffer(col["ends"][k].as_py(), "<i8")
        yield col["docs"][k].values, simple8b.unpack(p), ends, col["start"][k].as_py()


def _read_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for docs, ids, ends, start in _documents(batch):
            first = np.concatenate([[0], ends[:-1]])
            lists = pa.LargeListArray.from_arrays(pa.array(np.append(first[:1], ends), pa.int64()), pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([docs, pa.array(first + start), lists.cast(pa.list_(pa.int64()))],
                                             names=["id", "start", "ids"])


def _read_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for docs, ids, ends, start in _documents(batch):
            first = np.concatenate([[0], ends[:-1]])
            data = memoryview(ids.astype("<u4").tobytes())
            sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(first.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([docs, pa.array(first + start), pa.array(ends - first), pa.array(sums, pa.int64())],
                                             names=["id", "start", "n_tokens", "ids_crc32"])


def _read(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """The segments with ``start`` counted from the first file, and the type of an id."""
    files = spark.read.parquet(path)
    kind = files.schema["docs"].dataType.elementType.simpleString()
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row for each file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    placed = files.join(F.broadcast(offsets), F.col("part") == F.col("_part"))
    return placed.select((F.col("start") + F.col("_before")).alias("start"), "n_ids", "docs", "ends", "words", "blocks",
                         "escapes"), kind


def read(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, ids) of each document in the files: ``start`` ids lie before it."""
    segments, kind = _read(spark, path)
    out = segments.mapInArrow(_read_ids, f"id {kind}, start bigint, ids array<bigint>")
    return out.withColumnRenamed("id", id_col)


def read_sums(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of each document in the files; the ids are decoded,
    summed as little-endian unsigned 32-bit integers, and stay in the task."""
    segments, kind = _read(spark, path)
    out = segments.mapInArrow(_read_sums, f"id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
    return out.withColumnRenamed("id", id_col)
