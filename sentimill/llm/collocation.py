"""Phrase collocation mining with Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
``[^\\x20\\x09]+``. Every contiguous run of words of a piece is an occurrence of a phrase.

1. numpy prefix polynomials hash every word (over its bytes) and every run of words (over
   the words' hashes), with the language mixed in, to a 64-bit fingerprint. A task adds up
   equal ones and sends them as arrays, one for each range of fingerprints; there are as many
   ranges as the texts have ``RANGE`` bytes, so they grow in number and not in size, and a
   frequent phrase is one entry of each array. The task of a range sums (fingerprint,
   occurrences, pointer) and keeps those that are frequent enough. The pointer is the
   smallest id of a document that holds the phrase.
2. A run of k words can only be frequent if both its runs of k - 1 words are. These are in a
   Bloom filter (16 bits each, at most ``MAX_BITS``), so from three words on only runs that
   pass it are hashed and shuffled. A full filter lets more rows through, not fewer.
3. Runs whose fingerprint passes the filter of frequent ones are verified against the text:
   they are grouped by their words, not by fingerprint, and counted by (language, phrase).
   So phrases that share a fingerprint are told apart, and only frequent ones are written
   out. The pointer comes back from step 1 by fingerprint.
4. The scores are integer arithmetic on decimals of 38 digits.

Texts are read three times (with phrases of up to three words), and once to add up their
sizes; they are not shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .words import _BASE, _INVERSE, _LOWER, _power, buffers, mix, ranges

PIECE = 1 << 20           # bytes of text hashed at once (a longer text is hashed in parts)
GRAMS = 500_000           # fingerprints that a task adds up before it sends them on
PHRASES = 80_000          # phrases that a task counts before it sends them on
ROWS = 500                # rows of a batch that are looked at together
RANGE = 8 << 20           # bytes of text for each range of fingerprints
MAX_BITS = 1 << 28        # of the filter: 32 MB
_MAP_BITS = 32768
NO_DOC = np.int64((1 << 63) - 1)
SLICES = 32               # of a language, when its best phrases are chosen

_KIND = np.zeros(256, np.uint8)  # 0 word, 1 blank, 2 end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2

_GRAM = np.uint64(0xD1342543DE82EF95)
_GRAM_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


class Run:
    """The words of a run of whole texts: ``h`` hashes, ``start`` and ``end`` bytes, ``piece``
    (a number that words of the same piece share) and ``text`` (which text of the run)."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        lo, hi = int(offsets[0]), int(offsets[-1])
        parts, at, pieces = [], lo, 0
        while at < hi:
            to = hi
            if hi - at > 2 * PIECE:  # one long text: cut it behind a word
                to = at + PIECE
                while to < hi and _KIND[raw[to]] == 0:
                    ahead = np.flatnonzero(_KIND[raw[to:to + PIECE]])
                    to += int(ahead[0]) if len(ahead) else min(PIECE, hi - to)
            parts.append(self._part(raw[at:to], at, offsets, pieces))
            pieces = parts[-1][4]
            at = to
        cols = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(4)]
        self.h, self.start, self.end, piece = cols
        self.h = self.h.astype(np.uint64)
        self.text = np.searchsorted(offsets, self.start, side="right") - 1
        self.piece = piece + self.text  # both never fall, so the sum parts pieces and texts

    @staticmethod
    def _part(data: np.ndarray, at: int, offsets: np.ndarray, pieces: int):
        kind = _KIND[data]
        inside = kind == 0
        before = np.concatenate([[False], inside[:-1]])
        after = np.concatenate([inside[1:], [False]])
        cut = offsets[(offsets > at) & (offsets < at + len(data))] - at
        before[cut] = False
        after[cut - 1] = False
        start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * _power("up", _BASE, len(data)), out=total[1:])
        h = (total[end] - total[start]) * _power("down", _INVERSE, len(data))[start]
        h = mix(h + (end - start).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        closed = np.cumsum(kind == 2)
        last = pieces + (int(closed[-1]) if len(closed) else 0)
        return h, start + at, end + at, closed[start] + pieces, last

    def fingerprints(self, words: int, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, fingerprint) of each run of ``words`` words; ``salt`` by text."""
        n = len(self.h) - words + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        prefix = np.zeros(len(self.h) + 1, np.uint64)
        np.cumsum(self.h * _power("gram", _GRAM, len(self.h)), out=prefix[1:])
        first = np.flatnonzero(self.piece[:n] == self.piece[words - 1:words - 1 + n])
        poly = (prefix[first + words] - prefix[first]) * _power("ungram", _GRAM_INVERSE, n)[first]
        return first, mix(poly + np.uint64(words * 0x9E3779B97F4A7C15 % (1 << 64)) + salt[self.text[first]])


class Bits:
    """A Bloom filter of fingerprints with two positions each."""

    def __init__(self, n_bits: int, maps: dict[int, bytes]):
        self.mask = np.uint64(n_bits - 1)
        self.bytes = np.zeros(n_bits // 8, np.uint8)
        for k, m in maps.items():
            at = k * (_MAP_BITS // 8)
            part = self.bytes[at:at + _MAP_BITS // 8]
            part[:] = np.frombuffer(m, np.uint8)[:len(part)]

    def has(self, fp: np.ndarray) -> np.ndarray:
        ok = np.ones(len(fp), bool)
        for shift in (0, 32):
            at = (fp >> np.uint64(shift)) & self.mask
            ok &= (self.bytes[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return ok


def filter_of(frequent: DataFrame) -> Bits:
    """The filter of the column ``fp``: built as bitmaps on Spark; at most MAX_BITS reach the driver."""
    n_bits = min(MAX_BITS, max(_MAP_BITS, 1 << (16 * frequent.count() - 1).bit_length()))
    at = frequent.select(F.explode(F.array(*[F.shiftrightunsigned("fp", s).bitwiseAND(F.lit(n_bits - 1)) for s in (0, 32)])).alias("at"))
    maps = at.groupBy(F.expr(f"at div {_MAP_BITS}").alias("map")).agg(F.bitmap_construct_agg(F.expr(f"at % {_MAP_BITS}")).alias("bits"))
    return Bits(n_bits, {r.map: bytes(r.bits) for r in maps.collect()})


def _salts(langs: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs], np.uint64)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[Run, np.ndarray, np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]]:
    """(words, language number, salt and id of each text, languages, bytes, offsets) of runs of
    the rows (id, lang, text)."""
    for at in range(0, batch.num_rows, ROWS):  # a view of a few rows: no second copy of the batch
        part = batch.slice(at, ROWS)
        lang = part.column(1).fill_null("und").dictionary_encode()
        langs, code = lang.dictionary.to_pylist(), lang.indices.to_numpy()
        salts = _salts(langs)
        ids = part.column(0).fill_null(int(NO_DOC)).to_numpy()
        raw, offsets = buffers(part.column(2))
        for i, j in ranges(offsets, PIECE):
            yield Run(raw, offsets[i:j + 1]), code[i:j], salts[code[i:j]], ids[i:j], langs, raw, offsets[i:j + 1]


def _summed(fp: np.ndarray, n: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(fp, kind="stable")
    fp = fp[order]
    first = np.flatnonzero(np.concatenate([[True], fp[1:] != fp[:-1]]))
    return fp[first], np.add.reduceat(n[order], first), np.minimum.reduceat(doc[order], first)


def _counted(orders: tuple[int, ...], n_ranges: int, bits):
    """(range, sums) of the runs of words of these lengths whose shorter runs are in ``bits``:
    ``sums`` holds fingerprints, occurrences and pointers one behind the other, 64 bits each."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def out() -> pa.RecordBatch:
            fp, n, doc = _summed(*(np.concatenate(x) for x in zip(*held)))
            held.clear()
            at = ((fp >> np.uint64(32)) * np.uint64(n_ranges) >> np.uint64(32)).astype(np.int32)  # rises with fp
            first = np.flatnonzero(np.diff(at, prepend=-1))
            sums = [fp[i:j].tobytes() + n[i:j].tobytes() + doc[i:j].tobytes() for i, j in zip(first, np.append(first[1:], len(fp)))]
            return pa.RecordBatch.from_arrays([pa.array(at[first]), pa.array(sums, pa.binary())], names=["range", "sums"])

        for batch in batches:
            for run, _, salt, ids, *_ in _runs(batch):
                for k in orders:
                    first, fp = run.fingerprints(k, salt)
                    if bits is not None and len(fp):
                        at, short = run.fingerprints(k - 1, salt)
                        known = np.zeros(len(run.h) + 1, bool)
                        known[at] = bits.value.has(short)
                        may = known[first] & known[first + 1]
                        first, fp = first[may], fp[may]
                    if len(fp):
                        held.append(_summed(fp, np.ones(len(fp), np.int64), ids[run.text[first]]))
                        size += len(held[-1][0])
                if size >= GRAMS:
                    yield out()
                    size = 0
        if held:
            yield out()
    return count


def _often(min_count: int):
    """(fp, n, doc) of a range that occur at least ``min_count`` times."""
    def often(key, table):
        parts = [np.frombuffer(b, np.uint64).reshape(3, -1) for b in table.column("sums").to_pylist()]
        fp, n, doc = (np.concatenate([p[i] for p in parts]) for i in range(3))
        fp, n, doc = _summed(fp, n.view(np.int64), doc.view(np.int64))
        keep = n >= min_count
        return pa.table([pa.array(x[keep].view(np.int64)) for x in (fp, n, doc)], names=["fp", "n", "doc"])
    return often


def _verified(longest: int, bits):
    """(lang, words, phrase, fp, n) of the runs in ``bits``, grouped by their words; with each
    language's number of words under the empty phrase."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, int] = {}

        def out() -> pa.RecordBatch:
            keys = list(found)
            cols = [pa.array(c, t) for c, t in zip(zip(*keys), (pa.string(), pa.int32(), pa.string(), pa.int64()))]
            made = pa.RecordBatch.from_arrays([*cols, pa.array(found.values(), pa.int64())], names=["lang", "words", "phrase", "fp", "n"])
            found.clear()
            return made

        for batch in batches:
            for run, code, salt, _, langs, raw, offsets in _runs(batch):
                n = len(run.h)
                if not n:
                    continue
                for c, many in enumerate(np.bincount(code[run.text], minlength=len(langs)).tolist()):
                    if many:
                        found[langs[c], 0, "", 0] = found.get((langs[c], 0, "", 0), 0) + many
                # exact numbers of the words: each word is a segment, what parts it from the next another
                lo, hi = int(offsets[0]), int(offsets[-1])
                edges = np.empty(2 * n + 1, np.int64)
                edges[0:-1:2], edges[1::2], edges[-1] = run.start, run.end, hi
                segments = pa.Array.from_buffers(
                    pa.large_binary(), 2 * n, [None, pa.py_buffer(edges - lo), pa.py_buffer(_LOWER[raw[lo:hi]].tobytes())])
                coded = segments.dictionary_encode()
                words = coded.dictionary.to_pylist()
                word = coded.indices.to_numpy()[::2].astype(np.int64)
                # exact numbers of the runs of words that may be frequent, within a language
                gram = code[run.text] * np.int64(len(words)) + word
                for k in range(1, longest + 1):
                    first, fp = run.fingerprints(k, salt)
                    if k > 1:
                        if not len(first):
                            break
                        longer = np.full(n, -1, np.int64)
                        _, longer[first] = np.unique(gram[first] * np.int64(len(words)) + word[first + k - 1], return_inverse=True)
                        gram = longer
                    may = bits.value.has(fp)
                    first, fp = first[may], fp[may].view(np.int64)
                    if not len(first):
                        continue
                    _, at, many = np.unique(gram[first], return_index=True, return_counts=True)
                    places = first[at]
                    texts = [words[w].decode() for w in word[places].tolist()]
                    for j in range(1, k):
                        texts = [f"{t} {words[w].decode()}" for t, w in zip(texts, word[places + j].tolist())]
                    for c, t, f, m in zip(code[run.text[places]].tolist(), texts, fp[at].tolist(), many.tolist()):
                        key = (langs[c], k, t, f)
                        found[key] = found.get(key, 0) + m
                if len(found) >= PHRASES:
                    yield out()
        if found:
            yield out()
    return verify


def frequent_phrases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                     max_words: int = 3, min_count: int = 10) -> DataFrame:
    """(lang, words, phrase, n, first_doc): phrases of up to ``max_words`` words that occur at
    least ``min_count`` times in a language, with their exact numbers of occurrences.

    ``first_doc`` is the smallest id of a document with the phrase's fingerprint (null if
    these have none). The empty phrase (0 words) has the language's number of words. A null
    language is ``und``; null and empty texts have no words; texts of any length are counted
    whole; repeated rows count again each time. Ids must be integers; they may be null or
    repeat. Other columns are not looked at. An empty table has no phrases.
    """
    sc = docs.sparkSession.sparkContext
    t = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                    F.col(f"`{text_col}`").alias("text"))

    size = t.agg(F.sum(F.octet_length("text")).alias("size")).first().size or 0
    n_ranges = max(8, size // RANGE)

    def often(orders: tuple[int, ...], bits=None) -> DataFrame:
        sums = t.mapInArrow(_counted(orders, n_ranges, bits), "range int, sums binary")
        return materialize(sums.groupBy("range").applyInArrow(_often(min_count), "fp bigint, n bigint, doc bigint"), "grams")

    frequent = last = often((1, 2) if max_words > 1 else (1,))
    for k in range(3, max_words + 1):
        last = often((k,), sc.broadcast(filter_of(last)))
        frequent = frequent.unionByName(last)
    seen = t.mapInArrow(_verified(max_words, sc.broadcast(filter_of(frequent))), "lang string, words int, phrase string, fp bigint, n bigint")
    exact = seen.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"), F.max("fp").alias("fp"))
    exact = exact.where((F.col("n") >= min_count) | (F.col("words") == 0))
    docs_of = frequent.select("fp", F.nullif(F.col("doc"), F.lit(int(NO_DOC))).alias("first_doc"))
    return materialize(exact.join(docs_of, "fp", "left").drop("fp"), "phrases")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)); the products may have 38 digits."""
    def d(c: Column) -> Column:
        return c.cast("decimal(16,0)")

    top = F.lit(1_000_000).cast("decimal(7,0)") * (d(a) * d(a))
    return F.call_function("div", top, d(left) * d(right))


def collocations(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 max_words: int = 3, min_count: int = 10, cover_percent: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, first_doc): each language's ``top`` phrases.

    Candidates are the frequent phrases of at least two words. Cutting one after its first k
    words gives the counts l and r of the two parts, and 1,000,000 a a / (l r), rounded down;
    its score is that of the lowest cut (of equal ones, the first). A candidate inside a
    longer one that has at least ``cover_percent`` of its occurrences is dropped. Ranks go by
    score and count, both falling, then by phrase in the order of its bytes. Rows as in
    ``frequent_phrases``: null, empty and long texts, ties, repeated rows and empty tables.
    """
    f = frequent_phrases(docs, id_col, text_col, lang_col, max_words, min_count)
    w = F.split("phrase", " ")
    cand = f.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"), "first_doc", w.alias("w"))
    # every cut, with the counts of its parts
    cuts = cand.select("lang", "phrase", "a", "words", "first_doc", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "first_doc", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"))
    part = f.where("words > 0")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    lowest = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct(_score(F.col("a"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r", "a", "first_doc")).alias("cut"))
    # the largest longer candidate around each candidate
    sizes = F.sequence(F.lit(2), F.col("words") - 1)
    inner = F.flatten(F.transform(sizes, lambda s: F.transform(
        F.sequence(F.lit(1), F.col("words") - s + 1), lambda i: F.array_join(F.slice("w", i, s), " "))))
    around = cand.where("words > 2").select("lang", "a", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("a").alias("outer"))
    rows = lowest.join(around, ["lang", "phrase"], "left")
    rows = rows.where(F.col("outer").isNull() | (100 * F.col("outer") < cover_percent * F.col("cut.a")))
    rows = rows.select("lang", "phrase", *[f"cut.{c}" for c in ("a", "l", "r", "score", "first_doc")])
    # the best of slices of a language first, so that no task gets all of its phrases
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(SLICES)))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("place") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    n = f.where("words = 0").select("lang", F.col("n"))
    rows = rows.join(n, "lang")
    return rows.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score", "first_doc")
