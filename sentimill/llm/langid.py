"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords, the byte 2-, 3- and 4-grams of its
lower-cased UTF-8 text hashed into ``BINS`` bins; a linear layer and softmax give the
language. Both layers are trained together by stochastic gradient descent in numpy, on a
bounded sample of labelled texts (at most ``PER_LANGUAGE`` texts of each language, those with
the smallest hashes of id and text; equal rows count once). The executors turn the sampled texts into bin counts, so the
driver gets at most ``BINS`` numbers for each, whatever the length of the text.

A fifth of the sample is held back: it sets the temperature of the softmax and the
rejection thresholds, one for each octave of the number of subwords. For these the
executors score the held-back texts whole and cut to ``CUTS`` bytes, and so up to
``CALIBRATE`` more texts of each language; the threshold of an octave is the score that rejects
``REJECT_RIGHT`` of those classified right, and rises with the octave, so that clean short
texts stay. Texts below it are rejected; texts without a letter
are ``und`` and rejected. Half of the training steps see a random part of a text's
subwords, so that short texts are learnt too.

To predict, embedding and linear layer are multiplied into one [bins, languages] table (a
megabyte or so), and the scores of a text are the mean of the rows of its subwords: a
gather and a segmented sum over the Arrow buffers, over the whole text in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .words import _LOWER, buffers

BINS = 1 << 15
DIM = 16
GRAMS = (2, 3, 4)
PER_LANGUAGE = 600
CALIBRATE = 5_000  # more texts of each language for the thresholds, in the mean
EPOCHS, LEAST_STEPS = 8, 16_000  # a small sample is gone through more often
LEAST_PART = 8  # fewest subwords of a shortened training text
REJECT_RIGHT = 0.001
CUTS = (4, 8, 16, 32, 64, 128, 256, 512)  # bytes of the shortened texts of the calibration
LEVELS = 64  # octaves of the number of subwords
LEAST_RIGHT = 200  # texts that set the threshold of an octave
SEED = 7
_PIECE = 1 << 18
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # [BINS + 1, languages] float32; the last row is zero
    bias: np.ndarray
    temperature: float
    threshold: np.ndarray  # [LEVELS] by octave of the number of subwords
    right: np.ndarray  # [held-back texts classified right, 2]: score, number of subwords

    def accepts(self, score: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Whether a score is enough for a text of so many subwords."""
        return score >= self.threshold[level(count)]


def level(count: np.ndarray) -> np.ndarray:
    """Octave of a number of subwords."""
    return np.frexp(np.maximum(count, 1))[1] - 1


def thresholds(score: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Rejection threshold of each octave, from the scores of texts classified right.

    An octave with few texts takes in the shorter ones; where these are too few, nothing is
    rejected. The lowest score never sets a threshold alone. Octaves in a row whose
    thresholds would fall share their mean.
    """
    own = level(count)
    runs: list[list[float]] = []  # [threshold, texts, octaves]
    for v in range(LEVELS):
        k = v
        while k and ((own >= k) & (own <= v)).sum() < LEAST_RIGHT:
            k -= 1
        s = np.sort(score[(own >= k) & (own <= v)])
        at = float(s[max(1, int(REJECT_RIGHT * len(s)))]) if len(s) >= LEAST_RIGHT else 0.0
        runs.append([at, max(1, (own == v).sum()), 1])
        while len(runs) > 1 and runs[-2][0] > runs[-1][0]:
            (a, m, i), (b, n, j) = runs[-2:]
            runs[-2:] = [[(a * m + b * n) / (m + n), m + n, i + j]]
    return np.repeat([r[0] for r in runs], [r[2] for r in runs])


def gram_bins(raw: np.ndarray, ends: np.ndarray, n: int, bins: int = BINS) -> np.ndarray:
    """Bin of the n-gram that starts at each byte; ``bins`` where it would leave its text.

    ``ends``: for each byte, the end of its text within ``raw``.
    """
    low = np.concatenate([_LOWER[raw].astype(np.uint32), np.zeros(n, np.uint32)])
    h = np.full(len(raw), 2166136261 + n, np.uint32)
    for k in range(n):
        h = (h ^ low[k:k + len(raw)]) * np.uint32(16777619)
        h = h ^ (h >> np.uint32(15))
    out = (h * np.uint32(0x9E3779B1) >> np.uint32(12)).astype(np.int64) % bins
    out[np.arange(len(raw)) + n > ends] = bins
    return out


def _pieces(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(bytes, end of text for each byte, starts of texts, first text): pieces of the buffer.

    A piece has up to three bytes more than it counts, for the n-grams across its end.
    """
    total = int(offsets[-1])
    for at in range(int(offsets[0]), total, _PIECE):
        to = min(total, at + _PIECE)
        first = int(np.searchsorted(offsets, at, side="right")) - 1
        last = int(np.searchsorted(offsets, to, side="left"))
        edges = offsets[first:last + 1]
        size = np.minimum(edges[1:], to) - np.maximum(edges[:-1], at)
        ends = np.repeat(edges[1:] - at, size)
        yield raw[at:min(total, to + max(GRAMS))], ends, np.maximum(edges[:-1], at) - at, first


def text_scores(column: pa.Array, table: np.ndarray, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """(sums of the table's rows over the subwords of each text, number of subwords)."""
    raw, offsets = buffers(column)
    sums = np.zeros((len(offsets) - 1, table.shape[1]), np.float64)
    count = np.zeros(len(offsets) - 1, np.int64)
    for piece, ends, starts, first in _pieces(raw, offsets):
        n = len(ends)
        full = np.concatenate([ends, np.zeros(len(piece) - n, ends.dtype)])
        used = np.flatnonzero(np.diff(np.concatenate([starts, [n]])) > 0)  # texts with bytes here
        for g in GRAMS:
            bin_ = gram_bins(piece, full, g, bins)[:n]
            sums[first + used] += np.add.reduceat(table[bin_], starts[used], axis=0)
            count[first + used] += np.add.reduceat(bin_ < bins, starts[used])
    return sums, count


def _cuts(raw: np.ndarray, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The text at start..end, then a run of it for each size of CUTS that is shorter."""
    yield start, end
    for size in CUTS:
        if size < end - start:
            a = start + (size * 2654435761 + end - start) % (end - start - size + 1)
            while a < end and raw[a] & 0xC0 == 0x80:  # not inside a character
                a += 1
            b = min(end, a + size)
            while b < end and raw[b] & 0xC0 == 0x80:
                b += 1
            yield a, b


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, h, text) -> (lang, h, bins, counts): the subwords of each sampled text."""
    for batch in batches:
        raw, offsets = buffers(batch.column(2))
        bins, counts = [], []
        for k in range(len(offsets) - 1):
            total = np.zeros(BINS + 1, np.int64)
            for piece, ends, _, _ in _pieces(raw, offsets[k:k + 2]):
                full = np.concatenate([ends, np.zeros(len(piece) - len(ends), ends.dtype)])
                for g in GRAMS:
                    total += np.bincount(gram_bins(piece, full, g)[:len(ends)], minlength=BINS + 1)
            at = np.flatnonzero(total[:BINS])
            bins.append(at.astype(np.int32))
            counts.append(total[at].astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(bins, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.float32()))],
            names=["lang", "h", "bins", "counts"])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def held_back(n: int) -> int:
    """How many of n texts set temperature and thresholds: the first of the order of training."""
    return n // 5 if n >= 50 else 0


def train(rows: list[tuple], seed: int = SEED) -> Model:
    """Model from (language, bins, counts, ...) of labelled texts; texts without subwords are
    left out. No threshold is set yet."""
    rows = [r for r in rows if len(r[1])]
    languages = sorted({r[0] for r in rows})
    rng = np.random.RandomState(seed)
    order = rng.permutation(len(rows))
    held = order[:held_back(len(rows))]
    learn = order[len(held):]
    n = len(languages)
    label = np.array([languages.index(r[0]) for r in rows], np.int64)
    embed = (rng.rand(BINS, DIM).astype(np.float32) - 0.5) / DIM
    out, bias = np.zeros((DIM, n), np.float32), np.zeros(n, np.float32)
    weight = [np.asarray(c, np.float32) / np.float32(sum(c)) for _, _, c, *_ in rows]
    epochs = max(EPOCHS, -(-LEAST_STEPS // max(1, len(learn))))
    steps, done = epochs * max(1, len(learn)), 0
    for _ in range(epochs if len(learn) else 0):
        for i in rng.permutation(learn):
            rate = 0.5 * (1 - done / steps)
            done += 1
            at, w = rows[i][1], weight[i]
            if len(at) > LEAST_PART and rng.rand() < 0.5:  # as if the text were shorter
                part = rng.randint(0, len(at), int(np.exp(rng.uniform(np.log(LEAST_PART), np.log(len(at))))))
                part = np.unique(part)
                at, w = at[part], w[part] / w[part].sum()
            hidden = w @ embed[at]
            err = _softmax(hidden @ out + bias)
            err[label[i]] -= 1
            back = out @ err
            out -= rate * np.outer(hidden, err)
            bias -= rate * err
            # the average divides the step by the number of subwords: take it on a common scale
            embed[at] -= (rate * 20.0) * np.outer(w, back)
    table = np.concatenate([embed @ out, np.zeros((1, n), np.float32)]).astype(np.float32)
    logits = np.array([weight[i] @ table[rows[i][1]] for i in held]).reshape(len(held), n) + bias
    temperature = 1.0
    if len(held):
        truth = label[held]
        grid = np.exp(np.linspace(0.0, np.log(5), 33))
        loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(held)), truth], 1e-12)).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
    none = np.zeros((0, 2))
    return Model(languages, table, bias, temperature, thresholds(none[:, 0], none[:, 1]), none)


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, text) -> (score, count) of the texts and cuts that are classified right."""
        for batch in batches:
            raw, offsets = buffers(batch.column(1))
            at = [(k, a, b) for k in range(len(offsets) - 1) for a, b in _cuts(raw, int(offsets[k]), int(offsets[k + 1]))]
            sums, count = text_scores(pa.array([raw[a:b].tobytes() for _, a, b in at], pa.string()), model.table)
            p = _softmax((sums / np.maximum(count, 1)[:, None] + model.bias) / model.temperature)
            truth = np.array(batch.column(0).to_pylist(), object)[[k for k, _, _ in at]] if at else np.zeros(0, object)
            ok = (np.array(model.languages, object)[p.argmax(axis=1)] == truth) & (count > 0)
            yield pa.RecordBatch.from_arrays([pa.array(p.max(axis=1)[ok]), pa.array(count[ok])], names=["score", "count"])
    return score


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE) -> Model | None:
    """Train on a sample of at most ``per_language`` texts of each language.

    Rows with a null text or language are not used; None if nothing is left.
    """
    rows = labelled.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                           F.col(f"`{text_col}`").alias("text")).where("lang is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).collect()  # one row per language
    if not sizes:
        return None
    share, more = (F.create_map(*[x for r in sizes for x in (F.lit(r.lang), F.lit(min(1.0, k / r.n)))])
                   for k in (2 * per_language, 2 * per_language + CALIBRATE))
    drawn = F.pmod(F.col("h"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rows = rows.where("text is not null").withColumn("h", F.xxhash64("id", "text")).drop("id")
    # the draw bounds the rows that move; equal ids with equal texts would come all or none
    some = rows.where(drawn < F.element_at(more, F.col("lang"))).dropDuplicates(["lang", "h"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy(drawn, "h"))
    some = some.select("lang", "text", "h", place.alias("place"), (drawn >= F.element_at(share, F.col("lang"))).alias("rest"))
    some = materialize(some.where((F.col("place") <= per_language) | F.col("rest")), "language-sample")
    sample = F.col("place") <= per_language
    # whole texts only, batch by batch as they came: views, no Python objects and no second copy
    got = some.where(sample).select("lang", "h", "text").mapInArrow(
        _sparse, "lang string, h bigint, bins array<int>, counts array<float>").toArrow()
    texts = []
    for batch in got.to_batches():
        lang, h, bins, counts = batch.columns
        edge, flat, weight = bins.offsets.to_numpy(), bins.values.to_numpy(), counts.values.to_numpy()
        texts += [(name, flat[a:b], weight[a:b], x) for name, x, a, b in zip(lang.to_pylist(), h.to_pylist(), edge[:-1], edge[1:])]
    texts = [r for r in texts if len(r[1])]
    if not texts:
        return None
    texts.sort(key=lambda r: (r[0], len(r[1]), float(r[2].sum()), r[1][:8].tolist()))
    model = train(texts)
    aside = np.random.RandomState(SEED).permutation(len(texts))[:held_back(len(texts))]  # as in train
    aside = [texts[i][3] for i in aside]
    del texts, got
    scores = some.where(F.col("h").isin(aside) | F.col("rest") & ~sample).select("lang", "text").mapInArrow(
        _scorer(model), "score double, count bigint").toArrow()
    model.right = np.stack([scores.column(0).to_numpy(), scores.column(1).to_numpy()], axis=1)
    model.threshold = thresholds(model.right[:, 0], model.right[:, 1])
    return model


def _predictor(model: Model | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, held_out, letters, text) -> (id, held_out, lang_pred, score, rejected)."""
        for batch in batches:
            letters = np.asarray(batch.column(2).fill_null(False))
            if model is None:
                best, score = np.full(len(letters), UNKNOWN, object), np.zeros(len(letters))
                rejected = np.ones(len(letters), bool)
            else:
                sums, count = text_scores(batch.column(3), model.table)
                p = _softmax((sums / np.maximum(count, 1)[:, None] + model.bias) / model.temperature)
                best = np.array(model.languages, object)[p.argmax(axis=1)]
                score = p.max(axis=1)
                rejected = ~letters | ~model.accepts(score, count)
                best[~letters], score[~letters] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(best, pa.string()), pa.array(score), pa.array(rejected)],
                names=["id", "held_out", "lang_pred", "score", "rejected"])
    return predict


def held_out(ident: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2."""
    return F.pmod(F.crc32(F.coalesce(ident.cast("string"), F.lit(""))), F.lit(4)) == 2


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             model: Model | None = None) -> DataFrame:
    """One row per row of ``docs``: (id, held_out, lang_pred, score, rejected).

    Without a ``model`` one is trained on the rows of ``docs`` that are not held out. A null
    text, or one without a letter, is ``und`` with score 0 and rejected, and so is every
    text when there is nothing to learn from. Repeated rows get the same prediction; an
    empty table gives an empty table. Predictions use the text alone.
    """
    out = held_out(F.col(f"`{id_col}`"))
    model = model or fit(docs.where(~out), id_col, text_col, lang_col)
    t = docs.select(F.col(f"`{id_col}`").alias("id"), out.alias("held_out"),
                    F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
                    F.col(f"`{text_col}`").alias("text"))
    id_type = t.schema["id"].dataType.simpleString()
    r = t.mapInArrow(_predictor(model), f"id {id_type}, held_out boolean, lang_pred string, score double, rejected boolean")
    return r.withColumnRenamed("id", id_col)


def _keeper(model: Model | None, at: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows whose text (column ``at``) is accepted; the last column says whether it has letters."""
        for batch in batches:
            if model is None:
                continue
            ok = np.asarray(batch.column(batch.num_columns - 1).fill_null(False))
            sums, count = text_scores(batch.column(at), model.table)
            p = _softmax((sums / np.maximum(count, 1)[:, None] + model.bias) / model.temperature)
            ok = ok & model.accepts(p.max(axis=1), count)
            yield batch.filter(pa.array(ok)).select(list(range(batch.num_columns - 1)))
    return keep


def keep_accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is not rejected.

    Null and empty texts, and those without a letter, go, and so does every row when there is
    nothing to learn from. Texts are scored whole; repeated rows stay or go together; ids may
    be null or repeat. Columns are read by name, so others may have any name. An empty table
    gives an empty table.
    """
    model = fit(docs.where(~held_out(F.col(f"`{id_col}`"))), id_col, text_col, lang_col)
    letters = F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))
    cols = docs.columns
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)], letters.alias("letters"))
    from pyspark.sql.types import StructType
    schema = StructType(plain.schema.fields[:-1])
    out = plain.mapInArrow(_keeper(model, cols.index(text_col)), schema)
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])
