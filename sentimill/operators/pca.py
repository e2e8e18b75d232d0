"""Principal components of sparse features by blocked power iteration.

``pyspark.ml``'s PCA builds the dense covariance matrix on the driver: fine for a few
thousand columns, impossible for the 2**20 buckets of a hashed text. Here the matrix is
never built. A block of ``BLOCK`` vectors V, a table (bucket, v0, v1, ...), is multiplied by
the covariance through the features themselves:

* ``x . V`` for each document: features joined with V by bucket, summed by document;
* ``X' (X V)``: features joined with that by document, summed by bucket; the means, which
  would make the features dense, enter as a correction of each bucket's sum.

Sums combine inside the tasks, so a bucket or document with a third of all rows moves as
one partial row for each task. What reaches the driver is the BLOCK x BLOCK matrices V'Y and
Y'Y, from which the next block is made orthogonal (as linear combinations of columns) and
the components are read off (Rayleigh-Ritz). V has a row for each bucket and is broadcast
while that bound is small; each block is written to the shared folder, which cuts the lineage.

Up to ``DENSE_CELLS`` numbers, V is an array that every task gets. Then the features are gathered
by document once, and a step is one pass over them without a shuffle of features: each task
multiplies its documents and sends one row for each bucket, its sums.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .features import small

BLOCK = 8          # vectors iterated for the first few components: more of them converge faster
STEPS = 60         # at most
TOLERANCE = 1e-12  # squared sine of the angle by which a component still turns
POLISH = 5         # steps behind that: the measure itself is no finer than rounding allows
DENSE_CELLS = 1 << 20  # buckets times vectors (8 MB) up to which V is an array
PACKED_DOCS = 256      # documents of a packed row: at most num_features numbers each


@dataclass
class Components:
    """``axes``: (bucket, pc0, pc1, ...); of each, the largest coordinate is positive."""
    axes: DataFrame
    variances: list[float]
    num_features: int

    def save(self, path: str) -> None:
        self.axes.write.mode("errorifexists").parquet(f"{path}/axes")
        spark = self.axes.sparkSession
        spark.createDataFrame([(self.variances, self.num_features)],
                              "variances array<double>, num_features int").write.parquet(f"{path}/params")

    @staticmethod
    def load(spark, path: str) -> "Components":
        p = spark.read.parquet(f"{path}/params").first()
        return Components(spark.read.parquet(f"{path}/axes"), list(p.variances), p.num_features)


def _names(n: int, prefix: str = "v") -> list[str]:
    return [f"{prefix}{i}" for i in range(n)]


def _combined(matrix: np.ndarray, prefix: str, out: str) -> list[Column]:
    """Columns ``out``j = sum over i of ``prefix``i * matrix[i, j]."""
    cols = []
    for j in range(matrix.shape[1]):
        total = F.lit(0.0)
        for i in range(matrix.shape[0]):
            total = total + F.col(f"{prefix}{i}") * F.lit(float(matrix[i, j]))
        cols.append(total.alias(f"{out}{j}"))
    return cols


def _sums(df: DataFrame, left: list[str], right: list[str]) -> np.ndarray:
    """The matrix of the sums of each left times each right column."""
    row = df.agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0.0)) for a in left for b in right]).first()
    return np.array(row, np.float64).reshape(len(left), len(right))


def _orthogonal(gram: np.ndarray) -> np.ndarray:
    """R with (Y R)'(Y R) = 1 for Y'Y = gram; directions that Y does not span are left out."""
    values, vectors = np.linalg.eigh(gram)
    keep = values > values.max() * 1e-12 if values.max() > 0 else np.zeros(len(values), bool)
    return vectors[:, keep] / np.sqrt(values[keep])


def _times_covariance(x: DataFrame, v: DataFrame, shift: np.ndarray, n_docs: int, num_features: int, key: str) -> DataFrame:
    """(bucket, mean, v0.., y0..): y = X'X v - n_docs mean (mean . v), the covariance times
    n_docs - 1; ``v`` is (bucket, mean, v0..) and ``shift`` is mean . v."""
    n = len(shift)
    side = small(v.drop("mean"), num_features, n + 1)
    dots = x.join(side, "bucket").groupBy(key).agg(*[F.sum(F.col("x") * F.col(f"v{i}")).alias(f"s{i}") for i in range(n)])
    sums = x.join(dots, key).groupBy("bucket").agg(*[F.sum(F.col("x") * F.col(f"s{i}")).alias(f"t{i}") for i in range(n)])
    y = [(F.coalesce(F.col(f"t{i}"), F.lit(0.0)) - F.lit(float(n_docs * shift[i])) * F.col("mean")).alias(f"y{i}") for i in range(n)]
    return materialize(v.join(sums, "bucket", "left").select("bucket", "mean", *_names(n), *y), "pca-block")


def _ritz(both: np.ndarray, gram: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The first ``k`` Ritz values of V'CV = ``both``, the vectors as columns, and how far C still
    turns them: |C u|^2 - (u'C u)^2 of a component u, relative to its size (Y'Y = ``gram``)."""
    ritz, turned = np.linalg.eigh((both + both.T) / 2)
    order = np.argsort(-ritz)[:k]
    ritz, turn = ritz[order], turned[:, order]
    size = np.einsum("ij,ik,kj->j", turn, gram, turn)
    left = 1 - np.divide(ritz ** 2, size, out=np.ones_like(size), where=size > 0)
    return ritz, turn, left.max(initial=0.0)


def _packed(x: DataFrame, key: str) -> DataFrame:
    """(ends, bucket, x) as binary arrays: the features of up to ``PACKED_DOCS`` documents a row."""
    most = PACKED_DOCS

    def pack(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, most):
                buckets, values = (c.slice(at, most) for c in batch.columns)
                flat = (np.cumsum(buckets.value_lengths().to_numpy(), dtype="<i8"), buckets.flatten().to_numpy().astype("<i4"),
                        values.flatten().to_numpy().astype("<f8"))
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in flat], ["ends", "bucket", "x"])

    docs = x.where(F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(F.struct("bucket", "x")).alias("items"))
    return docs.select("items.bucket", "items.x").mapInArrow(pack, "ends binary, bucket binary, x binary")


def _times_features(packed: DataFrame, v: np.ndarray) -> np.ndarray:
    """X'X v, for ``v`` with a row for each bucket."""
    n = v.shape[1]

    def products(batches):
        import pyarrow as pa

        sums = np.zeros_like(v)
        for batch in batches:
            for ends, bucket, x in zip(*(c.to_pylist() for c in batch.columns)):
                ends, bucket, x = np.frombuffer(ends, "<i8"), np.frombuffer(bucket, "<i4"), np.frombuffer(x, "<f8")
                starts = np.concatenate([[0], ends[:-1]])
                dots = np.repeat(np.add.reduceat(v[bucket] * x[:, None], starts), ends - starts, axis=0)
                for j in range(n):
                    sums[:, j] += np.bincount(bucket, x * dots[:, j], len(sums))
        met = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), *[pa.array(sums[met, j]) for j in range(n)]],
                                         ["bucket", *_names(n, "t")])

    schema = "bucket int, " + ", ".join(f"{t} double" for t in _names(n, "t"))
    out = np.zeros_like(v)
    for row in packed.mapInArrow(products, schema).groupBy("bucket").agg(*[F.sum(t) for t in _names(n, "t")]).collect():
        out[row[0]] = row[1:]
    return out


def _fit_dense(x: DataFrame, start: DataFrame, n_docs: int, num_features: int, k: int, key: str, block: int, steps: int):
    """(bucket, pc0, ...) of the components found, before their signs, and their values; ``start`` is
    (bucket, mean, v0..). The driver holds the vectors, never the features."""
    rows = start.collect()
    table = np.zeros((num_features, block + 1))
    for row in rows:
        table[row[0]] = row[1:]
    mean, v = table[:, 0], table[:, 1:]
    v = v @ _orthogonal(v.T @ v)
    values, turn, more = np.zeros(0), np.zeros((v.shape[1], 0)), None
    packed = materialize(_packed(x, key), "pca-packed") if v.shape[1] else None
    for step in range(steps if v.shape[1] else 0):
        y = _times_features(packed, v) - n_docs * np.outer(mean, mean @ v)
        ritz, turn, left = _ritz(v.T @ y, y.T @ y, k)
        values = ritz / max(1, n_docs - 1)
        if more is None and left <= TOLERANCE:
            more = step + POLISH
        r = _orthogonal(y.T @ y)
        if step == more or step == steps - 1 or not r.shape[1]:
            break
        v = y @ r
    axes = v @ turn
    found = [(row[0], *[float(a) for a in axes[row[0]]]) for row in rows]
    schema = ", ".join(["bucket int", *[f"pc{j} double" for j in range(turn.shape[1])]])
    return materialize(x.sparkSession.createDataFrame(found, schema), "pca-axes"), values, turn.shape[1]


def _fit_wide(x: DataFrame, start: DataFrame, n_docs: int, num_features: int, k: int, key: str, block: int, steps: int):
    """The same as ``_fit_dense`` at any number of buckets: the vectors are tables."""
    v = materialize(start, "pca-start")
    found = _sums(v, ["mean", *_names(block)], _names(block))
    r = _orthogonal(found[1:])
    v, n, shift = v.select("bucket", "mean", *_combined(r, "v", "v")), r.shape[1], found[0] @ r
    values, turn, more = np.zeros(0), np.zeros((n, 0)), None
    for step in range(steps if n else 0):
        y = _times_covariance(x, v, shift, n_docs, num_features, key)
        found = _sums(y, ["mean", *_names(n), *_names(n, "y")], _names(n, "y"))
        both, gram = found[1:n + 1], found[n + 1:]
        ritz, turn, left = _ritz(both, gram, k)
        values = ritz / max(1, n_docs - 1)
        v = y
        if more is None and left <= TOLERANCE:
            more = step + POLISH
        r = _orthogonal(gram)
        if step == more or step == steps - 1 or not r.shape[1]:
            break
        v, n, shift = y.select("bucket", "mean", *_combined(r, "y", "v")), r.shape[1], found[0] @ r
    return materialize(v.select("bucket", *_combined(turn, "v", "pc")), "pca-axes"), values, turn.shape[1]


def fit(features: DataFrame, n_docs: int, num_features: int, k: int = 2, key: str = "id", value_col: str = "tfidf",
        block: int = BLOCK, steps: int = STEPS) -> Components:
    """The first ``k`` principal components of (key, bucket, value) rows.

    ``n_docs`` counts all documents: those without features (no row, or a row with a null
    bucket) are zero vectors. With fewer documents or buckets than ``k`` dimensions the other
    components are zero.
    """
    # zero weights (rare buckets) add nothing to any sum
    x = materialize(features.where("bucket is not null").select(key, "bucket", F.col(value_col).cast("double").alias("x"))
                    .where("x <> 0"), "pca-features")
    means = materialize(x.groupBy("bucket").agg((F.sum("x") / n_docs).alias("mean")), "pca-means")
    # the start is a function of the bucket: numbers between -1 and 1 from its hash
    start = [(F.pmod(F.xxhash64("bucket", F.lit(j)), F.lit(1 << 30)) / float(1 << 29) - 1.0).alias(f"v{j}") for j in range(block)]
    v = means.select("bucket", "mean", *start)
    find = _fit_dense if num_features * (block + 1) <= DENSE_CELLS else _fit_wide
    axes, values, found = find(x, v, n_docs, num_features, k, key, block, steps)
    if found:
        tops = axes.agg(*[F.max_by(f"pc{j}", F.abs(f"pc{j}")) for j in range(found)]).first()
        signs = [(F.col(f"pc{j}") * F.lit(-1.0 if (tops[j] or 0.0) < 0 else 1.0)).alias(f"pc{j}") for j in range(found)]
        axes = axes.select("bucket", *signs)
    axes = axes.select("bucket", *[F.col(f"pc{j}") if j < found else F.lit(0.0).alias(f"pc{j}") for j in range(k)])
    return Components(axes, [float(a) for a in values] + [0.0] * (k - found), num_features)


def project(features: DataFrame, components: Components, keys: Sequence[str], value_col: str = "tfidf") -> DataFrame:
    """``keys`` plus ``pc`` (array<double>): each document's features times the axes, not centred.

    A document without features has a row with a null bucket and the projection 0.
    """
    k = len(components.variances)
    side = small(components.axes, components.num_features, k + 1)
    sums = [F.coalesce(F.sum(F.col(value_col) * F.col(f"pc{j}")), F.lit(0.0)) for j in range(k)]
    return features.join(side, "bucket", "left").groupBy(*keys).agg(F.array(*sums).alias("pc"))
