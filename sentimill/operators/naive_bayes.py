"""Multinomial Naive Bayes (A10, L4, L5, L10), relational and ``pyspark.ml`` forms.

Relational model (smoothing ``lam``, ``V = num_features``):

* ``priors``: ``(label, n, pi)`` with ``pi = ln(n + lam) - ln(N + lam * C)``;
* ``theta``: ``(label, bucket, theta)`` with
  ``theta = ln(S + lam) - ln(T + lam * V)``, ``S`` the summed feature value of the class
  in the bucket and ``T`` its total; only observed cells are stored, every other bucket
  of the class scores ``default = ln(lam) - ln(T + lam * V)``.

Fitting is two grouped sums (partially combined per task). For prediction the model is
made into one row per bucket, once; each document's features are joined with it (broadcast
when small) and summed per document in one shuffle; the per-class constants are inlined.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .features import small

@dataclass
class NBModel:
    priors: DataFrame   # label, n, pi
    theta: DataFrame    # label, bucket, theta
    totals: DataFrame   # label, total, default_theta
    num_features: int
    smoothing: float

    def save(self, path: str) -> None:
        """Write the model tables (parquet) and its parameters under ``path``."""
        self.priors.write.mode("errorifexists").parquet(f"{path}/priors")
        self.totals.write.mode("errorifexists").parquet(f"{path}/totals")
        self.theta.write.mode("errorifexists").parquet(f"{path}/theta")
        spark = self.priors.sparkSession
        spark.createDataFrame([(self.num_features, self.smoothing)],
                              "num_features int, smoothing double").write.parquet(f"{path}/params")

    @staticmethod
    def load(spark, path: str) -> "NBModel":
        p = spark.read.parquet(f"{path}/params").first()
        return NBModel(spark.read.parquet(f"{path}/priors"), spark.read.parquet(f"{path}/theta"),
                       spark.read.parquet(f"{path}/totals"), int(p.num_features), float(p.smoothing))


def fit(features: DataFrame, docs: DataFrame, num_features: int, smoothing: float = 1.0,
        label_col: str = "label", value_col: str = "tfidf") -> NBModel:
    """Fit on ``features``, one row per (document, bucket) with the document's label, and
    ``docs``, one row per document with its label (documents without features included).

    Features are read once: the summed cells, at most classes x buckets rows, are written,
    and totals and log-likelihoods follow from them.
    """
    lam = float(smoothing)
    counts = materialize(docs.groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("n")), "class-counts")
    n_all, n_cls = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    priors = counts.select("label", "n", (F.log(F.col("n") + lam) - F.log(F.lit(n_all + lam * n_cls))).alias("pi"))
    cells = materialize(features.where(F.col("bucket").isNotNull())
                        .groupBy(F.col(label_col).alias("label"), "bucket")
                        .agg(F.sum(value_col).alias("s")), "class-cells")
    totals = cells.groupBy("label").agg(F.sum("s").alias("total"))
    totals = totals.select("label", "total",
                           (F.log(F.lit(lam)) - F.log(F.col("total") + lam * num_features))
                           .alias("default_theta"))
    theta = cells.join(totals, "label").select(
        "label", "bucket",
        (F.log(F.col("s") + lam) - F.log(F.col("total") + lam * num_features)).alias("theta"))
    return NBModel(priors, theta, totals, num_features, lam)


@dataclass
class Scorer:
    """A model made ready to score many batches: class constants and one row per bucket."""
    classes: list[tuple[int, float, float]]  # label, pi, default theta
    wide: DataFrame                          # bucket, d0.. (theta minus default of each class)
    num_features: int


def prepare(model: NBModel) -> Scorer:
    """Collect the class constants (a row per class) and write the wide model table once."""
    consts = (model.priors.join(model.totals, "label", "left")
              .select("label", "pi", F.coalesce("default_theta", F.lit(
                  math.log(model.smoothing) - math.log(model.smoothing * model.num_features))).alias("d"))
              .orderBy("label"))
    classes = [(r.label, r.pi, r.d) for r in consts.collect()]
    labels = [c[0] for c in classes]
    delta = model.theta.join(model.totals.select("label", "default_theta"), "label")
    wide = (delta.groupBy("bucket").pivot("label", labels)
            .agg(F.first(F.col("theta") - F.col("default_theta"))))
    wide = wide.select("bucket", *[F.col(str(c)).alias(f"d{i}") for i, c in enumerate(labels)])
    return Scorer(classes, materialize(wide, "nb-wide"), model.num_features)


def predict(scorer: Scorer, features: DataFrame, keys: Sequence[str], value_col: str = "tfidf") -> DataFrame:
    """``keys`` plus ``predicted``, one row per distinct ``keys`` of ``features``.

    ``keys`` must tell the documents apart and may carry any of their columns; a document
    without features has a row with a null bucket. One aggregate scores all of them.
    Score of class c: ``pi_c + default_c * sum(x) + sum(x * (theta_cj - default_c))``;
    ties go to the lowest label.
    """
    n = len(scorer.classes)
    x = features.select(*keys, "bucket", F.col(value_col).alias("x")).join(
        small(scorer.wide, scorer.num_features, n + 1), "bucket", "left")
    sums = [F.sum(F.col("x") * F.coalesce(F.col(f"d{i}"), F.lit(0.0))).alias(f"p{i}") for i in range(n)]
    per_doc = x.groupBy(*keys).agg(F.sum("x").alias("sx"), *sums)
    scores = [F.struct(
        (F.lit(pi) + F.lit(d) * F.coalesce(F.col("sx"), F.lit(0.0)) + F.coalesce(F.col(f"p{i}"), F.lit(0.0))).alias("score"),
        F.lit(-label).alias("neg_label")) for i, (label, pi, d) in enumerate(scorer.classes)]
    best = F.greatest(*scores) if n > 1 else scores[0]
    return per_doc.select(*keys, (-best["neg_label"]).cast("int").alias("predicted"))


# ------------------------------------------------------------------ pyspark.ml form

def label_indexer(data: DataFrame, label_col: str):
    """The classes of ``label_col`` numbered 0..C-1 (``pyspark.ml`` wants that): any codes."""
    from pyspark.ml.feature import StringIndexer

    return StringIndexer(inputCol=label_col, outputCol="label_index", stringOrderType="alphabetAsc").fit(data)


def ml_pipeline(num_features: int, labels: Sequence[str], min_doc_freq: int = 0, smoothing: float = 1.0,
                terms_col: str = "terms", hashing: str = "murmur3"):
    """Hashed TF -> IDF -> NaiveBayes(multinomial) -> class code, as one ``Pipeline``.

    ``labels`` are the codes by class number (``label_indexer(...).labels``); they are saved
    with the fitted pipeline, whose ``predicted`` column holds codes. ``hashing`` chooses the
    buckets: ``murmur3`` (``HashingTF``) or ``md5``, the buckets of the relational operators,
    counted by name; these names are part of the model, so the latter suits small sizes.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import CountVectorizerModel, IndexToString, SQLTransformer

    from .features import ml_tfidf_stages

    stages = ml_tfidf_stages(num_features, min_doc_freq, terms_col)
    if hashing == "md5":
        name = f"string(pmod(bigint(conv(substr(md5(t), 1, 8), 16, 10)), {num_features}))"
        stages[0:1] = [SQLTransformer(statement=f"SELECT *, transform({terms_col}, t -> {name}) AS buckets FROM __THIS__"),
                       CountVectorizerModel.from_vocabulary([str(i) for i in range(num_features)], "buckets", "tf")]
    nb = NaiveBayes(smoothing=smoothing, modelType="multinomial", featuresCol="features",
                    labelCol="label_index", predictionCol="prediction_index")
    code = IndexToString(inputCol="prediction_index", outputCol="predicted", labels=list(labels))
    return Pipeline(stages=[*stages, nb, code])
