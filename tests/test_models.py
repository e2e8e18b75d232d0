"""IDF, Naive Bayes, metrics, k-means, positional join (small hand-made fixtures)."""

import math

import pytest
from pyspark.sql import functions as F

from sentimill.operators import features as fx
from sentimill.operators import kmeans as km
from sentimill.operators import naive_bayes as nb
from sentimill.operators import positional
from sentimill.plans import evaluation as ev

DOCS = [(0, ["sad", "cry", "bad"], 0), (1, ["love", "happi", "good"], 4), (2, ["bad", "sad"], 0),
        (3, ["love", "love", "fun"], 4), (4, ["ok"], 2)]


def _terms(spark):
    return spark.createDataFrame([(i, t, l) for i, ts, l in DOCS for t in ts], "id long, term string, label int")


def test_idf_min_doc_freq(spark):
    tf = fx.term_frequency(_terms(spark), ["id"]).withColumnRenamed("term", "bucket")
    w = {r.bucket: r.idf for r in fx.idf(tf, F.lit(5), min_doc_freq=2).collect()}
    assert w["sad"] == pytest.approx(math.log(6 / 3))
    assert w["love"] == pytest.approx(math.log(6 / 3))
    assert w["cry"] == 0.0 and w["ok"] == 0.0


def test_nb_priors_and_predict(spark):
    t = _terms(spark)
    tf = fx.hashed_tf(t, ["id", "label"], 64).withColumn("tfidf", F.col("tf").cast("double"))
    labels = spark.createDataFrame([(i, l) for i, _, l in DOCS] + [(9, 4)], "id long, label int")
    model = nb.fit(tf, labels.where("id < 9"), 64, 1.0, label_col="label")
    pri = {r.label: r.pi for r in model.priors.collect()}
    assert pri[0] == pytest.approx(-0.9808, abs=1e-4)
    assert pri[2] == pytest.approx(-1.3863, abs=1e-4)
    assert pri[4] == pytest.approx(-0.9808, abs=1e-4)
    none = spark.createDataFrame([(9, 4, None, None)], "id long, label int, bucket int, tfidf double")
    scored = tf.select("id", "label", "bucket", "tfidf").unionByName(none)
    pred = {r.id: r.predicted for r in nb.predict(nb.prepare(model), scored, ["id", "label"]).collect()}
    assert pred[0] == 0 and pred[1] == 4 and pred[4] == 2
    assert pred[9] == 0  # no features: the larger prior, the lower label of a tie


def test_tfidf_of_unseen_buckets_equals_ml(spark):
    """The relational form against pyspark.ml's IDF, buckets without a training document included."""
    from pyspark.ml.feature import IDF
    from pyspark.ml.linalg import Vectors

    train, test = {0: {1: 2.0, 3: 1.0}, 1: {1: 1.0}}, {7: {1: 1.0, 2: 3.0, 3: 2.0}}
    for least in (0, 2):
        vec = lambda d: spark.createDataFrame([(i, Vectors.sparse(8, x)) for i, x in d.items()], ["id", "v"])
        want = IDF(minDocFreq=least, inputCol="v", outputCol="o").fit(vec(train)).transform(vec(test)).first().o
        rows = lambda d: spark.createDataFrame([(i, b, x) for i, t in d.items() for b, x in t.items()], "id long, bucket int, tf double")
        w = fx.idf(rows(train), F.lit(2), least)
        got = {r.bucket: r.tfidf for r in fx.tfidf(rows(test), w, 8, 2, least).collect()}
        assert got == {b: pytest.approx(want[b]) for b in test[7]}


def test_sparse_assignment_equals_dense(spark):
    rows = [(i, j, float((i * 7 + j * 3) % 5)) for i in range(12) for j in range(6) if (i + j) % 3]
    centers = km.random_centers(spark, 3, 6, seed=4)
    c = km.collect_centers(centers)
    x = spark.createDataFrame(rows, "id long, bucket int, tfidf double")
    full = [(i, [next((v for a, b, v in rows if (a, b) == (i, j)), 0.0) for j in range(6)]) for i in range(12)]
    dense = km.assign(spark.createDataFrame(full, "id long, features array<double>"), c)
    want = {r.id: r.predicted for r in dense.collect()}
    sparse = km.assign_sparse(x, ["id"], c)
    assert {r.id: r.predicted for r in sparse.collect()} == want
    a = {r.cluster: r for r in km.update(centers, km.batch_stats(dense)).collect()}
    b = {r.cluster: r for r in km.update(centers, km.sparse_stats(x, sparse, ["id"], 6)).collect()}
    assert {k: (v.weight, pytest.approx(v.center)) for k, v in a.items()} == {k: (v.weight, v.center) for k, v in b.items()}


def test_wide_centres_plan_fast(spark):
    import time

    c = km.collect_centers(km.random_centers(spark, 2, 4096))
    v = spark.createDataFrame([([0.5] * 4096,)] * 4, "features array<double>")
    t = time.time()
    km.assign(v, c)._jdf.queryExecution().executedPlan()
    assert time.time() - t < 3.0


def test_metrics_match_one_pass(spark):
    rows = [(0, 0)] * 9 + [(0, 4)] * 49 + [(4, 0)] * 42 + [(4, 4)] * 299 + [(2, 0)] * 5
    res = spark.createDataFrame(rows, "gt int, predicted int")
    one = {r.gt: r for r in ev.metrics_one_pass(res).collect()}
    for name in ("precision", "recall", "false_discovery_rate", "fall_out"):
        got = {r.gt: r[name] for r in ev.metric(spark, res, name).collect()}
        assert got == {k: pytest.approx(getattr(one[k], name)) for k in got}
    assert one[0].precision == pytest.approx(9 / 51)
    assert one[4].recall == pytest.approx(299 / 341)
    assert one[0].recall + 49 / 58 == pytest.approx(1.0)


def test_contingency_groups_gt_and_predicted(spark):
    res = spark.createDataFrame([(0, 0), (0, 1), (2, 1), (4, 0), (4, 0)], "gt int, predicted int")
    got = sorted(tuple(r) for r in ev.contingency(spark, res).collect())
    assert got == [(0, 0, 1), (0, 1, 1), (2, 1, 1), (4, 0, 2)]


def test_kmeans_update_rule(spark):
    centers = spark.createDataFrame([(0, [0.0, 0.0], 1.0), (1, [10.0, 10.0], 1.0)], km.CENTER_SCHEMA)
    pts = spark.createDataFrame([([1.0, 1.0],), ([2.0, 0.0],), ([9.0, 9.0],)], "features array<double>")
    a = km.assign(pts, centers)
    assert [r.predicted for r in a.collect()] == [0, 0, 1]
    new = {r.cluster: r for r in km.update(centers, km.batch_stats(a)).collect()}
    assert new[0].center == pytest.approx([1.0, 1 / 3]) and new[0].weight == 3.0
    assert new[1].center == pytest.approx([9.5, 9.5]) and new[1].weight == 2.0
    total = sum(r.weight for r in new.values())
    assert total == 2.0 + 3  # initial weights + points seen


def test_kmeans_dying_cluster_split(spark):
    centers = spark.createDataFrame([(0, [0.0], 1e-12), (1, [5.0], 100.0)], km.CENTER_SCHEMA)
    out = {r.cluster: r for r in km._split_dying(centers).collect()}
    assert out[0].weight == pytest.approx(out[1].weight)
    assert out[0].center[0] == pytest.approx(5.0) and out[1].center[0] == pytest.approx(5.0)


def test_zip_with_index_is_contiguous(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("k"))
    idx = positional.zip_with_index(df, ["k"]).orderBy("k").collect()
    assert [r.idx for r in idx] == list(range(1000))
    assert [r.k for r in idx] == list(range(1000))


def test_sparse_pca_equals_the_dense_one(spark):
    import numpy as np

    from sentimill.operators import pca

    rng = np.random.RandomState(3)
    dense = rng.rand(60, 20) * (rng.rand(60, 20) < 0.3) * np.linspace(4, 1, 20)
    dense[7] = 0  # a document without features
    rows = [(i, j, float(dense[i, j])) for i in range(60) for j in range(20) if dense[i, j]] + [(7, None, None)]
    x = spark.createDataFrame(rows, "id long, bucket int, tfidf double")
    got = pca.fit(x, 60, 32, k=3)
    _, s, axes = np.linalg.svd(dense - dense.mean(axis=0), full_matrices=False)
    assert np.allclose(got.variances, s[:3] ** 2 / 59, rtol=1e-9)
    found = {r.bucket: [r.pc0, r.pc1, r.pc2] for r in got.axes.collect()}
    want = axes[:3] * np.sign([a[np.abs(a).argmax()] for a in axes[:3]])[:, None]
    assert np.allclose([found[j] for j in range(20)], want.T, atol=1e-7)
    at = {r.id: r.pc for r in pca.project(x, got, ["id"]).collect()}
    assert np.allclose([at[i] for i in range(60)], dense @ want.T, atol=1e-6) and at[7] == [0.0, 0.0, 0.0]


def test_sparse_pca_steps_shuffle_no_features(spark, monkeypatch):
    import numpy as np

    from sentimill.operators import pca

    rng = np.random.RandomState(5)
    dense = rng.rand(700, 12) * (rng.rand(700, 12) < 0.4) * np.linspace(3, 1, 12)
    rows = [(None if i == 9 else i, j, float(dense[i, j])) for i in range(700) for j in range(12) if dense[i, j]]
    x = spark.createDataFrame(rows, "id long, bucket int, tfidf double").repartition(5)
    written, kept = [], pca.materialize
    monkeypatch.setattr(pca, "materialize", lambda df, name: written.append(name) or kept(df, name))
    got = pca.fit(x, 700, 64)
    assert len(written) <= 5, written  # no table for each step
    monkeypatch.setattr(pca, "DENSE_CELLS", 0)
    want = pca.fit(x, 700, 64)
    assert got.variances == pytest.approx(want.variances, rel=1e-9)
    a, b = ({r.bucket: (r.pc0, r.pc1) for r in c.axes.collect()} for c in (got, want))
    assert a.keys() == b.keys() and all(a[j] == pytest.approx(b[j], abs=1e-7) for j in a)


def test_sparse_pca_of_few_documents(spark, tmp_path):
    from sentimill.operators import pca

    x = spark.createDataFrame([(0, 3, 1.0), (1, 3, 3.0), (2, None, None)], "id long, bucket int, tfidf double")
    got = pca.fit(x, 3, 8)
    assert got.variances == [pytest.approx(7 / 3), pytest.approx(0.0, abs=1e-12)]
    assert [tuple(r) for r in got.axes.collect()] == [(3, 1.0, 0.0)]
    none = pca.fit(x.where("id = 2"), 1, 8)
    assert none.variances == [0.0, 0.0] and none.axes.count() == 0
    assert [r.pc for r in pca.project(x.where("id = 2"), none, ["id"]).collect()] == [[0.0, 0.0]]
    got.save(str(tmp_path / "pca"))
    assert pca.Components.load(spark, str(tmp_path / "pca")).axes.collect() == got.axes.collect()


def _dense(model, k):
    """Centres of a sparse model, over all buckets."""
    from sentimill.operators import sparse_kmeans as skm

    spark = model.moved.sparkSession
    every = spark.range(model.num_features).select(F.col("id").cast("int").alias("_b")).join(model.moved, F.col("_b") == F.col("bucket"), "left")
    rows = every.select("_b", *[v.alias(f"c{j}") for j, v in enumerate(skm._values(model, F.col("_b")))]).orderBy("_b").collect()
    return [[r[f"c{j}"] * model.clusters[j].scale / model.clusters[j].weight for r in rows] for j in range(k)]


@pytest.mark.parametrize("decay,unit", [(1.0, "batches"), (0.5, "batches"), (0.9, "points")])
def test_sparse_learning_equals_dense(spark, monkeypatch, decay, unit):
    import numpy as np

    from sentimill.operators import sparse_kmeans as skm

    if decay == 0.5:
        monkeypatch.setattr(skm, "LEAST_SCALE", 0.3)  # scales are multiplied into the coordinates
    k, dim = 3, 12
    model = skm.start_model(spark, k, dim, seed=4)
    c, w = np.array(_dense(model, k)), np.ones(k)
    assert [x.square for x in model.clusters] == [pytest.approx(s) for s in (c ** 2).sum(axis=1)]
    rng = np.random.RandomState(1)
    for batch in range(3):
        x = rng.rand(9, dim) * (rng.rand(9, dim) < 0.4) * 3
        x[4] = 0
        rows = [(i, j, float(x[i, j])) for i in range(9) for j in range(dim) if x[i, j]] + [(4, None, None)]
        feats = spark.createDataFrame(rows, "id long, bucket int, tfidf double")
        got = skm.assign(model, feats, ["id"]).persist()
        near = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert {r.id: r.predicted for r in got.collect()} == dict(enumerate(near.tolist()))
        model = skm.update(model, got, decay, unit)
        a = decay ** 9 if unit == "points" else decay
        m = np.bincount(near, minlength=k)
        sums = np.array([x[near == j].sum(axis=0) for j in range(k)])
        c, w = (c * (w * a)[:, None] + sums) / (w * a + m)[:, None], w * a + m
        assert [v.weight for v in model.clusters] == [pytest.approx(v) for v in w]
        assert np.allclose(_dense(model, k), c)
        assert np.allclose([v.square * (v.scale / v.weight) ** 2 for v in model.clusters], (c ** 2).sum(axis=1))
        got.unpersist()
    touched = {(r.cluster, r.bucket): r.value for r in skm.centers(model).collect()}
    assert all(v == pytest.approx(c[j, b]) for (j, b), v in touched.items())


def test_sparse_dying_cluster_starts_beside_the_heaviest(spark):
    from dataclasses import replace

    from sentimill.operators import sparse_kmeans as skm

    model = skm.start_model(spark, 2, 4, seed=1)
    light = replace(model.clusters[0], weight=1e-12, scale=1e-12)
    model = replace(model, clusters=(light, replace(model.clusters[1], weight=100.0, scale=100.0)))
    none = spark.createDataFrame([], "id long, predicted int, items array<struct<bucket: int, x: double>>")
    out = skm.update(model, none)
    a, b = _dense(out, 2)
    assert out.clusters[0].weight == out.clusters[1].weight == pytest.approx(50.0)
    assert a == pytest.approx(b) and a != b and b == pytest.approx(_dense(model, 2)[1])


def test_sparse_versions_survive_a_lost_write(spark):
    from sentimill.operators import sparse_kmeans as skm
    from sentimill.session import scratch_path

    job = scratch_path(spark, "sparse-job")
    model = skm.start_model(spark, 2, 8)
    state = skm.SparseState(spark, job, model, keep=2)
    feats = spark.createDataFrame([(1, 3, 2.0)], "id long, bucket int, tfidf double")
    for b in range(4):
        old = state.before(b)
        state.put(skm.update(old, skm.assign(old, feats, ["id"])), b)
    model.moved.write.parquet(f"{state.path}/moved/lost")  # no version names it
    again = skm.SparseState(spark, job, model)
    assert sum(c.weight for c in again.before(99).clusters) == 2 + 4
    assert sum(c.weight for c in again.before(3).clusters) == 2 + 3
    assert again.before(2).clusters and spark.read.parquet(f"{state.path}/versions").count() == 5
