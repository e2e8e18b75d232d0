"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (or data Spark derives from them) in full. The
column names equal those of the DuckDB statements in ``sentimill.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import features as fx
from ..operators import naive_bayes as nb
from ..operators import kmeans as km
from ..operators import sparse_kmeans as skm
from ..operators import pca, positional, sampling
from ..operators.clean import (CleanOptions, StemDictionary, clean_stages, clean_tweets, drop_stop_terms, exploded_terms,
                               lexicon_table, partition_by, preprocess_by_tables, stop_word_table, with_row_key)
from ..functions.lexicons import ACRONYMS, DEFAULT_STOP_WORDS, EMOTICONS
from ..sources import sinks, wire
from ..sources import tweets as tw
from ..streaming import jobs
from ..session import materialize, scratch_path
from ..sources.tables import table
from . import evaluation as ev

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


# ------------------------------------------------------------------ result tables

def nb_results_from_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in classifier result table: gt = quality*4, predicted = (1-toxic)*4."""
    lab = table(spark, sf_dir, "labels")
    return lab.select((F.col("quality") * 4).cast("int").alias("gt"),
                      ((1 - F.col("toxic")) * 4).cast("int").alias("predicted"))


@query("eval_precision")
def q_eval_precision(spark, sf_dir):
    return ev.metric(spark, nb_results_from_labels(spark, sf_dir), "precision")


@query("eval_recall")
def q_eval_recall(spark, sf_dir):
    return ev.metric(spark, nb_results_from_labels(spark, sf_dir), "recall")


@query("eval_fdr")
def q_eval_fdr(spark, sf_dir):
    return ev.metric(spark, nb_results_from_labels(spark, sf_dir), "false_discovery_rate")


@query("eval_fallout")
def q_eval_fallout(spark, sf_dir):
    return ev.metric(spark, nb_results_from_labels(spark, sf_dir), "fall_out")


@query("eval_onepass")
def q_eval_onepass(spark, sf_dir):
    return ev.metrics_one_pass(nb_results_from_labels(spark, sf_dir))


# ------------------------------------------------------------------ text chain

def _marked_docs(spark, sf_dir) -> DataFrame:
    return tw.documents_as_tweets(spark, sf_dir, markup=True).select("id", "text")


def _stage(spark, sf_dir, stage: str, as_text: bool = False) -> DataFrame:
    t = clean_stages(_marked_docs(spark, sf_dir), "text", CleanOptions(), upto=stage)
    out = F.array_join(stage, " ") if as_text else F.col(stage)
    return t.select("id", out.alias(stage))


@query("html_unescape")
def q_html_unescape(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.html_unescape(F.col("html")).alias("unescaped"))


@query("emoticon_replace")
def q_emoticon_replace(spark, sf_dir):
    return _stage(spark, sf_dir, "emoticons", as_text=True)


@query("acronym_expand")
def q_acronym_expand(spark, sf_dir):
    return _stage(spark, sf_dir, "preprocessed")


@query("tweet_clean")
def q_tweet_clean(spark, sf_dir):
    return _stage(spark, sf_dir, "tokenized")


@query("squeeze_repeats")
def q_squeeze_repeats(spark, sf_dir):
    return _stage(spark, sf_dir, "squeezed")


@query("dedupe_ordered")
def q_dedupe_ordered(spark, sf_dir):
    return _stage(spark, sf_dir, "deduped", as_text=True)


@query("stop_filter")
def q_stop_filter(spark, sf_dir):
    return _stage(spark, sf_dir, "stopped", as_text=True)


@query("stem_vocab")
def q_stem_vocab(spark, sf_dir):
    """Stem of every distinct term of the corpus (after stop-word removal): its dictionary.

    ``distinct`` pre-aggregates in every task before the shuffle, so a term occurring in
    a third of all rows still moves once per task.
    """
    t = clean_stages(partition_by(_marked_docs(spark, sf_dir), "id"), "text", CleanOptions(), upto="stopped")
    words = t.select(tx.explode_tokens(F.col("stopped"), "pos", "term"))
    return StemDictionary(spark).add(words, "term").withColumnRenamed("word", "term")


@query("process_tweet")
def q_process_tweet(spark, sf_dir):
    """Flagship: full cleaning chain, then the label join (tokens move, not raw text)."""
    t = clean_tweets(_marked_docs(spark, sf_dir), ["id"])
    terms = t.select("id", F.array_join("terms", " ").alias("terms"))
    return tw.with_polarity(spark, sf_dir, terms).select("id", "polarity", "terms")


@query("process_tweet_keys")
def q_process_tweet_keys(spark, sf_dir):
    """Tweets whose ids are missing (every third) or shared by two: still one row per tweet (P5)."""
    docs = _marked_docs(spark, sf_dir)
    given = F.when(F.pmod("id", F.lit(3)) > 0, F.expr("id div 2"))
    t = clean_tweets(docs.select(given.alias("id"), "text"), ["id"])
    return t.select("id", F.array_join("terms", " ").alias("terms"))


@query("stop_filter_file")
def q_stop_filter_file(spark, sf_dir):
    """Stop words read from a file and removed by an anti-join on the exploded tokens."""
    path = scratch_path(spark, "stop-words")
    spark.createDataFrame([(w,) for w in DEFAULT_STOP_WORDS], "value string").write.text(path)
    t = clean_stages(with_row_key(_marked_docs(spark, sf_dir)), "text", CleanOptions(), upto="deduped")
    terms = exploded_terms(t, ["id"], "deduped", "term", stem=False)
    return drop_stop_terms(terms, stop_word_table(spark, path)).select("id", "term")


@query("lexicon_file")
def q_lexicon_file(spark, sf_dir):
    """Emoticon and acronym lexicons read from files as tables and joined: the chain up to
    acronyms (S16, J6)."""
    loaded = {}
    for name, pairs in (("emoticons", EMOTICONS), ("acronyms", ACRONYMS)):
        path = scratch_path(spark, name)
        spark.createDataFrame([(f"{k}\t{v}",) for k, v in pairs], "value string").write.text(path)
        loaded[name] = lexicon_table(spark, path)
    return preprocess_by_tables(_marked_docs(spark, sf_dir), ["id"], "text", loaded["emoticons"], loaded["acronyms"])


# ------------------------------------------------------------------ features and Naive Bayes

NUM_FEATURES = 1024      # hashed feature dimension of the training job
MIN_DOC_FREQ = 5         # rare-bucket cut of the serving jobs
SMOOTHING = 1.0
TRAIN_PERCENT = 70


def _terms(spark, sf_dir, outer: bool = False) -> DataFrame:
    """(id, pos, term): stemmed terms of every document, one row per kept token.

    Documents are partitioned by id before they are cleaned. With ``outer`` a document
    without tokens has a row with a null term.
    """
    docs = partition_by(_marked_docs(spark, sf_dir), "id")
    t = clean_stages(docs, "text", CleanOptions(), upto="stopped")
    return exploded_terms(t.select("id", "stopped"), ["id"], "stopped", "term", outer=outer)


def _hashed(spark, sf_dir, num_features: int = NUM_FEATURES) -> DataFrame:
    """Hashed TF of the corpus, written once to the shared folder (it is read twice)."""
    return materialize(fx.hashed_tf(_terms(spark, sf_dir, outer=True), ["id"], num_features), "hashed-tf")


def _split(spark, sf_dir) -> DataFrame:
    """(id, polarity, is_train) for every document."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    return tw.with_polarity(spark, sf_dir, docs).select(
        "id", "polarity", sampling.in_sample(F.col("id"), TRAIN_PERCENT).alias("is_train"))


def _in_train() -> F.Column:
    # the split is a function of the id: a filter, not a join
    return sampling.in_sample(F.col("id"), TRAIN_PERCENT)


def _train_features(spark, sf_dir, num_features: int, min_doc_freq: int):
    """(idf, training documents, TF of all documents, split), IDF from the training part."""
    split = materialize(_split(spark, sf_dir), "split")
    tf = _hashed(spark, sf_dir, num_features)
    m = split.where("is_train").count()
    seen = tf.where(_in_train()).where("bucket is not null")
    return materialize(fx.idf(seen, F.lit(m), min_doc_freq), "idf"), m, tf, split


def _train_model(spark, sf_dir):
    """IDF and Naive Bayes fitted on the training part; returns (idf, m, model, tf, split)."""
    w, m, tf, split = _train_features(spark, sf_dir, NUM_FEATURES, MIN_DOC_FREQ)
    train = split.where("is_train").select("id", "polarity")
    x = fx.tfidf(tf.where(_in_train()), w, NUM_FEATURES, m, MIN_DOC_FREQ).join(train, "id")
    model = nb.fit(x, train, NUM_FEATURES, SMOOTHING, label_col="polarity")
    return w, m, model, tf, split


@query("term_frequency")
def q_term_frequency(spark, sf_dir):
    return fx.term_frequency(_terms(spark, sf_dir), ["id"])


@query("hashed_tf")
def q_hashed_tf(spark, sf_dir):
    return fx.hashed_tf(_terms(spark, sf_dir), ["id"], NUM_FEATURES)


@query("idf_weights")
def q_idf_weights(spark, sf_dir):
    m = table(spark, sf_dir, "documents").count()
    tf = fx.hashed_tf(_terms(spark, sf_dir), ["id"], NUM_FEATURES)
    return fx.idf(tf, F.lit(m), MIN_DOC_FREQ).select("bucket", "df", F.round("idf", 6).alias("idf"))


@query("tfidf")
def q_tfidf(spark, sf_dir):
    tf = _hashed(spark, sf_dir).where("bucket is not null")
    m = table(spark, sf_dir, "documents").count()
    x = fx.tfidf(tf, fx.idf(tf, F.lit(m), MIN_DOC_FREQ), NUM_FEATURES, m, MIN_DOC_FREQ)
    return x.select("id", "bucket", "tf", F.round("tfidf", 6).alias("tfidf"))


WIDE_FEATURES = 1 << 20  # hashed feature dimension of the streaming classifier


@query("tfidf_wide")
def q_tfidf_wide(spark, sf_dir):
    """TF-IDF of the test part over 2**20 buckets with no frequency cut: buckets that no
    training document has weigh ln(m + 1) (L3)."""
    w, m, tf, _ = _train_features(spark, sf_dir, WIDE_FEATURES, 0)
    test = tf.where(~_in_train()).where("bucket is not null")
    x = fx.tfidf(test, w, WIDE_FEATURES, m, 0)
    return x.select("id", "bucket", "tf", F.round("tfidf", 6).alias("tfidf"))


@query("split_70_30")
def q_split(spark, sf_dir):
    s = _split(spark, sf_dir)
    return s.select("id", F.when(F.col("is_train"), "train").otherwise("test").alias("part"))


@query("nb_priors")
def q_nb_priors(spark, sf_dir):
    model = _train_model(spark, sf_dir)[2]
    return model.priors.select("label", "n", F.round("pi", 6).alias("pi"))


@query("nb_loglik")
def q_nb_loglik(spark, sf_dir):
    """Log-likelihoods, from the model saved and loaded again."""
    path = scratch_path(spark, "nb-model")
    _train_model(spark, sf_dir)[2].save(path)
    theta = nb.NBModel.load(spark, path).theta
    return theta.select("label", "bucket", F.round("theta", 6).alias("theta"))


@query("nb_predict")
def q_nb_predict(spark, sf_dir):
    w, m, model, tf, split = _train_model(spark, sf_dir)
    test = split.where("not is_train").select("id", F.col("polarity").alias("gt"))
    x = fx.tfidf(tf.where(~_in_train()).join(test, "id"), w, NUM_FEATURES, m, MIN_DOC_FREQ)
    return nb.predict(nb.prepare(model), x, ["id", "gt"])


@query("tf_roundtrip")
def q_tf_roundtrip(spark, sf_dir):
    """Hashed TF written as parquet to the shared folder and read back."""
    path = scratch_path(spark, "tf")
    q_hashed_tf(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def _ml_model(spark, sf_dir):
    """(pyspark.ml pipeline fitted on the training part, cleaned terms of all documents)."""
    split = _split(spark, sf_dir)
    terms = clean_tweets(_marked_docs(spark, sf_dir), ["id"])
    data = materialize(terms.join(split, "id"), "ml-terms")
    train = data.where("is_train")
    classes = nb.label_indexer(train, "polarity")
    pipeline = nb.ml_pipeline(NUM_FEATURES, classes.labels, MIN_DOC_FREQ, SMOOTHING, hashing="md5")
    return pipeline.fit(classes.transform(train)), data


@query("nb_ml_roundtrip")
def q_nb_ml_roundtrip(spark, sf_dir):
    """pyspark.ml pipeline (hashed TF, IDF, NaiveBayes, class codes): fit, save, load, predict
    (S7, S8, P15, L10); the loaded model's predictions, and whether the fitted one agrees."""
    from pyspark.ml import PipelineModel

    model, data = _ml_model(spark, sf_dir)
    path = scratch_path(spark, "nb-pipeline")
    model.write().save(path)
    test = data.where("not is_train").select("id", F.col("polarity").alias("gt"), "terms")
    a = model.transform(test).select("id", F.col("predicted").alias("p"), F.col("probability").alias("before"))
    b = PipelineModel.load(path).transform(test).select("id", "gt", "predicted", "probability")
    same = (F.col("p") == F.col("predicted")) & (F.col("before") == F.col("probability"))
    return b.join(a, "id").select("id", "gt", F.col("predicted").cast("int").alias("predicted"), same.alias("loaded_agrees"))


# ------------------------------------------------------------------ k-means

KMEANS_K = 2
KMEANS_BATCHES = 4


def _vectors(spark, sf_dir) -> DataFrame:
    """Embedding vectors as the clustering input; class code gt = (label % 3) * 2."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("features"),
                    (F.pmod(F.col("label"), F.lit(3)) * 2).cast("int").alias("gt"))


def _initial_centers(spark, sf_dir) -> DataFrame:
    """The first k vectors, weight 1.0 each (a fixed, reproducible start)."""
    v = _vectors(spark, sf_dir).where(F.col("vec_id") < KMEANS_K)
    return v.select(F.col("vec_id").cast("int").alias("cluster"),
                    F.col("features").alias("center"), F.lit(1.0).alias("weight"))


def _projected(spark, sf_dir) -> DataFrame:
    """The vectors with x, y: their projection on the first two principal components.

    The sign of a component is free; here its largest coordinate is positive.
    """
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = _vectors(spark, sf_dir).withColumn("vec", array_to_vector("features"))
    model = PCA(k=2, inputCol="vec", outputCol="pc").fit(v)
    axes = model.pc.toArray()  # dimensions x 2
    sign = [1.0 if axes[abs(axes[:, i]).argmax(), i] > 0 else -1.0 for i in range(2)]
    p = model.transform(v).withColumn("pc", vector_to_array("pc"))
    return p.select("vec_id", "features", "gt", *[(F.round(F.col("pc")[i] * sign[i], 3) + 0.0).cast("float").alias(n)
                                                  for i, n in enumerate("xy")])


def _kmeans_results(spark, sf_dir) -> DataFrame:
    """Result rows (x, y, gt, predicted) of the projecting output mode: the cluster is that of
    the written point, with the first k points as centres."""
    p = materialize(_projected(spark, sf_dir).withColumn("point", F.array("x", "y").cast("array<double>")), "projected")
    centers = p.where(F.col("vec_id") < KMEANS_K).select(
        F.col("vec_id").cast("int").alias("cluster"), F.col("point").alias("center"), F.lit(1.0).alias("weight"))
    return km.assign(p, centers, "point").select("x", "y", "gt", "predicted")


@query("kmeans_assign")
def q_kmeans_assign(spark, sf_dir):
    a = km.assign(_vectors(spark, sf_dir), _initial_centers(spark, sf_dir))
    return a.select("vec_id", "gt", "predicted")


@query("kmeans_update")
def q_kmeans_update(spark, sf_dir):
    centers = _initial_centers(spark, sf_dir)
    stats = km.batch_stats(km.assign(_vectors(spark, sf_dir), centers))
    new = km.update(centers, stats, decay=1.0, time_unit="batches")
    return new.select("cluster", F.posexplode("center").alias("idx", "value"), "weight").select(
        "cluster", "idx", F.round("value", 6).alias("value"), "weight")


@query("kmeans_output")
def q_kmeans_output(spark, sf_dir):
    return _kmeans_results(spark, sf_dir)


@query("cluster_contingency")
def q_cluster_contingency(spark, sf_dir):
    return ev.contingency(spark, _kmeans_results(spark, sf_dir))


@query("scan_results")
def q_scan_results(spark, sf_dir):
    """Create the k-means result table, append the results, scan it."""
    path = scratch_path(spark, "test_kmeans")
    sinks.create_table(spark, sinks.KMEANS_RESULT_SCHEMA, path=path)
    sinks.append(_kmeans_results(spark, sf_dir), path=path)
    return ev.run(spark, ev.SCAN_SQL, sinks.scan(spark, path=path))


@query("pca_project")
def q_pca_project(spark, sf_dir):
    """2-D projection of the vectors on their first two principal components."""
    return _projected(spark, sf_dir).select("vec_id", "x", "y", "gt")


@query("kmeans_stream")
def q_kmeans_stream(spark, sf_dir):
    """Vectors arrive in batches (vec_id % 4); each batch updates the model, then is
    assigned with the updated model (T5). The job is started anew for each batch and goes
    on with its checkpoint and model."""
    v = _vectors(spark, sf_dir).withColumn("part", F.pmod("vec_id", F.lit(KMEANS_BATCHES)))
    staged, src = scratch_path(spark, "vectors"), scratch_path(spark, "vectors-in")
    v.write.partitionBy("part").parquet(staged)
    out, checkpoint = scratch_path(spark, "kmeans-out"), scratch_path(spark, "kmeans-job")
    for b in range(KMEANS_BATCHES):
        spark.read.parquet(f"{staged}/part={b}").write.mode("append").parquet(src)
        stream = spark.readStream.schema(v.drop("part").schema).parquet(src)
        jobs.cluster_stream(stream, _initial_centers(spark, sf_dir), out, checkpoint)
    return spark.read.parquet(out).select("vec_id", "gt", "predicted")


TEXT_FEATURES = 4096  # hashed feature dimension of the clustering stream


@query("kmeans_text_stream")
def q_kmeans_text_stream(spark, sf_dir):
    """Tweets clustered by text (S14, L6-L8): TF-IDF over 4,096 buckets, seeded random
    centres, one training batch of the whole training part, then the test part served from
    a stream without updating the model."""
    w, m, tf, split = _train_features(spark, sf_dir, TEXT_FEATURES, MIN_DOC_FREQ)
    train = materialize(fx.tfidf(tf.where(_in_train()), w, TEXT_FEATURES, m, MIN_DOC_FREQ), "text-train")
    start = km.random_centers(spark, KMEANS_K, TEXT_FEATURES, 1.0, seed=0)
    first = materialize(km.assign_sparse(train, ["id"], km.collect_centers(start)), "text-first")
    model = km.update(start, km.sparse_stats(train, first, ["id"], TEXT_FEATURES))
    centers = km.collect_centers(materialize(model, "text-model"))
    msgs = wire.encode(tw.tweets(spark, sf_dir, markup=True).where(~_in_train()))

    def predict(batch_tf: DataFrame) -> DataFrame:
        x = fx.tfidf(batch_tf, w, TEXT_FEATURES, m, MIN_DOC_FREQ)
        return km.assign_sparse(x, BATCH_KEYS, centers).drop("row_key")

    return _classified(spark, msgs, predict, TEXT_FEATURES).select("id", "gt", "predicted")


@query("kmeans_text_pca")
def q_kmeans_text_pca(spark, sf_dir):
    """Tweets clustered by text in two dimensions (L9, P17, P18, A12): principal components of
    the training part's sparse TF-IDF, seeded random centres of dimension 2, one training
    batch of the projected training part; then the test part from a stream, projected,
    assigned and written as (x, y, gt, predicted) batch by batch."""
    w, m, tf, _ = _train_features(spark, sf_dir, TEXT_FEATURES, MIN_DOC_FREQ)
    train = materialize(fx.tfidf(tf.where(_in_train()), w, TEXT_FEATURES, m, MIN_DOC_FREQ), "text-train")
    axes = pca.fit(train, m, TEXT_FEATURES)
    points = materialize(pca.project(train, axes, ["id"]), "text-points")
    start = km.random_centers(spark, KMEANS_K, 2, 1.0, seed=0)
    model = km.update(start, km.batch_stats(km.assign(points, start, "pc"), "pc"))
    centers = km.collect_centers(materialize(model, "text-model"))
    msgs = wire.encode(tw.tweets(spark, sf_dir, markup=True).where(~_in_train()))

    def predict(batch_tf: DataFrame) -> DataFrame:
        x = pca.project(fx.tfidf(batch_tf, w, TEXT_FEATURES, m, MIN_DOC_FREQ), axes, BATCH_KEYS)
        at = [F.col("pc")[j].cast("float").alias(n) for j, n in enumerate("xy")]
        return km.assign(x, centers, "pc").select("id", *at, "gt", "predicted")

    rows = _classified(spark, msgs, predict, TEXT_FEATURES)
    return rows.select("id", *[(F.round(n, 2) + 0.0).cast("float").alias(n) for n in "xy"], "gt", "predicted")


@query("kmeans_text_learn")
def q_kmeans_text_learn(spark, sf_dir):
    """A stream of texts that k-means learns from, over 2**20 buckets (A11, L6, L7, T5): the
    training tweets arrive in four batches, each of which updates the model; the coordinates
    of its centres in the buckets that were met. The job is started anew for each batch."""
    w, m, _, _ = _train_features(spark, sf_dir, WIDE_FEATURES, MIN_DOC_FREQ)
    model = skm.start_model(spark, KMEANS_K, WIDE_FEATURES, seed=0, spread=1 / 1024)
    train = tw.tweets(spark, sf_dir, markup=True).where(_in_train())
    msgs = train.select(F.pmod("id", F.lit(KMEANS_BATCHES)).alias("part"), wire.message().alias("value"))
    staged, src = scratch_path(spark, "texts"), scratch_path(spark, "texts-in")
    msgs.write.partitionBy("part").text(staged)
    out, checkpoint = scratch_path(spark, "learn-out"), scratch_path(spark, "learn-job")

    def featurize(good: DataFrame) -> DataFrame:
        return fx.tfidf(_batch_tf(good, WIDE_FEATURES), w, WIDE_FEATURES, m, MIN_DOC_FREQ)

    for b in range(KMEANS_BATCHES):
        spark.read.text(f"{staged}/part={b}").write.mode("append").text(src)
        jobs.learn_sparse_stream(jobs.file_source(spark, src), wire.decode, featurize, BATCH_KEYS, model, out, checkpoint)
    learnt = skm.SparseState(spark, checkpoint, model).before(KMEANS_BATCHES + 1)
    return skm.centers(learnt).select("cluster", "bucket", (F.round("value", 6) + 0.0).alias("value"), "weight")


# ------------------------------------------------------------------ parsers, wire format, ids

def _plain_tweets(spark, sf_dir) -> DataFrame:
    return tw.tweets(spark, sf_dir, markup=False)


@query("parse_lines")
def q_parse_lines(spark, sf_dir):
    """Tweets written as quoted text lines, scanned and split naively."""
    path = scratch_path(spark, "raw-lines")
    tw.to_raw_line(_plain_tweets(spark, sf_dir)).write.text(path)
    return tw.read_raw_lines(spark, path)


@query("parse_csv")
def q_parse_csv(spark, sf_dir):
    """Tweets written as CSV (quoted, doubled-quote escape), one record per line, and read back
    by a scan that splits files (S2)."""
    path = scratch_path(spark, "tweets-csv")
    tw.write_csv(_plain_tweets(spark, sf_dir), path, one_line=True)
    return tw.read_csv(spark, path, one_line=True)


@query("parse_rejects")
def q_parse_rejects(spark, sf_dir):
    """Tweets written as CSV lines, some of them broken (a field short, an id that is no number,
    an open quote), scanned with a reject channel: all lines, good or with their reason (S2, C21)."""
    t = _plain_tweets(spark, sf_dir).withColumn("text", F.regexp_replace("text", "[\r\n]", " "))

    def quoted(field: str) -> F.Column:
        return F.concat(F.lit('"'), F.replace(F.coalesce(F.col(field).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    fields = [quoted(c) for c in wire.FIELDS]
    case = F.pmod("id", F.lit(50))
    line = (F.when(case == 0, F.concat_ws(",", *fields[:5]))
            .when(case == 1, F.concat_ws(",", fields[0], F.concat(F.lit('"x'), F.substring(fields[1], 2, 30)), *fields[2:]))
            .when(case == 2, F.expr("substring(line, 1, length(line) - 1)")).otherwise(F.col("line")))
    path = scratch_path(spark, "csv-lines")
    t.withColumn("line", F.concat_ws(",", *fields)).select(line.alias("value")).write.text(path)
    good, rejected = tw.read_csv_checked(spark, path)
    ok = good.select("id", "polarity", "text", F.lit("ok").alias("reason"), F.lit(None).cast("string").alias("record"))
    return ok.unionByName(rejected.select("reason", "record"), allowMissingColumns=True)


@query("wire_encode")
def q_wire_encode(spark, sf_dir):
    return _plain_tweets(spark, sf_dir).select("id", wire.message().alias("value"))


@query("tweet_fields")
def q_tweet_fields(spark, sf_dir):
    """Field extraction and casts from wire messages."""
    d = wire.decode(wire.encode(_plain_tweets(spark, sf_dir)))
    return d.select("polarity", "id", "date", "query", "sender", "text")


def _messages(spark, sf_dir) -> DataFrame:
    """Wire messages of every tweet; every 50th is cut short (malformed JSON)."""
    m = wire.encode(_plain_tweets(spark, sf_dir), key_col="id")
    bad = F.pmod(F.col("key").cast("bigint"), F.lit(50)) == 0
    v = F.when(bad, F.expr("substring(value, 1, length(value) - 1)")).otherwise(F.col("value"))
    return m.select("key", v.alias("value"))


def _stream_files(spark, messages: DataFrame) -> DataFrame:
    """The messages written once as text files, as a stream of a few files per batch."""
    src = scratch_path(spark, "messages")
    messages.select("value").write.text(src)
    files = len(spark.read.text(src).inputFiles())
    return jobs.file_source(spark, src, max(1, -(-files // 4)))


@query("stream_decode")
def q_stream_decode(spark, sf_dir):
    """Messages streamed from files, decoded per micro-batch; malformed ones are kept
    with valid = false (T2, C19, S3 file form)."""
    out, checkpoint = scratch_path(spark, "decoded"), scratch_path(spark, "decode-job")
    jobs.run(_stream_files(spark, _messages(spark, sf_dir)),
             lambda b, i: jobs.write_batch(wire.decode(b), out, checkpoint, i), checkpoint)
    return spark.read.parquet(out).select("id", "polarity", "query", "sender", "text", "valid")


@query("replay_order")
def q_replay_order(spark, sf_dir):
    """Seeded random order of the replay set (O1): a distributed sort on a hash key, with
    each tweet's place in it."""
    t = _plain_tweets(spark, sf_dir).select("id", sampling.replay_key(F.col("id")).alias("replay_key"))
    return positional.zip_with_index(t, ["replay_key"], "place").select("id", "replay_key", "place")


BATCH_KEYS = ["row_key", "id", "gt"]


def _batch_tf(good: DataFrame, num_features: int) -> DataFrame:
    """Hashed TF of a decoded batch by row; the texts move once, by row key."""
    docs = good.select("row_key", "id", F.col("polarity").alias("gt"), "text")
    docs = partition_by(docs, "row_key")
    t = clean_stages(docs, "text", CleanOptions(), upto="stopped")
    return fx.hashed_tf(exploded_terms(t, BATCH_KEYS, "stopped", "term", outer=True), BATCH_KEYS, num_features)


def _classified(spark, msgs: DataFrame, predict, num_features: int) -> DataFrame:
    out, bad, checkpoint = (scratch_path(spark, n) for n in ("classified", "quarantine", "classify-job"))
    jobs.classify_stream(_stream_files(spark, msgs), wire.decode, predict, out, bad, checkpoint,
                         featurize=lambda good: _batch_tf(good, num_features))
    return spark.read.parquet(out)


@query("stream_classify")
def q_stream_classify(spark, sf_dir):
    """Test tweets streamed as wire messages; each micro-batch is cleaned, turned into
    TF-IDF with the training IDF and classified by the trained Naive Bayes model
    (T1, T3, T6, S11)."""
    w, m, model, _, _ = _train_model(spark, sf_dir)
    scorer = nb.prepare(model)
    msgs = wire.encode(tw.tweets(spark, sf_dir, markup=True).where(~_in_train()))

    def predict(batch_tf: DataFrame) -> DataFrame:
        x = fx.tfidf(batch_tf, w, NUM_FEATURES, m, MIN_DOC_FREQ)
        return nb.predict(scorer, x, BATCH_KEYS).drop("row_key")

    return _classified(spark, msgs, predict, NUM_FEATURES).select("id", "gt", "predicted")


@query("stream_classify_ml")
def q_stream_classify_ml(spark, sf_dir):
    """Test tweets streamed as wire messages; decoding, cleaning and the fitted pipeline are one
    streaming plan, a row for each message (T2, T3, T6)."""
    model = _ml_model(spark, sf_dir)[0]
    msgs = wire.encode(tw.tweets(spark, sf_dir, markup=True).where(~_in_train()))
    good = wire.decode(_stream_files(spark, msgs)).where("valid")
    t = clean_stages(good.select("id", F.col("polarity").alias("gt"), "text"), "text", CleanOptions(), upto="stopped")
    rows = t.select("id", "gt", F.coalesce(tx.stem_each(F.col("stopped")), F.array().cast("array<string>")).alias("terms"))
    out, checkpoint = scratch_path(spark, "classified-ml"), scratch_path(spark, "classify-ml-job")
    jobs.transform_stream(rows, model, out, checkpoint, ["id", "gt", "predicted"])
    return spark.read.parquet(out).withColumn("predicted", F.col("predicted").cast("int"))


@query("sink_roundtrip")
def q_sink_roundtrip(spark, sf_dir):
    """Result rows streamed and appended per micro-batch to a result table created
    beforehand; every batch is appended twice, which adds no row; then read (S9-S12)."""
    res = nb_results_from_labels(spark, sf_dir)
    path = scratch_path(spark, "test_NBM")
    sinks.create_table(spark, sinks.NB_RESULT_SCHEMA, path=path)
    src, checkpoint = scratch_path(spark, "results-in"), scratch_path(spark, "sink-job")
    res.write.parquet(src)
    stream = spark.readStream.schema(res.schema).parquet(src)

    def twice(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2):  # as after a failure behind the write
            sinks.append(batch, path=path, batch=f"{jobs.run_key(checkpoint)}-{batch_id}")

    jobs.run(stream, twice, checkpoint)
    return sinks.scan(spark, path=path)


@query("unique_ids")
def q_unique_ids(spark, sf_dir):
    """Ids given to the rows, and how many rows share each of them (1, if they are unique)."""
    ids = positional.unique_ids(_plain_tweets(spark, sf_dir).select("id"), "uid")
    return ids.groupBy("uid").agg(F.min("id").alias("id"), F.count("*").alias("rows_with_uid")).drop("uid")


@query("positional_join")
def q_positional_join(spark, sf_dir):
    """i-th label row paired with the i-th document row, both in id order."""
    left = _plain_tweets(spark, sf_dir).select("id", "polarity")
    right = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return positional.positional_join(left, right, ["id"], ["doc_id"]).select(
        "idx", "id", "polarity", "doc_id", "n_chars")


@query("run_table_name")
def q_run_table_name(spark, sf_dir):
    """Result rows with the time-stamped table name of the run, as a test of its form."""
    name = sinks.run_table_name("test_NBM")
    form = r"^test_NBM_(0[1-9]|[12][0-9]|3[01])_([01][0-9]|2[0-3])_[0-5][0-9]_[0-5][0-9]$"
    return nb_results_from_labels(spark, sf_dir).withColumn("name_in_form", name.rlike(form))


@query("sink_create")
def q_sink_create(spark, sf_dir):
    """Create the result table from its schema; a second create must fail; then the
    results are appended and scanned (S9, S10)."""
    path = scratch_path(spark, "test_NBM")
    sinks.create_table(spark, sinks.NB_RESULT_SCHEMA, path=path)
    try:
        sinks.create_table(spark, sinks.NB_RESULT_SCHEMA, path=path)
    except Exception:  # noqa: BLE001 - the expected "already exists" failure
        pass
    else:
        raise RuntimeError("creating an existing result table did not fail")
    sinks.append(nb_results_from_labels(spark, sf_dir), path=path)
    return sinks.scan(spark, path=path)
