"""Parsers, wire format, JDBC sink (Derby, in memory), streams."""

import pytest
from pyspark.sql import functions as F

from sentimill.operators import kmeans as km
from sentimill.operators import clean
from sentimill.operators.clean import load_lexicon
from sentimill.session import scratch_path
from sentimill.sources import sinks, tweets as tw, wire
from sentimill.streaming import jobs

LINES = ['"0","1","d","q","s","plain text"', '"4","2","d","q","s","cut ", here"',
         '"0","3","d","q","s","it\'s"', '"2","x","d"']


def test_naive_line_parser(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    got = tw.parse_raw_lines(df).collect()
    assert got[0].text == "plain text" and got[0].id == 1 and got[0].polarity == "0"
    assert got[1].text == "cut " and got[1].n_fields == 7
    assert got[2].text == "its"
    assert got[3].id is None and got[3].text is None and got[3].n_fields == 3


def test_csv_roundtrip_keeps_quotes_and_newlines(spark):
    rows = [(0, 1, "d", "q", "s", 'he said "hi", ok'), (4, 2, "d", "q", "s", "two\nlines"), (2, 3, "d", "q", "s", "")]
    df = spark.createDataFrame(rows, tw.TWEET_SCHEMA)
    path = scratch_path(spark, "t-csv")
    tw.write_csv(df, path)
    back = sorted(tuple(r) for r in tw.read_csv(spark, path, multi_line=True).collect())
    assert back == sorted(rows)
    # one record per line: any text comes back, and the file can be split
    rows += [(4, 4, "d", "q", "s", "a\\nb\nc\r\nd\\\\n,\"x\"\\"), (0, 5, "", "q", "s", "\\b\\\n")]
    tw.write_csv(spark.createDataFrame(rows, tw.TWEET_SCHEMA).coalesce(1), path + "-lines", one_line=True)
    assert sorted(tuple(r) for r in tw.read_csv(spark, path + "-lines", one_line=True).collect()) == sorted(rows)
    assert spark.read.text(path + "-lines").count() == len(rows)


def test_wire_decode_quarantines(spark):
    good = '["4","7","d","q","s","caf\\u00e9"]'
    df = spark.createDataFrame([(good,), ('["4","7"',), ('["a","b","c","d","e"]',), ("not json",)], "value string")
    got = wire.decode(df).collect()
    assert got[0].valid and got[0].text == "café" and got[0].id == 7
    assert [r.valid for r in got[1:]] == [False, False, False]


def test_jdbc_sink_create_append_scan(spark):
    url = "jdbc:derby:memory:sentimill_test;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    sinks.create_table(spark, sinks.KMEANS_RESULT_SCHEMA, jdbc_url=url, table="TEST_KMEANS", properties=props)
    with pytest.raises(Exception):
        sinks.create_table(spark, sinks.KMEANS_RESULT_SCHEMA, jdbc_url=url, table="TEST_KMEANS", properties=props)
    batch = spark.createDataFrame([(0, 1), (4, 0)], "gt int, predicted int")  # x, y filled with NULL
    assert sinks.append(batch, jdbc_url=url, table="TEST_KMEANS", properties=props)
    assert not sinks.append(batch.limit(0), jdbc_url=url, table="TEST_KMEANS", properties=props)
    back = sinks.scan(spark, jdbc_url=url, table="TEST_KMEANS", properties=props)
    rows = sorted((r["gt"], r["predicted"], r["x"]) for r in back.collect())
    assert rows == [(0, 1, None), (4, 0, None)]


DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def test_jdbc_batch_is_there_once(spark, monkeypatch):
    at = {"jdbc_url": "jdbc:derby:memory:sentimill_ledger;create=true", "table": "NBM", "properties": DERBY}
    sinks.create_table(spark, sinks.NB_RESULT_SCHEMA, **at)
    rows = spark.createDataFrame([(0, 4), (4, 4), (4, 0)], sinks.NB_RESULT_SCHEMA).repartition(3)
    assert sinks.append(rows, batch="job-0", **at)
    assert not sinks.append(rows, batch="job-0", **at)  # tried again behind the ledger
    assert sinks.scan(spark, **at).count() == 3

    # a failure between the delete and the insert
    execute = sinks._execute

    def fails_behind(*args):
        execute(*args)
        raise RuntimeError("lost")
    monkeypatch.setattr(sinks, "_execute", fails_behind)
    with pytest.raises(RuntimeError):
        sinks.append(rows, batch="job-1", **at)
    monkeypatch.setattr(sinks, "_execute", execute)
    # a failure between the insert and the ledger: rows that no scan shows
    rows.limit(2).withColumn("batch", F.lit("job-1")).write.jdbc(at["jdbc_url"], "NBM", mode="append", properties=DERBY)
    assert sinks.scan(spark, **at).count() == 3
    assert sinks.append(rows, batch="job-1", **at)
    assert sinks.scan(spark, **at).count() == 6
    assert spark.read.jdbc(at["jdbc_url"], "NBM", properties=DERBY).count() == 6

    # a task that inserts twice: the batch is deleted and inserted again, then given up on
    inserted = []

    def twice(*args):
        inserted.append(args)
        execute(*args)
        if len(inserted) == 1:
            rows.limit(1).withColumn("batch", F.lit("it's")).write.jdbc(at["jdbc_url"], "NBM", mode="append", properties=DERBY)
    monkeypatch.setattr(sinks, "_execute", twice)
    assert sinks.append(rows, batch="it's", **at) and len(inserted) == 2
    assert sinks.scan(spark, **at).count() == 9


def test_scans_see_whole_batches_only(spark):
    path = scratch_path(spark, "published")
    sinks.create_table(spark, sinks.KMEANS_RESULT_SCHEMA, path=path)

    def rows(*pairs):
        return spark.createDataFrame(pairs, sinks.NB_RESULT_SCHEMA)

    def seen():
        return sorted((r.gt, r.predicted) for r in sinks.scan(spark, path=path).collect())
    assert seen() == [] and sinks.scan(spark, path=path).columns == ["x", "y", "gt", "predicted"]
    sinks.append(rows((0, 0), (0, 4)), path=path, batch="b0")
    before = sinks.scan(spark, path=path)
    attempt = sinks._write_aside(rows((4, 4)), path)  # the first of the two writes of a batch
    assert seen() == [(0, 0), (0, 4)]
    sinks._publish(spark, path, "b0", attempt)         # the second: it replaces the batch at once
    assert seen() == [(4, 4)]
    assert before.count() == 2                         # a scan that began earlier goes on with what it saw
    for i in range(1, 5):
        sinks.append(rows((i, 0)), path=path, batch=f"b{i}")
    sinks._write_aside(rows((9, 9)), path)             # a failed attempt
    late = sinks._log(spark, path)
    assert sinks.merge(spark, path) == 6 and sinks.merge(spark, path) == 0
    assert seen() == [(1, 0), (2, 0), (3, 0), (4, 0), (4, 4)] and late.count() == 7
    assert not sinks.append(rows((1, 1)), path=path, batch="b1")  # merged: it is there already
    sinks.append(rows((5, 0)), path=path, batch="b5")
    assert len(seen()) == 6
    assert sinks.vacuum(spark, path, 3600) == 0 and sinks.vacuum(spark, path, 0) == 7
    assert len(seen()) == 6 and spark.read.parquet(f"{path}/rows").select("attempt").distinct().count() == 2


def test_wire_marks_failed_casts(spark):
    rows = [('["x","7","d","q","s","t"]',), ('["4","seven","d","q","s","t"]',), ('["4","7","d","q","s","t"]',)]
    got = wire.decode(spark.createDataFrame(rows, "value string")).collect()
    assert [r.valid for r in got] == [False, False, True]


def _message(i, polarity=4, text="so good"):
    return f'["{polarity}","{i}","d","q","s","{text}"]'


def test_classify_stream_restarts_without_loss(spark):
    src, out, bad, job = (scratch_path(spark, n) for n in ("c-in", "c-out", "c-bad", "c-job"))

    def send(ids, extra=()):
        lines = [(_message(i),) for i in ids] + [(x,) for x in extra]
        spark.createDataFrame(lines, "value string").write.mode("append").text(src)

    def start():
        return jobs.classify_stream(jobs.file_source(spark, src), wire.decode,
                                    lambda good: good.select("row_key", "id"), out, bad, job)
    send([1, 1, 2, 3, 4, 5, 6, 7, 8, 9], extra=["broken"])
    assert not start().isActive
    send([10, 11, 12, 13, 14], extra=[_message("none")])
    start()
    start()  # nothing new
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 1, *range(2, 15)]
    assert spark.read.parquet(bad).count() == 2
    # another job on the same output keeps what is there
    jobs.classify_stream(jobs.file_source(spark, src), wire.decode, lambda good: good.select("row_key", "id"), out, bad, job + "2")
    assert spark.read.parquet(out).count() == 30


def test_cluster_stream_goes_on_with_its_model(spark):
    src, out, job = (scratch_path(spark, n) for n in ("k-in", "k-out", "k-job"))
    centers = spark.createDataFrame([(0, [0.0], 1.0), (1, [10.0], 1.0)], km.CENTER_SCHEMA)

    def send(values):
        spark.createDataFrame([([float(v)],) for v in values], "features array<double>").write.mode("append").parquet(src)

    def start(**more):
        stream = spark.readStream.schema("features array<double>").parquet(src)
        return jobs.cluster_stream(stream, centers, out, job, **more)
    send([0, 1, 2, 1, 1, 1, 9, 10, 11, 10])
    start()
    send([0, 1, 9, 9, 10])
    start()
    model = {r.cluster: r for r in jobs.ModelState(spark, job, centers).before(99).collect()}
    assert model[0].weight + model[1].weight == 2 + 15 and model[0].weight == 9.0
    assert spark.read.parquet(out).count() == 15
    send([100])
    start(learn=False)
    assert {r.cluster: r.weight for r in jobs.ModelState(spark, job, centers).before(99).collect()} == {0: 9.0, 1: 8.0}
    assert spark.read.parquet(out).count() == 16


def test_a_batch_again_adds_no_row(spark):
    path = scratch_path(spark, "again")
    sinks.create_table(spark, sinks.NB_RESULT_SCHEMA, path=path)
    batch = spark.createDataFrame([(0, 4), (4, 4)], sinks.NB_RESULT_SCHEMA)
    for name in ("j-0", "j-0", "j-1"):
        assert sinks.append(batch, path=path, batch=name)
    assert not sinks.append(batch.limit(0), path=path, batch="j-2")
    assert sinks.scan(spark, path=path).count() == 4
    out = scratch_path(spark, "again-out")
    for _ in range(2):
        jobs.write_batch(batch, out, "job", 0)
    assert spark.read.parquet(out).count() == 2


def test_stream_that_takes_too_long(spark):
    src, job = scratch_path(spark, "t-in"), scratch_path(spark, "t-job")
    spark.range(3).select(F.col("id").cast("string").alias("value")).write.text(src)

    def slow(batch, batch_id):
        import time
        time.sleep(20)
    with pytest.raises(TimeoutError):
        jobs.run(jobs.file_source(spark, src), slow, job, timeout_s=1)


def test_kafka_options():
    assert jobs.kafka_options("h:9092", "tweets") == {"kafka.bootstrap.servers": "h:9092", "topic": "tweets"}


def test_lexicon_file_keeps_quotes(spark):
    path = scratch_path(spark, "lex")
    spark.createDataFrame([('":)\tsmile "x"',), ("no separator",), ("a\tb\tc",)], "value string").coalesce(1).write.text(path)
    assert load_lexicon(spark, path) == [('":)', 'smile "x"'), ("a", "b\tc")]


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    from sentimill.session import shared_dir

    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(RuntimeError):
        shared_dir(SimpleNamespace(sparkContext=sc))


def test_large_lexicons_are_joined(spark, monkeypatch):
    path = scratch_path(spark, "lex")
    spark.range(1_000_000).selectExpr("concat('w', id, '\t', 'r', id) AS value").write.text(path)
    with pytest.raises(ValueError):
        load_lexicon(spark, path)
    with pytest.raises(ValueError):
        clean.load_stop_words(spark, path)
    none = spark.createDataFrame([], "token string, replacement string")
    df = spark.createDataFrame([(1, "w5 x w5 w999999  W7"), (1, "w5"), (None, ""), (3, None)], "id long, text string")
    got = clean.preprocess_by_tables(df, ["id"], "text", clean.lexicon_table(spark, path), none).collect()
    assert {(r.id, r.preprocessed) for r in got} == {(None, ""), (3, None), (1, "r5"), (1, "r5 x w5 r999999  w7")} and len(got) == 4
    upper = spark.createDataFrame([("W7", "b"), ("W7", "a")], "token string, replacement string").groupBy("token").agg(F.min("replacement").alias("replacement"))
    got = clean.preprocess_by_tables(df.limit(1), ["id"], "text", none, upper).first()
    assert got.preprocessed == "w5 x w5 w999999  a"


def test_rejected_lines_and_good_ones_are_all_lines(spark):
    path = scratch_path(spark, "rejects")
    lines = ['"4","1","d","q","s","he said ""hi"", ok"', '"4","2","d","q","s"', '"4","x","d","q","s","t"', '"","3","d","q","s","t"',
             '"4","4","d","q","s","open', "", '"4","5","d","q","s","t","more"', "4,6,d,q,s,plain", '"0","7","","","",""']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    good, rejected = tw.read_csv_checked(spark, path)
    assert {r.id: r.text for r in good.collect()} == {1: 'he said "hi", ok', 6: "plain", 7: ""}
    assert {r.record: r.reason for r in rejected.collect()} == {
        lines[1]: "fields", lines[2]: "cast", lines[3]: "cast", lines[4]: "quote", lines[5]: "fields", lines[6]: "fields"}


def test_fitted_pipeline_on_a_stream_restarts(spark):
    from sentimill.operators import naive_bayes as nb

    data = spark.createDataFrame([(["good"], 10), (["good", "fun"], 10), (["bad"], 7), (["sad", "bad"], 7), (["ok"], 300)],
                                 "terms array<string>, code int")
    classes = nb.label_indexer(data, "code")
    for hashing in ("murmur3", "md5"):
        model = nb.ml_pipeline(64, classes.labels, hashing=hashing).fit(classes.transform(data))
        assert [int(r.predicted) for r in model.transform(data).collect()] == [10, 10, 7, 7, 300]
    src, out, job = (scratch_path(spark, n) for n in ("p-in", "p-out", "p-job"))
    for rows in ([(1, ["good"]), (1, ["good"]), (None, [])], [(4, ["bad"])]):
        spark.createDataFrame(rows, "id long, terms array<string>").write.mode("append").parquet(src)
        for _ in range(2):  # the second start finds nothing new
            jobs.transform_stream(spark.readStream.schema("id long, terms array<string>").parquet(src), model, out, job, ["id", "predicted"])
    got = sorted((r.id or 0, r.predicted) for r in spark.read.parquet(out).collect())
    assert [g[0] for g in got] == [0, 1, 1, 4] and got[1:] == [(1, "10"), (1, "10"), (4, "7")]


def test_sample_takes_rows_without_a_key(spark):
    from sentimill.operators import sampling

    df = spark.range(3000).selectExpr("if(id % 3 = 0, null, id) AS id", "string(id) AS text")
    parts = df.select(sampling.in_sample(F.col("id"), 70).alias("a"), sampling.in_sample(F.col("id"), 70, 0, F.col("text")).alias("b"),
                      sampling.replay_key(F.col("id")).alias("k"))
    assert parts.where("a is null or b is null or k is null").count() == 0
    n = df.where(sampling.in_sample(F.col("id"), 70, 0, F.col("text"))).count()
    assert abs(n - 2100) < 3 * 25.1


def test_scratch_is_removed(spark):
    from sentimill.session import Scratch, materialize

    with Scratch(spark):
        t = materialize(spark.range(5), "short")
        path = t.inputFiles()[0].rsplit("/", 1)[0]
        assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(path)
