"""Cleaning chain goldens, lexicon semantics, entity and case traps, Porter pairs."""

from pyspark.sql import functions as F

from sentimill.functions import text as tx
from sentimill.functions.lexicons import DEFAULT_STOP_WORDS
from sentimill.operators.clean import CleanOptions, clean_stages, clean_tweets

STOP = tuple(DEFAULT_STOP_WORDS) + ("x", "so")

# hand-derived goldens: tokens after stop-word removal (before stemming)
GOLDENS = [
    ("Looooove it :) LOL &lt;3 http://t.co/ab @joe_x 100% sooo", "loove smile laugh loud heart soo"),
    ("so so good", "shout good"),
    ("good\nday www.x.com", "goodday wwxcom"),
    (":-P 12", "playful"),
    ("", ""),
]


def _run(spark, texts, upto="stopped", opts=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    out = clean_stages(df, "text", opts or CleanOptions(stop_words=STOP), upto=upto)
    return [r[upto] for r in out.orderBy("id").collect()]


def test_goldens(spark):
    got = _run(spark, [g[0] for g in GOLDENS])
    assert [" ".join(t) for t in got] == [g[1] for g in GOLDENS]
    assert got[-1] == [""]  # an empty text keeps one empty token


def test_first_occurrence_only(spark):
    got = _run(spark, [":) x :)", "QQ QQ qq"], upto="emoticons")
    assert got[0] == ["smile", "x", ":)"]
    assert got[1] == ["sad", "QQ", "qq"]
    pre = _run(spark, ["QQ QQ qq"], upto="preprocessed")
    assert pre[0] == "sad quick question qq"


def test_unescape(spark):
    df = spark.createDataFrame(
        [("&lt;3",), ("&amp;lt;",), ("&#8364;",), ("&#x41;",), ("&foo;",), ("&amp",), ("a&nbsp;b",),
         ("&#xZZ;",), ("&#99999999;",), ("&AMP;",), ("&#x0000000041;",), ("&#" + "0" * 40 + "66;",), ("&#0;",)], "t string")
    got = [r[0] for r in df.select(tx.html_unescape(F.col("t"))).collect()]
    assert got == ["<3", "&lt;", "€", "A", "&foo;", "&amp", "a b", "&#xZZ;", "&#99999999;", "&AMP;", "A", "B", "\ufffd"]


def test_ascii_case_only(spark):
    got = _run(spark, ["Straße İx Kelvin"], upto="tokenized")
    assert got == ["strae x elvin"]


def test_long_tokens_are_not_upper_cased_before_acronyms(spark):
    text = "QQ ttyl ÉTTYL lolß \u212aQQ aVeryLongWord Straße LOL lol"
    df = spark.createDataFrame([(text,)], "t string")
    old = F.array_join(tx.replace_first(F.transform(F.split("t", " "), lambda x: F.translate(x, tx.LOWER, tx.UPPER)), tx.ACRONYMS), " ")
    r = df.select(F.translate(old, tx.UPPER, tx.LOWER).alias("old"), tx.acronym_expand(F.split("t", " ")).alias("new")).first()
    assert r.old == r.new


def test_squeeze_and_dedupe(spark):
    got = _run(spark, ["aaaa bbb aa aaaa ddd"], upto="deduped")
    assert got == [["aa", "bb", "dd"]]


def test_terms_have_only_letters(spark):
    texts = ["Hello W0rld!! http://x.y/z #tag @user café don't", "  \t  ", "ééé"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    out = clean_tweets(df, ["id"], opts=CleanOptions(stop_words=STOP))
    for r in out.collect():
        assert all(t == "" or t.isalpha() and t.isascii() and t.islower() for t in r.terms)


PORTER = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "caress": "caress", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor",
    "sing": "sing", "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail",
    "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "rational": "ration", "valenci": "valenc", "hesitanci": "hesit", "digitizer": "digit",
    "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile",
    "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
    "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous",
    "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electriciti": "electr", "electrical": "electr",
    "hopeful": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust",
    "defensible": "defens", "irritant": "irrit", "replacement": "replac", "adjustment": "adjust",
    "dependent": "depend", "adoption": "adopt", "homologou": "homolog", "communism": "commun",
    "activate": "activ", "angulariti": "angular", "homologous": "homolog", "effective": "effect",
    "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controll": "control", "roll": "roll", "generalizations": "gener", "oscillators": "oscil",
    "dying": "die", "dies": "die", "spied": "spi", "died": "die", "enjoy": "enjoy", "try": "tri",
    "conditionally": "condit", "emotionally": "emot", "traditionally": "tradit", "rationally": "ration",
    "radically": "radic", "say": "say", "syyyyy": "syyyyi", "ayyyyed": "ayyyi",
    "flies": "fli", "skies": "sky", "news": "news", "at": "at", "": "",
}


def test_porter_pairs(spark):
    df = spark.createDataFrame([(w,) for w in PORTER], "w string")
    got = {r.w: r.s for r in tx.with_stem(df, "w", "s").collect()}
    assert {w: got[w] for w in PORTER if got[w] != PORTER[w]} == {}


def test_porter_sql_dialects_agree(spark):
    import duckdb

    from sentimill.functions.porter import stem_sql
    from sentimill.functions.sqlgen import DUCKDB

    con = duckdb.connect()
    rows = con.execute(f"SELECT w, {stem_sql(DUCKDB, 'w')} FROM unnest(?) t(w)", [list(PORTER)]).fetchall()
    assert {w: s for w, s in rows if s != PORTER[w]} == {}


def test_a_filter_on_stemmed_terms_is_planned(spark):
    import time

    from sentimill.operators.clean import StemDictionary, clean_stages, exploded_terms

    df = spark.createDataFrame([(1, "running runs :) ran"), (2, "")], "id long, text string")
    t = clean_stages(df, "text", CleanOptions(stop_words=[]))
    start = time.time()
    terms = exploded_terms(t, ["id"])
    begun = time.time()
    kept = terms.where("term <> '' and term like 'run%'")
    kept._jdf.queryExecution().executedPlan()
    assert time.time() - begun < 5 and start
    assert sorted(r.term for r in kept.collect()) == ["run", "run"]
    # words that a dictionary has are not stemmed again, and it outlives the job that began it
    first = StemDictionary(spark)
    first.add(df.selectExpr("explode(split('running cats running', ' ')) AS w"), "w")
    again = StemDictionary(spark, first.path)
    got = again.add(df.selectExpr("explode(split('cats ponies', ' ')) AS w"), "w")
    assert sorted(tuple(r) for r in got.collect()) == [("cats", "cat"), ("ponies", "poni"), ("running", "run")]
    assert spark.read.parquet(first.path).count() == 3


def test_list_stemmer_is_the_sql_stemmer(spark):
    import random

    from sentimill.functions.porter import IRREGULAR_FORMS, word_stemmer

    r = random.Random(1)
    ends = ["", "ational", "alli", "bli", "logi", "ization", "fulness", "ement", "sion", "eed", "ied", "ing", "ed", "sses", "ies", "y", "ll"]
    words = [*PORTER, *dict(IRREGULAR_FORMS), "yéed", "Kyyying", "a1yed", "__ing",
             *("".join(r.choices("abcdeyilosztx", k=r.randint(0, 6))) + r.choice(ends) + r.choice(ends) for _ in range(500))]
    stem = word_stemmer()
    df = spark.createDataFrame([(w,) for w in dict.fromkeys(words)], "w string")
    assert [(x.w, x.s) for x in tx.with_stem(df, "w", "s").collect() if stem(x.w) != x.s] == []
    lists = [["running", None, "ponies", "running"], [], None, [""]]
    got = spark.createDataFrame([(i, w) for i, w in enumerate(lists)], "i int, w array<string>").select("i", tx.stem_each(F.col("w")).alias("s"))
    assert [x.s for x in got.orderBy("i").collect()] == [["run", None, "poni", "run"], [], None, [""]]


def test_java_noise_classes_delete_the_same(spark):
    import random

    r = random.Random(2)
    bits = ["a", "Bc", "9", "_", "@", "://", ":", "/", " ", "\t", "\n", "é", "\u212a", "\U0001f600", "http://x.y/z", "@joe_x", "\u00a0", "!"]
    texts = ["".join(r.choices(bits, k=r.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    old, new = (F.regexp_replace("t", p, "") for p in (tx.NOISE_RE, tx.JAVA_NOISE_RE))
    plain_old, plain_new = (F.regexp_replace("t", p, "") for p in (tx.NOISE_NO_URL_RE, tx.JAVA_NOISE_NO_URL_RE))
    differ = (old != new) | (plain_old != plain_new)
    assert df.where(differ).collect() == []


def test_terms_are_stemmed_in_their_rows(spark):
    # no table of all words of the corpus is written, joined or gathered by row
    docs = spark.createDataFrame([(1, "running runs :) ran"), (1, ""), (None, "ponies"), (2, None)], "id long, text string")
    terms = clean_tweets(docs, ["id"], opts=CleanOptions(stop_words=[]))
    plan = terms._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert sorted((r.id or 0, r.terms) for r in terms.collect()) == [(0, ["poni"]), (1, [""]), (1, ["run", "run", "smile", "ran"]), (2, [])]
