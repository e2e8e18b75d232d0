"""Tweet datasets: mapping from the driver tables, raw-line files, CSV files.

A tweet row is ``(polarity int, id bigint, date string, query string, sender string,
text string)``. Polarity uses the codes 0 (negative), 2 (neutral/unlabelled), 4 (positive).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import table

TWEET_SCHEMA = T.StructType([
    T.StructField("polarity", T.IntegerType()),
    T.StructField("id", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("sender", T.StringType()),
    T.StructField("text", T.StringType()),
])

# Schema of a raw tweet as read from a file: every field a string.
RAW_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in TWEET_SCHEMA])

# Markup appended to document texts so that the entity, emoticon, acronym, URL and
# @name rules are exercised (the generated documents contain none of these). The
# suffix is chosen by ``doc_id % 5``; the oracle uses the same list.
MARKUP_SUFFIXES = [
    " Looooove it :) LOL &lt;3 http://t.co/ab @joe_x 100% sooo",
    " so so good :-P 12 :) :)",
    " QQ qq xD XD lol &amp;lt; &#8364; &#x41;BC &nbsp;x",
    " www.x.com :( BRB TTYL <3 &foo; &amp",
    "",
]


def polarity_from_labels(quality: Column) -> Column:
    """quality 1 -> 4 (positive), 0 -> 0 (negative), no label -> 2."""
    return (F.when(quality == 1, 4).when(quality == 0, 0).otherwise(2)).cast("int")


def markup_suffix(doc_id: Column) -> Column:
    arr = F.array(*[F.lit(s) for s in MARKUP_SUFFIXES])
    return F.element_at(arr, (F.pmod(doc_id, F.lit(len(MARKUP_SUFFIXES))) + 1).cast("int"))


def tweet_date(doc_id: Column) -> Column:
    return F.concat(F.lit("2009-04-"), F.lpad((F.pmod(doc_id, F.lit(28)) + 1).cast("string"), 2, "0"))


def documents_as_tweets(spark: SparkSession, sf_dir: str, markup: bool = False) -> DataFrame:
    """``documents`` viewed as unlabelled tweets (polarity added by ``with_polarity``)."""
    d = table(spark, sf_dir, "documents")
    text = F.concat(F.col("text"), markup_suffix(F.col("doc_id"))) if markup else F.col("text")
    return d.select(F.col("doc_id").alias("id"), tweet_date(F.col("doc_id")).alias("date"),
                    F.col("lang").alias("query"), F.col("source").alias("sender"),
                    text.alias("text"))


def with_polarity(spark: SparkSession, sf_dir: str, df: DataFrame, id_col: str = "id") -> DataFrame:
    """Attach polarity from ``labels`` (left join on the document id).

    Join this *after* the text has been reduced to tokens so that the shuffle, if the
    labels are too large to broadcast, moves tokens rather than raw text. Whether to
    broadcast is decided by Catalyst / AQE from the measured size of ``labels``.
    """
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias(id_col), "quality")
    return (df.join(lab, id_col, "left")
              .withColumn("polarity", polarity_from_labels(F.col("quality")))
              .drop("quality"))


def tweets(spark: SparkSession, sf_dir: str, markup: bool = False) -> DataFrame:
    t = with_polarity(spark, sf_dir, documents_as_tweets(spark, sf_dir, markup))
    return t.select(*[f.name for f in TWEET_SCHEMA])


# ------------------------------------------------------------------ raw line files

def to_raw_line(df: DataFrame) -> DataFrame:
    """One ``"f1","f2",...,"f6"`` line per tweet (line breaks in the text become spaces)."""
    fields = [F.col(c).cast("string") for c in ("polarity", "id", "date", "query", "sender")]
    text = F.regexp_replace(F.col("text"), "[\r\n]", " ")
    body = F.concat_ws('","', *[F.coalesce(f, F.lit("")) for f in fields + [text]])
    return df.select(F.concat(F.lit('"'), body, F.lit('"')).alias("value"))


def parse_raw_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Naive line parser: drop ``'``, split on ``",``, drop ``"`` from every field.

    A text holding ``",`` is cut there (as in the original training job). Rows with
    fewer than six fields get NULLs; ``n_fields`` tells them apart.
    """
    parts = F.split(F.translate(F.col(value_col), "'", ""), '",', -1)
    clean = F.transform(parts, lambda f: F.translate(f, '"', ""))
    a = lines.select(clean.alias("f"))
    pick = [F.try_element_at(F.col("f"), F.lit(i + 1)) for i in range(6)]
    return a.select(
        pick[0].alias("polarity"),
        pick[1].try_cast("bigint").alias("id"),
        pick[2].alias("date"), pick[3].alias("query"), pick[4].alias("sender"),
        pick[5].alias("text"),
        F.size("f").alias("n_fields"))


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text-line scan (one tweet per line), parsed naively."""
    return parse_raw_lines(spark.read.text(path))


# ------------------------------------------------------------------ CSV files

# a record on one line: codes of backslash, line feed and carriage return
_CODES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))


def write_csv(df: DataFrame, path: str, one_line: bool = False) -> None:
    """Quoted CSV. With ``one_line`` line breaks in fields are written as ``\\n`` and ``\\r`` (and
    a backslash as ``\\b``), so that large files can be split where they are read."""
    def field(name: str) -> Column:
        c = F.col(name).cast("string")
        for mark, code in _CODES if one_line else ():
            c = F.replace(c, F.lit(mark), F.lit(code))
        return c.alias(name)

    (df.select([field(f.name) for f in RAW_SCHEMA])
       .write.mode("errorifexists").option("quoteAll", True).option("escape", '"').csv(path))


def read_csv(spark: SparkSession, path: str, multi_line: bool = False, one_line: bool = False) -> DataFrame:
    """Quote-aware CSV scan (``,`` separator, ``"`` quote, doubled quote escape).

    The scan is split by byte ranges, with one record per line; ``one_line`` turns the codes
    of ``write_csv`` back into line breaks. ``multi_line`` reads line breaks inside quoted
    texts as they are; such files are read one task per file, so large inputs should come as
    many files, or with ``one_line``.
    """
    raw = (spark.read.schema(RAW_SCHEMA).option("quote", '"').option("escape", '"')
           .option("multiLine", multi_line).option("mode", "PERMISSIVE")
           # CSV has no NULL: an empty field is an empty string, as in Python's csv module
           .option("nullValue", "\u0000\u0001").csv(path))
    if one_line:
        for mark, code in reversed(_CODES):
            raw = raw.select(*[F.replace(F.col(f.name), F.lit(code), F.lit(mark)).alias(f.name) for f in RAW_SCHEMA])
    return raw.select(F.col("polarity").try_cast("int").alias("polarity"),
                      F.col("id").try_cast("bigint").alias("id"),
                      "date", "query", "sender", "text")


def read_csv_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): a CSV scan, one record per line, that loses no line.

    ``good`` has the columns of ``read_csv``; ``rejected`` has ``reason`` and the line itself
    as ``record``. Reasons, the first that holds: ``quote`` (an open quote), ``fields`` (not
    six of them), ``cast`` (polarity or id is not a number). The scan is split by byte ranges;
    both parts are filters of it.
    """
    schema = ", ".join(f"{f.name} string" for f in RAW_SCHEMA) + ", _bad string"
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "nullValue": "\u0000\u0001"}
    t = spark.read.text(path).select("value", F.from_csv("value", schema, options).alias("r"))
    polarity, ident = F.col("r.polarity").try_cast("int"), F.col("r.id").try_cast("bigint")
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    empty = F.trim("value") == ""
    reason = (F.when(quotes % 2 == 1, "quote").when(empty | F.col("r").isNull() | F.col("r._bad").isNotNull(), "fields")
              .when(polarity.isNull() | ident.isNull(), "cast"))
    t = t.select("value", reason.alias("reason"), polarity.alias("polarity"), ident.alias("id"),
                 *[F.col(f"r.{c}").alias(c) for c in ("date", "query", "sender", "text")])
    good = t.where("reason is null").select("polarity", "id", "date", "query", "sender", "text")
    return good, t.where("reason is not null").select("reason", F.col("value").alias("record"))
