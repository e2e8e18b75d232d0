"""The tweet cleaning chain over a DataFrame.

Every stage up to the stop words is a native column expression evaluated row by row in the
executors: no shuffle, no Python worker and nothing collected to the driver, so it scales
with the number of input partitions. Intermediate stages are exposed as columns so that
each one can be inspected or reused on its own. Token lists are stemmed in their rows by an
Arrow UDF; ``StemDictionary`` keeps stems as a table in which each distinct word is stemmed once.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.lexicons import ACRONYMS, DEFAULT_STOP_WORDS, EMOTICONS
from ..session import materialize, scratch_path

BROADCAST_WORDS = 500_000  # rows of a table of words that are broadcast (some 40 MB)
LITERAL_WORDS = 50_000     # entries of a list that may become a constant of the plan


@dataclass(frozen=True)
class CleanOptions:
    emoticons: Sequence[tuple[str, str]] = tuple(EMOTICONS)
    acronyms: Sequence[tuple[str, str]] = tuple(ACRONYMS)
    stop_words: Sequence[str] = tuple(DEFAULT_STOP_WORDS)
    entities: Sequence[tuple[str, str]] | None = None
    strip_apostrophes: bool = False  # the training path of the original drops ' first
    drop_empty: bool = False  # an empty text keeps its single empty token by default
    stem: bool = True


STAGES = ("unescaped", "emoticons", "preprocessed", "tokenized", "squeezed", "deduped",
          "stopped")


def load_stop_words(spark, path: str) -> list[str]:
    """Stop-word list from a one-word-per-line text file, as one hash set for the filter.

    For lists of more than ``LITERAL_WORDS`` (an error here) use ``stop_word_table`` with
    ``drop_stop_terms``, which join instead.
    """
    return [r.word for r in _few(stop_word_table(spark, path), path)]


def _few(table: DataFrame, path: str) -> list:
    rows = table.limit(LITERAL_WORDS + 1).collect()
    if len(rows) > LITERAL_WORDS:
        raise ValueError(f"{path} has more than {LITERAL_WORDS} entries: join it as a table")
    return rows


def stop_word_table(spark, path: str) -> DataFrame:
    """(word) of a one-word-per-line text file, of any size."""
    return spark.read.text(path).select(F.trim("value").alias("word")).where("word <> ''").distinct()


def drop_stop_terms(terms: DataFrame, stop_words: DataFrame, term_col: str = "term") -> DataFrame:
    """Rows of exploded terms that are not in a stop-word table (anti-join, any list size)."""
    return terms.join(stop_words.select(F.col("word").alias("_stop")), F.col(term_col) == F.col("_stop"), "left_anti")


def _lexicon_lines(spark, path: str, sep: str) -> DataFrame:
    parts = F.split("value", f"\\Q{sep}\\E", 2)
    return spark.read.text(path).where(F.instr("value", sep) > 0).select(parts[0].alias("token"), parts[1].alias("replacement"))


def load_lexicon(spark, path: str, sep: str = "\t") -> list[tuple[str, str]]:
    """``token<sep>replacement`` lines, quotes taken literally; one literal map of the chain.

    For more than ``LITERAL_WORDS`` entries (an error here) use ``lexicon_table``.
    """
    return [(r.token, r.replacement) for r in _few(_lexicon_lines(spark, path, sep), path)]


def lexicon_table(spark, path: str, sep: str = "\t") -> DataFrame:
    """(token, replacement) of ``token<sep>replacement`` lines, of any number; of a token that
    occurs twice, the smallest replacement."""
    return _lexicon_lines(spark, path, sep).groupBy("token").agg(F.min("replacement").alias("replacement"))


def replace_first_by_table(df: DataFrame, tokens_col: str, lexicon: DataFrame, out_col: str) -> DataFrame:
    """``df`` plus ``out_col``: its tokens with the first occurrence of each lexicon key replaced.

    ``df`` has ``_row`` (see ``with_row_key``), is read twice and so should be a written table.
    The exploded tokens are joined with the lexicon (broadcast or not, as its size says), and
    only those that hit go on: the first position of each (row, token), gathered by row.
    """
    ex = df.select("_row", tx.explode_tokens(F.col(tokens_col), "_pos", "_tok"))
    hit = ex.join(lexicon.select(F.col("token").alias("_key"), F.col("replacement").alias("_new")), F.col("_tok") == F.col("_key"))
    first = hit.groupBy("_row", "_tok").agg(F.min("_pos").alias("_pos"), F.min("_new").alias("_new"))
    at = first.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_pos", "_new"))).alias("_at"))
    new = F.transform(tokens_col, lambda t, i: F.coalesce(F.col("_at")[i], t))
    return df.join(at, "_row", "left").withColumn(out_col, new).drop("_at")


def preprocess_by_tables(df: DataFrame, keys: Sequence[str], text_col: str, emoticons: DataFrame, acronyms: DataFrame,
                         opts: CleanOptions = CleanOptions()) -> DataFrame:
    """``keys`` and ``preprocessed``: the chain up to acronyms (C1-C6) with lexicons of any size,
    given as (token, replacement) tables."""
    t = clean_stages(with_row_key(df.select(*keys, text_col)), text_col, opts, upto="unescaped")
    t = materialize(t.select("_row", *keys, tx.split_space(F.col("unescaped")).alias("_tokens")), "lexicon-tokens")
    t = replace_first_by_table(t, "_tokens", emoticons, "_emoticons")
    t = materialize(t.select("_row", *keys, F.transform("_emoticons", tx.ascii_upper).alias("_upper")), "lexicon-upper")
    t = replace_first_by_table(t, "_upper", acronyms, "_acronyms")
    return t.select(*keys, tx.ascii_lower_text(F.array_join("_acronyms", " ")).alias("preprocessed"))


def clean_stages(df: DataFrame, text_col: str = "text", opts: CleanOptions = CleanOptions(),
                 upto: str = "stopped") -> DataFrame:
    """Add the stage columns of the chain, up to and including ``upto``."""
    last = STAGES.index(upto)
    text = F.col(text_col)
    if opts.strip_apostrophes:
        text = F.translate(text, "'", "")
    t = df.withColumn("unescaped", tx.html_unescape(text, opts.entities))
    if last >= 1:
        t = t.withColumn("emoticons", tx.replace_first(tx.split_space(F.col("unescaped")),
                                                       opts.emoticons))
    if last >= 2:
        t = t.withColumn("_expanded", tx.expand_acronyms(F.col("emoticons"), opts.acronyms))
        t = t.withColumn("preprocessed", tx.ascii_lower_text(F.col("_expanded")))
    if last >= 3:
        # lower-cases what it leaves, so the lower-cased text is not made for it
        t = t.withColumn("tokenized", tx.tokenize(F.col("_expanded")))
    if last >= 4:
        t = t.withColumn("squeezed", tx.squeeze_repeats(F.col("tokenized")))
    if last >= 5:
        t = t.withColumn("deduped", F.array_distinct(tx.split_space(F.col("squeezed"))))
    if last >= 6:
        t = t.withColumn("stopped", tx.remove_stop_words(F.col("deduped"), opts.stop_words))
    return t.drop("_expanded")


class StemDictionary:
    """Stems of all words met so far: a table (word, stem) in the shared folder.

    ``add`` stems the distinct words that the table does not have yet and appends them, so a
    word is stemmed once, however often it occurs, and over all batches that share the
    dictionary. Being read from files, the stem is a plain column for the optimizer: a filter
    or join on stemmed terms is planned like any other and never reaches into the stemmer.
    With ``path`` the table outlives the job. One job at a time may add words.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "stems")
        self.parts = 0 if path is None else len(self._known_parts())

    def _known_parts(self) -> list:
        try:
            return self.spark.read.parquet(self.path).select("part").distinct().collect()
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return []

    def table(self) -> DataFrame:
        t = self.spark.read.parquet(self.path).select("word", "stem")
        # a word may stand in two parts if a job ended between writing and reading
        return t if self.parts < 2 else t.dropDuplicates(["word"])

    def add(self, words: DataFrame, word_col: str) -> DataFrame:
        """The table, with all words of the column in it. ``words`` is read once."""
        new = words.select(F.col(word_col).alias("word")).where("word is not null").distinct()
        if self.parts:
            new = new.join(self.table().select("word"), "word", "left_anti")
        # written before it is stemmed: nothing but the scan lies below the stemmer
        new = materialize(new, "new-words")
        n = new.count()
        if self.parts == 0 or n:
            # a small file is one split, but stemming is bound by CPU: spread it
            tasks = min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), n // 2000 + 1)
            tx.with_stem(new.repartition(tasks), "word", "stem").write.parquet(f"{self.path}/part={uuid.uuid4().hex}")
            self.parts += 1
        return self.table()


def join_stems(tokens: DataFrame, tok_col: str, out_col: str, dictionary: StemDictionary) -> DataFrame:
    """``tokens`` plus ``out_col``, the stem of ``tok_col``; ``tokens`` is read twice.

    The dictionary is broadcast up to ``BROADCAST_WORDS`` counted rows; a larger one is
    joined as adaptive execution sees fit, which splits frequent words.
    """
    stems = dictionary.add(tokens, tok_col).select(F.col("word").alias("_word"), F.col("stem").alias(out_col))
    side = F.broadcast(stems) if stems.count() <= BROADCAST_WORDS else stems
    return tokens.join(side, F.col(tok_col) == F.col("_word"), "left").drop("_word")


def stem_token_lists(df: DataFrame, keys: Sequence[str], tokens_col: str = "stopped",
                     out_col: str = "terms", drop_empty: bool = False) -> DataFrame:
    """Stem every token of ``tokens_col``; one output row per row of ``df``, in place: no row is
    cut up or gathered, so those with equal or missing ``keys`` stay apart. A missing list
    (of a null text) becomes an empty one."""
    t = df.select(*keys, F.coalesce(tx.stem_each(F.col(tokens_col)), F.array().cast("array<string>")).alias(out_col))
    return t.withColumn(out_col, F.filter(out_col, lambda x: x != "")) if drop_empty else t


def partition_by(df: DataFrame, key: str) -> DataFrame:
    """``df`` partitioned by ``key``, before texts are cleaned.

    This is the only exchange of the chain: it moves the texts, which are smaller than
    their exploded tokens, and aggregates by the key that follow add none. The number is
    fixed to ``spark.sql.shuffle.partitions``: cleaning is bound by CPU, so partitions are
    not merged by their size.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def with_row_key(df: DataFrame) -> DataFrame:
    """Adds ``_row``, unique for each row, and partitions by it."""
    return partition_by(df.withColumn("_row", F.monotonically_increasing_id()), "_row")


def exploded_terms(df: DataFrame, keys: Sequence[str], tokens_col: str = "stopped",
                   term_col: str = "term", stem: bool = True, outer: bool = False,
                   dictionary: StemDictionary | None = None) -> DataFrame:
    """One row per (keys, position, stemmed term): the input of term counting.

    With ``outer`` a row without tokens gives one row with a null term. The lists are stemmed
    in their rows, before they are exploded. With ``dictionary`` they are written once and
    joined with it instead.
    """
    def exploded(lists: DataFrame, name: str) -> DataFrame:
        return lists.select(*keys, tx.explode_tokens(F.col(tokens_col), "pos", name, outer=outer))

    if not stem:
        return exploded(df, term_col)
    if dictionary is None:
        return exploded(df.select(*keys, tx.stem_each(F.col(tokens_col)).alias(tokens_col)), term_col)
    ex = exploded(materialize(df.select(*keys, tokens_col), "tokens"), "_tok")
    return join_stems(ex, "_tok", term_col, dictionary).drop("_tok")


def clean_tweets(df: DataFrame, keys: Sequence[str], text_col: str = "text",
                 out_col: str = "terms", opts: CleanOptions = CleanOptions()) -> DataFrame:
    """``keys`` plus ``out_col``: the cleaned, de-duplicated, stop-filtered, stemmed terms."""
    t = clean_stages(with_row_key(df.select(*keys, text_col)), text_col, opts, upto="stopped")
    if not opts.stem:
        return t.select(*keys, F.col("stopped").alias(out_col))
    return stem_token_lists(t, keys, "stopped", out_col, opts.drop_empty)
