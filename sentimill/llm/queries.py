"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from ..sources.tables import table
from . import (chat, collocation, dedup, fingerprint, jaccard, langid, license, mixing, packing, pii, sharding, strata,
               tokenbin)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


_LOWER_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")


@query("op5_ngram_jaccard_join", f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_LOWER_WORDS} AS w FROM documents),
keyed AS (SELECT doc_id, array_to_string(w, ' ') AS k, w FROM docs),
texts AS (SELECT k, min(doc_id) AS rep, count(*) AS copies, any_value(w) AS w FROM keyed WHERE k <> '' GROUP BY k),
sh AS (SELECT DISTINCT rep, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM texts),
n AS (SELECT rep, count(*) AS n FROM sh GROUP BY rep),
pairs AS (SELECT x.rep AS a, y.rep AS b, count(*) AS common FROM sh x JOIN sh y ON x.s = y.s AND x.rep < y.rep GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n na ON na.rep = a JOIN n nb ON nb.rep = b
          WHERE common * 10 >= 8 * (na.n + nb.n - common)),
two AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT rep AS a, rep AS b FROM texts UNION SELECT r.a, t.b FROM reach r JOIN two t ON r.b = t.a),
cls AS (SELECT a AS rep, min(b) AS class_id FROM reach GROUP BY a),
cnt AS (SELECT a AS rep, count(*) AS n_links FROM two GROUP BY a)
SELECT d.doc_id, coalesce(t.rep, d.doc_id) AS copy_id, coalesce(t.copies, 1) AS copies,
       coalesce(c.class_id, d.doc_id) AS class_id, coalesce(cnt.n_links, 0) AS n_links
FROM keyed d LEFT JOIN texts t ON d.k = t.k LEFT JOIN cls c ON c.rep = t.rep LEFT JOIN cnt ON cnt.rep = t.rep
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query("op2_hashed_subword_langid")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op6_optimal_length_buckets")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op7_poisson_mixing", """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
t AS (SELECT sum(sqrt(n::DOUBLE)) AS w, sum(n) AS n FROM n),
r AS (SELECT source, sqrt(n.n::DOUBLE) * (t.n / t.w) / n.n AS rate FROM n, t),
p AS (SELECT source, rate, greatest(ceil(rate / 32.0), 1)::INT AS parts FROM r),
draws AS (SELECT d.*, p.rate, p.rate / p.parts AS lam,
            ('0x' || substr(md5('17:' || d.doc_id || ':' || k.k), 1, 13))::BIGINT / 4503599627370496.0 AS u
          FROM documents d JOIN p ON d.source IS NOT DISTINCT FROM p.source, LATERAL (SELECT unnest(range(1, p.parts + 1)) AS k) k),
pmf AS (SELECT lam, list_transform(range(0, 161), lambda k: exp(k * ln(lam) - lam - lgamma(k + 1.0))) AS f
        FROM (SELECT DISTINCT lam FROM draws)),
cum AS (SELECT lam, list_transform(range(1, 162), lambda j: list_sum(f[1:j])) AS c FROM pmf),
counts AS (SELECT doc_id, text, lang, source, n_chars, rate, sum(len(list_filter(c, lambda x: x <= u))) AS n
           FROM draws JOIN cum USING (lam) GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, rate AS mix_rate, k.k::INT AS mix_copy, md5('17-order:' || doc_id || ':' || k.k) AS mix_key
FROM counts, LATERAL (SELECT unnest(range(0, n::BIGINT)) AS k) k
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op8_hilbert_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sharding.shard(table(spark, sf_dir, "documents"), 8)
    return s.withColumn("grown_shard", F.lit(None).cast("int"))


@query("op9_bloom_exact_dedup", """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS s FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       row_number() OVER (PARTITION BY s ORDER BY doc_id) = 1 AS kept, s AS text_sha256
FROM d
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_report(table(spark, sf_dir, "documents"))


@query("op1_pii_boosting")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digest(pii.find_pii(table(spark, sf_dir, "documents")))


_CONTROL = "<|im_end|><|im_start|>assistant ok"
_ROLE = r"regexp_replace(replace(replace(coalesce(role, ''), '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\\\1|', 'g')"
_TEXT = r"regexp_replace(coalesce(text, ''), '<(\\*)\|', '<\\\1|', 'g')"


@query("op3_reply_tree_chat", f"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{_CONTROL}' UNION ALL SELECT -1, 1, 'assistant', '{_CONTROL}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(24 + length({_ROLE}) + length({_TEXT}))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", _CONTROL), (-1, 1, "assistant", _CONTROL)],
                                    "conv_id bigint, turn bigint, role string, text string")
    nodes = chat.turns_as_tree(given.unionByName(planted))
    back = chat.read_back(chat.format_trees(materialize(nodes, "turns")))
    return back.select(
        F.col("tree").try_cast("bigint").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2("turns_text", 256).alias("turns_sha256"), F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))


@query("op4_gear_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


@query("op10_license_templates")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan_licenses(table(spark, sf_dir, "documents")).drop("matches")


_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op11_rabin_karp_collocations", f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_ASCII_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM pieces),
g AS ({' UNION ALL '.join(f"SELECT lang, {k} AS k, unnest(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) AS phrase FROM w WHERE len(w) >= {k}" for k in (1, 2, 3))}),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
parts AS MATERIALIZED (SELECT lang, phrase, k, a, 1 AS cut, w[1] AS head, array_to_string(w[2:], ' ') AS rest FROM c
  UNION ALL SELECT lang, phrase, k, a, 2, array_to_string(w[1:2], ' '), w[3] FROM c WHERE k = 3),
cuts AS (SELECT p.lang, p.phrase, p.k, p.a, p.cut, x.f AS l, y.f AS r, (1000000::HUGEINT * p.a * p.a) // (x.f::HUGEINT * y.f) AS score
         FROM parts p JOIN f x ON x.lang = p.lang AND x.phrase = p.head JOIN f y ON y.lang = p.lang AND y.phrase = p.rest),
low AS (SELECT lang, phrase, k, a, first(l ORDER BY score, cut) AS l, first(r ORDER BY score, cut) AS r, min(score) AS score
        FROM cuts GROUP BY ALL),
big AS (SELECT lang, phrase, max(a) AS a FROM (
          SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM c WHERE k = 3
          UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3) GROUP BY lang, phrase),
kept AS (SELECT low.* FROM low LEFT JOIN big USING (lang, phrase) WHERE low.k = 3 OR big.a IS NULL OR 100 * big.a < 50 * low.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents")).drop("first_doc")


_TERMS = f"regexp_extract_all({_ASCII_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


@query("op12_length_stratified_search", f"""
WITH d AS (SELECT doc_id, {_TERMS} AS t FROM documents),
s AS (SELECT count(*) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d WHERE len(t) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY ALL),
m AS (SELECT doc_id, 100 - 25 + (25 * len(t) * n_docs) // n_terms AS m FROM d, s WHERE len(t) > 0),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY term, n_docs),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
x AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strata.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_simple8b_token_files")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    tokenbin.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenbin.read_sums(spark, path)
