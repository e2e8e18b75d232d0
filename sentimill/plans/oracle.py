"""DuckDB statements equal in meaning to each registered query (correctness oracle)."""

from __future__ import annotations

import numpy as np

from .oracle_text import chain_ctes, docs_source, plain_stem_ctes, stemmed_ctes, unescape_sql

ORACLE: dict[str, str] = {}

NB_RESULTS = "(SELECT (quality * 4)::INTEGER AS gt, ((1 - toxic) * 4)::INTEGER AS predicted FROM labels)"


# rows of two classes: a metric is the mean of a truth value over a row or column of the table
_TWO = f"FROM {NB_RESULTS} WHERE gt IN (0, 4) AND predicted IN (0, 4)"


def _share(row: str, test: str, name: str, by: str) -> str:
    return (f"SELECT {row} AS gt, avg(CASE WHEN {test} THEN 1::DOUBLE ELSE 0::DOUBLE END) AS {name} {_TWO} "
            f"GROUP BY {by} HAVING bool_or({test})")


ORACLE["eval_precision"] = _share("predicted", "gt = predicted", "precision", "predicted")
ORACLE["eval_recall"] = _share("gt", "gt = predicted", "recall", "gt")
ORACLE["eval_fdr"] = _share("4 - predicted", "gt <> predicted", "false_discovery_rate", "predicted")
ORACLE["eval_fallout"] = _share("gt", "gt <> predicted", "fall_out", "gt")

ORACLE["eval_onepass"] = f"""
WITH c AS (
  SELECT count(*) FILTER (WHERE gt = 0 AND predicted = 0) AS n00,
         count(*) FILTER (WHERE gt = 0 AND predicted = 4) AS n04,
         count(*) FILTER (WHERE gt = 4 AND predicted = 0) AS n40,
         count(*) FILTER (WHERE gt = 4 AND predicted = 4) AS n44
  FROM {NB_RESULTS})
SELECT 0 AS gt, n00 / nullif(n00 + n40, 0) AS precision, n00 / nullif(n00 + n04, 0) AS recall,
       n04 / nullif(n04 + n44, 0) AS false_discovery_rate, n04 / nullif(n04 + n00, 0) AS fall_out FROM c
UNION ALL
SELECT 4, n44 / nullif(n44 + n04, 0), n44 / nullif(n44 + n40, 0),
       n40 / nullif(n40 + n00, 0), n40 / nullif(n40 + n44, 0) FROM c
"""

# ------------------------------------------------------------------ text chain

_CHAIN = "WITH " + chain_ctes(docs_source(markup=True))
_STEMMED = _CHAIN + stemmed_ctes()

ORACLE["html_unescape"] = f"SELECT page_id, {unescape_sql('html')} AS unescaped FROM pages"
ORACLE["emoticon_replace"] = _CHAIN + "SELECT id, array_to_string(emoticons, ' ') AS emoticons FROM e"
ORACLE["acronym_expand"] = _CHAIN + "SELECT id, preprocessed FROM p"
ORACLE["tweet_clean"] = _CHAIN + "SELECT id, tokenized FROM k"
ORACLE["squeeze_repeats"] = _CHAIN + "SELECT id, squeezed FROM q"
ORACLE["dedupe_ordered"] = _CHAIN + "SELECT id, array_to_string(deduped, ' ') AS deduped FROM d"
ORACLE["stop_filter"] = _CHAIN + "SELECT id, array_to_string(stopped, ' ') AS stopped FROM s"

ORACLE["stem_vocab"] = (_CHAIN + ", v AS (SELECT DISTINCT unnest(stopped) AS term FROM s), "
                        + plain_stem_ctes("v", "term") + "SELECT word AS term, stem FROM t9")

_POLARITY = ("CASE l.quality WHEN 1 THEN 4 WHEN 0 THEN 0 ELSE 2 END::INTEGER")
ORACLE["process_tweet"] = (_STEMMED + f"SELECT f.id, {_POLARITY} AS polarity, array_to_string(terms, ' ') AS terms "
                           "FROM f LEFT JOIN labels l ON l.doc_id = f.id")

# ------------------------------------------------------------------ features and Naive Bayes

_BUCKET = "(('0x' || substr(md5(term), 1, 8))::UBIGINT % 1024)::INTEGER"
_HASH_PCT = "(('0x' || substr(md5('0:' || d.doc_id::VARCHAR), 1, 8))::UBIGINT % 100)"
_FEAT = _STEMMED + f""",
terms AS (SELECT id, unnest(terms) AS term FROM f),
htf AS (SELECT id, {_BUCKET} AS bucket, count(*) AS tf FROM terms GROUP BY ALL),
split AS (SELECT d.doc_id AS id, CASE l.quality WHEN 1 THEN 4 WHEN 0 THEN 0 ELSE 2 END::INTEGER AS polarity,
                 {_HASH_PCT} < 70 AS is_train
          FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
tr AS (SELECT * FROM split WHERE is_train),
te AS (SELECT id, polarity AS gt FROM split WHERE NOT is_train),
tf_tr AS (SELECT * FROM htf WHERE id IN (SELECT id FROM tr)),
idf_tr AS (SELECT bucket, CASE WHEN count(*) >= 5 THEN ln(((SELECT count(*) FROM tr) + 1) / (count(*) + 1)) ELSE 0.0 END AS idf
           FROM tf_tr GROUP BY bucket),
x AS (SELECT t.id, tr.polarity AS label, t.bucket, t.tf * i.idf AS v FROM tf_tr t JOIN idf_tr i USING (bucket) JOIN tr USING (id)),
cnt AS (SELECT polarity AS label, count(*) AS n FROM tr GROUP BY polarity),
priors AS (SELECT label, n, ln(n + 1.0) - ln((SELECT sum(n) FROM cnt) + 1.0 * (SELECT count(*) FROM cnt)) AS pi FROM cnt),
cells AS (SELECT label, bucket, sum(v) AS s FROM x GROUP BY label, bucket),
tot AS (SELECT label, sum(s) AS total FROM cells GROUP BY label),
theta AS (SELECT label, bucket, ln(s + 1.0) - ln(total + 1024.0) AS theta FROM cells JOIN tot USING (label))
"""

ORACLE["term_frequency"] = _FEAT + "SELECT id, term, count(*) AS tf FROM terms GROUP BY id, term"
ORACLE["hashed_tf"] = _FEAT + "SELECT id, bucket, tf FROM htf"
_IDF_ALL = ("(SELECT bucket, count(*) AS df, CASE WHEN count(*) >= 5 THEN "
            "ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) ELSE 0.0 END AS idf FROM htf GROUP BY bucket)")
ORACLE["idf_weights"] = _FEAT + f"SELECT bucket, df, round(idf, 6) AS idf FROM {_IDF_ALL}"
ORACLE["tfidf"] = _FEAT + f"SELECT h.id, h.bucket, h.tf, round(h.tf * i.idf, 6) AS tfidf FROM htf h JOIN {_IDF_ALL} i USING (bucket)"
ORACLE["split_70_30"] = _FEAT + "SELECT id, CASE WHEN is_train THEN 'train' ELSE 'test' END AS part FROM split"
ORACLE["nb_priors"] = _FEAT + "SELECT label, n, round(pi, 6) AS pi FROM priors"
ORACLE["nb_loglik"] = _FEAT + "SELECT label, bucket, round(theta, 6) AS theta FROM theta"
ORACLE["nb_predict"] = _FEAT + """,
xt AS (SELECT t.id, t.bucket, t.tf * i.idf AS v FROM htf t JOIN idf_tr i USING (bucket) WHERE t.id IN (SELECT id FROM te)),
cls AS (SELECT p.label, p.pi, coalesce(ln(1.0) - ln(tot.total + 1024.0), ln(1.0) - ln(1024.0)) AS d
        FROM priors p LEFT JOIN tot USING (label)),
sc AS (SELECT te.id, te.gt, cls.label, cls.pi + coalesce(sum(xt.v * coalesce(th.theta, cls.d)), 0.0) AS score
       FROM te CROSS JOIN cls LEFT JOIN xt ON xt.id = te.id
       LEFT JOIN theta th ON th.label = cls.label AND th.bucket = xt.bucket
       GROUP BY te.id, te.gt, cls.label, cls.pi)
SELECT id, gt, first(label ORDER BY score DESC, label ASC)::INTEGER AS predicted FROM sc GROUP BY id, gt
"""
ORACLE["tf_roundtrip"] = ORACLE["hashed_tf"]

ORACLE["process_tweet_keys"] = (_STEMMED + "SELECT CASE WHEN id % 3 > 0 THEN id // 2 END AS id, "
                                "array_to_string(terms, ' ') AS terms FROM f")
ORACLE["stop_filter_file"] = _CHAIN + "SELECT id, unnest(stopped) AS term FROM s"
ORACLE["lexicon_file"] = ORACLE["acronym_expand"]
ORACLE["nb_ml_roundtrip"] = f"SELECT *, true AS loaded_agrees FROM ({ORACLE['nb_predict']})"
ORACLE["stream_classify_ml"] = ORACLE["nb_predict"]


def _features(buckets: int) -> str:
    """htf and what follows from it over another number of buckets."""
    return _FEAT.replace("% 1024)", f"% {buckets})")


ORACLE["tfidf_wide"] = _features(1 << 20) + """,
df AS (SELECT bucket, count(*) AS df FROM tf_tr GROUP BY bucket)
SELECT h.id, h.bucket, h.tf, round(h.tf * ln(((SELECT count(*) FROM tr) + 1) / (coalesce(df, 0) + 1)), 6) AS tfidf
FROM htf h LEFT JOIN df USING (bucket) WHERE h.id IN (SELECT id FROM te)
"""


def _text_clusters(dim: int, k: int) -> str:
    """One training batch from seeded random centres, then the nearest centre of each test tweet."""
    centers = np.random.RandomState(0).randn(k, dim)
    rows = ", ".join(f"({i}, [{', '.join(repr(float(x)) for x in c)}]::DOUBLE[])" for i, c in enumerate(centers))

    def near(docs: str, model: str) -> str:
        dots = (f"SELECT d.id, n.cluster, n.q - 2 * coalesce(sum(x.v * e.c), 0) AS d FROM {docs} d CROSS JOIN "
                f"(SELECT cluster, sum(c * c) AS q FROM {model} GROUP BY cluster) n LEFT JOIN xall x ON x.id = d.id "
                f"LEFT JOIN {model} e ON e.bucket = x.bucket AND e.cluster = n.cluster GROUP BY d.id, n.cluster, n.q")
        return f"SELECT id, first(cluster ORDER BY d, cluster)::INTEGER AS predicted FROM ({dots}) GROUP BY id"
    return _features(dim) + f""",
xall AS MATERIALIZED (SELECT t.id, t.bucket, t.tf * coalesce(i.idf, 0.0) AS v FROM htf t LEFT JOIN idf_tr i USING (bucket)),
c0 AS MATERIALIZED (SELECT cluster, unnest(c) AS c, unnest(range(0, len(c))) AS bucket FROM (VALUES {rows}) t(cluster, c)),
a0 AS MATERIALIZED ({near('tr', 'c0')}),
n0 AS (SELECT predicted AS cluster, count(*) AS m FROM a0 GROUP BY 1),
s0 AS (SELECT predicted AS cluster, bucket, sum(v) AS s FROM xall JOIN a0 USING (id) GROUP BY ALL),
c1 AS MATERIALIZED (SELECT c0.cluster, c0.bucket, CASE WHEN m IS NULL THEN c ELSE (c + coalesce(s, 0)) / (1.0::DOUBLE + m) END AS c
                    FROM c0 LEFT JOIN n0 USING (cluster) LEFT JOIN s0 USING (cluster, bucket))
SELECT te.id, te.gt, p.predicted FROM te JOIN ({near('te', 'c1')}) p USING (id)
"""


ORACLE["kmeans_text_stream"] = _text_clusters(4096, 2)


def _gram_axis(name: str, matrix: str, steps: int = 24) -> str:
    """CTE ``name`` (u, l): first eigenvector of a symmetric matrix (i, v: its row as a list), unit
    length, and its eigenvalue, by repeated multiplication."""
    out = [f"{name}0 AS MATERIALIZED (SELECT list(1.0::DOUBLE + (i * 7919 % 101) / 100.0 ORDER BY i) AS u FROM {matrix})"]
    for k in range(steps):
        out.append(f"{name}p{k} AS MATERIALIZED (SELECT list(list_dot_product(v, (SELECT u FROM {name}{k})) ORDER BY i) AS w FROM {matrix})")
        out.append(f"{name}{k + 1} AS MATERIALIZED (SELECT list_transform(w, lambda x: x / s) AS u, s AS l "
                   f"FROM (SELECT w, sqrt(list_dot_product(w, w)) AS s FROM {name}p{k}))")
    return ",\n".join(out) + f",\n{name} AS MATERIALIZED (SELECT u, l FROM {name}{steps})"


def _text_pca_clusters(dim: int, k: int) -> str:
    """Principal axes of the training TF-IDF, through the matrix of the products of the (centred)
    documents, which has the same ones; then one training batch in two dimensions."""
    centers = np.random.RandomState(0).randn(k, 2)
    rows = ", ".join(f"({i}, {float(x)!r}::DOUBLE, {float(y)!r}::DOUBLE)" for i, (x, y) in enumerate(centers))

    def near(model: str) -> str:
        return (f"SELECT p.id, first(m.cluster ORDER BY (p.x - m.x) * (p.x - m.x) + (p.y - m.y) * (p.y - m.y), m.cluster)::INTEGER "
                f"AS predicted FROM pr p CROSS JOIN {model} m GROUP BY p.id")

    def square(a: str) -> str:
        return (f"SELECT i, list(d / m ORDER BY j) AS v FROM (SELECT p.i, q.i AS j, list_dot_product(p.v, q.v) AS d "
                f"FROM {a} p CROSS JOIN {a} q) CROSS JOIN (SELECT max(list_max(v)) AS m FROM {a}) GROUP BY i")

    def axis(name: str, u: str) -> str:
        return f"""
{name}r AS (SELECT x.bucket, sum(x.v * d.c) AS c FROM xtr x JOIN (SELECT unnest((SELECT ids FROM ord)) AS id, unnest(u) AS c FROM {u}) d
  USING (id) GROUP BY x.bucket),
{name}c AS MATERIALIZED (SELECT bucket, {name}r.c - mu * (SELECT list_sum(u) FROM {u}) AS c FROM {name}r JOIN mu USING (bucket)),
{name} AS MATERIALIZED (SELECT bucket, c / sqrt((SELECT sum(c * c) FROM {name}c)) * (SELECT sign(arg_max(c, abs(c))) FROM {name}c) AS c FROM {name}c)"""

    return _features(dim) + f""",
xall AS MATERIALIZED (SELECT t.id, t.bucket, t.tf * i.idf AS v FROM htf t JOIN idf_tr i USING (bucket) WHERE i.idf <> 0),
xtr AS MATERIALIZED (SELECT x.* FROM xall x JOIN tr USING (id)),
ord AS MATERIALIZED (SELECT list(id ORDER BY id) AS ids FROM tr),
mu AS MATERIALIZED (SELECT bucket, sum(v) / (SELECT count(*) FROM tr) AS mu FROM xtr GROUP BY bucket),
rm AS MATERIALIZED (SELECT tr.id, coalesce(sum(v * mu), 0) AS r FROM tr LEFT JOIN xtr USING (id) LEFT JOIN mu USING (bucket) GROUP BY tr.id),
dots AS (SELECT p.id AS i, q.id AS j, sum(p.v * q.v) AS d FROM xtr p JOIN xtr q USING (bucket) GROUP BY ALL),
g0 AS MATERIALIZED (SELECT a.id AS i, list(coalesce(d, 0) - a.r - b.r + (SELECT sum(mu * mu) FROM mu) ORDER BY b.id) AS v
  FROM rm a CROSS JOIN rm b LEFT JOIN dots ON dots.i = a.id AND dots.j = b.id GROUP BY a.id),
g1 AS MATERIALIZED ({square('g0')}),
g2 AS MATERIALIZED ({square('g1')}),
g3 AS MATERIALIZED ({square('g2')}),
{_gram_axis('va', 'g3')},
g4 AS MATERIALIZED (SELECT i, list_transform(v, lambda c, k: c - w.l * w.c * w.u[k]) AS v FROM g3 JOIN (
  SELECT unnest((SELECT ids FROM ord)) AS i, unnest(u) AS c, u, l FROM va) w USING (i)),
{_gram_axis('vb', 'g4')},
{axis('ax', 'va')},
{axis('ay', 'vb')},
pr AS MATERIALIZED (SELECT s.id, coalesce(sum(x.v * ax.c), 0) AS x, coalesce(sum(x.v * ay.c), 0) AS y FROM split s LEFT JOIN xall x USING (id)
  LEFT JOIN ax USING (bucket) LEFT JOIN ay USING (bucket) GROUP BY s.id),
c0 AS (SELECT * FROM (VALUES {rows}) t(cluster, x, y)),
a0 AS (SELECT n.* FROM ({near('c0')}) n JOIN tr USING (id)),
c1 AS MATERIALIZED (SELECT c0.cluster, (any_value(c0.x) + coalesce(sum(p.x), 0)) / (1 + count(p.id)) AS x,
  (any_value(c0.y) + coalesce(sum(p.y), 0)) / (1 + count(p.id)) AS y
  FROM c0 LEFT JOIN (SELECT pr.*, predicted FROM pr JOIN a0 USING (id)) p ON p.predicted = c0.cluster GROUP BY c0.cluster)
SELECT te.id, (round(p.x, 2) + 0.0)::FLOAT AS x, (round(p.y, 2) + 0.0)::FLOAT AS y, te.gt, n.predicted
FROM te JOIN pr p USING (id) JOIN ({near('c1')}) n USING (id)
"""


ORACLE["kmeans_text_pca"] = _text_pca_clusters(4096, 2)


def _text_learning(dim: int, k: int, batches: int, spread: float) -> str:
    """Batches of the training tweets in order, each updating dense centres over the buckets that
    occur; the square of the other coordinates only shrinks with the weight."""
    def start(cluster: str, bucket: str) -> str:
        h = f"md5('0:' || {cluster} || ':' || {bucket})"
        u = " + ".join(f"('0x' || substr({h}, {8 * i + 1}, 8))::UBIGINT / 4294967296.0" for i in range(4))
        return f"(({u}) - 2.0::DOUBLE) * sqrt(3.0::DOUBLE) * {spread!r}::DOUBLE"

    out = [_features(dim) + f""",
xb AS MATERIALIZED (SELECT t.id, t.id % {batches} AS part, t.bucket, t.tf * i.idf AS v FROM tf_tr t JOIN idf_tr i USING (bucket) WHERE i.idf <> 0),
bs AS MATERIALIZED (SELECT DISTINCT bucket FROM xb),
st AS MATERIALIZED (SELECT j AS cluster, b AS bucket, {start('j', 'b')} AS c FROM range({k}) a(j), range({dim}) r(b)),
rest AS MATERIALIZED (SELECT cluster, sum(c * c) AS q FROM st WHERE bucket NOT IN (SELECT bucket FROM bs) GROUP BY cluster),
c0 AS MATERIALIZED (SELECT cluster, bucket, c, 1.0::DOUBLE AS w FROM st JOIN bs USING (bucket))"""]
    for b in range(batches):
        out.append(f"""
p{b} AS MATERIALIZED (SELECT id, first(cluster ORDER BY d, cluster) AS cluster FROM (
  SELECT t.id, n.cluster, n.q - 2 * coalesce(sum(x.v * e.c), 0) AS d FROM tr t CROSS JOIN (
    SELECT cluster, sum(c * c) + any_value(rest.q) / (max(w) * max(w)) AS q FROM c{b} JOIN rest USING (cluster) GROUP BY cluster) n
  LEFT JOIN xb x ON x.id = t.id LEFT JOIN c{b} e ON e.bucket = x.bucket AND e.cluster = n.cluster
  WHERE t.id % {batches} = {b} GROUP BY t.id, n.cluster, n.q) GROUP BY id),
n{b} AS (SELECT cluster, count(*) AS m FROM p{b} GROUP BY cluster),
s{b} AS (SELECT cluster, bucket, sum(v) AS s FROM xb JOIN p{b} USING (id) GROUP BY ALL),
c{b + 1} AS MATERIALIZED (SELECT cluster, bucket, (c * w + coalesce(s, 0)) / (w + coalesce(m, 0)) AS c, w + coalesce(m, 0) AS w
  FROM c{b} LEFT JOIN n{b} USING (cluster) LEFT JOIN s{b} USING (cluster, bucket))""")
    return ",".join(out) + f" SELECT cluster::INTEGER AS cluster, bucket, round(c, 6) + 0.0 AS value, w AS weight FROM c{batches}"


ORACLE["kmeans_text_learn"] = _text_learning(1 << 20, 2, 4, 1 / 1024)

from .oracle_more import register as _register_more  # noqa: E402

_register_more(ORACLE)
