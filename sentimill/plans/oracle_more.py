"""DuckDB oracles for k-means, parsers, wire format, streams and row numbering."""

from __future__ import annotations

NB_RESULTS = "(SELECT (quality * 4)::INTEGER AS gt, ((1 - toxic) * 4)::INTEGER AS predicted FROM labels)"


def _dist(v: str, c: str) -> str:
    return f"list_reduce(list_transform({v}, lambda x, i: (x - {c}[i]) * (x - {c}[i])), lambda p, q: p + q)"


KM = f"""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS f, ((label % 3) * 2)::INTEGER AS gt,
                   vec_id % 4 AS b FROM embeddings),
c AS (SELECT vec_id::INTEGER AS cluster, embedding::DOUBLE[] AS center, 1.0::DOUBLE AS weight
      FROM embeddings WHERE vec_id < 2),
a AS (SELECT v.vec_id, v.gt, v.f, first(c.cluster ORDER BY {_dist('v.f', 'c.center')}, c.cluster)::INTEGER AS predicted
      FROM v CROSS JOIN c GROUP BY v.vec_id, v.gt, v.f)
"""


KMEANS_UPDATE = KM + """,
st AS (SELECT predicted AS cluster, count(*) AS m FROM a GROUP BY 1),
sx AS (SELECT cluster, idx, sum(x) AS s FROM
       (SELECT predicted AS cluster, unnest(f) AS x, unnest(range(0, len(f))) AS idx FROM a) GROUP BY 1, 2),
ce AS (SELECT cluster, unnest(center) AS value, unnest(range(0, len(center))) AS idx, weight FROM c)
SELECT ce.cluster, ce.idx::INTEGER AS idx,
       round(CASE WHEN st.m IS NULL THEN ce.value ELSE (ce.value * ce.weight + sx.s) / (ce.weight + st.m) END, 6) AS value,
       ce.weight + coalesce(st.m, 0) AS weight
FROM ce LEFT JOIN st USING (cluster) LEFT JOIN sx ON sx.cluster = ce.cluster AND sx.idx = ce.idx
"""


def _axis(name: str, matrix: str, squarings: int = 14) -> str:
    """CTE ``name`` (i, x): the first eigenvector of a symmetric matrix (i, j, c), by squaring
    the matrix until only this direction is left; its largest coordinate is positive."""
    out = [f"{name}0 AS MATERIALIZED (SELECT i, j, c / (SELECT max(abs(c)) FROM {matrix}) AS c FROM {matrix})"]
    for k in range(squarings):
        a = f"{name}{k}"
        out.append(f"{a}s AS MATERIALIZED (SELECT p.i, q.j, sum(p.c * q.c) AS c FROM {a} p JOIN {a} q ON p.j = q.i GROUP BY p.i, q.j)")
        out.append(f"{name}{k + 1} AS MATERIALIZED (SELECT i, j, c / (SELECT max(abs(c)) FROM {a}s) AS c FROM {a}s)")
    last = f"{name}{squarings}"
    out.append(f"{name}col AS (SELECT i, c FROM {last} WHERE j = (SELECT i FROM {last} WHERE i = j ORDER BY c DESC LIMIT 1))")
    out.append(f"{name} AS MATERIALIZED (SELECT i, c / sqrt((SELECT sum(c * c) FROM {name}col)) * "
               f"(SELECT sign(arg_max(c, abs(c))) FROM {name}col) AS x FROM {name}col)")
    return ",\n".join(out)


PCA = """,
el AS MATERIALIZED (SELECT vec_id, unnest(f) AS x, unnest(range(0, len(f))) AS i FROM v),
ce AS (SELECT vec_id, i, x - avg(x) OVER (PARTITION BY i) AS x FROM el),
co AS MATERIALIZED (SELECT p.i, q.i AS j, sum(p.x * q.x) AS c FROM ce p JOIN ce q ON p.vec_id = q.vec_id GROUP BY ALL),
""" + _axis("ax", "co") + """,
lam AS (SELECT sum(p.x * c * q.x) AS l FROM co JOIN ax p ON p.i = co.i JOIN ax q ON q.i = co.j),
rest AS MATERIALIZED (SELECT co.i, co.j, c - (SELECT l FROM lam) * p.x * q.x AS c FROM co JOIN ax p ON p.i = co.i JOIN ax q ON q.i = co.j),
""" + _axis("ay", "rest") + """,
pr AS (SELECT el.vec_id, (round(sum(el.x * ax.x), 3) + 0.0)::FLOAT AS x, (round(sum(el.x * ay.x), 3) + 0.0)::FLOAT AS y
       FROM el JOIN ax USING (i) JOIN ay USING (i) GROUP BY el.vec_id)
"""


#: clusters of the written points, the first two points as centres
KMEANS_XY = """,
xy AS (SELECT p.vec_id, p.x, p.y, v.gt, first(q.vec_id::INTEGER ORDER BY (p.x::DOUBLE - q.x) * (p.x::DOUBLE - q.x)
         + (p.y::DOUBLE - q.y) * (p.y::DOUBLE - q.y), q.vec_id) AS predicted
       FROM pr p JOIN v USING (vec_id) CROSS JOIN (SELECT * FROM pr WHERE vec_id < 2) q GROUP BY p.vec_id, p.x, p.y, v.gt)
"""


def kmeans_stream_sql(batches: int = 4) -> str:
    """Batches in order: update the model with the batch, then assign the batch with it."""
    parts = [KM, ", m0 AS (SELECT cluster, center, weight FROM c)"]
    outs = []
    for b in range(batches):
        parts.append(f""",
a{b} AS (SELECT v.vec_id, v.gt, v.f, first(m.cluster ORDER BY {_dist('v.f', 'm.center')}, m.cluster) AS p
        FROM v CROSS JOIN m{b} m WHERE v.b = {b} GROUP BY v.vec_id, v.gt, v.f),
n{b} AS (SELECT p AS cluster, count(*) AS m FROM a{b} GROUP BY 1),
x{b} AS (SELECT cluster, idx, sum(x) AS s FROM
         (SELECT p AS cluster, unnest(f) AS x, unnest(range(0, len(f))) AS idx FROM a{b}) GROUP BY 1, 2),
e{b} AS (SELECT cluster, unnest(center) AS c, unnest(range(0, len(center))) AS idx, weight FROM m{b}),
m{b + 1} AS (SELECT e.cluster,
             list(CASE WHEN n.m IS NULL THEN e.c ELSE (e.c * e.weight + x.s) / (e.weight + n.m) END ORDER BY e.idx) AS center,
             any_value(e.weight + coalesce(n.m, 0)) AS weight
         FROM e{b} e LEFT JOIN n{b} n USING (cluster) LEFT JOIN x{b} x ON x.cluster = e.cluster AND x.idx = e.idx
         GROUP BY e.cluster),
o{b} AS (SELECT v.vec_id, v.gt, first(m.cluster ORDER BY {_dist('v.f', 'm.center')}, m.cluster)::INTEGER AS predicted
        FROM v CROSS JOIN m{b + 1} m WHERE v.b = {b} GROUP BY v.vec_id, v.gt)""")
        outs.append(f"SELECT * FROM o{b}")
    return "".join(parts) + "\n" + " UNION ALL ".join(outs)


TW = """WITH tw AS (
  SELECT CASE l.quality WHEN 1 THEN 4 WHEN 0 THEN 0 ELSE 2 END::INTEGER AS polarity, d.doc_id AS id,
         '2009-04-' || lpad(((d.doc_id % 28) + 1)::VARCHAR, 2, '0') AS date, d.lang AS query,
         d.source AS sender, d.text AS text
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
"""

_APOS = "chr(39)"
_QUOTE = "chr(34)"

PARSE_LINES = TW + f""",
ln AS (SELECT '"' || concat_ws('","', coalesce(polarity::VARCHAR, ''), coalesce(id::VARCHAR, ''),
              coalesce(date, ''), coalesce(query, ''), coalesce(sender, ''),
              coalesce(regexp_replace(text, '[\\r\\n]', ' ', 'g'), '')) || '"' AS line FROM tw),
pf AS (SELECT list_transform(string_split(replace(line, {_APOS}, ''), '",'), lambda x: replace(x, {_QUOTE}, '')) AS f
       FROM ln)
SELECT f[1] AS polarity, TRY_CAST(f[2] AS BIGINT) AS id, f[3] AS date, f[4] AS query, f[5] AS sender,
       f[6] AS text, len(f)::INTEGER AS n_fields FROM pf
"""

TWEETS = TW + "SELECT polarity, id, date, query, sender, text FROM tw"

WIRE = TW + "SELECT id, to_json([polarity::VARCHAR, id::VARCHAR, date, query, sender, text]) AS value FROM tw"

_NULL_BAD = ", ".join(f"CASE WHEN id % 50 = 0 THEN NULL ELSE {c} END AS {c}"
                      for c in ("id", "polarity", "query", "sender", "text"))
STREAM_DECODE = TW + f"SELECT {_NULL_BAD}, id % 50 <> 0 AS valid FROM tw"

_FIELD = "('\"' || replace(coalesce({0}::VARCHAR, ''), '\"', '\"\"') || '\"')"
_FIVE = [_FIELD.format(c) for c in ("polarity", "id", "date", "query", "sender")]
_TEXT = "regexp_replace(text, '[\\r\\n]', ' ', 'g')"
_LINE = "concat_ws(',', " + ", ".join([*_FIVE, _FIELD.format(_TEXT)]) + ")"
PARSE_REJECTS = TW + f"""
SELECT CASE WHEN id % 50 > 2 THEN id END AS id, CASE WHEN id % 50 > 2 THEN polarity END AS polarity,
       CASE WHEN id % 50 > 2 THEN {_TEXT} END AS text,
       CASE id % 50 WHEN 0 THEN 'fields' WHEN 1 THEN 'cast' WHEN 2 THEN 'quote' ELSE 'ok' END AS reason,
       CASE id % 50 WHEN 0 THEN concat_ws(',', {', '.join(_FIVE)})
         WHEN 1 THEN concat_ws(',', {_FIVE[0]}, '"x' || id || '"', {', '.join(_FIVE[2:])}, {_FIELD.format(_TEXT)})
         WHEN 2 THEN {_LINE}[:-2] END AS record
FROM tw
"""

REPLAY_ORDER = TW + ("SELECT id, md5('0:' || id::VARCHAR) AS replay_key, "
                     "row_number() OVER (ORDER BY md5('0:' || id::VARCHAR)) - 1 AS place FROM tw")
POSITIONAL_JOIN = TW + """,
l AS (SELECT row_number() OVER (ORDER BY id) - 1 AS idx, id, polarity FROM tw),
r AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx, doc_id, n_chars FROM documents)
SELECT l.idx, l.id, l.polarity, r.doc_id, r.n_chars FROM l JOIN r USING (idx)
"""


def register(oracle: dict[str, str]) -> None:
    oracle["kmeans_assign"] = KM + "SELECT vec_id, gt, predicted FROM a"
    oracle["kmeans_output"] = KM + PCA + KMEANS_XY + "SELECT x, y, gt, predicted FROM xy"
    oracle["pca_project"] = KM + PCA + "SELECT vec_id, x, y, gt FROM v JOIN pr USING (vec_id)"
    oracle["unique_ids"] = "SELECT doc_id AS id, 1::BIGINT AS rows_with_uid FROM documents"
    oracle["run_table_name"] = f"SELECT gt, predicted, true AS name_in_form FROM {NB_RESULTS}"
    oracle["scan_results"] = oracle["kmeans_output"]
    oracle["cluster_contingency"] = KM + PCA + KMEANS_XY + "SELECT gt, predicted, count(*) AS C1 FROM xy WHERE gt <> 1 AND gt <> 3 GROUP BY ALL"
    oracle["kmeans_update"] = KMEANS_UPDATE
    oracle["kmeans_stream"] = kmeans_stream_sql()
    oracle["parse_lines"] = PARSE_LINES
    oracle["parse_csv"] = TWEETS
    oracle["parse_rejects"] = PARSE_REJECTS
    oracle["tweet_fields"] = TWEETS
    oracle["wire_encode"] = WIRE
    oracle["stream_decode"] = STREAM_DECODE
    oracle["replay_order"] = REPLAY_ORDER
    oracle["stream_classify"] = oracle["nb_predict"]
    oracle["sink_roundtrip"] = f"SELECT gt, predicted FROM {NB_RESULTS}"
    oracle["positional_join"] = POSITIONAL_JOIN
    oracle["sink_create"] = oracle["sink_roundtrip"]
