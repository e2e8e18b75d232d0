"""DuckDB SQL for the cleaning chain (used only as the correctness oracle).

Written with DuckDB's own list lambdas and RE2 regexes, independently of the Spark
column code; the stemmer too is written apart from the engine's, from the published rules.
"""

from __future__ import annotations

from ..functions.lexicons import ACRONYMS, DEFAULT_STOP_WORDS, EMOTICONS, html_entities
from ..functions.porter import IRREGULAR_FORMS
from ..functions.sqlgen import DUCKDB as D
from ..functions.sqlgen import ascii_lower, ascii_upper
from ..sources.tweets import MARKUP_SUFFIXES

ENTITY_RE = r"&(#?[xX]?(?:[0-9a-fA-F]+|[A-Za-z0-9_]{1,8}));"
ENTITY_SPLIT_RE = r"&#?[xX]?(?:[0-9a-fA-F]+|[A-Za-z0-9_]{1,8});"
NOISE_RE = r"[0-9]+|@[A-Za-z0-9]+|[^0-9A-Za-z \t]|[A-Za-z0-9_]+://[^ \t\n\x0B\f\r]+"


def _list(values) -> str:
    return "[" + ", ".join(D.lit(v) for v in values) + "]"


def _map(pairs) -> str:
    return "MAP {" + ", ".join(f"{D.lit(k)}: {D.lit(v)}" for k, v in pairs) + "}"


def suffix_sql(id_col: str) -> str:
    return f"{_list(MARKUP_SUFFIXES)}[({id_col} % {len(MARKUP_SUFFIXES)}) + 1]"


def _chr(x: str) -> str:
    return f"CASE WHEN {x} = 0 OR {x} BETWEEN 55296 AND 57343 THEN chr(65533) ELSE chr({x}::INTEGER) END"


def unescape_sql(t: str) -> str:
    hx = "TRY_CAST('0x' || right('0' || ltrim(substr(n, 3), '0'), 12) AS UBIGINT)"
    dc = "TRY_CAST(right('0' || ltrim(substr(n, 2), '0'), 18) AS BIGINT)"
    dec = (f"CASE WHEN regexp_full_match(n, '#[xX][0-9a-fA-F]+') AND length(ltrim(substr(n, 3), '0')) < 12 "
           f"AND {hx} <= 1114111 THEN {_chr(hx)} "
           f"WHEN regexp_full_match(n, '#[0-9]+') AND length(ltrim(substr(n, 2), '0')) < 18 AND {dc} <= 1114111 "
           f"THEN {_chr(dc)} "
           f"WHEN starts_with(n, '#') THEN '&' || n || ';' "
           f"ELSE coalesce({_map(html_entities())}[n], '&' || n || ';') END")
    parts = f"regexp_split_to_array({t}, {D.lit(ENTITY_SPLIT_RE)})"
    names = f"regexp_extract_all({t}, {D.lit(ENTITY_RE)}, 1)"
    body = (f"list_transform([{parts}], lambda ps: ps[1] || array_to_string("
            f"list_transform({names}, lambda n, i: ({dec}) || ps[i + 1]), ''))[1]")
    return f"CASE WHEN instr({t}, '&') > 0 THEN {body} ELSE {t} END"


def replace_first_sql(toks: str, pairs) -> str:
    keys = _list([k for k, _ in pairs])
    return (f"list_transform({toks}, lambda t, i: CASE WHEN list_contains({keys}, t) "
            f"AND list_position({toks}, t) = i THEN {_map(pairs)}[t] ELSE t END)")


def squeeze_sql(s: str) -> str:
    # characters left after tokenizing are a-z and single spaces
    for ch in "abcdefghijklmnopqrstuvwxyz":
        s = f"regexp_replace({s}, '{ch}{{3,}}', '{ch}{ch}', 'g')"
    return s


def chain_ctes(source: str, text_col: str = "text", id_col: str = "id",
               stop_words=None) -> str:
    """CTEs u, e, p, k, q, d, s over ``source`` (must expose ``id_col``, ``text_col``)."""
    stop = _list(stop_words if stop_words is not None else DEFAULT_STOP_WORDS)
    return f"""
u AS (SELECT *, {unescape_sql(text_col)} AS unescaped FROM {source}),
e AS (SELECT *, {replace_first_sql("string_split(unescaped, ' ')", EMOTICONS)} AS emoticons FROM u),
p AS (SELECT *, {ascii_lower(D, "array_to_string(" + replace_first_sql("up", ACRONYMS) + ", ' ')")} AS preprocessed
      FROM (SELECT *, list_transform(emoticons, lambda x: {ascii_upper(D, 'x')}) AS up FROM e)),
k AS (SELECT *, trim(regexp_replace(regexp_replace({ascii_lower(D, 'preprocessed')}, {D.lit(NOISE_RE)}, '', 'g'),
      '[ \\t]+', ' ', 'g'), ' ') AS tokenized FROM p),
q AS (SELECT *, {squeeze_sql('tokenized')} AS squeezed FROM k),
d AS (SELECT *, list_filter(string_split(squeezed, ' '), lambda x, i: list_position(string_split(squeezed, ' '), x) = i) AS deduped FROM q),
s AS MATERIALIZED (SELECT *, list_filter(deduped, lambda x: NOT list_contains({stop}, x)) AS stopped FROM d)
"""


def stemmed_ctes(id_col: str = "id") -> str:
    """CTEs tok, t0..t9, f behind those of ``chain_ctes``: f is s with its list of stemmed terms."""
    return f""",
tok AS MATERIALIZED (SELECT {id_col}, unnest(stopped) AS term, unnest(range(0, len(stopped))) AS pos FROM s),
{plain_stem_ctes('tok', 'term')},
f AS MATERIALIZED (SELECT s.*, coalesce(x.terms, []) AS terms FROM s LEFT JOIN (
  SELECT {id_col}, list(stem ORDER BY pos) AS terms FROM tok JOIN t9 ON t9.word = tok.term GROUP BY {id_col}) x USING ({id_col}))
"""


_CC, _VV = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_GT0 = f"^({_CC})?{_VV}{_CC}"
_EQ1 = f"^({_CC})?{_VV}{_CC}({_VV})?$"
_GT1 = f"^({_CC})?{_VV}{_CC}{_VV}{_CC}"
_VOWEL = f"^({_CC})?[aeiouy]"
_CVC = f"^{_CC}[aeiouy][^aeiouwxy]$|^[aeiou][^aeiou]$"


def _suffixes(w: str, rules: list[tuple[str, str, str]], otherwise: str) -> str:
    """The longest listed suffix decides: with its measure the ending is replaced, else the word stays."""
    out = []
    for end, put, need in sorted(rules, key=lambda r: -len(r[0])):
        out.append(f"WHEN ends_with({w}, '{end}') THEN CASE WHEN regexp_matches({w}[:-{len(end) + 1}], '{need}') "
                   f"THEN {w}[:-{len(end) + 1}] || '{put}' ELSE {w} END")
    return f"CASE {' '.join(out)} ELSE {otherwise} END"


def plain_stem_ctes(words: str, col: str) -> str:
    """CTEs t0..t9 that stem the words of a table step by step, with the published measures as
    regular expressions; written apart from the engine's stemmer. t9 has (word, stem)."""
    two = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
           ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
           ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"),
           ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful")]
    three = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
    four = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ou", "ism", "ate", "iti",
            "ous", "ive", "ize"]
    rest = (f"CASE WHEN regexp_matches(r, '(at|bl|iz)$') THEN r || 'e' "
            f"WHEN length(r) >= 2 AND r[-1] = r[-2] AND regexp_matches(r, '[^aeiou]$') THEN "
            f"CASE WHEN r[-1] IN ('l', 's', 'z') THEN r ELSE r[:-2] END "
            f"WHEN regexp_matches(r, '{_EQ1}') AND regexp_matches(r, '{_CVC}') THEN r || 'e' ELSE r END")
    ion = ("WHEN ends_with(w, 'ion') THEN CASE WHEN regexp_matches(w[:-4], '" + _GT1 + "') AND w[-4] IN ('s', 't') "
           "THEN w[:-4] ELSE w END")
    step4 = _suffixes("w", [(e, "", _GT1) for e in four], "w").replace("CASE WHEN", f"CASE {ion} WHEN", 1)
    logi = f"CASE WHEN ends_with(w, 'logi') THEN CASE WHEN regexp_matches(w[:-4], '{_GT0}') THEN w[:-2] ELSE w END ELSE w END"
    odd = ", ".join(f"({D.lit(a)}, {D.lit(b)})" for a, b in IRREGULAR_FORMS)
    return f"""
t0 AS (SELECT DISTINCT {col} AS word, CASE WHEN starts_with({col}, 'y') THEN 'Y' || {col}[2:] ELSE {col} END AS w FROM {words}),
t1 AS (SELECT word, CASE WHEN ends_with(w, 'sses') THEN w[:-3] WHEN ends_with(w, 'ies') THEN CASE WHEN length(w) = 4 THEN w[:-2] ELSE w[:-3] END
       WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN w[:-2] ELSE w END AS w FROM t0),
t2 AS (SELECT word, w, CASE WHEN ends_with(w, 'ied') OR ends_with(w, 'eed') THEN NULL
       WHEN ends_with(w, 'ed') AND regexp_matches(w[:-3], '{_VOWEL}') THEN w[:-3]
       WHEN ends_with(w, 'ing') AND regexp_matches(w[:-4], '{_VOWEL}') THEN w[:-4] END AS r FROM t1),
t3 AS (SELECT word, CASE WHEN ends_with(w, 'ied') THEN CASE WHEN length(w) = 4 THEN w[:-2] ELSE w[:-3] END
       WHEN ends_with(w, 'eed') THEN CASE WHEN regexp_matches(w[:-4], '{_GT0}') THEN w[:-2] ELSE w END
       WHEN r IS NULL THEN w ELSE {rest} END AS w FROM t2),
t4 AS (SELECT word, CASE WHEN length(w) > 2 AND regexp_matches(w, '([^aeiouy]|^y|[aeiou]yy)y$|[^aeiouy]yyy$|Yyy$') AND NOT regexp_matches(w, 'Yy$')
       THEN w[:-2] || 'i' ELSE w END AS w FROM t3),
t5 AS (SELECT word, CASE WHEN ends_with(w, 'alli') AND regexp_matches(w[:-5], '{_GT0}') THEN w[:-3] ELSE w END AS w FROM t4),
t6 AS (SELECT word, {_suffixes("w", [(a, b, _GT0) for a, b in two], logi)} AS w FROM t5),
t7 AS (SELECT word, {_suffixes("w", [(a, b, _GT0) for a, b in three], "w")} AS w FROM t6),
t8 AS (SELECT word, {step4} AS w FROM t7),
t9a AS (SELECT word, CASE WHEN ends_with(w, 'e') AND (regexp_matches(w[:-2], '{_GT1}') OR (regexp_matches(w[:-2], '{_EQ1}')
        AND NOT regexp_matches(w[:-2], '{_CVC}'))) THEN w[:-2] ELSE w END AS w FROM t8),
t9 AS (SELECT word, coalesce(o.b, CASE WHEN length(word) <= 2 THEN word WHEN ends_with(w, 'll') AND regexp_matches(w[:-2], '{_GT1}')
       THEN lower(w[:-2]) ELSE lower(w) END) AS stem FROM t9a LEFT JOIN (VALUES {odd}) o(a, b) ON o.a = t9a.word)
"""


def docs_source(markup: bool = True) -> str:
    text = f"text || {suffix_sql('doc_id')}" if markup else "text"
    return f"(SELECT doc_id AS id, {text} AS text FROM documents)"
