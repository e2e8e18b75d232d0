"""Tweet cleaning as native Spark column expressions (no Python UDF).

Order of the chain (normative):

1. ``html_unescape``          named / decimal / hex character references, one pass
2. ``split_space``            split on single spaces, empty tokens kept
3. ``replace_first``          emoticon -> word, first occurrence of each key only
4. ``acronym_expand``         acronym -> phrase on upper-cased tokens, then lower case
5. ``tokenize``               delete digits, @names, non-alphanumerics and URLs; squash spaces
6. ``squeeze_repeats``        any run of 3+ equal characters -> 2
7. ``array_distinct``         de-duplicate, first occurrence order kept
8. ``remove_stop_words``      drop stop words
9. ``stem_tokens``            Porter stem of every token (duplicates created here are kept)

Case changes are ASCII-only (``translate``), because the cleaned text is bytes-oriented:
Spark's ``upper``/``lower`` would turn, e.g., U+00DF into ``SS`` or U+212A into ``k``.

Lexicon lookups use ``IN`` lists (Catalyst turns long lists into hash sets) guarding a
literal map; the quadratic first-occurrence test only runs for tokens that are keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lexicons import ACRONYMS, DEFAULT_STOP_WORDS, EMOTICONS, html_entities
from .porter import stem_steps, word_stemmer
from .sqlgen import LOWER, SPARK, UPPER

# Regular expressions (Java syntax). Classes are spelled out so that they mean the same
# thing in every engine: \d = [0-9], \w = [A-Za-z0-9_], \s = [ \t\n\x0B\f\r].
ENTITY_RE = r"&(#?[xX]?(?:[0-9a-fA-F]+|[A-Za-z0-9_]{1,8}));"
ENTITY_SPLIT_RE = r"&#?[xX]?(?:[0-9a-fA-F]+|[A-Za-z0-9_]{1,8});"
NOISE_RE = (r"[0-9]+|@[A-Za-z0-9]+|[^0-9A-Za-z \t]"
            r"|[A-Za-z0-9_]++://[^ \t\n\x0B\f\r]+")
# Without "://" in the text the URL alternative cannot match: a cheaper equivalent.
NOISE_NO_URL_RE = r"[0-9]+|@[A-Za-z0-9]+|[^0-9A-Za-z \t]"
# The same two for Java, in the time that a scan takes. Java matches a class of several ranges
# by nested calls, some ten times slower than its named classes (ASCII only, as above). Runs of
# noise are one match. A URL begins at a letter behind no other letter (digits and _ before it
# are noise of their own), so no word is tried from each of its letters.
JAVA_NOISE_NO_URL_RE = r"[^\p{Alpha} \t@]+|@\p{Alnum}*"
JAVA_NOISE_RE = JAVA_NOISE_NO_URL_RE + r"|(?<!\p{Alpha})\p{Alpha}\w*+://\S+"
REPEAT_RE = r"(.)\1\1+"  # a run of two stays as it is
MAX_CODE_POINT = 0x10FFFF
STEM_MEMO = 200_000  # words whose stems a task remembers (some 30 MB)


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def ascii_upper(c: Column) -> Column:
    """A-Z for a-z. ``translate`` looks each character up, so only words that are not ASCII, where
    ``upper`` would do more, go through it. ``c`` is read several times: bind it with ``let``."""
    return F.when(_is_ascii(c), F.upper(c)).otherwise(F.translate(c, LOWER, UPPER))


def ascii_lower(c: Column) -> Column:
    return F.when(_is_ascii(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def ascii_lower_text(text: Column) -> Column:
    """``ascii_lower`` of a long text: where it is not ASCII, word by word."""
    return let(text, lambda s: F.when(_is_ascii(s), F.lower(s))
               .otherwise(F.array_join(F.transform(split_space(s), ascii_lower), " ")))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a function of one Column).

    Binding through a one-element ``transform`` keeps an intermediate result from being
    inlined (and recomputed) at every place the body reads it.
    """
    return F.transform(F.array(value), body)[0]


def _literal_map(pairs: Iterable[tuple[str, str]]) -> Column:
    flat = []
    for k, v in pairs:
        flat += [F.lit(k), F.lit(v)]
    return F.create_map(*flat)


# ---------------------------------------------------------------- C1: entity unescape

def _code_point_char(n: Column) -> Column:
    """Character for code point ``n`` (NUL and surrogates become U+FFFD)."""
    safe = F.when((n == 0) | n.between(0xD800, 0xDFFF), F.lit(0xFFFD)).otherwise(n)
    return F.decode(F.unhex(F.lpad(F.hex(safe), 8, "0")), "UTF-32")


def _decode_entity(name: Column, entities: Column) -> Column:
    """Replacement for ``&name;``; unknown or unparsable references stay as written."""
    as_written = F.concat(F.lit("&"), name, F.lit(";"))
    # leading zeros do not count; nine digits left of either kind are out of range
    hex_digits = F.regexp_replace(name, "^#[xX]0*", "")
    dec_digits = F.regexp_replace(name, "^#0*", "")
    hex_val = F.when(F.length(hex_digits) <= 8, F.conv(F.concat(F.lit("0"), hex_digits), 16, 10).cast("bigint"))
    dec_val = F.when(F.length(dec_digits) <= 8, F.concat(F.lit("0"), dec_digits).cast("bigint"))
    return (F.when(name.rlike("^#[xX][0-9a-fA-F]+$") & (hex_val <= MAX_CODE_POINT), _code_point_char(hex_val))
            .when(name.rlike("^#[0-9]+$") & (dec_val <= MAX_CODE_POINT), _code_point_char(dec_val))
            .when(name.startswith("#"), as_written)
            .otherwise(F.coalesce(F.try_element_at(entities, name), as_written)))


def html_unescape(text: Column, entities: Sequence[tuple[str, str]] | None = None) -> Column:
    """Replace ``&name;``, ``&#NNN;`` and ``&#xHH;`` in one left-to-right pass.

    A ``;`` is required and the result is not rescanned (``&amp;lt;`` -> ``&lt;``).
    The text is cut at the references and rebuilt with ``zip_with``; texts without
    ``&`` skip all of it.
    """
    emap = _literal_map(entities if entities is not None else html_entities())

    def rebuild(s: Column) -> Column:
        parts = F.split(s, ENTITY_SPLIT_RE, -1)
        names = F.regexp_extract_all(s, F.lit(ENTITY_RE), 1)
        pieces = F.zip_with(
            F.transform(names, lambda nm: _decode_entity(nm, emap)),
            F.slice(parts, 2, F.size(parts)),
            lambda rep, tail: F.concat(rep, tail))
        return F.concat(F.element_at(parts, 1), F.array_join(pieces, ""))

    return let(text, lambda s: F.when(F.instr(s, "&") > 0, rebuild(s)).otherwise(s))


# ---------------------------------------------------------------- C2-C6: lexicons

def split_space(text: Column) -> Column:
    """Split on single spaces; empty tokens are kept (``''`` -> ``['']``)."""
    return F.split(text, " ", -1)


def replace_first(tokens: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Replace the first occurrence of each lexicon key in ``tokens`` (exact match)."""
    keys = [k for k, _ in pairs]
    lex = _literal_map(pairs)
    return let(tokens, lambda toks: F.transform(
        toks,
        lambda t, i: F.when(t.isin(keys) & (F.array_position(toks, t) == i + 1),
                            F.element_at(lex, t)).otherwise(t)))


def expand_acronyms(tokens: Column, pairs: Sequence[tuple[str, str]] | None = None) -> Column:
    """The text of the tokens with acronyms expanded, whatever their case; cases are mixed in it.

    Only tokens that are short enough to be a key are upper-cased.
    """
    pairs = pairs if pairs is not None else ACRONYMS
    longest = max((len(k.encode()) for k, _ in pairs), default=0)
    keyed = F.transform(tokens, lambda t: F.when(F.octet_length(t) <= longest, ascii_upper(t)).otherwise(t))
    return F.array_join(replace_first(keyed, pairs), " ")


def acronym_expand(tokens: Column, pairs: Sequence[tuple[str, str]] | None = None) -> Column:
    """Expand acronyms; returns the lower-cased text."""
    return ascii_lower_text(expand_acronyms(tokens, pairs))


# ---------------------------------------------------------------- C7-C15: cleaning

def tokenize(text: Column) -> Column:
    """Lower-case, delete noise (digits, @names, symbols, URLs) and squash blanks."""
    def strip(low: Column) -> Column:
        return F.when(F.instr(low, "://") > 0, F.regexp_replace(low, JAVA_NOISE_RE, "")) \
                .otherwise(F.regexp_replace(low, JAVA_NOISE_NO_URL_RE, ""))

    # no noise depends on the case, and what is left is ASCII: there ``lower`` is exact
    s = F.lower(let(text, strip))
    return F.trim(F.regexp_replace(s, "[ \t]+", " "))


def squeeze_repeats(text: Column) -> Column:
    """Squeeze every run of two or more equal characters to exactly two."""
    return F.regexp_replace(text, REPEAT_RE, "$1$1")


def remove_stop_words(tokens: Column, stop_words: Sequence[str] | None = None) -> Column:
    words = list(stop_words if stop_words is not None else DEFAULT_STOP_WORDS)
    return F.filter(tokens, lambda t: ~t.isin(words))


def explode_tokens(tokens: Column, pos_col: str = "pos", tok_col: str = "tok",
                   outer: bool = False) -> Column:
    """Generator: one row ``(pos, tok)`` per array element (``inline`` of structs).

    Building the structs with ``transform`` first keeps the optimizer from rewriting
    the generator input; a plain ``posexplode`` over the cleaning chain re-evaluated
    the chain per element and ran several times slower.
    """
    items = F.transform(tokens, lambda x, i: F.struct(i.alias(pos_col), x.alias(tok_col)))
    return F.inline_outer(items) if outer else F.inline(items)


def with_stem(df: DataFrame, word_col: str, out_col: str) -> DataFrame:
    """Add ``out_col``, the Porter stem of the single-word column ``word_col``.

    Each step of the stemmer becomes one column, so the whole chain compiles into the
    surrounding whole-stage-codegen stage (nesting it as lambdas instead runs
    interpreted and is far slower).
    """
    steps = stem_steps(SPARK, word_col, "_st")
    cols = [name for name, _ in steps]
    for name, expr in steps:
        df = df.withColumn(name, F.expr(expr))
    return df.withColumn(out_col, F.col(cols[-1])).drop(*cols)


def stem_each(tokens: Column) -> Column:
    """The array column with each word stemmed in place: one row in, one row out.

    An Arrow UDF (``porter.word_stemmer``). Of a batch each distinct word is stemmed once, and
    the last ``STEM_MEMO`` words or so of a task are remembered. Needs no shuffle and no state,
    so it may stand in a streaming plan.
    """
    limit, word_stem = STEM_MEMO, word_stemmer()

    def stems(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        known = {}
        for lists, _ in batches:
            words = lists.flatten().dictionary_encode()
            found = []
            for w in words.dictionary.to_pylist():
                s = known.get(w)
                if s is None:
                    if len(known) >= limit:
                        known.clear()
                    s = known[w] = word_stem(w)
                found.append(s)
            flat = pa.array(found, words.dictionary.type).take(words.indices)
            ends = pc.cumulative_sum(pc.fill_null(lists.value_lengths(), 0))
            offsets = pa.concat_arrays([pa.array([0], ends.type), ends]).cast(pa.int32())
            yield pa.ListArray.from_arrays(offsets, flat, mask=lists.is_null())

    # the annotations that tell the iterator form, as types: names would be looked up in vain
    import pyarrow
    stems.__annotations__ = {"batches": Iterator[tuple[pyarrow.Array, pyarrow.Array]], "return": Iterator[pyarrow.Array]}
    # A column that is read twice is not inlined into its reader: with the cleaning chain and its
    # lambdas as argument, Spark 4.1 does not find the UDF again and fails ("Cannot evaluate").
    # Equal arguments are sent once.
    return F.arrow_udf(stems, "array<string>")(tokens, tokens)
