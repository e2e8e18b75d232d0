"""Collocations: fingerprints and counts against plain Python, the full rule against brute force."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sentimill.llm import collocation as co
from sentimill.llm.words import buffers

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for p in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(_UPPER)):
        yield re.findall("[^ \t]+", p)


def counted(rows, longest=3):
    """Counter of (lang, words) and Counter of words by lang."""
    f, n = Counter(), Counter()
    for _, lang, text in rows:
        lang = lang or "und"
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, min_count=10, cover=50, top=2000, longest=3):
    f, n = counted(rows, longest)
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    out = []
    for (lang, w), a in cand.items():
        score, _, left, right = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]])
                                    for k in range(1, len(w)))
        inside = any(x == lang and len(v) > len(w) and 100 * b >= cover * a and any(v[i:i + len(w)] == w for i in range(len(v)))
                     for (x, v), b in cand.items())
        if not inside:
            out.append((lang, -score, -a, " ".join(w).encode(), left, right))
    rank, last, result = 0, None, []
    for lang, score, a, phrase, left, right in sorted(out):
        rank = rank + 1 if lang == last else 1
        last = lang
        if rank <= top:
            result.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return result


TEXT = st.lists(st.sampled_from(["a", "B", "b", "ñ", " ", "  ", "\t", ".", "\n", "漢字", "É", "\x0b", "-"]), max_size=40).map("".join)


@settings(max_examples=120, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=6))
def test_fingerprints_are_those_of_the_phrases(texts):
    raw, offsets = buffers(pa.array(texts))
    run = co.Run(raw, offsets)
    salt = np.zeros(len(texts), np.uint64)
    want = [p for t in texts for p in pieces(t)]
    for k in (1, 2, 3):
        _, fp = run.fingerprints(k, salt)
        grams = [tuple(w[i:i + k]) for w in want for i in range(len(w) - k + 1)]
        assert len(fp) == len(grams)
        assert len(set(zip(grams, fp.tolist()))) == len(set(grams)) == len(set(fp.tolist()))


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = "one two, three four five " * 40 + "x" * 500 + " end. last"
    raw, offsets = buffers(pa.array(["first text", text, "", "one two"]))
    whole = co.Run(raw, offsets[1:3])
    monkeypatch.setattr(co, "PIECE", 64)
    parts = co.Run(raw, offsets[1:3])
    for name in ("h", "start", "end"):
        assert (getattr(whole, name) == getattr(parts, name)).all()
    assert (np.diff(whole.piece) == np.diff(parts.piece)).all()
    salt = np.zeros(2, np.uint64)
    for k in (1, 2, 3):
        assert [x.tolist() for x in whole.fingerprints(k, salt)] == [x.tolist() for x in parts.fingerprints(k, salt)]


def _rows(df):
    return [(r.doc_id, r.lang, r.text) for r in df.collect()]


def _found(df):
    return [tuple(r) for r in df.drop("first_doc").orderBy("lang", "rank").collect()]


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    vocab = ["the", "The", "of", "cat", "sat", "on", "mat", "ñu", "Ñu", "x-y", "  ", "dog"]
    texts = [" ".join(rng.choice(vocab, rng.integers(0, 60))) + rng.choice([".", " ", "\n", ", the cat sat"]) for _ in range(120)]
    rows = [(i if i % 3 else None, [None, "en", "und", "fr"][i % 4], t) for i, t in enumerate(texts)] + [(7, "en", texts[1])] * 15
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string").repartition(5)
    assert _found(co.collocations(df)) == brute(rows)
    assert _found(co.collocations(df, max_words=4, min_count=3, cover_percent=80, top=7)) == brute(rows, 3, 80, 7, 4)
    assert _found(co.collocations(df, max_words=2, min_count=3)) == brute(rows, 3, longest=2)


def test_equal_fingerprints_are_told_apart(spark, monkeypatch):
    """With fingerprints of 3 bits every phrase collides; counts and phrases stay right."""
    rows = [(i, "en", "a b c d, a b, c d e. " + "f g " * (i % 3)) for i in range(12)]
    real = co.Run.fingerprints
    raw, offsets = buffers(pa.array([r[2] for r in rows]))
    run = co.Run(raw, offsets)
    first, fp = run.fingerprints(2, np.zeros(len(rows), np.uint64))

    def narrow(self, words, salt):
        at, h = real(self, words, salt)
        return at, h & np.uint64(7)

    monkeypatch.setattr(co.Run, "fingerprints", narrow)
    everything = co.Bits(32768, {0: b"\xff" * 4096})

    class Held:
        value = everything

    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["id", "lang", "text"])
    got = Counter()
    for out in co._verified(3, Held)(iter([batch])):
        for lang, k, phrase, _, n in zip(*(out.column(i).to_pylist() for i in range(5))):
            if k:
                got[lang, tuple(phrase.split(" "))] += n
    assert got == counted(rows)[0]


def test_pointers_name_the_first_document(spark):
    rows = [(40 - i, "en", "kind regards. other words") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    assert {r.phrase: r.first_doc for r in co.collocations(df).collect()}["kind regards"] == 11


def test_products_beyond_64_bits(spark):
    df = spark.createDataFrame([(3_000_000_000, 4_000_000_000, 5_000_000_000), (9 * 10**14, 9 * 10**14, 9 * 10**14 + 1)], "a bigint, l bigint, r bigint")
    got = [r[0] for r in df.select(co._score(df.a, df.l, df.r)).collect()]
    assert got == [10**6 * a * a // (b * c) for a, b, c in [(3 * 10**9, 4 * 10**9, 5 * 10**9), (9 * 10**14, 9 * 10**14, 9 * 10**14 + 1)]]


def test_messy_rows(spark, messy, empty):
    assert _found(co.collocations(messy, min_count=2)) == brute(_rows(messy), 2)
    assert co.collocations(empty).count() == 0
    assert _found(co.collocations(messy.where("text is null"))) == []


@pytest.mark.parametrize("n_bits", [32768, 1 << 20])
def test_filter_has_no_false_negatives(spark, n_bits, monkeypatch):
    monkeypatch.setattr(co, "MAX_BITS", n_bits)
    fps = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 5000)
    bits = co.filter_of(spark.createDataFrame([(int(x),) for x in fps], "fp bigint"))
    assert bits.has(fps.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(-2**63, 2**63 - 1, 5000).view(np.uint64)
    assert bits.has(others).mean() < (0.2 if n_bits == 32768 else 0.02)
