"""Length-stratified search against plain Python."""

import math
import re
from collections import Counter

import numpy as np

from sentimill.llm import strata
from sentimill.llm.strata import search

_UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(_UPPER))


def brute(docs, queries, k=20):
    """(item, rank, id, score); documents as (id, text)."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in queries:
        scores = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // max(1, n_terms)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 12 * m))
                    for t in terms(text) if t in b)
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def made(n, seed):
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(60)] + ["Ñu", "ÉCOLE", "x1", "THE", "the"]
    p = 1 / np.arange(1, len(vocab) + 1)
    return [" ".join(rng.choice(vocab, int(rng.pareto(1.2) * 5) % 400, p=p / p.sum())) + rng.choice(["!", ""]) for _ in range(n)]


def test_against_brute_force(spark, monkeypatch):
    texts = made(600, 1)
    docs = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[5]) for i in range(60)]
    queries = list(enumerate(made(25, 2))) + [(100, None), (101, ""), (102, "nowhere"), (103, "the THE the"), (104, texts[5])]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    q = spark.createDataFrame(queries, "item_id bigint, text string")
    want = brute(docs, queries)
    assert found(search(d, q)) == want
    # small segments, an early threshold and several blocks of queries change nothing
    for name, value in (("SEGMENT", 16), ("FIRST", 25), ("QUERIES", 7)):
        monkeypatch.setattr(strata, name, value)
    assert found(search(d, q)) == want
    monkeypatch.setattr(strata, "VOCABULARY", 3)  # all terms are indexed
    assert found(search(d, q, k=5)) == brute(docs, queries, 5)


def test_bounds_hold_and_skip(spark, monkeypatch):
    """Strata below the threshold are not visited: the bound of each visited one reaches it."""
    texts = [f"rare common filler{i % 5} " + "common " * (i % 40) for i in range(400)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    q = spark.createDataFrame([(1, "rare common")], "item_id bigint, text string")
    monkeypatch.setattr(strata, "FIRST", 30)
    want = brute(list(enumerate(texts)), [(1, "rare common")])
    assert found(search(d, q)) == want
    index = strata.build_index(d)
    rows = strata.term_lists(q, "item_id", "text").select("id", "terms", "tfs").collect()
    block = strata._block(rows, index)

    class Held:
        value = block

    floor, visited = min(s for *_, s in want), []
    for m in [r.m for r in index.segments.select("m").distinct().collect()]:
        peaks = index.peaks.where(f"m = {m}").toArrow()
        bound = strata._bounds(Held)((peaks.column("m")[0],), peaks).column("bound").to_pylist()
        visited.append(bool(bound) and bound[0] >= floor)
    assert 0 < sum(visited) < len(visited)


def test_repeated_and_missing_ids(spark):
    docs = [(None, "one two"), (None, "one two"), (3, "one two"), (3, "one"), (None, None), (4, "")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    q = spark.createDataFrame([("a", "one"), ("a", "two"), (None, "two one")], "item_id string, text string")
    got = found(search(d, q))
    assert got == brute(docs, [("a", "one"), ("a", "two"), (None, "two one")])


def test_messy_rows(spark, messy, empty):
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    queries = [(1, "plain text of one"), (2, "una palabra fin 1 2"), (3, "漢字 Qué"), (4, None)]
    q = spark.createDataFrame([(*x, "x", "x") for x in queries], "item_id bigint, text string, q string, doc_id string")
    assert found(search(messy, q)) == brute(rows, queries)
    assert search(empty, q).count() == 0
    assert search(messy, q.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert search(messy, q.limit(0)).count() == 0
