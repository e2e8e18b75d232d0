"""Document operators against brute force, and on messy and empty tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sentimill.llm import dedup, fingerprint, jaccard, langid, license, mixing, packing, pii, queries, sharding
from sentimill.llm import words as W

from .conftest import LONG, ROWS

DOCS = "/root/testdata/sf0.001/documents.parquet"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(DOCS)


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


# ------------------------------------------------------------------ words

def test_words_of_long_and_empty_texts(monkeypatch):
    given_ = ["", "A b", None, LONG[:30_000], "x" * 5_000 + " y", "é–ß 1.2"]
    monkeypatch.setattr(W, "PIECE", 1_000)
    seen = 0
    for first, h, off in W.groups(pa.array(given_)):
        for k in range(len(off) - 1):
            want = [W.word_hash(x) for x in WORD.findall(lower(given_[first + k]))]
            assert h[off[k]:off[k + 1]].tolist() == want
            seen += 1
    assert seen == len(given_)


def test_shingles_and_sequences():
    for _, h, off in W.groups(pa.array(["a b c d e f", "a b", "", "a b c d e", "b a", "a b"])):
        s, at = W.shingles(h, off)
        assert np.diff(at).tolist() == [2, 1, 0, 1, 1, 1]
        assert s[at[0]] == s[at[3]] and s[at[1]] == s[at[5]] != s[at[4]]
        keys = W.sequence_keys(h, off)
        assert keys[1] == keys[5] and len(set(keys.tolist())) == 5


# ------------------------------------------------------------------ op1

def plain_spans(text):
    out = []
    for kind, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
                    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"),
                    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True,
                  "card": 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0,
                  "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return sorted(out, key=lambda z: (z[1], pii.ORDER[z[0]]))


def base_of(text):
    return sorted((s[:3] for s in pii.base_spans(text) if s[3]), key=lambda z: (z[1], pii.ORDER[z[0]]))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="0125.@+- ()a%Z\né", max_size=60))
def test_base_spans_equal_plain_patterns(text):
    assert base_of(text) == plain_spans(text)


def test_base_spans_of_documents_and_long_runs(texts):
    for t in texts.values():
        assert base_of(t) == plain_spans(t)
    for t in ("9" * 200_000, "a" * 200_000, "+1" + " " * 200_000, "1 " * 100_000, "a@" * 50_000):
        pii.base_spans(t)


def test_added_spans_and_messy_rows(spark, messy, empty):
    got = {}
    for r in pii.find_pii(messy).collect():
        got[r.doc_id] = [(s.kind, s.start, s.end) for s in r.spans if s.base]
    assert got[1] == got[2] == plain_spans(ROWS[0][1]) and got[3] == [] and got[11] == plain_spans(LONG)
    assert pii.find_pii(empty).count() == 0
    docs = spark.read.parquet(DOCS.replace("sf0.001", "sf0.01"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    added = [(texts[r.doc_id][s.start:s.end], s.kind) for r in pii.find_pii(docs).collect() for s in r.spans if not s.base]
    # secrets, and cards that stand in a row with others (their base match has too many digits)
    assert {k for _, k in added} == {"secret", "card"}
    assert all(re.fullmatch("[0-9a-f]{40}", t) if k == "secret" else re.fullmatch("[0-9]{16}", t) and pii.luhn(t) for t, k in added)
    assert all(f"{t} {t}" in " ".join(texts.values()) for t, k in added if k == "card")


def test_model_separates_hard_negatives_and_redacts():
    ex = pii.synthetic(3_000, seed=99)
    model = pii.train([(pii.features(k, t, a, b), y) for k, t, a, b, y in pii.synthetic(3_000)])
    p = model.probability(np.array([pii.features(k, t, a, b) for k, t, a, b, _ in ex]))
    picked = np.array([p[i] >= model.threshold[e[0]] for i, e in enumerate(ex)])
    truth = np.array([e[4] for e in ex], bool)
    assert truth[picked].mean() > 0.95 and picked[truth].mean() > 0.7
    t = 'password = "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567" and 1.2.3.4'
    assert pii.redact(t, pii.find([t], model)[0]) == 'password = "[secret]" and [ip]'


def test_generators_propose_the_items_of_a_row():
    rng = np.random.RandomState(4)

    def card():
        while True:
            d = "4" + "".join(map(str, rng.randint(0, 10, 15)))
            if pii.luhn(d):
                sep = ["", " ", "-"][rng.randint(3)]
                return sep.join(d[i:i + 4] for i in range(0, 16, 4))

    def phone():
        a, b, c = rng.randint(200, 999), rng.randint(200, 999), rng.randint(1000, 9999)
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1 {a} {b} {c}", f"{a}.{b}.{c}"][rng.randint(4)]

    makers = {"card": card, "phone": phone, "ip": lambda: ".".join(str(x) for x in rng.randint(1, 256, 4))}
    for _ in range(200):
        kind = list(makers)[rng.randint(3)]
        text, want = "x ", []
        for _ in range(rng.randint(1, 6)):
            item = makers[kind]()
            want.append((kind, len(text), len(text) + len(item)))
            text += item + " "
        proposed = {s[:3] for s in pii.base_spans(text)} | set(pii.added_candidates(text))
        assert set(want) <= proposed, text
    digits = "12 345 6789 01 2345 678 " * 4000  # linear in the text
    assert len(pii.added_candidates(digits)) < 60 * 4000


@pytest.mark.parametrize("text,kind,items", [
    ("call (212) 555-0100 (646) 555-0199 now", "phone", ["(212) 555-0100", "(646) 555-0199"]),
    ("card 4111 1111 1111 1111 5500 0000 0000 0004 paid", "card", ["4111 1111 1111 1111", "5500 0000 0000 0004"]),
    ("cards: 4111111111111111 5500000000000004 340000000000009", "card", ["4111111111111111", "5500000000000004"])])
def test_items_in_rows_are_found(pii_model, text, kind, items):
    found = [text[a:b] for k, a, b, *_ in pii.find([text], pii_model)[0] if k == kind]
    assert set(items) <= set(found)


def test_sample_is_bounded_in_candidates(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "train", lambda examples: seen.append(len(examples)))
    text = "1.2.3.4, 10.20.30.40, 4111 1111 1111 1111, " * 3000
    pii.fit(spark.createDataFrame([(1, text), (2, text + "x")], "doc_id long, text string"))
    assert 0 < seen[0] - len(pii.synthetic()) <= 2 * pii.SAMPLE_CANDIDATES


@pytest.fixture(scope="module")
def pii_model():
    return pii.train([(pii.features(k, t, a, b), y) for k, t, a, b, y in pii.synthetic()])


@pytest.mark.parametrize("lead", ["api_key=", "see https://x.example.com/a?access_token=", "export SECRET_KEY=", "A=1\nDB_PASSWORD="])
def test_value_of_an_assignment(pii_model, lead):
    t = lead + "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567"
    assert pii.redact(t, pii.find([t], pii_model)[0]) == lead + "[secret]"


# ------------------------------------------------------------------ op2

def test_language_of_held_out_texts(docs):
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
    assert sum(r.rejected for r in got) <= 0.03 * len(got)


def test_language_scores_by_brute_force(monkeypatch):
    monkeypatch.setattr(langid, "_PIECE", 64)
    rng = np.random.RandomState(0)
    table = rng.rand(langid.BINS + 1, 3).astype(np.float32)
    table[-1] = 0
    given_ = ["", "a", "ab", "Grüße " * 40, None, "xyz" * 70]
    sums, count = langid.text_scores(pa.array(given_), table)
    for i, t in enumerate(given_):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        want, n = np.zeros(3), 0
        for g in langid.GRAMS:
            if len(raw) >= g:
                b = langid.gram_bins(raw, np.full(len(raw), len(raw)), g)[:len(raw) - g + 1]
                want, n = want + table[b].astype(float).sum(axis=0), n + len(b)
        assert count[i] == n and np.allclose(sums[i], want, rtol=1e-4)


def test_language_messy(messy, empty):
    got = {r.doc_id: r for r in langid.identify(messy).collect()}
    for i in (3, 4, 5, 8):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert langid.identify(empty).count() == 0 and langid.keep_accepted(empty).count() == 0
    kept = langid.keep_accepted(messy)
    assert kept.columns == messy.columns and {r.doc_id for r in kept.collect()}.isdisjoint({3, 4, 5, 8})


@pytest.mark.parametrize("known", [("en", "de"), ("de", "en", "es", "fr")])
def test_gibberish_and_unlearnt_languages_are_rejected(spark, known):
    docs = spark.read.parquet(DOCS.replace("sf0.001", "sf0.01"))
    own = docs.where(F.col("lang").isin(*known))
    model = langid.fit(own.where(~langid.held_out(F.col("doc_id"))))
    rng = np.random.RandomState(1)
    gibberish = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz    "), 400)) for _ in range(40)]
    polish = ["Wszyscy ludzie rodzą się wolni i równi pod względem swojej godności i swych praw. Są oni obdarzeni rozumem",
              "i sumieniem i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa",
              "Nikogo nie wolno czynić niewolnikiem ani nakładać na nikogo służebności; nie wolno stosować tortur"]
    strange = spark.createDataFrame(list(enumerate(gibberish + polish)), "doc_id long, text string").withColumn("lang", F.lit("en"))
    got = [r.rejected for r in langid.identify(strange, model=model).orderBy("doc_id").collect()]
    assert sum(got[:40]) >= 38 and sum(got[40:]) >= 2
    if len(known) == 2:
        other = langid.identify(docs.where("lang in ('fr', 'es') and length(text) > 300"), model=model).collect()
        assert sum(r.rejected for r in other) >= 0.8 * len(other)
    clean = langid.identify(own, model=model).where("held_out").collect()
    assert sum(r.rejected for r in clean) <= 0.03 * len(clean)


def test_sample_is_bounded_for_null_and_repeated_ids(spark, monkeypatch):
    n = spark.range(6_000)
    docs = n.select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit("en").alias("lang"),
                    F.concat_ws(" ", F.lit("mail a.b@example.com text"), F.when(F.col("id") % 2 > 0, F.col("id"))).alias("text"))
    seen = []
    monkeypatch.setattr(langid, "train", lambda rows: seen.append(len(rows)) or langid.Model(
        ["en"], np.zeros((langid.BINS + 1, 1), np.float32), np.zeros(1), 1.0, np.zeros(langid.LEVELS), np.zeros((0, 2))))
    for ids in (docs, docs.withColumn("doc_id", F.lit(None).cast("long"))):
        langid.fit(ids, per_language=100)
    assert seen[0] == 100 and 60 <= seen[1] <= 100
    monkeypatch.setattr(pii, "train", lambda examples: seen.append(len(examples)))
    pii.fit(docs.withColumn("doc_id", F.lit(None).cast("long")), sample_docs=300)
    assert seen[2] - len(pii.synthetic()) <= 400


def test_thresholds_rise_with_the_subwords():
    score, count = np.tile(np.linspace(0.5, 1, 10_001), 2), np.repeat([20, 300], 10_001)
    score[10_001:] += 0.3 * (1 - score[10_001:])
    got = langid.thresholds(score, count)
    assert got[:4].tolist() == [0] * 4 and np.allclose(got[4:8], 0.5005) and np.allclose(got[8:], 0.65035)
    assert np.allclose(langid.thresholds(score, count[::-1])[4:], (0.5005 + 0.65035) / 2, rtol=1e-3)


# ------------------------------------------------------------------ op4

def test_fingerprints_by_brute_force(spark, docs, texts):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    got = {r.doc_id: r for r in fingerprint.compare_with_next(docs).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    ids = sorted(texts)
    assert len(got) == len(ids)
    for i, nxt in zip(ids, ids[1:] + ids[:1]):
        t, k = texts[i], len(texts[i]) // 4
        e = t[:len(t) - k] + texts[nxt][:k]
        a, b, c = (fingerprint.weights(x.encode()) for x in (t, e, texts[nxt]))
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert got[i].fingerprint == fingerprint.as_text(a) and got[i].edited_fingerprint == fingerprint.as_text(b)
        assert got[i].near_edited == pytest.approx(fingerprint.containment(a, b))
        assert got[i].near_next == pytest.approx(fingerprint.containment(a, c))
        if len(t) > 1_000:
            assert 0.6 < got[i].near_edited < 0.8


def test_gear_hash_and_chunks():
    raw = np.random.RandomState(3).randint(0, 256, 500).astype(np.uint8)
    want, h = [], 0
    for b in raw:
        h = ((h << 1) + int(fingerprint._GEAR[b])) % (1 << 32)
        want.append(h)
    assert fingerprint.gear_hash(raw).tolist() == want
    for n in (0, 1, 24, 25, 500):
        c = fingerprint.chunks(raw[:n].tobytes())
        assert [a for a, _ in c] == [0, *[b for _, b in c]][:len(c)] and (not n or c[-1][1] == n)
        assert all(fingerprint.LEAST <= b - a <= fingerprint.MOST for a, b in c[:-1])
    same = b"".join(bytes([i % 251]) * 3 for i in range(2_000))
    assert fingerprint.containment(fingerprint.weights(raw.tobytes() * 8), fingerprint.weights(b"inserted" + raw.tobytes() * 8)) > 0.8
    assert fingerprint.containment(fingerprint.weights(same), fingerprint.weights(raw.tobytes())) < 0.1


def test_fingerprint_messy(messy, empty, spark):
    got = fingerprint.compare_with_next(messy).collect()
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = Counter((r[0], len(r[1] or ""), hashlib.sha256(fingerprint.edited(r[1] or "", n[1] or "").encode()).hexdigest())
                   for r, n in zip(order, order[1:] + order[:1]))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert fingerprint.compare_with_next(empty).count() == 0
    one = fingerprint.compare_with_next(spark.createDataFrame([(1, "alone " * 30)], "doc_id long, text string")).first()
    assert one.near_next == 1.0
    assert Counter(r.doc_id for r in fingerprint.fingerprints(messy).collect()) == Counter(r[0] for r in ROWS)


def slow_chunks(data):
    """Byte by byte: the gear hash, and a cut where it has enough zero bits for the size so far."""
    out, start, h, hashes = [], 0, 0, []
    for b in data:
        h = ((h << 1) + int(fingerprint._GEAR[b])) & 0xFFFFFFFF
        hashes.append(h)
    for end in range(1, len(data) + 1):
        size, zeros = end - start, 32 - hashes[end - 1].bit_length()
        if len(data) - start <= fingerprint.LEAST:
            break
        if size >= fingerprint.LEAST and (zeros >= fingerprint.STRICT if size < fingerprint.NORMAL else
                                          zeros >= fingerprint.LOOSE or size == fingerprint.MOST) or end == len(data):
            out.append((start, end))
            start = end
    return out + [(start, len(data))] * (start < len(data))


def test_chunks_against_a_byte_by_byte_chunker(texts):
    rng = np.random.RandomState(6)
    made = [rng.bytes(n) for n in (0, 1, 24, 25, 56, 57, 192, 193, 5000)] + [b"a" * 1000, b"ab" * 700]
    for data in made + [t.encode() for t in list(texts.values())[:40]]:
        assert fingerprint.chunks(data[:6000]) == slow_chunks(data[:6000])


def test_fingerprints_of_a_hot_id_are_spread(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, null, id) AS doc_id", "concat('text number ', id) AS text")
    got = fingerprint.compare_with_next(rows)
    assert got.count() == 3000
    edges = fingerprint._edges(rows.selectExpr("coalesce(doc_id, -1L) AS key", "xxhash64(text) AS h"), 8)
    assert len(edges) >= 7 and sum(e[0] == -1 for e in edges) >= 2
    # the order is one cycle: each text is the next of exactly one
    nexts = {r.near_next for r in got.collect()}
    assert all(0 <= x <= 1 for x in nexts)


# ------------------------------------------------------------------ op5

def brute_classes(rows):
    """id -> (copy_id, copies, class_id, n_links), by comparing all pairs of word sequences."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[tuple(WORD.findall(lower(t)))].append(i)
    sets = {w: frozenset(w[k:k + 5] for k in range(max(1, len(w) - 4))) for w in groups if w}
    label, links = {w: min(ids) for w, ids in groups.items() if w}, Counter()
    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            x, y = label[a], label[b]
            label = {w: min(x, y) if c in (x, y) else c for w, c in label.items()}
    return {i: (min(ids), len(ids), label[w], links[w]) if w else (i, 1, i, 0) for w, ids in groups.items() for i in ids}


def test_near_duplicates_by_brute_force(spark, docs, texts, monkeypatch):
    rng = np.random.RandomState(4)
    rows = list(texts.items())
    base = WORD.findall(lower(max(texts.values(), key=len)))[:150]
    for k in range(60):  # a hot group at similarities around the threshold
        w = list(base)
        for at in rng.randint(0, len(w), rng.randint(0, 5)):
            w[at] = f"w{rng.randint(1000)}"
        rows.append((10_000 + k, " ".join(w)))
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", 7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.copy_id, r.copies, r.class_id, r.n_links) for r in jaccard.near_duplicates(df).collect()}
    want = brute_classes(rows)
    assert got == want
    assert max(v[3] for v in want.values()) > 20
    assert {r.doc_id for r in jaccard.keep_one(df).collect()} == {i for i, v in want.items() if v[2] == i}


def test_pruning_keeps_pairs_at_the_threshold():
    least = jaccard.least_matches(0.8, 1e-7)
    assert len(least) == jaccard.PERMS // jaccard.STEP and least == sorted(least) and least[-1] < 0.8 * jaccard.PERMS
    sets = [np.unique(np.random.RandomState(i).randint(0, 1 << 60, 300).astype(np.uint64)) for i in range(90)]
    a, b = np.triu_indices(90, 1)
    assert jaccard._shared(sets, a, b).tolist() == [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b)]


def test_near_duplicates_messy(messy, empty):
    got = defaultdict(set)
    for r in jaccard.near_duplicates(messy).collect():
        got[r.doc_id].add((r.copy_id, r.copies, r.class_id, r.n_links))
    assert got[1] == got[2] == {(1, 3, 1, 0)} and got[3] == {(3, 1, 3, 0)} and got[8] == {(8, 1, 8, 0)}
    assert got[9] == got[10] == {(9, 2, 9, 0)} and got[None] == {(None, 1, None, 0)}
    assert jaccard.near_duplicates(empty).count() == 0
    kept = jaccard.keep_one(messy)
    assert kept.columns == messy.columns
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in kept.collect()) == sorted(
        [(False, 0)] + [(True, i) for i in (1, 3, 4, 5, 7, 8, 9, 11)])


# ------------------------------------------------------------------ op6

def test_boundaries_are_optimal():
    rng = np.random.RandomState(1)
    for _ in range(30):
        n = rng.randint(1, 9)
        longest = np.sort(rng.choice(50, n, replace=False) + 1).astype(float)
        count = rng.randint(1, 9, n)
        ends = packing.boundaries(count, count * longest, longest, 3)

        def padding(cut):
            out, a = 0, 0
            for e in cut:
                out += sum(c * (longest[e] - x) for c, x in zip(count[a:e + 1], longest[a:e + 1]))
                a = e + 1
            return out
        best = min(padding(list(c) + [n - 1]) for k in range(3) for c in combinations(range(n - 1), k))
        assert ends[-1] == n - 1 and len(ends) <= 3 and padding(ends) == pytest.approx(best)


def check_packing(rows, budget):
    by = defaultdict(list)
    for r in rows:
        assert r.n_tokens <= r.bucket_length
        by[r.bucket, r.batch].append(r)
    last = {b: max(x for c, x in by if c == b) for b, _ in by}
    for (b, batch), group in by.items():
        assert sorted(r.slot for r in group) == list(range(len(group)))
        full = max(1, budget // max(1, group[0].bucket_length))
        assert len(group) == full if batch < last[b] else 0 < len(group) <= full
    assert all({x for c, x in by if c == b} == set(range(last[b] + 1)) for b in last)


def test_packing(docs, texts, messy, empty):
    got = packing.pack(docs, budget=2_000).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts.items()}
    check_packing(got, 2_000)
    rows = packing.pack(messy, budget=50, carry=("id", "bucket")[:1]).collect()
    check_packing(rows, 50)
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in ROWS) and all(r.id == "x" for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {0}
    assert packing.pack(empty).count() == 0


def least_padding(lengths, k):
    """By the plain recursion over the distinct lengths, in whole numbers."""
    n = Counter(lengths)
    size = sorted(n)
    docs, toks = [0], [0]
    for x in size:
        docs.append(docs[-1] + n[x])
        toks.append(toks[-1] + x * n[x])
    best = [0] + [math.inf] * len(size)
    for _ in range(k):
        best = [0] + [min(best[i] + size[j - 1] * (docs[j] - docs[i]) - toks[j] + toks[i] for i in range(j)) for j in range(1, len(size) + 1)]
    return best[-1]


def test_padding_of_long_lengths_is_the_least():
    rng = np.random.RandomState(2)
    for k in (1, 2, 5, 8):
        lengths = np.concatenate([rng.randint(0, 3_000, 200), (rng.pareto(1.0, 150) * 900).astype(int).clip(0, 10 ** 7)]).tolist()
        n = sorted(Counter(lengths).items())
        ends = packing.boundaries([c for _, c in n], [x * c for x, c in n], [x for x, _ in n], k)
        tops = [n[e][0] for e in ends]
        assert len(ends) <= k and sum(min(t for t in tops if t >= x) - x for x in lengths) == least_padding(lengths, k)


def test_packing_query_pads_least(spark):
    rows = [(i, "w " * n) for i, n in enumerate([0, 1, 5, 900, 1023, 1024, 1025, 1026, 1300, 2047, 2048, 2049, 5000, 5001, 9999, 20_000] * 2 + [7] * 30)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), buckets=5).collect()
    assert sum(r.bucket_length - r.n_tokens for r in got) == least_padding([r.n_tokens for r in got], 5)
    check_packing(got, packing.BUDGET)


def test_packing_spreads_a_hot_id(spark, monkeypatch):
    monkeypatch.setattr(packing, "HOT_ID", 100)
    df = spark.range(3000).selectExpr("if(id % 3 = 0, null, id) AS doc_id", "'one text' AS text")
    got = packing.pack(df, budget=64)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert got.count() == 3000 and "_hot" in plan
    check_packing(got.collect(), 64)


# ------------------------------------------------------------------ op7

def test_poisson_mixing(spark, docs, messy, empty):
    d = docs.select("doc_id", "source")
    got = mixing.mix(d, weights={"src0": 3.0, "src1": 1.0}, epochs=2.0).collect()
    n = Counter(r.source for r in d.collect())
    total = sum(n.values())
    rate = {"src0": 2 * total * 0.75 / n["src0"], "src1": 2 * total * 0.25 / n["src1"]}
    want = Counter()
    for r in d.collect():
        lam = rate.get(r.source)
        if lam is None:
            continue
        parts = max(1, math.ceil(lam / mixing.PART))
        for k in range(1, parts + 1):
            u = int(hashlib.md5(f"{mixing.SEED}:{r.doc_id}:{k}".encode()).hexdigest()[:13], 16) / 2 ** 52
            p = c = math.exp(-lam / parts)
            x = 0
            while c <= u:
                x += 1
                p *= lam / parts / x
                c += p
            want[r.doc_id] += x
    assert Counter(r.doc_id for r in got) == +want
    assert all(sorted(r.mix_copy for r in got if r.doc_id == i) == list(range(want[i])) for i in list(want)[:20])
    assert len({r.mix_key for r in got}) == len(got)
    big = mixing.mix(spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a").alias("source")), epochs=100.0).count()
    assert abs(big - 30_000) < 1_000
    m = mixing.mix(messy)
    assert m.columns == messy.columns + ["mix_rate", "mix_copy", "mix_key"]
    assert {r.source for r in mixing.mix(messy, epochs=50.0).collect()} == {None, "s0", "s1", "s2"}
    assert mixing.mix(empty).count() == 0


def test_mixing_of_null_and_repeated_ids(spark):
    """Rows that share an id draw apart: the counts are those of independent draws."""
    n = 6_000
    for ident in ("if(id % 3 = 0, null, id)", "if(id % 3 = 0, 7000, id)"):
        df = spark.range(n).selectExpr(f"{ident} AS doc_id", "concat('text ', if(id % 2 = 0, '', string(id))) AS text", "'a' AS source")
        got = mixing.mix(df)
        total, hot = got.count(), got.where("doc_id is null or doc_id = 7000").count()
        assert abs(total - n) < 3 * math.sqrt(n) and abs(hot - n / 3) < 3 * math.sqrt(n / 3)
        assert got.select("mix_key").distinct().count() == total
        sizes = [len(p) for p in got.rdd.glom().collect()]
        assert max(sizes) < 2 * total / len(sizes)
        assert [tuple(r) for r in mixing.mix(df).orderBy("mix_key").collect()] == [tuple(r) for r in got.orderBy("mix_key").collect()]


def test_mixing_query_keeps_whole_documents(spark, docs):
    got = queries.QUERIES["op7_poisson_mixing"](spark, DOCS.rsplit("/", 1)[0])
    assert got.columns == docs.columns + ["mix_rate", "mix_copy", "mix_key"]
    rows = {r.doc_id: tuple(r) for r in docs.collect()}
    got = got.collect()
    assert got and all(tuple(r)[:len(docs.columns)] == rows[r.doc_id] for r in got)


# ------------------------------------------------------------------ op8

def test_hilbert_curve_is_continuous(spark):
    cells = spark.range(512).select((F.col("id") % 8).alias("a"), (F.col("id") / 8 % 8).cast("int").alias("b"),
                                    (F.col("id") / 64).cast("int").alias("c"))
    got = cells.withColumn("h", sharding.hilbert_index([F.col("a"), F.col("b"), F.col("c")], 3)).orderBy("h").collect()
    assert [r.h for r in got] == list(range(512))
    assert all(abs(x.a - y.a) + abs(x.b - y.b) + abs(x.c - y.c) == 1 for x, y in zip(got, got[1:]))


def test_sharding(docs, texts, messy, empty):
    for df, rows in ((docs, [(i, t) for i, t in texts.items()]), (messy, [r[:2] for r in ROWS])):
        got = sharding.shard(df, 8).collect()
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
            (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
        shards = defaultdict(list)
        for r in got:
            shards[r.shard].append(r.slot)
        sizes = [len(shards[s]) for s in range(8)]
        assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in shards.values())
    at = defaultdict(set)  # equal texts are parted by the seven cuts at most
    for r in sharding.shard(docs, 8).collect():
        at[texts[r.doc_id]].add(r.shard)
    assert sum(len(s) - 1 for s in at.values()) <= 7
    assert sharding.shard(empty, 8).count() == 0


def test_shards_prune(docs):
    got = sharding.shard(docs, 8, carry=("source", "lang")).collect()
    per = [len({r.lang for r in got if r.shard == s}) * len({r.source for r in got if r.shard == s}) for s in range(8)]
    assert sum(per) < 0.75 * 8 * len({r.lang for r in got}) * len({r.source for r in got})


def test_sharding_against_brute_force(docs):
    import xxhash

    def key(text):
        return int.from_bytes(xxhash.xxh64(text.encode(), seed=42).digest(), "big", signed=True)

    rows = docs.select("doc_id", "text", "source", "lang").collect()
    first = {}
    for r in sorted(rows, key=lambda r: r.doc_id):
        first.setdefault(r.text or "", r)
    digits, states = sharding.curve_table(3)

    def curve(r):
        f, size = first[r.text or ""], len((r.text or "").encode()) + 1
        cells = [key("\0" if f.source is None else f.source) % 64, key("\0" if f.lang is None else f.lang) % 64,
                 min(63, math.floor(math.log2(size) * 2))]
        h = state = 0
        for level in range(5, -1, -1):
            at = state * 8 + sum((c >> level & 1) << k for k, c in enumerate(cells))
            h, state = h * 8 + digits[at], states[at]
        return h, key(r.text or ""), r.doc_id
    order = sorted(rows, key=curve)
    n, want = len(rows), {}
    for idx, r in enumerate(order):
        s = idx * 8 // n
        data = (r.text or "").encode()
        want[r.doc_id] = (len(data) + 1, zlib.crc32(data), s, idx - -(-s * n // 8))
    got = {r.doc_id: (r["size"], r.text_crc32, r.shard, r.slot) for r in sharding.shard(docs, 8).collect()}
    assert got == want


# ------------------------------------------------------------------ op9

def test_exact_dedup(spark, docs, texts, messy, empty, monkeypatch):
    for bits in (dedup.MAX_BITS, 1 << 15):
        monkeypatch.setattr(dedup, "MAX_BITS", bits)
        groups = defaultdict(list)
        for i, t in texts.items():
            groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)].append(i)
        got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in dedup.dedup_report(docs).collect()}
        assert got == {i: (min(v), len(v), i == min(v), hashlib.sha256(k.encode()).hexdigest()) for k, v in groups.items() for i in v}
        assert {r.doc_id for r in dedup.keep_first(docs).collect()} == {min(v) for v in groups.values()}
    rows = dedup.dedup_report(messy).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows) == Counter(
        [(1, 1, 3, True), (2, 1, 3, False), (2, 1, 3, False), (3, 3, 2, True), (4, 3, 2, False), (5, 5, 1, True),
         (None, None, 1, True), (7, 7, 1, True), (8, 8, 1, True), (9, 9, 2, True), (10, 9, 2, False), (11, 11, 1, True)])
    kept = dedup.keep_first(messy)
    assert kept.columns == messy.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 3, 5, None, 7, 8, 9, 11])
    assert dedup.dedup_report(empty).count() == 0 and dedup.keep_first(empty).count() == 0


def test_exact_dedup_by_ranges(spark, messy, monkeypatch):
    """More rows than one filter is for: each range of hashes has its own; the result is the same."""
    rows = spark.range(4000).selectExpr("if(id % 7 = 0, null, id) AS doc_id", "concat('text  ', id % 3000) AS text", "id AS `a.b`")
    for df in (rows, messy):
        want, kept = dedup.dedup_report(df), dedup.keep_first(df)
        want, kept = Counter(map(tuple, want.collect())), Counter((r.doc_id, r.text) for r in kept.collect())
        monkeypatch.setattr(dedup, "MAX_BITS", 1 << 15)
        monkeypatch.setattr(dedup, "BITS_PER_ROW", 32 if df is rows else 10_000)
        assert dedup.n_ranges(df.count()) > 2
        got = dedup.keep_first(df)
        assert got.columns == df.columns and Counter((r.doc_id, r.text) for r in got.collect()) == kept
        report = Counter(map(tuple, dedup.dedup_report(df).collect()))
        if df is rows:  # among rows without an id any may stay
            assert report == want
        else:
            assert {r[0] for r in report} == {r[0] for r in want} and sum(report.values()) == sum(want.values())
        monkeypatch.undo()
    n = 4000
    monkeypatch.setattr(dedup, "MAX_BITS", 1 << 15)
    h = spark.range(n).select(F.sha2(F.col("id").cast("string"), 256).alias("sha"))
    bits = dedup.filter_bits(n // dedup.n_ranges(n))
    part = h.where(F.pmod(F.xxhash64("sha", F.lit(2)), F.lit(dedup.n_ranges(n))) == 0)
    flagged = dedup.with_maybe_repeated(part, "sha", dedup.repeated_bits(part, "sha", bits), bits)
    assert flagged.where("_maybe").count() < 0.05 * part.count()


# ------------------------------------------------------------------ op10

def as_expression(markup):
    """A template as a plain regular expression over words that are each followed by a blank."""
    out = []
    for t in re.findall(r"\[\[|\]\]|\{\{[0-9-]+\}\}|[0-9a-z\x80-\U0010FFFF]+", markup.lower()):
        if t == "[[":
            out.append("(?:")
        elif t == "]]":
            out.append(")?")
        elif t.startswith("{{"):
            least, _, most = t[2:-2].rpartition("-")
            out.append(f"(?:[^ ]+ ){{{least or 1},{most}}}")
        else:
            out.append(f"{t} ")
    return re.compile("(?:^|(?<= ))" + "".join(out))


def drawn(markup, rng):
    """A text that a template describes."""
    out, depth, skip = [], 0, None
    for t in re.findall(r"\[\[|\]\]|\{\{[0-9-]+\}\}|[^\s\[\]{}]+", markup):
        if t == "[[":
            depth += 1
            if skip is None and rng.rand() < 0.5:
                skip = depth
        elif t == "]]":
            skip = None if skip == depth else skip
            depth -= 1
        elif skip is None and t.startswith("{{"):
            least, _, most = t[2:-2].rpartition("-")
            out += [str(rng.randint(1, 9)) for _ in range(rng.randint(int(least or 1), int(most) + 1))]
        elif skip is None:
            out.append(t)
    return out


def test_templates_against_regular_expressions(spark):
    rng = np.random.RandomState(8)
    expressions = [(label, as_expression(t)) for label, t in license.TEMPLATES]
    rows = []
    for _, t in license.TEMPLATES * 4:
        words = drawn(t, rng)
        if rng.rand() < 0.4 and len(words) > 3:  # one word is missing or another
            at = rng.randint(len(words))
            words[at:at + 1] = [] if rng.rand() < 0.5 else ["other"]
        rows.append((len(rows), " ".join(["some", "text", *words, *drawn(license.TEMPLATES[rng.randint(len(license.TEMPLATES))][1], rng)])))
    got = {r.doc_id: r.labels for r in license.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    some = 0
    for i, text in rows:
        words = "".join(f"{w} " for w in WORD.findall(lower(text)))
        want = {label for label, x in expressions if x.search(words)} | {label for phrase, label in license.BASE if f" {phrase} " in f" {words}"}
        assert got[i] == ",".join(sorted(want)), text
        some += len(want)
    assert some > len(rows)


@pytest.mark.parametrize("text,label", [
    ("Licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("This work is under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 license", "cc-by-nc"),
    ("a Creative Commons Attribution-ShareAlike 3.0 Unported License", "cc-by-sa"),
    ("This file is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "gpl"),
    ("under the terms of the GNU Lesser General Public License as published", "gpl,lgpl"),
    ("the GNU Affero General Public License", "agpl,gpl"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy", "mpl-2.0"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
     "that the above copyright notice and this permission notice appear in all copies.", "isc"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("// SPDX-License-Identifier: BSD-2-Clause", "bsd-2-clause"),
    ("a creative writing class: attribution 4 points, common sense 3", "")])
def test_common_notices(text, label):
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["id", "text"])
    out = list(license._scan(license.Scanner.of())(iter([batch])))[0]
    assert out.column(6).to_pylist() == [label]


def test_templates():
    a = license.compile_template("t", "grant [[all of]] rights to {{1-3}} under [[the [[old]] law]] end")

    def accepts(text):
        nodes = a.closure({0})
        for w in text.split():
            nodes = a.step(nodes, W.word_hash(w))
        return a.end in nodes
    for ok in ("grant rights to x under end", "grant all of rights to x y z under the law end",
               "grant rights to under under the old law end"):
        assert accepts(ok)
    for no in ("grant rights to under end", "grant all rights to x under end", "grant rights to a b c d under end",
               "grant rights to x under the old end", "grant rights to x under end more"):
        assert not accepts(no)
    with pytest.raises(ValueError):
        license.compile_template("t", "a [[b")


def test_license_scan(spark, docs, texts, messy, empty):
    got = {r.doc_id: r for r in license.scan_licenses(docs).collect()}
    for i, t in texts.items():
        w = WORD.findall(lower(t))
        at = [(k, label) for phrase, label in license.BASE for k in range(len(w))
              if w[k:k + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(w), len(at))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and {x for _, x in at} <= set(r.labels.split(","))
    mit = dict(license.TEMPLATES[::-1])["mit"]
    full = next(t for n, t in license.TEMPLATES if n == "mit" and len(t) > 500)
    assert mit
    whole = full.replace("[[(including the next paragraph)]] ", "")
    rows = [(0, "x " + whole + " y"), (1, whole.replace("free of charge", "for a charge")), (2, whole.upper().replace(" ", "\n")),
            (3, whole + " " + "Licensed under CC BY-NC 4.0.")]
    m = {r.doc_id: r for r in license.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [m[i].labels for i in range(4)] == ["mit", "", "mit", "cc-by-nc,mit"]
    assert m[0].score == 1.0 and 0 < m[1].score < 0.3
    got = Counter((r.doc_id, r.n_words, r.labels) for r in license.scan_licenses(messy).collect())
    assert got[(7, 7, "mit")] == 1 and got[(3, 0, "")] == 1 and got[(2, 17, "")] == 2
    assert license.scan_licenses(empty).count() == 0
