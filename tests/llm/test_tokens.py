"""Simple-8b and token files: exact round trips, and ids against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sentimill.llm import simple8b, tokenbin
from sentimill.llm.words import buffers
from sentimill.session import scratch_path

MODEL = public_tokenizers.path("byte_bpe_50k.json")


def round_trip(values):
    p = simple8b.pack(np.array(values, np.uint64))
    back = simple8b.from_bytes(p.n, *simple8b.to_bytes(p))
    assert simple8b.unpack(back).tolist() == list(values)
    return p


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=1300))
def test_simple8b_round_trip(values):
    round_trip(values)


def test_simple8b_words_by_hand():
    assert len(round_trip([0] * 512).words) == 3          # 240, 240 and the 32 that are left of the block
    assert len(round_trip([1] * 120).words) == 2
    p = round_trip([5, 1 << 40, 7])
    assert p.escape_at.tolist() == [1] and p.escape_value.tolist() == [1 << 40]
    assert p.words.tolist() == [4 << 60 | 5 | 7 << 6]  # room for twenty of 3 bits
    assert round_trip([]).blocks.tolist() == [0]


def test_simple8b_blocks_decode_alone():
    values = np.random.default_rng(3).integers(0, 50_000, 5000).astype(np.uint64)
    p = simple8b.pack(values)
    for b in range(len(p.blocks) - 1):
        n = min(simple8b.BLOCK, p.n - b * simple8b.BLOCK)
        words = p.words[p.blocks[b]:p.blocks[b + 1]]
        alone = simple8b.Packed(n, words, np.array([0, len(words)]), np.zeros(0, np.int64), np.zeros(0, np.uint64))
        assert (simple8b.unpack(alone) == values[b * simple8b.BLOCK:][:n]).all()


def ids_of(texts, encoder):
    raw, offsets = buffers(pa.array(texts))
    ids, ends = encoder.ids(raw, offsets)
    return [x.tolist() for x in np.split(ids, ends[:-1])]


PIECES = ["a", "  ", " ", "\n", "\t", "don't", "'re", "x1", "ñ", "é.", "×", "÷b", "ÿ", "漢字", " ", "　", "...", ",", "É", "s's", "<|endof", "text|>", "😀"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=6))
def test_pieces_have_the_ids_of_the_whole_text(texts):
    encoder = _encoder()
    assert ids_of(texts, encoder) == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_forgotten_pieces_are_tokenised_again(monkeypatch):
    monkeypatch.setattr(tokenbin, "KNOWN", 8)
    with open(MODEL, encoding="utf-8") as f:
        encoder = tokenbin.Encoder(f.read())
    for i in range(30):
        texts = [f"some words {'abcdefghij'[i % 10]}x come back {i % 3} times", "ñandú come back"]
        assert ids_of(texts, encoder) == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


_made = []


def _encoder():
    if not _made:
        with open(MODEL, encoding="utf-8") as f:
            _made.append(tokenbin.Encoder(f.read()))
    return _made[0]


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        encoder = tokenbin.Encoder(f.read())
    texts = ["Hello  World", "", "one two  three.", "  "]
    assert ids_of(texts, encoder) == [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_runs_are_cut_into_segments_of_whole_documents(monkeypatch):
    from types import SimpleNamespace

    monkeypatch.setattr(tokenbin, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    monkeypatch.setattr(tokenbin, "SEGMENT", 60)
    texts = [f"text {i} " * (i % 9) for i in range(50)] + ["a long text " * 30, "", "end"]
    with open(MODEL, encoding="utf-8") as f:
        model = SimpleNamespace(value=f.read())
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    rows = list(tokenbin._segments(model, 0)(iter([batch, batch.slice(0, 2)])))
    assert len(rows) > 20 and [r.column(1)[0].as_py() for r in rows] == list(range(len(rows)))
    start, seen = 0, []
    for r in rows:
        assert r.column(0)[0].as_py() == 3 and r.column(2)[0].as_py() == start
        start += r.column(3)[0].as_py()
        for docs, ids, ends, _ in tokenbin._documents(r):
            seen += zip(docs.to_pylist(), [x.tolist() for x in np.split(ids, ends[:-1])])
    want = [x + [0] for x in ids_of(texts, _encoder())]
    assert seen == [*enumerate(want), (0, want[0]), (1, want[1])]


def test_files_of_messy_rows(spark, messy):
    path = scratch_path(spark, "tokens")
    tokenbin.write(messy, path, MODEL)
    got = tokenbin.read(spark, path).collect()
    sums = tokenbin.read_sums(spark, path).collect()
    tok = Tokenizer.from_file(MODEL)
    want = sorted(((r.doc_id is not None, r.doc_id or 0), tok.encode(r.text or "", add_special_tokens=False).ids + [0])
                  for r in messy.select("doc_id", "text").collect())
    in_order = sorted(got, key=lambda r: r.start)
    # rows that share an id (two equal ones here) follow each other
    assert [((r.doc_id is not None, r.doc_id or 0), r.ids) for r in in_order] == want
    ends = np.cumsum([len(r.ids) for r in in_order])
    assert [r.start for r in in_order] == [0, *ends[:-1].tolist()]
    assert sorted((r.start, r.n_tokens, r.ids_crc32) for r in sums) == [
        (r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in in_order]


def test_a_hot_id_is_spread(spark):
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, null, id) AS doc_id", "'same text' AS text")
    path = scratch_path(spark, "tokens")
    tokenbin.write(rows, path, MODEL)
    parts = [r["count"] for r in spark.read.parquet(path).selectExpr("part", "explode(docs) AS d").groupBy("part").count().collect()]
    assert max(parts) < 2 * 3000 / len(parts)
    assert tokenbin.read(spark, path).count() == 3000


@pytest.mark.parametrize("read", [tokenbin.read, tokenbin.read_sums])
def test_files_of_an_empty_table(spark, empty, read):
    path = scratch_path(spark, "tokens")
    tokenbin.write(empty, path, MODEL)
    assert read(spark, path).count() == 0


def test_query_against_the_tokenizer(spark):
    from sentimill.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op13_simple8b_token_files"](spark, sf).collect()}
    tok, start, want = Tokenizer.from_file(MODEL), 0, {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        want[r.doc_id] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert got == want
