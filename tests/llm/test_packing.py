"""Operator 6 against a plain loop over the same documents."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tillroll.llm import packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(str(public_tokenizers.path(packing.VOCABULARY)))


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check(pieces, docs, tokenizer, size):
    """Every id in exactly one piece; sequences gapless and full but the last."""
    want = {d: ids_of(tokenizer, t) for d, t in docs}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = want[p.doc_id][p.start : p.start + p.length]
        assert p.length > 0 and len(ids) == p.length and p.doc_tokens == len(want[p.doc_id])
        assert p.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        by_doc[p.doc_id].append((p.start, p.length))
        by_seq[p.sequence_id].append((p.offset, p.length))
    assert set(by_doc) == set(want)
    for d, x in by_doc.items():
        at = 0
        for s, n in sorted(x):
            assert s == at
            at += n
        assert at == len(want[d])
    full = []
    for x in by_seq.values():
        at = 0
        for s, n in sorted(x):
            assert s == at
            at += n
        full.append(at)
    assert sorted(full)[1:] == [size] * (len(full) - 1) and max(full, default=0) <= size
    assert sorted(by_seq) == list(range(len(by_seq)))


def test_query_matches_brute_force(spark, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    out = packing.query(spark, SF).collect()
    check(out, docs, tokenizer, packing.SEQUENCE_TOKENS)


def test_edge_cases(spark, tokenizer):
    docs = [
        (1, None), (2, ""), (3, "a"), (4, "Word " * 500), (5, "x <|endoftext|> Y<|ENDOFTEXT|>"), (6, "É é A b\tc\n"),
        (7, "word."), (8, "don't   'S it's"),
    ]
    df = spark.createDataFrame([(d, t, "clash", 9) for d, t in docs], "doc_id long, text string, part string, ids int").repartition(3)
    check(packing.digests(packing.pack(df, size=16)).collect(), docs, tokenizer, 16)


def test_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a b"), (1, "c"), (1, "c")], "doc_id long, text string")
    out = packing.digests(packing.pack(df, size=4)).collect()
    assert sum(p.length for p in out) == 3 + 2 + 2
    assert packing.digests(packing.pack(df.limit(0), size=4)).collect() == []


def test_word_memory_is_bounded(tokenizer, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "WORDS_KEPT", 5)
    enc = packing.WordEncoder(str(public_tokenizers.path(packing.VOCABULARY)))
    for text in ("one two three", "four five six seven", "a b c d e f g h", "one"):
        (got,) = enc.encode([text])
        assert np.frombuffer(got, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_encode_like_whole_texts(tokenizer):
    import public_tokenizers

    enc = packing.WordEncoder(str(public_tokenizers.path(packing.VOCABULARY)))
    texts = [
        "Straße, œuvre. naïve e\u0301 e\u0301, \u0130stanbul ΟΔΟΣ, ªº, Ǆ. 日本語, 日本語。", "a., b,. c.. d.. 1. 2, x1. ½ Ⅷ ١٢", "", " ",
        "\u00a0x\u2028y z\u200b", "it's o'clock, 're. 'll, don't.", "ﬁ ﬃ, ＡＢＣ. 𝐀𝐁, e\u0327\u0301. ǰ, ΐ. ŉ", "<| x <|endoftext|>,",
    ]
    for text, got in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(got, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_words_are_given_places_once(tokenizer, monkeypatch):
    """A word, stem or tail is learnt when first met; the next turn knows the words of
    the last one, not those before."""
    import public_tokenizers

    words = packing.Words()
    assert [words[w] for w in (b"a", b"b", b"a")] == [0, 1, 0] and words.fresh == [b"a", b"b"]
    words.ids[:] = [b"A", b"B"]
    words.fresh.clear()
    later = words.turned()
    assert [later[w] for w in (b"b", b"c")] == [0, 1] and later.ids == [b"B", None] and later.fresh == [b"c"]
    later.ids[1] = b"C"
    last = later.turned()
    assert last[b"a"] == 0 and last.fresh == [b"a"]

    monkeypatch.setattr(packing, "WORDS_KEPT", 8)
    enc = packing.WordEncoder(str(public_tokenizers.path(packing.VOCABULARY)))
    whole = []
    monkeypatch.setattr(enc, "_ids", lambda text, f=enc._ids: whole.append(text) or f(text))
    texts = ["one two, one. three,", "two, four x1.", "five six seven", "one two, nine", "four"]
    for text in texts:
        (got,) = enc.encode([text])
        assert np.frombuffer(got, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert whole[:2] == ["one two three", ", <|endoftext|> ."]
