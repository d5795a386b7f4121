"""Operator 12 against the tiktoken library."""

import hashlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from tillroll.llm import duckdb_bpe

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tiktoken_own():
    import public_tokenizers
    import tiktoken

    ranks = duckdb_bpe.read_ranks(str(public_tokenizers.path(duckdb_bpe.VOCABULARY)))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return duckdb_bpe._tokenizer(duckdb_bpe.VOCABULARY)


def hexed(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_query_matches_tiktoken(spark, tiktoken_own):
    got = {r.doc_id: r for r in duckdb_bpe.query(spark, SF).collect()}
    docs = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(got) == len(docs)
    for d in docs:
        ids = tiktoken_own.encode_ordinary(d["text"] or "")
        r = got[d["doc_id"]]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hexed(",".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == hexed((d["text"] or "").encode())


def test_every_code_point(coder, tiktoken_own):
    """White space, letters, numbers and the rest are told apart as tiktoken does."""
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1 {chr(c)}  {chr(c)}{chr(c)}b" for c in points[k : k + 4096]) for k in range(0, len(points), 4096)]
    got = list(coder.encode(texts))
    assert [g.tolist() for g in got] == [tiktoken_own.encode_ordinary(t) for t in texts]
    assert list(coder.decode(got)) == [t.encode() for t in texts]


@pytest.mark.parametrize("long_word", [4, 64])
def test_long_words(coder, tiktoken_own, monkeypatch, long_word):
    """The shortcuts of long words change no id, also where they are used for all words."""
    monkeypatch.setattr(duckdb_bpe, "LONG_WORD", long_word)
    coder._known.clear()
    coder._older.clear()
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdeghinorstuABCX0123456789=-_éßñ中文д"))
    texts = ["a" * 30_000, "=" * 5001 + "-=" * 3000, "ab" * 4000 + "a", "ééé" * 2000, "​" * 999, " " * 5000, "\n\n \n" * 300]
    texts += ["".join(rng.choice(letters[:k], n)) for k in (2, 3, 5, 9, 16, 36) for n in (65, 300, 3000)]
    assert [g.tolist() for g in coder.encode(texts)] == [tiktoken_own.encode_ordinary(t) for t in texts]


def test_bounds_change_nothing(coder, tiktoken_own, monkeypatch):
    """Small queries, slices and a small memory of words give the same ids and bytes."""
    for name, value in {"QUERY_BYTES": 50, "QUERY_TOKENS": 7, "WORDS_KEPT": 3}.items():
        monkeypatch.setattr(duckdb_bpe, name, value)
    coder._known.clear()
    coder._older.clear()
    texts = ["", "one two three four " * 20, "x", "Überraschung größer als naïve", "", "tail"]
    got = list(coder.encode(texts))
    assert [g.tolist() for g in got] == [tiktoken_own.encode_ordinary(t) for t in texts]
    assert list(coder.decode(got)) == [t.encode() for t in texts]


def test_edge_cases(spark, tiktoken_own):
    rows = [(1, None, "x", 5), (2, "", "x", 6), (3, "It's  a\ttest\r\n", None, 7), (3, "It's  a\ttest\r\n", None, 7), (None, "日本語 <|endoftext|>", "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `ids` string, `row` int")
    coded = duckdb_bpe.encode(docs)
    got = [(r["row"], r["ids"]) for r in coded.collect()]
    assert sorted([(str(tuple(r)), i) for r, i in got]) == sorted([(str(r), tiktoken_own.encode_ordinary(r[1] or "")) for r in rows])
    back = duckdb_bpe.decode(coded)
    assert all(bytes(r["decoded"]).decode() == (r["row"]["row"]["text"] or "") for r in back.collect())
    assert duckdb_bpe.digests(docs).count() == 5
    empty = duckdb_bpe.digests(docs.limit(0))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_null_and_unknown_ids(spark):
    ids = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert [(r["row"]["k"], r["decoded"]) for r in duckdb_bpe.decode(ids).orderBy("row.k").collect()] == [(1, None), (2, b"")]
    for bad in ([50300], [None], [-1]):
        with pytest.raises(Exception, match="an id is"):
            duckdb_bpe.decode(spark.createDataFrame([(1, bad)], "k int, ids array<int>")).collect()


def test_latin_texts_split_alike(coder):
    """The pattern for Latin-1 texts finds the words that the tokenizer's pattern finds."""
    chars = [chr(c) for c in range(256)]
    texts = ["".join(a + b + c for c in chars) for a in "a1 -'\n\xa0" for b in chars[::7]] + [a + b for a in chars for b in chars]
    texts += ["I'll don't they're 'Sx\u0020\u0020 y\t\n z", "ﬀ é\xa0 1"]
    assert coder._latin_words_of is not coder._words_of
    for text in texts:
        assert coder._split(text) == coder._words_of(text), text


def test_batch_is_learnt_in_one_query(coder, monkeypatch):
    """The new words of a batch of long texts go into one query, and each word is looked up once."""
    calls = []
    monkeypatch.setattr(coder, "_contracted", lambda words, query, f=coder._contracted: calls.append(len(words)) or f(words, query))
    coder._known.clear()
    coder._older.clear()
    texts = [f"qxzj{k}vw " + "the same words again " * 60_000 for k in range(8)]
    got = list(coder.encode(texts))
    assert list(coder.decode(got)) == [t.encode() for t in texts]
    assert len(calls) == 1
