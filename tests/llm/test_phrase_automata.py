"""Operator 11 against its SQL, a brute-force count and its automata's own laws."""

import re
from collections import Counter

import numpy as np
import pytest

from tillroll.llm import phrase_automata as pa_

from .helpers import duck_llm

SF = "/root/testdata/sf0.01"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least=10, first=2000, percent=50):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, w), a in cands.items():
        longer = [b for (g, x), b in cands.items() if g == lang and len(x) > len(w) and any(x[i : i + len(w)] == w for i in range(len(x) - len(w) + 1))]
        if any(100 * b >= percent * a for b in longer):
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, x in out.items() for rank, (s, a, p, l, r) in enumerate(sorted(x)[:first], 1)
    )


def found(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string")
    return sorted(map(tuple, pa_.first_phrases(docs, **options).collect()))


def test_query_matches_sql(spark):
    got = pa_.query(spark, SF)
    want = duck_llm(SF).sql(pa_.SQL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall()) != []


@pytest.mark.parametrize("bounds", [(1_500_000, 1 << 22), (7, 5)])
def test_blocks_change_nothing(spark, monkeypatch, bounds):
    """Blocks and chunks of a few words, many ranges, a text that is most of the corpus, copies."""
    monkeypatch.setattr(pa_, "BLOCK_TOKENS", bounds[0])
    monkeypatch.setattr(pa_, "CHUNK_BYTES", bounds[1])
    rng = np.random.default_rng(2)
    words = np.array(["a", "b", "the", "New", "york", "x\x01", "a\x01", "é", "É", "ab", "York.", "b,", "\tc", "d\n"])
    text = lambda n: " ".join(rng.choice(words, n, p=np.array([9, 8, 7, 6, 6, 1, 1, 2, 1, 3, 1, 1, 1, 1]) / 48))
    rows = [(text(300), "en"), (text(40), "de"), (text(60), None), (text(50), "und")] + [("hot line of words here", "en")] * 40
    assert found(spark, rows, least=4) == brute(rows, 4) != []
    assert found(spark, rows, least=4, first=5) == brute(rows, 4, 5)
    assert found(spark, rows, least=3, inside_percent=90) == brute(rows, 3, percent=90)


def test_edge_cases(spark):
    rows = [(None, "en"), ("", None), ("   \t \n.,;", "en"), ("one", "fr"), ("x" * 100_000 + " y", "en")] + [("so it goes", None)] * 10
    assert found(spark, rows) == brute(rows) == [("und", 1, "so it goes", 10, 10, 10, 30, 1_000_000)]
    assert found(spark, []) == []


def test_pieces_and_gaps(spark):
    """Only tabs and spaces part words; other white space is part of them, and form feeds end pieces."""
    rows = [("a b\tc  d\x0be f\x0cg\x1fh i j k", "en")] * 12
    assert found(spark, rows) == brute(rows) != []


def test_large_counts_are_exact():
    """Squares of counts beyond 64 bits."""
    words = [b"u", b"v"]
    table = lambda phrases, weights: pa_.CountAutomaton.build(words, np.array(phrases), np.array(weights))
    import pyarrow as pa

    row = lambda a, **x: {**x, **dict(zip(pa_._FIELDS, a.columns(), strict=True))}
    a, l, r = 6 * 10**11 + 1, 7 * 10**11 + 3, 8 * 10**11 + 9
    counts = pa.Table.from_pylist([row(table([[1, 0, 0], [1, 2, 0], [2, 0, 0]], [l, a, r]), part=0, lang="en")])
    answers = pa.Table.from_pylist([row(table([[1, 0, 0], [2, 0, 0]], [l, r]), part=0, lang="en", inside=False)])
    got = pa_._score(50)(counts, answers).to_pylist()
    assert [(x["phrase"], x["a"], x["l"], x["r"], x["score"]) for x in got] == [("u v", a, l, r, 10**6 * a * a // (l * r))]


def test_automaton_is_minimal_and_round_trips():
    words = [b"a", b"b", b"c"]
    rows = sorted({(a, b, c) for a in (1, 2) for b in (0, 1, 2, 3) for c in (0, 3) if b or not c})
    phrases, weights = np.array(rows), np.array([1 + (r[1] == 0) for r in rows])
    auto = pa_.CountAutomaton.build(words, phrases, weights)
    # a leaf, the state behind two words, one behind one word, the root
    assert len(auto.weight) == 4
    back = pa_.CountAutomaton.read(dict(zip(pa_._FIELDS, auto.columns(), strict=True)))
    w, p, f = pa_.union([back])
    assert (w, p.tolist(), f.tolist()) == (words, phrases.tolist(), weights.tolist())
    w, p, f = pa_.union([back, auto, pa_.CountAutomaton.build([b"aa", b"c"], np.array([[1, 2, 0]]), np.array([7]))])
    assert f.sum() == 2 * weights.sum() + 7 and len(p) == len(rows) + 1
    asked = np.array([[1, 0, 0], [1, 2, 3], [3, 0, 0], [3, 1, 0], [1, 3, 2]])
    assert auto.compose([b"a", b"c", b"zz"], asked).tolist() == [2, 0, 0, 0, 0]
    assert auto.compose(words, np.array([[1, 2, 3], [2, 1, 0], [2, 0, 0], [3, 0, 0]])).tolist() == [1, 1, 2, 0]


def test_other_columns_are_ignored(spark):
    docs = spark.createDataFrame([("p q r", "en", 1, "x")] * 11, "text string, lang string, part int, words string")
    assert [tuple(r) for r in pa_.first_phrases(docs).collect()] == [("en", 1, "p q r", 11, 11, 11, 33, 1_000_000)]


def test_long_text_and_many_ranges(spark):
    """Length times samples of all ranges is beyond an int."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "100")
    try:
        docs = spark.createDataFrame([("many words and more " * 20_000, "en"), ("short", "en")], "text string, lang string")
        assert 400_000 * pa_.SAMPLES_PER_RANGE * pa_.RANGES_PER_PARTITION * 100 >= 1 << 31
        assert {b[0] for b in pa_.range_bounds(docs)} == {"en"}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_block_is_never_longer(monkeypatch):
    """A long text behind a nearly full block: its words have numbers of ``_BITS`` all the same."""
    monkeypatch.setattr(pa_, "BLOCK_TOKENS", 7)
    blocks = pa_._Blocks()
    texts = [b" ".join(b"%c" % (97 + k) for k in range(a, z)) for a, z in ((0, 6), (6, 19), (0, 2))]
    found = [x for t in texts for x in blocks.add(t)] + list(blocks.finish())
    assert max(len(vocabulary) for vocabulary, _, _ in found) <= 7
    ones = Counter()
    for vocabulary, phrases, counts in found:
        ones.update({vocabulary[p[0] - 1]: int(n) for p, n in zip(phrases, counts, strict=True) if p[1] == 0})
    assert ones == Counter(w for t in texts for w in t.split())
