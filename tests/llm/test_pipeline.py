"""The corpus pipeline against a brute-force version of each stage on its own input."""

from collections import Counter

import corpus_pipeline as cp
import pytest

from tillroll.llm import adaptive_quality, packing, temperature_mix
from tillroll.llm.common import table, written

from .test_line_edit_join import brute as brute_lines
from .test_minhash_forest import brute as brute_near
from .test_packing import check as check_pieces
from .test_packing import tokenizer  # noqa: F401
from .test_temperature_mix import check as check_mix

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of each stage."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in cp.STAGES:
        after = written(stage(spark, docs, SF), "test-pipeline")
        out.append((name, docs, after))
        docs = after
    return {name: (a, b) for name, a, b in out}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_columns(spark, stages):
    columns = table(spark, SF, "documents").columns
    assert [n for n, _ in cp.STAGES] == list(stages) and all(stages[n][1].columns == columns for n in list(stages)[:-1])


def test_quality(stages, tmp_path):
    before, after = stages["quality rules"]
    from .helpers import duck_llm

    kept = {r[0] for r in duck_llm(SF).execute(f"SELECT doc_id FROM ({adaptive_quality.SQL}) WHERE kept").fetchall()}
    assert rows(after) == [r for r in rows(before) if r[0] in kept] and 0 < len(kept) < before.count()


def test_lines(stages):
    before, after = stages["line dedup"]
    want = brute_lines([(r.doc_id, r.text) for r in before.collect()])
    got = {r.doc_id: (r.text, r.n_chars) for r in after.collect()}
    left = {i: (t, len(t)) for i, (n, gone, t) in want.items() if not (gone and gone == n)}
    assert got == left


def test_near(stages):
    before, after = stages["near-dedup"]
    want = brute_near([(r.doc_id, r.text) for r in before.collect()], 5)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, (_, _, kept) in want.items() if kept)


def test_mixing(stages):
    before, after = stages["mixing"]
    plan = temperature_mix.mix_plan(before).collect()
    units = {(r.doc_id, r.source): max(1, len(r.text.encode().split())) for r in before.collect()}
    check_mix(plan, units, temperature_mix.TARGET_ENTROPY, temperature_mix.MAX_REPEATS, temperature_mix.BLOCK_TOKENS)
    copies = Counter((r.doc_id, r.source) for r in plan)
    own = {(r[0], r[3]): r for r in rows(before)}
    assert Counter(rows(after)) == Counter({own[k]: n for k, n in copies.items()})


def test_packing(stages, tokenizer):  # noqa: F811
    before, after = stages["packing"]
    docs = [(r.doc_id, r.text) for r in before.collect()]
    copies, pieces, once = Counter(d for d, _ in docs), after.collect(), []
    seen = Counter()
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        key = (p.doc_id, seen[p.doc_id] // p.doc_tokens)
        seen[p.doc_id] += p.length
        once.append(type(p)(**{**p.asDict(), "doc_id": key}))
    check_pieces(once, [((d, k), t) for d, t in dict(docs).items() for k in range(copies[d])], tokenizer, packing.SEQUENCE_TOKENS)


def test_run(spark, stages):
    whole = cp.run(spark, SF)
    assert whole.columns == stages["packing"][1].columns
    assert sum(r.length for r in whole.collect()) == sum(r.length for r in stages["packing"][1].collect())


def test_empty_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, row int, kept boolean, gone int"
    text = " ".join(f"word{i}" for i in range(60))
    data = [
        (1, text, "en", "a", len(text), 1, None, 2), (None, text, None, None, None, None, None, None), (2, None, "en", None, 0, 1, True, 2),
        (3, "", None, "a", 0, 1, True, 2), (4, text, "en", "a", len(text), 5, True, 2), (1, text, "en", "a", len(text), 1, None, 2),
    ]
    for df in (spark.createDataFrame(data, schema), spark.createDataFrame([], schema)):
        docs = df
        for _, stage in cp.STAGES[:-1]:
            docs = written(stage(spark, docs, SF), "test-pipeline")
            assert docs.columns == df.columns
        ids = Counter(r.doc_id for r in docs.collect())
        assert set(ids) == ({1, None} if df.count() else set())
        cp.STAGES[-1][1](spark, docs, SF).collect()
