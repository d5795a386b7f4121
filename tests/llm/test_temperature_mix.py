"""Operator 4 against the definition of the mix."""

import math
from collections import Counter, defaultdict

import duckdb
import pytest

from tillroll.llm import temperature_mix as tm

SF = "/root/testdata/sf0.01"


def alpha(shares, target, limit):
    def entropy(a):
        w = [p**a for p in shares]
        return -sum(x / sum(w) * math.log(x / sum(w)) for x in w) / math.log(len(w)) if len(w) > 1 else 1.0

    def first(good):
        lo, hi = 0.0, 1.0
        if good(0.0):
            return 0.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if good(mid) else (mid, hi)
        return hi

    top = max(shares) / min(shares)
    return max(first(lambda a: top ** (1 - a) <= limit), first(lambda a: entropy(a) < target))


def check(rows, units, target, limit, block_tokens):
    """units: (doc_id, source) -> tokens; rows: copies of the plan."""
    tokens = defaultdict(int)
    for (_, s), n in units.items():
        tokens[s] += n
    total = sum(tokens.values())
    a = alpha([t / total for t in tokens.values()], target, limit)
    ratio = {s: (t / total) ** (a - 1) for s, t in tokens.items()}
    budget = {s: ratio[s] / min(ratio.values()) * t for s, t in tokens.items()}
    longest = max(units.values())
    got, copies = defaultdict(int), Counter()
    for r in rows:
        assert r.n_tokens == units[r.doc_id, r.source]
        got[r.source] += r.n_tokens
        copies[r.doc_id, r.source] += 1
    assert set(copies) == set(units)
    for s in tokens:
        epochs = [copies[k] for k in units if k[1] == s]
        assert max(epochs) - min(epochs) <= 1 and max(epochs) <= math.ceil(budget[s] / tokens[s] + 1e-6)
        assert -1 - 1e-6 * budget[s] <= got[s] - budget[s] <= longest + 1e-6 * budget[s]
    blocks = defaultdict(list)
    for r in rows:
        blocks[r.block_id].append(r)
    n_blocks = max(1, math.ceil(sum(budget.values()) / block_tokens - 1e-6))
    assert max(blocks) < n_blocks
    for b in blocks.values():
        assert sorted(r.position for r in b) == list(range(len(b)))
        for s in tokens:
            assert abs(sum(r.n_tokens for r in b if r.source == s) - budget[s] / n_blocks) <= 2 * longest + 1
    return a


def test_query(spark):
    con = duckdb.connect()
    units = {
        (d, s): max(1, len([w for w in (t or "").encode().split()]))
        for d, s, t in con.execute(f"SELECT doc_id, source, text FROM '{SF}/documents.parquet'").fetchall()
    }
    rows = tm.query(spark, SF).collect()
    check(rows, units, tm.TARGET_ENTROPY, tm.MAX_REPEATS, tm.BLOCK_TOKENS)


@pytest.mark.parametrize("target,limit", [(0.99, 50.0), (0.9, 1.5), (0.0, 3.0), (1.0, 1.0)])
def test_hot_source(spark, target, limit):
    data = [(i, "hot" if i % 3 else f"s{i % 7}", "w " * (1 + i % 50)) for i in range(900)] + [(5000, None, "a b"), (5001, "s1", None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], "doc_id long, source string, text string, s string, tokens int").repartition(6)
    units = {(d, s): max(1, len((t or "").split())) for d, s, t in data}
    rows = tm.mix_plan(df, target_entropy=target, max_repeats=limit, block_tokens=3000).collect()
    a = check(rows, units, target, limit, 3000)
    assert limit > 1.0 or a == 1.0


def test_blocks_are_shuffled_and_stable(spark):
    df = spark.createDataFrame([(i, f"s{i % 2}", "w w") for i in range(400)], "doc_id long, source string, text string")
    one = tm.mix_plan(df.repartition(3), block_tokens=100).collect()
    two = tm.mix_plan(df.repartition(5), block_tokens=100).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))
    ids = [r.doc_id for r in sorted(one, key=lambda r: (r.block_id, r.position))]
    assert ids != sorted(ids)


def test_mix_keeps_columns_and_repeats(spark):
    data = [(1, "a", "x y", 7), (1, "a", "x y", 8), (None, None, "z", 9), (2, "b", "q " * 40, 10)]
    df = spark.createDataFrame(data, "doc_id long, source string, text string, position int")
    out = tm.mix(df, max_repeats=1.0)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(data, key=repr)
    assert tm.mix(df.limit(0)).collect() == [] and tm.mix_plan(df.limit(0)).collect() == []
