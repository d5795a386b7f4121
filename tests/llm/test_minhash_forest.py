"""Operator 1 against all pairs."""

import math
import random
import re
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from tillroll.llm import minhash_forest as mf

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, size, percent=80):
    """doc_id -> (set size, component, kept) by comparing every pair that shares a shingle."""
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        n = len(w) - size + 1
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(n)) if n > 0 else frozenset([tuple(w)] if w else [])
    post = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            post[x].append(i)
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in post[x] if j > i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_query_matches_all_pairs(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    assert got(mf.query(spark, SF)) == brute(rows, 4)


def variants(n, words=60, seed=3):
    """A star of near copies (one to six words changed) and unrelated texts."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(500)}" for _ in range(words)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randrange(7)):
            w[rnd.randrange(words)] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(n + i, " ".join(f"z{rnd.randrange(10**6)}" for _ in range(40))) for i in range(40)]
    return rows


@pytest.mark.parametrize("run", [4, 256])
def test_dense_region(spark, monkeypatch, run):
    """Runs larger than allowed are deepened; the group is found whole."""
    monkeypatch.setattr(mf, "RUN", run)
    rows = variants(200)
    out = got(mf.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    want = brute(rows, 5)
    if run == 256:
        assert out == want
    else:  # regions cut into runs of four: nothing wrong, and the group still hangs together
        assert all(out[i][0] == want[i][0] for i in want)
        big = Counter(v[1] for v in want.values()).most_common(1)[0][0]
        mine = [out[i][1] for i, v in want.items() if v[1] == big]
        assert Counter(mine).most_common(1)[0][1] >= 0.9 * len(mine)
        assert all(out[i][1] == i for i, v in want.items() if v[1] == i and i >= 200)


def test_dense_region_loses_no_link(spark, monkeypatch):
    """What no prefix makes small is compared all with all."""
    monkeypatch.setattr(mf, "RUN", 4)
    rows = variants(200)
    assert got(mf.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == brute(rows, 5)


def test_groups_are_compared_once(spark, monkeypatch):
    """Classes of a group meet in its blocks, and not in the shorter runs of each value as well."""
    monkeypatch.setattr(mf, "RUN", 4)
    members, blocks, seen = mf._members, mf._block_runs, {"members": [], "blocks": []}

    def keep(what, df, rows):
        seen[what].append(rows.first()[0])
        return df

    monkeypatch.setattr(mf, "_members", lambda runs, classes: keep("members", members(runs, classes), runs.selectExpr("sum(size(reps))")))
    monkeypatch.setattr(mf, "_block_runs", lambda groups: keep("blocks", out := blocks(groups), out.selectExpr("count(*)")))
    rows = variants(200, seed=4)
    assert got(mf.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == brute(rows, 5)
    assert seen["blocks"] and seen["members"][1] <= 1.05 * seen["blocks"][0], seen


def templated(n, pairs, seed):
    """Documents of one template (similarity 0.7) and pairs at 0.80 to 0.84 among them."""
    rnd = random.Random(seed)
    base = [f"t{rnd.randrange(5000)}" for _ in range(200)]
    own = lambda k: [f"o{rnd.randrange(10**9)}" for _ in range(k)]
    docs = [base + own(41) for _ in range(n)]
    docs += [docs[k][: 200 + (more := rnd.randrange(15, 21))] + own(41 - more) for k in range(pairs)]
    rnd.shuffle(docs)
    return [(i, " ".join(w)) for i, w in enumerate(docs)]


def test_templated_region(spark, monkeypatch):
    """Pairs that longer prefixes separate are found by the values they share alone."""
    monkeypatch.setattr(mf, "RUN", 8)
    rows = templated(500, 100, 5)
    want = brute(rows, 5)
    assert 90 <= sum(not kept for _, _, kept in want.values()) <= 100
    assert got(mf.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))) == want


def test_edge_cases(spark):
    long_text = " ".join(f"k{i}" for i in range(30_000))
    rows = [
        (5, "A b c"), (3, "a B\tc"), (9, None), (8, ""), (7, " \n"), (6, "one"), (4, "é b c"), (1, long_text), (2, long_text + " end"),
        (20, "É b c"),
    ]
    df = spark.createDataFrame([(i, t, b"x", 1) for i, t in rows], "doc_id long, text string, sig binary, run int")
    out = got(mf.near_duplicates(df))
    assert out == brute(rows, 5)
    assert out[5][1] == 3 and out[4][1] == 4 and out[2][1] == 1 and out[9] == (0, 9, True)


def test_null_ids_repeats_and_empty(spark):
    text = "a b c d e f g"
    df = spark.createDataFrame([(None, text), (2, text), (2, text), (1, text), (1, "other words are here for one id")], "doc_id long, text string")
    out = sorted(((r.doc_id, r.component_id, r.kept) for r in mf.near_duplicates(df).collect()), key=repr)
    assert out == sorted([(None, None, True), (2, 1, False), (2, 1, False), (1, 1, True), (1, 1, True)], key=repr)
    assert mf.near_duplicates(df.limit(0)).collect() == []


def test_estimates(spark):
    import numpy as np

    rnd = np.random.default_rng(1)
    errors = []
    for _ in range(60):
        a = rnd.integers(0, 1 << 63, 500, dtype=np.uint64)
        b = np.concatenate([a[:400], rnd.integers(0, 1 << 63, 100, dtype=np.uint64)])
        x, y = (np.frombuffer(mf.signature(np.unique(s)), ">u2") for s in (a, b))
        errors.append((x == y).mean() - 400 / 600)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_estimate_limit_rejects_no_similar_pair():
    """Binomial: a pair at the least similarity falls below MAYBE once in 50,000."""
    n, p = mf.TREES * mf.DEPTH, mf.PERCENT / 100
    below = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(n + 1) if k < mf.MAYBE * n)
    assert below < 2e-5
