"""Operator 7 against brute force."""

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tillroll.llm import kmeans_tree as kt

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>"


def exact(rows, every, k=5):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    norm = np.sqrt((x**2).sum(axis=1))
    out = {}
    for n, q in enumerate(ids):
        if q % every == 0:
            s = x @ x[n] / (norm * norm[n])
            out[q] = sorted((-round(float(c), 12), i) for c, i in zip(s, ids, strict=True) if i != q)[:k]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((-round(r.score, 12), r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_query_recall(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()]
    want, got = exact(rows, 50), results(kt.query(spark, SF))
    assert set(want) == set(got)
    hit = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))
    exact_scores = {q: dict((i, s) for s, i in exact(rows, 50, len(rows))[q]) for q in list(want)[:3]}
    for q, scores in exact_scores.items():
        assert all(abs(scores[i] - s) < 1e-9 for s, i in got[q])


def test_deep_tree_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(kt, "LEAF_SAMPLE", 8)
    monkeypatch.setattr(kt, "BLOCK", 7)
    rnd = np.random.default_rng(5)
    centers = rnd.normal(size=(12, 16))
    rows = [(i, (centers[i % 12] + 0.2 * rnd.normal(size=16)).astype(np.float32).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want, got = exact(rows, 10), results(kt.nearest(df, F.col("vec_id") % 10 == 0))
    hit = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert set(want) == set(got) and hit >= 0.9 * 5 * len(want)


def test_copies_ties_and_unusable(spark):
    same = [0.5, 1.0, 0.0]
    nan, inf = float("nan"), float("inf")
    rows = [(i, same) for i in range(30)]
    rows += [(100, [1.0, 0.0, 0.0]), (101, [2.0, 0.0, 0.0]), (110, None), (120, []), (130, [0.0, 0.0, -0.0]), (140, [nan, 1.0, 0.0])]
    rows += [(150, [inf, 1.0, 0.0]), (160, [None, 1.0, 0.0]), (170, [1.0, 2.0]), (None, same), (20, same), (180, [0.5, 1.0, -0.0])]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], SCHEMA + ", vec string, leaf int")
    got = results(kt.nearest(df, F.col("vec_id") % 10 == 0))
    assert set(got) == {0, 10, 20, 100, 180}
    assert [i for _, i in got[0]] == [1, 2, 3, 4, 5] and [i for _, i in got[10]] == [0, 1, 2, 3, 4]
    assert [i for _, i in got[180]] == [0, 1, 2, 3, 4] and got[100][0] == (-1.0, 101)


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], SCHEMA)
    assert results(kt.nearest(df, F.col("vec_id") == 0)) == {0: [(0.0, 1)]}
    assert kt.nearest(df.limit(0), F.col("vec_id") == 0).collect() == []
