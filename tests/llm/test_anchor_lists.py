"""Operator 13 against its SQL, a brute-force search and the walks' certificates."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from .helpers import duck_llm

from tillroll.llm import anchor_lists as al

SF = "/root/testdata/sf0.01"


def brute(rows, positives=al.POSITIVES, negatives=al.NEGATIVES):
    """Every pair of an anchor and a row, with Python integers."""
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        x = (label, [int(np.floor(256.0 * float(np.float32(c)))) for c in v])
        kept[i] = min(kept.get(i, x), x)
    out = []
    for a, (label, v) in kept.items():
        if a % al.ANCHOR_STEP:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in kept.items() if i != a}
        by = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in by if kept[i][0] == label][:positives]:
            near = [i for i in by if kept[i][0] != label and al.LOWEST * score[p] <= 100 * score[i] <= al.HIGHEST * score[p]]
            out += [(a, p, k, i, score[p], score[i]) for k, i in enumerate(near[:negatives], 1)]
    return sorted(out)


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return sorted(map(tuple, al.hard_negatives(df, **kw).collect()))


def test_query_matches_sql(spark):
    got = al.query(spark, SF)
    want = duck_llm(SF).sql(al.SQL)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall()) != []


@pytest.mark.parametrize("bounds", [(1024, 8192, 256), (3, 40, 8)])
def test_chunks_and_shards(spark, monkeypatch, bounds):
    """Many small chunks, shards and strides find the same; ties, copies and a hot vector stand at their places."""
    for name, value in zip(("CHUNK_ANCHORS", "SHARD_ROWS", "STRIDE"), bounds):
        monkeypatch.setattr(al, name, value)
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist(), int(rng.integers(0, 3))) for i in range(1000, 2200, 5)]
    rows += [(i, [1.0, 2.0, 0.0, 1.0], int(i % 2)) for i in range(3000, 3160)]
    assert found(spark, rows) == brute(rows)


def test_clustered_vectors_end_early(monkeypatch):
    """On directions that differ by cluster the walk reads part of the list and finds the same as all of it."""
    rng = np.random.default_rng(9)
    monkeypatch.setattr(al, "STRIDE", 32)
    centre = rng.normal(size=(20, 16))
    v = np.rint(60 * (np.repeat(centre, 100, axis=0) + 0.05 * rng.normal(size=(2000, 16))))
    ids, labels = np.arange(2000), np.zeros(2000, np.int64)
    members = v[300:310]
    shared = al.SharedList(members, ids, labels, v)
    read = []
    plain = shared.scores
    shared.scores = lambda a, start: read.append(start) or plain(a, start)
    walk = al.Walk(members, np.arange(10), ids[300:310], np.zeros(10, np.int64), True, 5)
    walk.along(shared, np.arange(10))
    assert len(read) * 32 < 1000
    for j in range(10):
        s = (v @ members[j]).astype(int)
        want = sorted((i for i in range(2000) if i != 300 + j), key=lambda i: (-s[i], i))[:5]
        assert walk.ids[j].tolist() == want


def test_bounds_hold():
    """No member's product passes its length times the bound, zero and opposite vectors included."""
    rng = np.random.default_rng(1)
    members = rng.normal(size=(7, 5)) * rng.integers(0, 4, (7, 1))
    v = np.vstack([rng.normal(size=(200, 5)) * 50, -20 * members, np.zeros((3, 5))])
    shared = al.SharedList(members, np.arange(len(v)), np.zeros(len(v), int), v)
    assert (members @ shared.vectors.T <= np.linalg.norm(members, axis=1)[:, None] * shared.bound * (1 + 1e-9) + 1e-6).all()
    assert (np.diff(shared.bound) <= 0).all()


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (100, [0.0, 0.0], 1), (200, [], 2), (300, [1.0], 2), (None, [1.0, 1.0], 1), (400, [1.0, nan], 1),
        (500, [inf, 1.0], 1), (600, None, 1), (700, [1.0, 1.0], None), (800, [1.0, None], 1), (900, [-1.0, -0.5], 1),
        (1, [1.0, 0.4], 1), (2, [0.5, 0.25], 3), (3, [0.5, 0.25], 4), (3, [0.5, 0.25], 4), (3, [0.9, 0.25], 9), (4, [0.25, 0.0], 1), (7, [0.6, 0.1], 9), (-100, [1.0, 0.5], 3),
    ]
    assert found(spark, rows) == brute([(i, (v + [0.0, 0.0])[:2] if v is not None else v, x) for i, v, x in rows]) != []
    assert found(spark, []) == []


def test_large_products_are_exact(spark):
    rows = [(i, [1e6 + i * 8, -3e5 * (i % 3), 7.0], i % 2) for i in range(0, 400, 10)]
    assert found(spark, rows, positives=2, negatives=3) == brute(rows, 2, 3) != []


def test_other_columns_are_ignored(spark):
    rows = [(i, [1.0, float(i)], i % 2, "x", None) for i in range(0, 300, 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, chunk string, v int")
    assert sorted(map(tuple, al.hard_negatives(df).collect())) == brute([r[:3] for r in rows])


def test_labels_and_ids_of_the_table(spark):
    rows = pq.read_table("/root/testdata/sf0.001/embeddings.parquet").to_pylist()
    got = sorted(map(tuple, al.query(spark, "/root/testdata/sf0.001").collect()))
    assert got == brute([(r["vec_id"], r["embedding"], r["label"]) for r in rows])
