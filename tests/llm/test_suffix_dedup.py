"""Operator 9 against a plain dictionary of all windows."""

import hashlib
import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from tillroll.llm import suffix_dedup as sd

SF = "/root/testdata/sf0.001"


def brute(rows, match=sd.MATCH):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256 of the rest)"""
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - match + 1):
            w = raw[k : k + match]
            if w in seen:
                gone[k : k + match] = b"\1" * match
            else:
                seen.add(w)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def got(df):
    return {r.row.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect()}


def test_query(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    out = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.query(spark, SF).collect()}
    assert out == brute(rows)


def test_cover():
    pairs = {(a - b) % sd.V for a in sd.COVER for b in sd.COVER}
    assert pairs == set(range(sd.V))


@pytest.mark.parametrize("seed", range(6))
def test_suffix_order(seed):
    rnd = random.Random(seed)
    part = bytes(rnd.choice(b"ab") for _ in range(rnd.choice([3, 40, 200])))
    data = b"".join(part[: rnd.randrange(len(part) + 1)] + bytes([rnd.choice(b"abc")]) for _ in range(40))[:3000]
    padded = data + bytes(sd.MATCH + 8)
    wanted = np.array(sorted(rnd.sample(range(len(data)), len(data) // 2)))
    order = sd.sorted_suffixes(padded, wanted)
    assert sorted(order.tolist()) == wanted.tolist()
    heads = [padded[k : k + sd.MATCH] for k in order.tolist()]
    assert heads == sorted(heads)


@pytest.mark.parametrize("size", [1 << 20, 300, 150])
def test_runs(monkeypatch, size):
    """Runs cover every window once; equal windows have one key and different runs,
    also where long texts are cut into slices."""
    monkeypatch.setattr(sd, "SLICE", size)
    rnd = random.Random(1)
    noise = bytes(rnd.choice(b"abc") for _ in range(900))
    texts = [b"", b"a" * 99, b"a" * 700, noise, b"ab" * 200, noise[100:420] + noise[50:300], b"x" * 100]
    keys, covered = {}, set()
    for r, (t, at, n, key) in enumerate(zip(*(x.tolist() for x in sd.runs_of(texts)), strict=True)):
        for k in range(at, at + n):
            assert (t, k) not in covered
            covered.add((t, k))
            w = texts[t][k : k + sd.MATCH]
            own = keys.setdefault(w, (key, set()))
            assert own[0] == key and r not in own[1]
            own[1].add(r)
    assert covered == {(t, k) for t, x in enumerate(texts) for k in range(len(x) - sd.MATCH + 1)}


def corpus(n=80, seed=2):
    rnd = random.Random(seed)

    def words(k):
        return " ".join(rnd.choice(["alpha", "béta", "gamma", "delta", "x"]) + str(rnd.randrange(900)) for _ in range(k))

    common, other = words(40), words(30)
    rows = []
    for i in range(n):
        parts = [words(rnd.randrange(1, 30))]
        if i % 2:
            parts.append(common)
        if i % 5 == 0:
            parts.append(other[rnd.randrange(40) :])
        if i % 9 == 0:
            parts += [parts[0], "z" * rnd.randrange(300)]
        parts.append(words(rnd.randrange(10)))
        rows.append((i * 3 + 1, " ".join(parts)))
    rows += [(500 + k, rows[k][1]) for k in range(0, 40, 4)] + [(0, rows[7][1] + "!")]
    return rows


@pytest.mark.parametrize("local,part,hot", [(16, 64, 100_000), (1, 64, 1000), (16, 64, 3), (2, 4, 1000)])
def test_frequent_keys(spark, monkeypatch, local, part, hot):
    monkeypatch.setattr(sd, "LOCAL_LEAST", local)
    monkeypatch.setattr(sd, "LOCAL_PART", part)
    monkeypatch.setattr(sd, "HOT", hot)
    rows = corpus()
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, key string, h int").repartition(5)
    assert got(sd.remove_repeats(df)) == brute(rows)


def test_edge_cases(spark):
    rnd = random.Random(9)
    noise = "".join(rnd.choice("abcdefgh ") for _ in range(60_000))
    rows = [
        (1, None), (2, ""), (3, "a" * 99), (4, "a" * 99), (5, "a" * 100), (6, "a" * 100), (7, "a" * 1000), (8, "ab" * 300), (9, noise),
        (10, "é" * 60), (11, "x" + "é" * 60), (12, noise[100:300] + noise[250:400] + "end"), (13, noise[1000:50_000]),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(sd.remove_repeats(df)) == brute(rows)


def test_null_ids_repeats_and_empty(spark):
    long_text = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(None, long_text), (4, long_text), (4, long_text), (5, long_text), (5, "other")], "doc_id long, text string")
    out = sorted(((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in sd.remove_repeats(df).collect()), key=repr)
    n = len(long_text)
    assert out == sorted([(None, n, 0, 0), (4, n, 0, 0), (4, n, 0, 0), (5, n, n, 1), (5, 5, 0, 0)], key=repr)
    assert sd.remove_repeats(df.limit(0)).collect() == []
