"""Operator 10 against all pairs of lines."""

import random

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import line_edit_join as le

SF = "/root/testdata/sf0.001"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("abé", max_size=14), st.text("abé", max_size=14), st.integers(1, 4))
def test_banded_distance(a, b, k):
    assert le.within(a, b, k) == (distance(a, b) <= k)


@settings(max_examples=300, deadline=None)
@given(st.text("abé𝄞", min_size=3, max_size=16), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 16), st.sampled_from("abc")), max_size=2))
def test_segments_lose_no_pair(a, edits):
    b = a
    for kind, at, c in edits:
        at = min(at, len(b))
        b = b[:at] + ("" if kind == 1 else c) + b[at + (kind != 0) :]
    longer, other = (a, b) if len(a) >= len(b) else (b, a)
    index = {k for k, s, _, _ in le.entries(other) if s & le.INDEX}
    probe = {k for k, s, _, _ in le.entries(longer) if s & le.PROBE}
    assert index & probe
    differ = le.parities(longer, longer.encode()) ^ le.parities(other, other.encode())
    assert differ.bit_count() <= 2 * le.EDITS


def brute(rows, edits=le.EDITS):
    """doc_id -> (lines, removed, text)"""
    first = {}
    for i, text in rows:
        for k, line in le.lines_of(text or ""):
            first[line] = min(first.get(line, (i, k)), (i, k))
    lines = sorted(first)
    up = {x: x for x in lines}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    long_lines = sorted((x for x in lines if len(x) >= le.MIN_CHARS), key=len)
    for i, a in enumerate(long_lines):
        for b in long_lines[i + 1 :]:
            if len(b) - len(a) > edits:
                break
            # Two edits cut 24 characters into three runs, one of at least eight.
            if {a[k : k + 6] for k in range(len(a) - 5)} & {b[k : k + 6] for k in range(len(b) - 5)}:
                if distance(a, b) <= edits:
                    x, y = find(a), find(b)
                    x, y = sorted((x, y), key=lambda t: first[t])
                    up[y] = x
    stay = {}
    for x in lines:
        r = find(x)
        stay[r] = min(stay.get(r, first[x]), first[x])
    out = {}
    for i, text in rows:
        gone = {k for k, line in le.lines_of(text or "") if stay[find(line)] != (i, k)}
        kept = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        out[i] = (sum(1 for _ in le.lines_of(text or "")), len(gone), kept)
    return out


def got(df):
    return {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in df.collect()}


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, gone string, line int").repartition(4)
    return got(le.dedup_lines(df, **options).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "text"))


def test_query(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    out = got(le.query(spark, SF))
    assert set(out) == {i for i, _ in rows}
    assert out == brute(rows)


@pytest.mark.parametrize("pairs,levels", [(4096, 3), (4, 3), (4, 1)])
def test_frequent_segments(spark, monkeypatch, pairs, levels):
    """Keys shared by many lines go through deeper levels and blocks; same result."""
    monkeypatch.setattr(le, "PAIRS", pairs)
    monkeypatch.setattr(le, "LEVELS", levels)
    monkeypatch.setattr(le, "BLOCK", 8)
    rnd = random.Random(4)
    base = "the common beginning of a line that many share, number "
    rows = []
    for i in range(60):
        lines = [base + f"{rnd.randrange(3000):04d}", "short", "x" * 30 if i % 2 else "x" * 29 + "é"]
        w = list(base + "and a long tail after it")
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(len(w))] = rnd.choice("abc")
        rows.append((i, "\n".join([*lines, "".join(w)])))
    assert run(spark, rows) == brute(rows)


def rules(n, seed, near=20):
    """Lines of one repeated character with three others, and planted pairs two edits apart."""
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        w = list(rnd.choice("-=._") * rnd.choice((38, 39, 40)))
        for _ in range(3):
            w[rnd.randrange(len(w))] = chr(97 + rnd.randrange(26))
        out.append("".join(w))
        if k < near:
            for _ in range(2):
                at = rnd.randrange(len(w))
                w[at : at + rnd.randrange(2)] = rnd.choice(("", w[0], "#"))
            out.append("".join(w))
    out += ["-" * 40, "--b--------------------------------=------", "=-" * 20, "=-" * 19 + "=", "-=" * 20]
    return out


@pytest.mark.parametrize("pairs,levels,n", [(4096, 3, 300), (4, 1, 60), (4, 2, 60), (4, 3, 60)])
def test_lines_of_repeated_characters(spark, monkeypatch, pairs, levels, n):
    """A line that holds a frequent key at several places has a rest for each."""
    monkeypatch.setattr(le, "PAIRS", pairs)
    monkeypatch.setattr(le, "LEVELS", levels)
    if pairs == 4096:  # nothing is left to the blocks
        monkeypatch.setattr(le, "_block_links", lambda left, edits: spark.createDataFrame([], "u binary, v binary"))
    rows = list(enumerate(rules(n, levels + pairs)))
    assert run(spark, rows) == brute(rows)


def test_frequent_key_is_not_held(monkeypatch):
    """The rows of a key pass through once it makes PAIRS pairs; probes without a segment too."""
    import pyarrow as pa

    class Entries:  # hands the task function over
        def repartition(self, *_):
            return self

        sortWithinPartitions = repartition

        def mapInArrow(self, f, _):
            return f

    monkeypatch.setattr(le, "PAIRS", 16)
    held = []

    def batches():
        for k in range(50):
            keys = [1] * 20 if k < 25 else [2] * 20
            mark = le.INDEX | le.PROBE if k < 25 else le.PROBE
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(range(20 * k, 20 * k + 20), pa.int64()), pa.array([mark] * 20, pa.int32())],
                names=["key", "line", "mark"],
            )

    for out in le._met(Entries(), 2)(batches()):
        held.append(out.num_rows)
    assert held == [20] * 50


def test_edge_cases(spark):
    line = "a line that is long enough to be matched"
    rows = [
        (1, None), (2, ""), (3, "\n \n\t"), (4, f"{line}\n{line}\n\nend"), (0, line + "!"), (7, line.upper()), (8, "tiny"), (9, "tinY"), (10, "tiny"),
        (11, "z" * 100_000), (12, "z" * 99_999 + "y"), (13, f"é{line}\r"), (14, "u" * 23 + "a"), (15, "u" * 23 + "b"), (16, "v" * 22 + "a"), (17, "v" * 22 + "b"),
    ]
    out = run(spark, rows)
    assert out[4] == (3, 2, "\nend") and out[0] == (1, 0, line + "!") and out[12] == (1, 1, "") and out[10] == (1, 1, "") and out[9][1] == 0
    assert out[15][1] == 1 and out[17][1] == 0 and out[1] == (0, 0, None) and out[3] == (0, 0, "\n \n\t") and out[13] == (1, 1, "")


def test_null_ids_repeats_and_empty(spark):
    line = "a line that is long enough to be matched"
    df = spark.createDataFrame([(None, line), (2, line), (2, line), (3, line), (3, "other\nsecond")], "doc_id long, text string")
    out = sorted(((r.row.doc_id, r.text, r.n_removed) for r in le.dedup_lines(df).collect()), key=repr)
    assert out == sorted([(None, line, 0), (2, line, 0), (2, line, 0), (3, "", 1), (3, "other\nsecond", 0)], key=repr)
    assert le.dedup_lines(df.limit(0)).collect() == []


def test_lines_of_equal_parities_keep_their_own_ids(spark):
    """Two lines of the same letters whose digests begin with the same 30 bits."""
    rnd, seen, twins = random.Random(7), {}, None
    letters = list("0123456789" * 4)
    while twins is None:
        rnd.shuffle(letters)
        line = "".join(letters)
        other = seen.setdefault(int.from_bytes(le.digest(line)[:4], "big") & ~3, line)
        twins = (other, line) if other != line else None
    a, b = twins
    rows = [(1, f"{a}\n{b}"), (2, b[:5] + "x" + b[6:]), (3, a[:5] + "x" + a[6:])]
    assert run(spark, rows) == brute(rows)


def test_lines_under_one_id(spark, monkeypatch):
    """Lines that share an id and a frequent key cost no run."""
    monkeypatch.setattr(le, "short", lambda raw, f=le.short: f(raw) & 15)
    monkeypatch.setattr(le, "PAIRS", 4)
    rows = [(i, f"the common beginning of a line that many share, number {i * 37:04d}") for i in range(60)]
    rows += [(100 + i, f"{i * 41:04d} is the number before the common end of lines of this length") for i in range(60)]
    assert set(run(spark, rows)) == {i for i, _ in rows}


def test_repeated_id_without_the_place(spark):
    """A row under the same id that has fewer lines than the first occurrence's place."""
    line = "a line that is long enough to be matched"
    rows = [(1, "top"), (1, f"first\nsecond\n{line}"), (2, line + "!")]
    out = le.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.row.doc_id, r.text) for r in out) == [(1, f"first\nsecond\n{line}"), (1, "top"), (2, "")]


def test_members_before_the_first_segment(spark, monkeypatch):
    """Rows of a frequent key that came before its first segment are members, those of
    a key without any are not."""
    monkeypatch.setattr(le, "PAIRS", 16)
    probes = [(1, n, le.PROBE) for n in range(40)] + [(2, n, le.PROBE) for n in range(40)]
    entries = spark.createDataFrame([*probes, (1, 40, le.INDEX | le.PROBE | 4)], "key long, line long, mark int").coalesce(1)
    members = le._members(le.written(le._met(entries, 2), "test-met")).collect()
    assert sorted((r.key, r.a, r.side) for r in members) == [(1, n, le.PROBE) for n in range(40)] + [(1, 40, le.INDEX | le.PROBE | 4)]


def test_components_of_stars_take_no_step(spark, monkeypatch):
    """Edges that lead to the roots already are not worked on again."""
    from tillroll.llm import common

    labels = []
    monkeypatch.setattr(common, "written", lambda df, label, f=common.written: labels.append(label) or f(df, label))
    stars = common.components(spark.createDataFrame([(1, 5), (1, 6), (7, 2), (2, 2)], "u long, v long"), "c")
    assert sorted(map(tuple, stars.collect())) == [(1, 1), (2, 2), (5, 1), (6, 1), (7, 2)]
    assert labels == ["c-edges"]
    path = common.components(spark.createDataFrame([(k, k + 1) for k in range(20)], "u long, v long"), "c")
    assert sorted(map(tuple, path.collect())) == [(k, 0) for k in range(21)]
    assert common.components(stars.filter("node < 0").toDF("u", "v"), "c").collect() == []
