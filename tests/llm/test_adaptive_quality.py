"""Operator 8: the SQL statement, counts by brute force and edge cases."""

import random
import re
from collections import defaultdict

import pytest
from compare import compare
from pyspark.sql import functions as F

from tillroll.llm import adaptive_quality as aq
from tillroll.llm.common import written

from .helpers import duck_llm, sf_copy

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for k in range(len(words) - 2):
        windows[tuple(words[k : k + 3])].append(k)
    covered = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), sum(c in aq.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered), failed


def got(df):
    return {r[0]: tuple(r[1:7]) for r in df.collect()}


def test_sql(spark):
    r = compare(aq.query(spark, SF), duck_llm(SF), aq.SQL)
    assert r["hash_equal"] and not r["type_diff"], r


def odd_rows():
    rnd = random.Random(2)
    rows = [
        (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t", None, "a"), (4, "a b c a b c", "en", "a"), (5, "a\x0bb\x0cc d", None, None),
        (6, "é # * ü\n\né # * ü\n", "xx", "b"), (7, "x " * 60, "en", "a"), (8, "w w   z", "en", "a"), (9, "\n".join(["same line here"] * 30), "en", "a"),
        (10, " ".join(f"w{k}" for k in range(40_000)), "en", "a"), (11, "a a a a b a a a", "en", "a"), (12, "|<>&%$*#" * 50, "de", "a"),
    ]
    for k in range(13, 120):
        words = [rnd.choice("abcdef") + str(rnd.randrange(30)) for _ in range(rnd.randrange(1, 150))]
        rows.append((k, "".join(w + rnd.choice([" ", " ", "\n", "  ", "\t"]) for w in words), rnd.choice(["en", "de", None]), rnd.choice(["a", "b"])))
    return rows


def test_counts(spark, tmp_path):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", n_words int, kept string")
    d = sf_copy(spark, tmp_path, documents=df)
    out = got(aq.query(spark, d))
    assert out == {r[0]: counts(r[1]) for r in rows}


@pytest.mark.parametrize("least", [200, 3])
def test_sql_on_odd_rows(spark, tmp_path, monkeypatch, least):
    monkeypatch.setattr(aq, "MIN_DOCS", least)
    d = sf_copy(spark, tmp_path, documents=spark.createDataFrame(odd_rows(), SCHEMA))
    con = duck_llm(SF)
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{d}/documents.parquet/*.parquet')")
    r = compare(aq.query(spark, d), con, aq._sql())
    assert r["hash_equal"], r


def test_sketches_merge(spark):
    """Bins of two halves add up to the bins of the whole."""
    df = written(aq.quality_features(spark.createDataFrame(odd_rows(), SCHEMA)), "test-features").withColumn("doc_id", F.col("row.doc_id"))

    def bins(part):
        rows = aq.quality_sketches(part).collect()
        return {(r["level"], r["lang"], r["source"], r["feature"], r["bin"]): r["n"] for r in rows}

    whole, merged = bins(df), defaultdict(int)
    for part in (df.filter("doc_id % 2 = 0"), df.filter("doc_id % 2 = 1")):
        for k, n in bins(part).items():
            merged[k] += n
    assert dict(merged) == whole


def test_outliers_go_and_columns_stay(spark):
    rnd = random.Random(1)
    rows = [(k, " ".join(f"word{rnd.randrange(5000)}" for _ in range(100)), "en", "a") for k in range(300)]
    rows.append((900, " ".join(f"w#{rnd.randrange(5000)}###" for _ in range(100)), "en", "a"))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", row string, total int")
    out = aq.quality_filter(df)
    assert out.columns == df.columns and {r["doc_id"] for r in out.collect()} == set(range(300))
    assert aq.quality_filter(df.limit(0)).collect() == []
    plan = aq.with_verdict(written(aq.quality_features(df), "test-features"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    twice = aq.quality_filter(df.unionByName(df.filter(F.col("doc_id") < 2)))
    assert twice.count() == 302
