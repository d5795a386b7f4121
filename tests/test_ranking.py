"""Distributed order operators against plain single-partition windows."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators import ranking as R


@pytest.fixture(scope="module")
def mixed(spark):
    rnd = random.Random(7)
    base = datetime(2011, 1, 1)
    rows = []
    for i in range(1500):
        rows.append((
            i,
            rnd.choice([None, "a", "b", "B", "z", "ü", "a'b", "x\ny"]),
            rnd.randint(-3, 3),
            None if rnd.random() < 0.05 else Decimal(rnd.randint(-500, 500)) / 100,
            base + timedelta(hours=rnd.randint(0, 50)),
            rnd.choice([1.5, -0.0, 0.0, 2.25]),
        ))
    return spark.createDataFrame(rows, "id long, s string, n int, d decimal(10,2), t timestamp_ntz, f double")


@pytest.mark.parametrize("cols", [["id"], ["s", "id"], ["n", "d", "t", "id"], ["f", "id"], ["s", "n", "id"], ["t", "d", "id"]])
def test_row_number_matches_window(spark, mixed, cols):
    got, n = R.row_number_global(mixed, cols, "rn")
    assert n == 1500
    want = mixed.withColumn("rn", F.row_number().over(Window.orderBy(*[F.col(c).asc() for c in cols])).cast("long"))
    assert sorted(got.select("id", "rn").collect()) == sorted(want.select("id", "rn").collect())


@pytest.mark.parametrize("n", [0, 1, 10, 5000])
def test_row_number_takes_one_path_at_every_size(spark, n):
    """Ten rows are range-sorted and written like five thousand."""
    df = spark.range(n).withColumn("k", (F.col("id") * 7919) % 100_003)
    got, count = R.row_number_global(df, ["k"], "rn")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert count == n and "ranked" in str(got.inputFiles()) if n else count == 0
    assert "Window" in plan
    rows = sorted((r["k"], r["rn"]) for r in got.collect())
    assert [rn for _, rn in rows] == list(range(1, n + 1))


def test_row_number_uses_several_partitions(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got, _ = R.row_number_global(spark.range(4000).withColumn("k", -F.col("id")), ["k"], "rn")
        assert len(got.inputFiles()) > 1
        assert got.filter(F.col("rn") != 4000 - F.col("id")).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("n", [0, 1, 4, 6, 13, 100])
def test_ntile_by_cuts_matches_window(spark, n):
    """Sizes around the tiles, many ties, all values equal, negative and wide values."""
    rows = [(k * 7919 % 1009 - 300, k % 3, 8, (k * 982_451_653_977) % 10**13 - 5 * 10**12) for k in range(n)]
    df = spark.createDataFrame(rows, "id long, v int, same int, wide long")
    got = R.ntile_by_cuts(df, 5, {"t1": "v", "t2": "same", "t3": "wide"}, "id")
    tile = lambda c: F.ntile(5).over(Window.orderBy(c, "id"))
    want = df.withColumns({"t1": tile("v"), "t2": tile("same"), "t3": tile("wide")})
    assert got.dtypes == want.dtypes
    assert sorted(got.collect()) == sorted(want.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_cuts_are_found_in_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(R, "CUT_BUCKETS", 3)
    rnd = random.Random(5)
    rows = [(k, rnd.choice([-5, 0, 3, 7, 1000])) for k in rnd.sample(range(-500, 500), 90)]
    df = spark.createDataFrame(rows, "id long, v long")
    order = sorted((v, k) for k, v in rows)
    assert R.order_cuts(df, ["v"], "id", [1, 18, 45, 90]) == {"v": [order[0], order[17], order[44], order[89]]}


@pytest.mark.parametrize("range_rows", [16, 4_000_000])
def test_rank_within_groups(spark, range_rows):
    rnd = random.Random(3)
    rows = []
    for i in range(1, 801):
        g = "hot" if rnd.random() < 0.4 else rnd.choice([None, "", "a1", "b2", "c3", "a7", "b9"])
        rows.append((i, g, rnd.choice([None, "", "x"])))
    df = spark.createDataFrame(rows, "rid long, g string, h string")
    got = R.rank_within_groups(df, ["g", "h"], "rid", "rk", "sz", range_rows=range_rows)
    w = Window.partitionBy("g", "h")
    want = df.withColumn("rk", F.row_number().over(w.orderBy("rid")).cast("long")).withColumn("sz", F.count(F.lit(1)).over(w))
    assert got.columns == want.columns
    assert sorted(got.select("rid", "rk", "sz").collect()) == sorted(want.select("rid", "rk", "sz").collect())


@pytest.mark.parametrize("bits", [1 << 29, 1 << 15])
def test_rank_repeated(spark, monkeypatch, tmp_path, bits):
    """Single rows, pairs, a hot group, NULLs, no repeats at all; a filter that is far too small."""
    monkeypatch.setattr(R, "FILTER_BITS", bits)
    monkeypatch.setattr(R, "FILTER_BITS_EACH", 16 if bits > 1 << 15 else 1)
    rnd = random.Random(4)
    rows = [(i, "hot" if rnd.random() < 0.3 else rnd.choice([None, "", f"s{i}", f"p{i // 2}", f"p{i // 2}"]), None if i % 2 else "x") for i in range(1, 1501)]
    rows += [(i, "pair", "x") for i in (2000, 2001)]
    df = spark.createDataFrame(rows, "rid long, g string, h string")
    got = R.rank_repeated(df, ["g", "h"], "rid", "rk", "sz", work=str(tmp_path / "work"), range_rows=100)
    w = Window.partitionBy("g", "h")
    want = df.withColumn("rk", F.row_number().over(w.orderBy("rid")).cast("long")).withColumn("sz", F.count(F.lit(1)).over(w))
    assert got.columns == want.columns and sorted(got.select("rid", "rk", "sz").collect()) == sorted(want.select("rid", "rk", "sz").collect())
    for alone in (df.filter("g = 'pair' and rid = 2000"), df.limit(0)):
        got = R.rank_repeated(alone, ["g", "h"], "rid", "rk", "sz", work=str(tmp_path / f"w{alone.count()}"))
        assert [(r.rk, r.sz) for r in got.collect()] == [(1, 1)] * alone.count()


def test_single_rows_are_not_exchanged(spark, tmp_path):
    """Of 5000 rows with ten repeated only those reach the exchange of wide rows."""
    df = spark.range(5000).select(F.col("id").alias("rid"), F.greatest(F.col("id"), F.lit(9)).cast("string").alias("g"))
    got = R.rank_repeated(df, ["g"], "rid", "rk", "sz", work=str(tmp_path / "work"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    alone, met = got.filter("sz = 1").count(), got.filter("sz > 1").count()
    assert (alone, met) == (4990, 10) and plan.startswith("Union")
    first = plan.split("\n:- ")[1].split("\n+- ")[0]
    assert "Window" not in first and "Aggregate" not in first
    moved = got._jdf.queryExecution().analyzed().children().apply(1)
    assert "Window" in moved.toString()


def test_many_hot_groups_join_their_carry_by_shuffle(spark):
    """Twenty groups over forty ranges each: 800 carry rows, and no broadcast."""
    df = spark.range(1, 20_001).select(F.col("id").alias("rid"), (F.col("id") % 20).cast("string").alias("g"))
    got = R.rank_within_groups(df, ["g"], "rid", "rk", "sz", range_rows=500)
    rows = got.collect()
    assert all(r["sz"] == 1000 and r["rk"] == (r["rid"] + 19) // 20 for r in rows) and len(rows) == 20_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
