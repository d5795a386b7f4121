"""Rows are numbered where they are, and queries load no more layers than they read."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.operators import ranking as R
from tillroll.plans import builds, warehouse
from tillroll.plans.registry import QUERIES
from tillroll.sources import fixture


def test_number_kept_and_totals_before(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 37 % 5003 * 3 + 1).alias("k"), (F.col("id") % 4).alias("n")).localCheckpoint()
    got = R.number_kept(df, F.col("n") != 1, "k", "rn", work=str(tmp_path / "kept")).select("k", "rn").collect()
    want = df.filter("n <> 1").select("k", F.row_number().over(Window.orderBy("k")).alias("rn")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    rows = df.unionByName(spark.sql("SELECT CAST(null AS BIGINT) AS k, 5L AS n"))
    got = R.totals_before(rows, "k", "n", "t", work=str(tmp_path / "totals")).collect()
    before = F.sum("n").over(Window.orderBy("k")) - F.col("n")
    assert sorted(map(str, got)) == sorted(map(str, rows.select("k", before.alias("t")).collect()))


def test_raw_rows_equal_one_window(spark, tmp_path):
    """Also where keys of the tables are not unique and a line has no order."""
    tables = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("lineitem", "orders", "customer", "nation", "part")}
    tables["part"] = tables["part"].unionByName(tables["part"].filter("p_partkey % 7 = 0").withColumn("p_name", F.lit("other")))
    tables["orders"] = tables["orders"].unionByName(tables["orders"].filter("o_orderkey % 5 = 0"))
    lost = tables["lineitem"].filter("l_linenumber = 2").limit(3).withColumn("l_orderkey", F.lit(None).cast("long"))
    tables["lineitem"] = tables["lineitem"].filter("l_orderkey < 900").unionByName(lost)
    for t, df in tables.items():
        df.write.parquet(f"{tmp_path}/{t}.parquet")
    rows = fixture.raw_rows(spark, str(tmp_path), work=str(tmp_path / "work")).cache()
    n = fixture.raw_text_rows(spark, str(tmp_path)).count()
    assert n > 4000 and sorted(r[0] for r in rows.select("raw_row_id").collect()) == list(range(1, n + 1))
    order = [c for c in fixture.ROW_ORDER]
    plain = fixture.raw_text_rows(spark, str(tmp_path)).withColumn("raw_row_id", F.row_number().over(Window.orderBy(*order, "_copy")))
    line = lambda df: sorted(map(str, df.select("raw_row_id", *S.RAW_COLUMNS).collect()))
    assert len(line(rows)) == len(line(plain)) == n
    # equal rows may change places, so orders that stand twice are compared without ids
    assert sorted(x.split(",", 1)[1] for x in line(rows)) == sorted(x.split(",", 1)[1] for x in line(plain))


def test_layers_on_demand(spark, tmp_path, monkeypatch):
    """A query of the raw layer loads that alone; a later one carries the build on."""
    monkeypatch.setattr(builds, "builds_dir", lambda s: f"file://{tmp_path}/builds")
    monkeypatch.setattr(warehouse, "_OPENED", {})
    first = warehouse.warehouse_for(spark, SF_SMALL, upto="raw")
    root, n = first.root, first.raw.count()
    assert first.upto == "raw" and "staging" not in first.timings
    assert warehouse.warehouse_for(spark, SF_SMALL, upto="raw") is first
    monkeypatch.setattr(warehouse, "load_raw", lambda *a: pytest.fail("loaded again"))
    full = warehouse.warehouse_for(spark, SF_SMALL)
    assert (full.root, full.upto, full.staging.count()) == (root, "fact", n) and full.fact.count() < n


def test_refresh_loads_twice_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(builds, "builds_dir", lambda s: f"file://{tmp_path}/builds")
    monkeypatch.setattr(warehouse, "_OPENED", {})
    loads, load_raw = [], warehouse.load_raw
    monkeypatch.setattr(warehouse, "load_raw", lambda *a: loads.append(1) or load_raw(*a))
    assert QUERIES["layer_refresh"](spark, SF_SMALL).count() == 7 and len(loads) == 2


def test_product_view_holds_flags_per_invoice(spark, wh_small):
    """Rows per product and invoice carry no sum and no attribute of the product."""
    from tillroll.plans import catalog

    plan = catalog.view(wh_small, "v_product_kpis")._jdf.queryExecution().optimizedPlan().toString()
    per_invoice = [x for x in plan.splitlines() if "Aggregate [" in x and "invoice_no" in x.partition("], [")[0]]
    assert per_invoice and not any("sum(" in x or "stock_code" in x for x in per_invoice)


def test_dense_lookup_and_values(spark, tmp_path):
    """Dense keys of integral ids, also negative, far apart and missing, and back; a key that is not dense is an error."""
    ids = [-5000, -1, 0, 1, 2, 63, 64, 1023, 1024, 5000, 2**31 - 1]
    table = spark.createDataFrame([(v, k) for k, v in enumerate(ids, 1)], "id int, key long")
    rows = spark.createDataFrame([(n, v) for n, v in enumerate([*ids, *ids, None, None, 3, -2, 2**31 - 2])], "n long, at int")
    got = R.dense_lookup(rows, table, "at", "id", "key", "n", work=str(tmp_path / "bits")).select("n", "at", "key").collect()
    assert len(got) == 27 and all(r.key == (ids.index(r["at"]) + 1 if r["at"] in ids else None) for r in got)
    R.value_blocks(table, "key", "id").write.parquet(str(tmp_path / "ids"))
    keys = spark.createDataFrame([(k,) for k in [*range(0, 13), -7, None]], "key long")
    back = R.dense_values(keys, spark.read.parquet(str(tmp_path / "ids")), "key", "id", "int").collect()
    assert len(back) == 15 and all(r.id == (ids[r.key - 1] if r.key in range(1, 12) else None) for r in back)
    with pytest.raises(Exception, match="not dense"):
        R.dense_lookup(rows, table.withColumn("key", F.col("key") * 2), "at", "id", "key", "n", work=str(tmp_path / "gap"))


def test_packed_rows_come_back(spark):
    """Flags, record types and invoice numbers of any form, NULL too."""
    from tillroll.operators import facts

    numbers = ["500123", "C500123", "0123", "C0123", "-5", "c5", "", None, "C", "9" * 18, "9" * 19, "C" + "9" * 19, "٣"]
    flags = [[bool(n >> k & 1) if (n + k) % 3 else None for k in range(len(facts.FLAGS))] for n in range(len(numbers))]
    types = [*S.RECORD_TYPES, None, "", "other"] * 2
    data = [(n, *f, types[n], x) for n, (f, x) in enumerate(zip(flags, numbers, strict=True))]
    df = spark.createDataFrame(data, f"n int, {', '.join(f'{f} boolean' for f in facts.FLAGS)}, record_type string, invoice_no string")
    packed = facts.packed(df)
    assert not {*facts.FLAGS, "record_type", "invoice_no"} & set(packed.columns)
    assert sorted(map(tuple, facts.unpacked(packed).select(*df.columns).collect())) == data


def test_load_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    """Every step's shuffle files are gone when it has ended; the session's setting stays."""
    from tillroll.plans import session

    monkeypatch.setattr(builds, "builds_dir", lambda s: f"file://{tmp_path}/builds")
    before = spark.conf.get(session._CLEANUP)
    left = lambda: sum(1 for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n") if f.endswith(".data"))
    spark.range(1000).repartition(4, "id").count()
    first = left()
    wh = warehouse.build(spark, SF_SMALL, root=f"file://{tmp_path}/tillroll/w")
    assert left() <= first and spark.conf.get(session._CLEANUP) == before
    assert wh.fact.count() == wh.rows["fact_sales"] > 0


def test_facts_are_exchanged_narrow(spark, wh_small, monkeypatch):
    """No flag, record type or amount goes through an exchange of the fact load, and with the
    customers' bits broadcast no exchange is by customer; the view's calendar is added last."""
    from tillroll.operators import facts, views

    rows = facts.keyed_rows(wh_small.staging, wh_small.dim_customer, wh_small.dim_product, wh_small.dim_country)
    assert not {*facts.FLAGS, "record_type", "line_amount", "customer_id"} & set(rows.columns)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = views.sales_enriched(wh_small)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    below = plan[plan.index("Join ") :]
    assert "AS year_month" not in below and "AS week_of_year" not in below


def test_product_kpis_hold_flags_per_invoice(spark, wh_small):
    from tillroll.operators import views

    plan = views.product_kpis(wh_small)._jdf.queryExecution().optimizedPlan().toString()
    per_invoice = [x for x in plan.splitlines() if "Aggregate [" in x and "invoice_no" in x.partition("], [")[0]]
    assert per_invoice and not any("sum(" in x for x in per_invoice)
