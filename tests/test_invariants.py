"""Published fixture values (sf0.001) and pipeline invariants."""

from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from tillroll.operators import analyses as G
from tillroll.operators import profile as B
from tillroll.operators import validate as H
from tillroll.operators import views as V


EXPECTED = {
    "/root/testdata/sf0.001": dict(
        raw=6020, dup=(21, 42, 21), fact=5999,
        types={"SALE": 4801, "CANCELLATION": 818, "STOCK_ADJUSTMENT": 293, "ACCOUNTING_ADJUSTMENT": 23,
               "ZERO_PRICE": 27, "OTHER": 58},
        codes=(380, 200), blanks=(179, 1527, 97), unknown=(95, 222, 1516), invoices=2089,
        dims={"dim_product": 201, "dim_country": 25, "dim_customer": 151, "dim_date": 2406}, months=80,
        orders=(4788, 1444, 634), buyers=(150, 24, 121798),
        money=("110812793.20", "18700352.00", "92112441.20", "76740.16"),
        segments={"ONE_TIME": 1, "REPEAT_2_TO_5": 38, "REPEAT_6_TO_10": 96, "HIGHLY_RECURRENT": 15},
    ),
    "/root/testdata/sf0.01": dict(
        raw=60151, dup=(151, 302, 151), fact=60000,
        types={"SALE": 47921, "CANCELLATION": 8603, "STOCK_ADJUSTMENT": 2876, "ACCOUNTING_ADJUSTMENT": 292,
               "ZERO_PRICE": 258, "OTHER": 201},
        codes=(3710, 1910), blanks=(1719, 15259, 102), unknown=(102, 2468, 15193), invoices=21059,
        dims={"dim_product": 1911, "dim_country": 25, "dim_customer": 1499, "dim_date": 2406}, months=80,
        orders=(47814, 14387, 6552), buyers=(1498, 24, 1215130),
        money=("1154296959.20", "205975138.80", "948321820.40", "80231.94"),
        segments={"ONE_TIME": 11, "REPEAT_2_TO_5": 399, "REPEAT_6_TO_10": 920, "HIGHLY_RECURRENT": 168},
    ),
}


@pytest.fixture(scope="module", params=sorted(EXPECTED))
def built(request, spark):
    from tillroll.plans.warehouse import warehouse_for

    return warehouse_for(spark, request.param), EXPECTED[request.param]


def test_fixture_counts(built):
    wh, e = built
    raw, stg = wh.raw, wh.staging
    assert raw.count() == e["raw"]
    assert tuple(B.duplicate_census(raw).first()) == e["dup"]
    types = {r["record_type"]: r["count"] for r in stg.groupBy("record_type").count().collect()}
    assert types == e["types"]
    codes = stg.agg(F.count_distinct("source_stock_code"), F.count_distinct("stock_code")).first()
    assert tuple(codes) == e["codes"]
    m = B.missing_values(raw).first()
    assert (m["missing_description"], m["missing_customer_id"], m["missing_stock_code"]) == e["blanks"]
    assert raw.agg(F.count_distinct("invoice_no")).first()[0] == e["invoices"]


def test_star_counts(built):
    wh, e = built
    assert wh.fact.count() == e["fact"]
    dims = {d: getattr(wh, d).count() for d in e["dims"]}
    assert dims == e["dims"]
    unknown = wh.fact.agg(*[F.count_if(F.col(k) == 0) for k in ("product_key", "country_key", "customer_key")]).first()
    assert tuple(unknown) == e["unknown"]
    assert V.monthly_kpis(wh).count() == e["months"]


def test_kpi_overview_values(built):
    wh, e = built
    k = V.kpi_overview(wh).first()
    assert (k["positive_sale_lines"], k["positive_order_count"], k["cancelled_invoice_count"]) == e["orders"]
    assert (k["identified_customer_count"], k["sales_country_count"], k["sold_quantity"]) == e["buyers"]
    got = (k["gross_revenue"], k["cancellation_amount"], k["net_revenue"], k["average_order_value"])
    assert got == tuple(Decimal(v) for v in e["money"])


def test_frequency_segments(built):
    wh, e = built
    seg = {r["customer_frequency_segment"]: r["customer_count"] for r in G.customer_frequency_segments(wh).collect()}
    assert seg == e["segments"]


def test_revenue_invariants(wh_small):
    k = V.kpi_overview(wh_small).first()
    months = V.monthly_kpis(wh_small).agg(F.sum("gross_revenue"), F.count(F.lit(1))).first()
    assert abs(months[0] - k["gross_revenue"]) <= Decimal("0.01") * months[1]
    cancelled_positive = wh_small.fact.filter(F.col("is_cancelled") & (F.col("line_amount") > 0)).count()
    if cancelled_positive == 0:
        assert k["net_revenue"] == k["gross_revenue"] - k["cancellation_amount"]
    full = G.revenue_pareto(wh_small, k=wh_small.dim_rows("product")).collect()
    assert full[-1]["cumulative_revenue_share_pct"] == Decimal("100.00")
    shares = [r["cumulative_revenue_share_pct"] for r in full]
    assert shares == sorted(shares)


def test_ntile_sizes_and_no_orphans(wh_small):
    scores = G.rfm_scores(wh_small)
    for c in ("recency_score", "frequency_score", "monetary_score"):
        sizes = [r["count"] for r in scores.groupBy(c).count().collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert all(r["passed"] for r in H.orphans(wh_small).collect())
    assert all(r["passed"] for r in H.constraints(wh_small).collect())


def test_shuffle_joins_match_broadcast(spark, wh_small):
    """With broadcasting off, unknown keys bypass the join and results stay."""
    from tillroll.operators import facts

    stamps = ["raw_ingested_at", "warehouse_loaded_at"]

    def results():
        fact = facts.fact_sales(wh_small.staging, wh_small.dim_customer, wh_small.dim_product, wh_small.dim_country)
        out = {"fact": sorted(fact.drop(*stamps).collect()), "enriched": sorted(V.sales_enriched(wh_small).drop(*stamps).collect())}
        out |= {n: sorted(getattr(V, n)(wh_small).collect()) for n in ("order_summary", "product_kpis", "country_kpis")}
        return out | {"orphans": H.orphans(wh_small).collect()}

    want = results()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = V.sales_enriched(wh_small)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert results() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_changed_input_is_loaded_anew(spark, tmp_path):
    """A file:// path whose input changes gives the new rows, and the replaced
    build and its working frames are gone."""
    import shutil
    from pathlib import Path

    import pyarrow.parquet as pq

    from tillroll.plans.warehouse import INPUT_TABLES, refresh, warehouse_for

    for t in INPUT_TABLES:
        shutil.copy(f"/root/testdata/sf0.001/{t}.parquet", tmp_path / f"{t}.parquet")
    d = f"file://{tmp_path}"
    first = warehouse_for(spark, d)
    n = first.raw.count()
    assert warehouse_for(spark, d).root == first.root
    assert not Path(first.root.removeprefix("file:"), "_work").exists()
    lines = pq.read_table("/root/testdata/sf0.001/lineitem.parquet")
    (tmp_path / "lineitem.parquet").unlink()
    pq.write_table(lines.slice(0, lines.num_rows // 2), tmp_path / "lineitem.parquet", coerce_timestamps="us")
    second = warehouse_for(spark, d)
    assert second.root != first.root and second.raw.count() < n
    assert not Path(first.root.removeprefix("file:")).exists()
    again = refresh(spark, d)
    assert again.root != second.root and again.raw.count() < n and not Path(second.root.removeprefix("file:")).exists()


def test_fact_months_read_their_files_only(wh_small):
    one = wh_small.fact_months(199501, 199502)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sales_month" in plan
    rows = one.select("date_key").collect()
    assert rows and all(19950100 < r["date_key"] < 19950300 for r in rows)
    assert len(rows) == wh_small.fact.filter("date_key between 19950101 and 19950231").count()


def test_calendar_filter_prunes_month_folders(spark, wh_small):
    """A quarter asked for by calendar attributes reads three month folders."""
    from tillroll.plans import catalog

    df = catalog.quarter_sales(wh_small, 1995, 2)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    assert "dynamicpruning" in plan.toString()
    scans = [p for p in _nodes(plan) if "fact_sales" in p.toString().splitlines()[0] and p.nodeName().startswith("Scan")]
    assert [p.metrics().apply("numPartitions").value() for p in scans] == [3]


def _nodes(plan):
    """All nodes of a physical plan, adaptive stages opened."""
    while (name := plan.getClass().getSimpleName()) == "AdaptiveSparkPlanExec" or name.endswith("QueryStageExec"):
        plan = plan.executedPlan() if name == "AdaptiveSparkPlanExec" else plan.plan()
    children = plan.children()
    return [plan, *[n for k in range(children.size()) for n in _nodes(children.apply(k))]]


def test_views_belong_to_the_application(spark, wh_small):
    """Another session of the application finds views and descriptions by name."""
    from tillroll.plans import catalog

    catalog.publish(wh_small)
    other = spark.newSession()
    assert other.table("analytics.v_kpi_overview").collect() == [tuple(r) for r in V.kpi_overview(wh_small).collect()]
    assert other.catalog.getTable("analytics.v_kpi_overview").description == catalog.VIEW_COMMENTS["v_kpi_overview"]
    told = catalog.descriptions(wh_small).groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in told}["schema"] == 4 and {r["kind"]: r["count"] for r in told}["view"] == 7


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    from tillroll.plans import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    monkeypatch.setattr(session, "_configured_dir", lambda s: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
