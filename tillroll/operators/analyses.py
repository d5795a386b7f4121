"""Business analyses over the views.

Top-k reports are cut with ``orderBy(...).limit(k)`` first (a distributed
top-k: each task keeps its k best rows) and ranked afterwards inside the k
rows: the first k rows of the full order carry the same dense ranks as in
the full ranking.  Cumulative shares need only those k rows and the total.
Order-based scores over all customers (NTILE) compare with exact cut points.
Every ranking gets the natural key as final tie-break, so results are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.money import exact_mean, money, percent
from tillroll.operators import views
from tillroll.operators.ranking import ntile_by_cuts
from tillroll.plans.session import materialize, run_root


def _top(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def _dense_rank_in(df: DataFrame, value: str, out: str) -> Column:
    """Dense rank by ``value`` desc inside an already cut top-k frame."""
    return F.dense_rank().over(Window.orderBy(F.col(value).desc())).cast("long").alias(out)


def kpi_overview(wh) -> DataFrame:
    """G1."""
    return views.kpi_overview(wh)


def monthly_growth(wh) -> DataFrame:
    """Gross revenue against the previous month.  One row per month, so
    the unpartitioned LAG window holds at most a few hundred rows."""
    months = views.monthly_sums(wh).select("year_month", "month_start", "gross_revenue", "net_revenue")
    prev = F.lag("gross_revenue").over(Window.orderBy(F.col("month_start").asc_nulls_last()))
    with_prev = months.withColumn("previous_month_gross_revenue", prev)
    return with_prev.select(
        "year_month",
        "gross_revenue",
        "net_revenue",
        "previous_month_gross_revenue",
        percent(
            "gross_revenue - previous_month_gross_revenue", "previous_month_gross_revenue", num_scale=2, den_scale=2
        ).alias("gross_revenue_growth_pct"),
        "month_start",
    ).orderBy(F.col("month_start").asc_nulls_last()).drop("month_start")


def top_countries(wh, k: int = S.TOP_COUNTRIES_ROWS) -> DataFrame:
    """G3."""
    top = _top(views.country_kpis(wh), [F.col("gross_revenue").desc(), F.col("country_name").asc()], k)
    return top.select(
        "country_name", "positive_order_count", "identified_customer_count", "sold_quantity",
        "gross_revenue", "net_revenue", "average_order_value",
        _dense_rank_in(top, "gross_revenue", "revenue_rank"),
    )


def _merchandise(products: DataFrame) -> DataFrame:
    return products.filter(F.col("is_merchandise"))


def _top_products(wh, p: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The k first products by their sums; their invoices are counted afterwards.
    The k rows are written, as both sides of the join need them."""
    top = materialize(_top(p, order, k), run_root(p.sparkSession, "top-products"))
    return top.join(views.product_invoices(wh, top), "product_key")


def top_products_by_quantity(wh, k: int = S.TOP_PRODUCTS_ROWS) -> DataFrame:
    """G4."""
    p = _merchandise(views.product_sums(wh)).filter(F.col("net_quantity") > 0)
    top = _top_products(wh, p, [F.col("net_quantity").desc(), F.col("stock_code").asc()], k)
    return top.select(
        "stock_code", "product_description", "positive_order_count", "sold_quantity", "cancelled_quantity",
        "net_quantity", "net_revenue", _dense_rank_in(top, "net_quantity", "quantity_rank"),
    )


def top_products_by_revenue(wh, k: int = S.TOP_PRODUCTS_ROWS) -> DataFrame:
    """G5."""
    p = _merchandise(views.product_sums(wh)).filter(F.col("net_revenue") > 0)
    top = _top_products(wh, p, [F.col("net_revenue").desc(), F.col("stock_code").asc()], k)
    return top.select(
        "stock_code", "product_description", "positive_order_count", "sold_quantity", "cancelled_quantity",
        "gross_revenue", "cancellation_amount", "net_revenue", _dense_rank_in(top, "net_revenue", "revenue_rank"),
    )


def top_customers(wh, k: int = S.TOP_CUSTOMERS_ROWS) -> DataFrame:
    """G6."""
    top = _top(views.customer_kpis(wh), [F.col("gross_revenue").desc(), F.col("customer_id").asc()], k)
    return top.select(
        "customer_id", "order_count", "purchased_quantity", "gross_revenue", "average_order_value",
        "first_order_timestamp", "last_order_timestamp",
        _dense_rank_in(top, "gross_revenue", "customer_revenue_rank"),
    )


def frequency_segment(order_count: Column) -> Column:
    expr = None
    for label, lo, hi in S.FREQUENCY_SEGMENTS:
        cond = order_count >= lo if hi is None else order_count.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def customer_frequency_segments(wh) -> DataFrame:
    """G7."""
    c = views.customer_kpis(wh)
    seg = c.groupBy(frequency_segment(F.col("order_count")).alias("customer_frequency_segment")).agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("order_count").alias("_orders"),
        F.sum("gross_revenue").alias("_revenue"),
        F.min("order_count").alias("_min_orders"),
    )
    return seg.select(
        "customer_frequency_segment",
        "customer_count",
        exact_mean("_orders", "customer_count").alias("average_order_count"),
        money("_revenue").alias("segment_revenue"),
        "_min_orders",
    ).orderBy("_min_orders").drop("_min_orders")


def top_product_per_month(wh) -> DataFrame:
    """Best merchandise product by net revenue in each month.  The
    per-month winner is a minimum over (-net revenue, code) — an aggregate
    with partial aggregation, not a window."""
    merch = wh.dim_product.filter(F.col("is_merchandise"))
    fact = views.with_calendar(wh.fact, ["year_month"])
    per_product = fact.groupBy("year_month", "product_key").agg(
        F.round(F.sum(F.when(views.N(), F.col("line_amount"))), 2).cast(S.MONEY).alias("net_revenue")
    )
    # attributes (and the merchandise filter) joined to month x product rows, not to fact lines
    known = per_product.filter(F.col("product_key") != S.UNKNOWN_KEY)
    monthly = views.attach(known, merch, "product_key", ["stock_code", "product_description"])
    best = F.min(
        F.struct(
            (-F.col("net_revenue")).alias("neg"),
            F.col("stock_code").alias("stock_code"),
            F.col("product_description").alias("product_description"),
            F.col("net_revenue").alias("net_revenue"),
        )
    )
    top = monthly.filter(F.col("net_revenue") > 0).groupBy("year_month").agg(best.alias("b"))
    return top.select(
        "year_month", "b.stock_code", "b.product_description", "b.net_revenue"
    ).orderBy("year_month")


def revenue_pareto(wh, k: int = S.PARETO_ROWS) -> DataFrame:
    """Net revenue share and cumulative share of the top-k merchandise
    products.  The running sum of the first k rows needs only those rows;
    the grand total is a global aggregate (one row, broadcast)."""
    p = _merchandise(views.product_sums(wh)).filter(F.col("net_revenue") > 0).select(
        "stock_code", "product_description", "net_revenue"
    )
    total = p.agg(F.sum("net_revenue").alias("total_revenue"))
    top = _top(p, [F.col("net_revenue").desc(), F.col("stock_code").asc()], k)
    running = F.sum("net_revenue").over(
        Window.orderBy(F.col("net_revenue").desc(), F.col("stock_code").asc()).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
    )
    return (
        top.crossJoin(F.broadcast(total))
        .withColumn("cumulative_revenue", running)
        .select(
            "stock_code",
            "product_description",
            "net_revenue",
            percent("net_revenue", "total_revenue", num_scale=2, den_scale=2).alias("revenue_share_pct"),
            percent("cumulative_revenue", "total_revenue", num_scale=2, den_scale=2).alias(
                "cumulative_revenue_share_pct"
            ),
        )
        .orderBy(F.col("net_revenue").desc(), F.col("stock_code").asc())
    )


def most_cancelled_products(wh, k: int = S.MOST_CANCELLED_ROWS) -> DataFrame:
    """G10."""
    p = _merchandise(views.product_sums(wh)).filter(F.col("cancelled_quantity") > 0)
    return _top_products(wh, p, [F.col("cancelled_quantity").desc(), F.col("stock_code").asc()], k).select(
        "stock_code", "product_description", "positive_order_count", "cancellation_invoice_count",
        "sold_quantity", "cancelled_quantity", "cancelled_units_pct_of_sold", "cancellation_amount",
    )


# -- RFM --------------------------------------------------------------------

def reference_date(wh) -> DataFrame:
    """The day after the last calendar day (one row)."""
    return wh.dim_date.filter(~F.col("is_unknown")).agg(F.date_add(F.max("full_date"), 1).alias("reference_date"))


def rfm_measures(wh) -> DataFrame:
    """Recency (days), frequency (order-summary rows), monetary value."""
    orders = views.order_summary(wh).filter(F.col("customer_key") != S.UNKNOWN_KEY)
    per_customer = orders.groupBy("customer_id").agg(
        F.max(F.to_date("order_timestamp")).alias("_last"),
        F.count(F.lit(1)).alias("frequency"),
        money(F.sum("order_revenue")).alias("monetary_value"),
    )
    return per_customer.crossJoin(F.broadcast(reference_date(wh))).select(
        "customer_id",
        F.datediff("reference_date", "_last").alias("recency_days"),
        "frequency",
        "monetary_value",
    )


def rfm_scores(wh) -> DataFrame:
    """Quintile scores; ties broken by customer_id.  The measures are written
    once per build; the scores compare each row with the ends of the quintiles."""
    m = wh.derived("rfm_measures", lambda: rfm_measures(wh).withColumn("_cents", (F.col("monetary_value") * 100).cast("long")))
    outs = {"_r": "recency_days", "frequency_score": "frequency", "monetary_score": "_cents"}
    return ntile_by_cuts(m, S.RFM_TILES, outs, "customer_id").select(
        "customer_id", "recency_days", "frequency", "monetary_value",
        (F.lit(S.RFM_TILES + 1) - F.col("_r")).cast("int").alias("recency_score"),
        "frequency_score", "monetary_score",
    )


def rfm_segment() -> Column:
    out = F.lit(S.OTHER_RFM_SEGMENT)
    for label, condition in reversed(S.RFM_SEGMENT_RULES):
        out = F.when(F.expr(condition), F.lit(label)).otherwise(out)
    return out


def rfm_segments(wh) -> DataFrame:
    """G11d."""
    scores = [F.col(c).cast("string") for c in ("recency_score", "frequency_score", "monetary_score")]
    return rfm_scores(wh).withColumns({"rfm_score": F.concat(*scores), "rfm_segment": rfm_segment()})


def rfm_summary(wh) -> DataFrame:
    """G11."""
    seg = rfm_segments(wh)
    agg = seg.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("recency_days").alias("_r"),
        F.sum("frequency").alias("_f"),
        F.sum("monetary_value").alias("_m"),
    )
    return agg.select(
        "rfm_segment",
        "customer_count",
        exact_mean("_r", "customer_count").alias("average_recency_days"),
        exact_mean("_f", "customer_count").alias("average_frequency"),
        exact_mean("_m", "customer_count", total_scale=2).alias("average_monetary_value"),
        money("_m").alias("total_segment_revenue"),
    ).orderBy(F.col("total_segment_revenue").desc())


# -- README examples and reported measures ------------------------------------

def example_monthly_revenue(wh) -> DataFrame:
    """G12."""
    return views.monthly_kpis(wh).select(
        "year_month", "gross_revenue", "cancellation_amount", "net_revenue", "average_order_value"
    ).orderBy("year_month")


def example_top_merchandise(wh, k: int = S.TOP_PRODUCTS_ROWS) -> DataFrame:
    """G13."""
    p = _merchandise(views.product_sums(wh)).filter(F.col("net_revenue") > 0)
    return _top(p, [F.col("net_revenue").desc(), F.col("stock_code").asc()], k).select(
        "stock_code", "product_description", "net_quantity", "gross_revenue", "cancellation_amount", "net_revenue"
    )


def example_top_customers(wh, k: int = S.TOP_CUSTOMERS_ROWS) -> DataFrame:
    """G14."""
    return _top(views.customer_kpis(wh), [F.col("gross_revenue").desc(), F.col("customer_id").asc()], k).select(
        "customer_id", "order_count", "gross_revenue", "average_order_value"
    )


def country_revenue_share(wh) -> DataFrame:
    """Each country's share of the summed country gross revenue."""
    c = views.country_sums(wh)
    total = c.agg(F.sum("gross_revenue").alias("_total"))
    return c.crossJoin(F.broadcast(total)).select(
        "country_key", "country_name", "gross_revenue",
        percent("gross_revenue", "_total", num_scale=2, den_scale=2).alias("gross_revenue_share_pct"),
    )


def segment_share(wh) -> DataFrame:
    """Frequency segments' share of customers and of revenue."""
    seg = customer_frequency_segments(wh)
    total = seg.agg(F.sum("customer_count").alias("_c"), F.sum("segment_revenue").alias("_r"))
    return seg.crossJoin(F.broadcast(total)).select(
        "customer_frequency_segment", "customer_count", "segment_revenue",
        percent("customer_count", "_c").alias("customer_share_pct"),
        percent("segment_revenue", "_r", num_scale=2, den_scale=2).alias("revenue_share_pct"),
    )


def cancellation_ratio_ranking(wh, k: int = S.MOST_CANCELLED_ROWS) -> DataFrame:
    """Merchandise with the highest cancelled share of sold units."""
    p = _merchandise(views.product_sums(wh)).filter(F.col("cancelled_units_pct_of_sold").isNotNull())
    order = [
        F.col("cancelled_units_pct_of_sold").desc(), F.col("cancelled_quantity").desc(), F.col("stock_code").asc()
    ]
    return _top(p, order, k).select(
        "stock_code", "product_description", "sold_quantity", "cancelled_quantity", "cancelled_units_pct_of_sold"
    )


def code_merge_report(wh) -> DataFrame:
    """Distinct source codes, distinct normalised codes and their difference;
    one narrow distinct each."""

    def distinct(c: str, out: str) -> DataFrame:
        return wh.staging.select(c).filter(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1)).alias(out))

    both = distinct("source_stock_code", "source_code_count").crossJoin(distinct("stock_code", "normalized_code_count"))
    return both.withColumn("merged_code_count", F.col("source_code_count") - F.col("normalized_code_count"))


def non_merchandise_codes(wh) -> DataFrame:
    """Known products whose category is not merchandise."""
    return (
        wh.dim_product.filter(~F.col("is_unknown") & (F.col("product_category") != S.MERCHANDISE_CATEGORY))
        .select("stock_code", "product_description", "product_category")
        .orderBy("product_category", "stock_code")
    )
