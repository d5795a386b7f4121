"""Analytical views over the fact table (lazy DataFrames).

Each view joins only the dimensions whose attributes it returns, and joins
them after aggregating where the grouping key is the surrogate key: the
unused joins of the wide enriched view are never planned.  Calendar
attributes come from the invoice date itself (the calendar covers every
invoice date), so no view joins the date dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions import calendar
from tillroll.functions.money import exact_mean, money, percent
from tillroll.operators import facts
from tillroll.operators.ranking import dense_values, value_blocks

# Attributes of the unknown members.
UNKNOWN_ATTRIBUTES = {
    "customer_id": None,
    "stock_code": S.UNKNOWN_NAME,
    "product_description": S.UNKNOWN_PRODUCT_DESCRIPTION,
    "product_category": S.UNKNOWN_CATEGORY,
    "is_merchandise": False,
    "country_name": S.UNKNOWN_NAME,
}
ORDER_REVENUE = "decimal(24,4)"


# -- measures ---------------------------------------------------------------

def P() -> Column:
    return F.col("is_positive_sale")


def X() -> Column:
    return F.col("is_cancelled")


def N() -> Column:
    return F.col("record_type").isin(*S.NET_RECORD_TYPES)


def _sum_if(cond: Column, c: str) -> Column:
    return F.sum(F.when(cond, F.col(c)))


def invoice_measures(
    fact: DataFrame, group: list[str], *, cancelled_qty=False, net_qty=False, stock_qty=False, extra=()
) -> tuple[DataFrame, list[Column]]:
    """Grouped measures whose distinct counts are all over invoices, without
    Spark's ``Expand``: rows are first aggregated per (group, invoice) — a hot
    invoice is absorbed by the partial aggregation — then per group, where an
    invoice counts once if any of its lines is a positive sale (resp. cancelled)."""
    q, a = "quantity", "line_amount"
    per_invoice = fact.groupBy(*group, "invoice_no").agg(
        F.max(P().cast("int")).alias("_p"),
        F.max(X().cast("int")).alias("_x"),
        _sum_if(P(), q).alias("_pq"),
        _sum_if(X(), q).alias("_xq"),
        _sum_if(N(), q).alias("_nq"),
        _sum_if(F.col("is_stock_adjustment"), q).alias("_sq"),
        _sum_if(P(), a).alias("_pa"),
        _sum_if(X(), a).alias("_xa"),
        _sum_if(N(), a).alias("_na"),
        *extra,
    )
    zero = F.lit(0)
    out = [
        F.count_if(F.col("_p") == 1).alias("positive_order_count"),
        F.count_if(F.col("_x") == 1).alias("_x_orders"),
        F.coalesce(F.sum("_pq"), zero).cast("long").alias("sold_quantity"),
    ]
    if cancelled_qty:
        out.append(F.abs(F.coalesce(F.sum("_xq"), zero)).cast("long").alias("cancelled_quantity"))
    if net_qty:
        out.append(F.coalesce(F.sum("_nq"), zero).cast("long").alias("net_quantity"))
    if stock_qty:
        out.append(F.abs(F.coalesce(F.sum("_sq"), zero)).cast("long").alias("stock_adjustment_quantity"))
    out += [
        F.coalesce(F.sum("_pa"), zero).alias("_gross"),
        F.coalesce(F.sum("_xa"), zero).alias("_cancel"),
        F.coalesce(F.sum("_na"), zero).alias("_net"),
    ]
    return per_invoice, out


def gross() -> Column:
    return money("_gross").alias("gross_revenue")


def cancellation() -> Column:
    return money(F.abs(F.col("_cancel"))).alias("cancellation_amount")


def net() -> Column:
    return money("_net").alias("net_revenue")


def aov() -> Column:
    return exact_mean("_gross", "positive_order_count", total_scale=4).alias("average_order_value")


def cancel_rate() -> Column:
    return percent("_x_orders", "positive_order_count + _x_orders").alias("cancellation_invoice_rate_pct")


# -- dimension attachment -----------------------------------------------------

def attach(df: DataFrame, dim: DataFrame, key: str, cols: list[str], own: tuple[str, ...] = ()) -> DataFrame:
    """INNER JOIN on a surrogate key.  Spark broadcasts the dimension if its files
    are small.  Key 0, often a large share of the rows, is not joined: its rows
    carry a hash of themselves (of the columns ``own`` that tell them apart) beside the key,
    match nothing, and get the unknown member's attributes as literals."""
    known = dim.filter(F.col(key) != S.UNKNOWN_KEY).select(
        F.col(key).alias("_k"), F.lit(0).cast("long").alias("_own"), *[F.col(c).alias(f"_a_{c}") for c in cols]
    )
    here = F.col(key) == S.UNKNOWN_KEY
    left = df.withColumn("_row", F.when(here, F.xxhash64(*(own or df.columns)).bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("long")))
    joined = left.join(known, (left[key] == known["_k"]) & (left["_row"] == known["_own"]), "left")
    joined = joined.filter(F.col("_k").isNotNull() | here)
    attributes = {
        c: F.when(here, F.lit(UNKNOWN_ATTRIBUTES[c]).cast(dim.schema[c].dataType)).otherwise(F.col(f"_a_{c}")) for c in cols
    }
    return joined.withColumns(attributes).drop("_row", "_k", "_own", *[f"_a_{c}" for c in cols])


def with_calendar(df: DataFrame, cols: list[str]) -> DataFrame:
    attrs = calendar.attributes(F.to_date("invoice_timestamp"))
    return df.withColumns({c: attrs[c] for c in cols})


# -- F1 .. F7 -----------------------------------------------------------------

ENRICHED_COLUMNS = (
    "sales_key", "raw_row_id", "date_key", "full_date", "calendar_year", "calendar_quarter", "month_number",
    "month_name", "year_month", "week_of_year", "day_of_week", "day_name", "is_weekend", "customer_key",
    "customer_id", "product_key", "stock_code", "product_description", "product_category", "is_merchandise",
    "country_key", "country_name", "invoice_no", "invoice_timestamp", "quantity", "unit_price", "line_amount",
    "record_type", "is_cancelled", "is_stock_adjustment", "is_accounting_adjustment", "is_zero_price",
    "is_missing_customer", "is_missing_description", "is_positive_sale", "source_duplicate_group_size",
    "source_file", "raw_ingested_at", "warehouse_loaded_at",
)
CALENDAR_VIEW_COLUMNS = [
    "full_date", "calendar_year", "calendar_quarter", "month_number", "month_name", "year_month",
    "week_of_year", "day_of_week", "day_name", "is_weekend",
]


def attach_customer_id(wh, df: DataFrame, own: tuple[str, ...]) -> DataFrame:
    """As ``attach`` for the customer id, an integer in the order of its dense key: the
    ids are joined as blocks of a few bits each, written once per build."""
    known = wh.dim_customer.filter(F.col("customer_key") != S.UNKNOWN_KEY)
    blocks = wh.derived("customer_ids", lambda: value_blocks(known, "customer_key", "customer_id"))
    here = F.col("customer_key") == S.UNKNOWN_KEY
    # Rows of key 0 carry a negative key of their own beside it, which is in no block.
    place = F.when(here, F.xxhash64(*own).bitwiseOR(F.lit(-(1 << 63)))).otherwise(F.col("customer_key"))
    kind = wh.dim_customer.schema["customer_id"].dataType.simpleString()
    found = dense_values(df.withColumn("_own", place), blocks, "_own", "customer_id", kind)
    return found.filter(F.col("customer_id").isNotNull() | here).drop("_own")


def sales_enriched(wh) -> DataFrame:
    """fact with customer, product, country and calendar attributes.  Rows are exchanged
    for the products as ``packed`` ones; the calendar is added to the joined rows."""
    df = attach_customer_id(wh, facts.packed(wh.fact), ("raw_row_id",))
    df = attach(
        df, wh.dim_product, "product_key",
        ["stock_code", "product_description", "product_category", "is_merchandise"], ("raw_row_id",),
    )
    df = attach(df, wh.dim_country, "country_key", ["country_name"], ("raw_row_id",))
    df = with_calendar(facts.unpacked(df), CALENDAR_VIEW_COLUMNS)
    notes = {f.name: f.metadata for f in wh.fact.schema.fields}
    return df.select(*[F.col(c).alias(c, metadata=notes.get(c, {})) for c in ENRICHED_COLUMNS])


def order_summary(wh) -> DataFrame:
    """positive-sale lines per (invoice, customer, country)."""
    agg = (
        wh.fact.filter(P())
        .groupBy("invoice_no", "customer_key", "country_key")
        .agg(
            F.min("date_key").alias("date_key"),
            F.min("invoice_timestamp").alias("order_timestamp"),
            F.count(F.lit(1)).alias("line_count"),
            F.count_distinct("product_key").alias("distinct_product_count"),
            F.sum("quantity").cast("long").alias("order_quantity"),
            F.round(F.sum("line_amount"), 4).cast(ORDER_REVENUE).alias("order_revenue"),
        )
    )
    agg = attach(agg, wh.dim_customer, "customer_key", ["customer_id"], ("invoice_no", "country_key"))
    agg = attach(agg, wh.dim_country, "country_key", ["country_name"], ("invoice_no", "customer_key"))
    return agg.select(
        "invoice_no", "customer_key", "customer_id", "country_key", "country_name", "date_key",
        "order_timestamp", "line_count", "distinct_product_count", "order_quantity", "order_revenue",
    )


def _order_groups(fact: DataFrame, *group: str) -> DataFrame:
    """Fact lines reduced to one row per (group, invoice, customer, country):
    the later distinct counts then expand these rows, not every fact line."""
    q, a = "quantity", "line_amount"
    return fact.groupBy(*group, "invoice_no", "customer_key", "country_key").agg(
        F.count_if(P()).alias("_lines"),
        F.max(P().cast("int")).alias("_p"),
        F.max(X().cast("int")).alias("_x"),
        _sum_if(P(), q).alias("_pq"),
        _sum_if(P(), a).alias("_pa"),
        _sum_if(X(), a).alias("_xa"),
        _sum_if(N(), a).alias("_na"),
    )


def _from_order_groups(*, cancels: bool = True, countries: bool = True) -> list[Column]:
    p = F.col("_p") == 1
    zero = F.lit(0)
    out = [F.count_distinct(F.when(p, F.col("invoice_no"))).alias("positive_order_count")]
    if cancels:
        out.append(F.count_distinct(F.when(F.col("_x") == 1, F.col("invoice_no"))).alias("_x_orders"))
    out.append(
        F.count_distinct(F.when(p & (F.col("customer_key") != S.UNKNOWN_KEY), F.col("customer_key"))).alias(
            "identified_customer_count"
        )
    )
    if countries:
        out.append(
            F.count_distinct(F.when(p & (F.col("country_key") != S.UNKNOWN_KEY), F.col("country_key"))).alias(
                "sales_country_count"
            )
        )
    return out + [
        F.coalesce(F.sum("_lines"), zero).cast("long").alias("positive_sale_lines"),
        F.coalesce(F.sum("_pq"), zero).cast("long").alias("sold_quantity"),
        F.coalesce(F.sum("_pa"), zero).alias("_gross"),
        F.coalesce(F.sum("_xa"), zero).alias("_cancel"),
        F.coalesce(F.sum("_na"), zero).alias("_net"),
    ]


def kpi_overview(wh) -> DataFrame:
    """one row of headline KPIs (needs no dimension attribute)."""
    row = _order_groups(wh.fact).agg(*_from_order_groups())
    return row.select(
        "positive_sale_lines",
        "positive_order_count",
        F.col("_x_orders").alias("cancelled_invoice_count"),
        "identified_customer_count",
        "sales_country_count",
        "sold_quantity",
        gross(),
        cancellation(),
        net(),
        aov(),
        cancel_rate(),
    )


def monthly_kpis(wh) -> DataFrame:
    """KPIs per calendar month, in month order."""
    df = with_calendar(wh.fact, ["year_month", "full_date"])
    per_invoice, measures = invoice_measures(df, ["year_month"], cancelled_qty=True, extra=[F.min("full_date").alias("_first_day")])
    agg = per_invoice.groupBy("year_month").agg(F.min("_first_day").alias("month_start"), *measures)
    month = calendar.attributes(F.col("month_start"))
    return agg.select(
        "year_month", *[month[c].alias(c) for c in ("calendar_year", "month_number", "month_name")], "month_start",
        "positive_order_count", F.col("_x_orders").alias("cancelled_invoice_count"),
        "sold_quantity", "cancelled_quantity", gross(), cancellation(), net(), aov(), cancel_rate(),
    ).orderBy(F.col("month_start").asc_nulls_last())


# -- sums without invoice counts: combined before the shuffle ------------------

def _sums(fact: DataFrame, group: list[str], *extra: Column) -> DataFrame:
    """Quantities and amounts per group; each task sends one row per group."""
    zero, q, a = F.lit(0), "quantity", "line_amount"
    return fact.groupBy(*group).agg(
        F.coalesce(_sum_if(P(), q), zero).cast("long").alias("sold_quantity"),
        F.abs(F.coalesce(_sum_if(X(), q), zero)).cast("long").alias("cancelled_quantity"),
        F.coalesce(_sum_if(N(), q), zero).cast("long").alias("net_quantity"),
        F.coalesce(_sum_if(P(), a), zero).alias("_gross"),
        F.coalesce(_sum_if(X(), a), zero).alias("_cancel"),
        F.coalesce(_sum_if(N(), a), zero).alias("_net"),
        *extra,
    )


def monthly_sums(wh) -> DataFrame:
    """Revenue per calendar month."""
    df = with_calendar(wh.fact, ["year_month", "full_date"])
    return _sums(df, ["year_month"], F.min("full_date").alias("month_start")).select(
        "year_month", "month_start", gross(), cancellation(), net()
    )


def product_sums(wh) -> DataFrame:
    """Quantities and revenue per known product, with its attributes."""
    agg = _sums(wh.fact.filter(F.col("product_key") != S.UNKNOWN_KEY), ["product_key"])
    agg = attach(agg, wh.dim_product, "product_key", ["stock_code", "product_description", "is_merchandise"])
    return agg.select(
        "product_key", "stock_code", "product_description", "is_merchandise", "sold_quantity", "cancelled_quantity", "net_quantity",
        gross(), cancellation(), net(), percent("cancelled_quantity", "sold_quantity").alias("cancelled_units_pct_of_sold"),
    )


def product_invoices(wh, products: DataFrame) -> DataFrame:
    """Invoice counts of the few given products (``product_key``), by a
    semi-join of the fact, so only their lines are shuffled."""
    return _invoice_counts(wh.fact.join(products.select("product_key"), "product_key", "left_semi"), "product_key")


def _invoice_counts(fact: DataFrame, key: str) -> DataFrame:
    """Invoices that sold and that were cancelled per key."""
    per_invoice = fact.groupBy(key, "invoice_no").agg(F.max(P().cast("int")).alias("_p"), F.max(X().cast("int")).alias("_x"))
    return per_invoice.groupBy(key).agg(
        F.count_if(F.col("_p") == 1).alias("positive_order_count"), F.count_if(F.col("_x") == 1).alias("cancellation_invoice_count")
    )


def country_sums(wh) -> DataFrame:
    """Gross revenue per country."""
    agg = _sums(wh.fact, ["country_key"])
    return attach(agg, wh.dim_country, "country_key", ["country_name"]).select("country_key", "country_name", gross())


def country_kpis(wh) -> DataFrame:
    """KPIs per country (unknown country kept)."""
    agg = _order_groups(wh.fact).groupBy("country_key").agg(*_from_order_groups(cancels=False, countries=False))
    agg = attach(agg, wh.dim_country, "country_key", ["country_name"])
    return agg.select(
        "country_key", "country_name", "positive_order_count", "identified_customer_count",
        "sold_quantity", gross(), cancellation(), net(), aov(),
    )


def product_kpis(wh) -> DataFrame:
    """KPIs per known product.  There are about as many products of an invoice as fact
    lines, so those rows hold two flags only, and the sums are taken beside them."""
    known = wh.fact.filter(F.col("product_key") != S.UNKNOWN_KEY)
    stock = F.abs(F.coalesce(_sum_if(F.col("is_stock_adjustment"), "quantity"), F.lit(0))).cast("long").alias("stock_adjustment_quantity")
    agg = _sums(known, ["product_key"], stock).join(_invoice_counts(known, "product_key"), "product_key")
    agg = attach(
        agg, wh.dim_product, "product_key",
        ["stock_code", "product_description", "product_category", "is_merchandise"], ("product_key",),
    )
    return agg.select(
        "product_key", "stock_code", "product_description", "product_category", "is_merchandise",
        "positive_order_count", "cancellation_invoice_count",
        "sold_quantity", "cancelled_quantity", "net_quantity", "stock_adjustment_quantity",
        gross(), cancellation(), net(),
        percent("cancelled_quantity", "sold_quantity").alias("cancelled_units_pct_of_sold"),
    )


def customer_kpis(wh, orders: DataFrame | None = None) -> DataFrame:
    """purchase KPIs per identified customer, from the order summary."""
    orders = order_summary(wh) if orders is None else orders
    agg = (
        orders.filter(F.col("customer_key") != S.UNKNOWN_KEY)
        .groupBy("customer_key", "customer_id")
        .agg(
            F.min("order_timestamp").alias("first_order_timestamp"),
            F.max("order_timestamp").alias("last_order_timestamp"),
            F.count(F.lit(1)).alias("order_count"),
            # sets of days and countries of one customer: the calendar and the
            # countries bound them, and two distinct counts would expand the rows
            F.size(F.collect_set(F.to_date("order_timestamp"))).cast("long").alias("active_purchase_days"),
            F.size(F.collect_set("country_key")).cast("long").alias("country_count"),
            F.sum("order_quantity").cast("long").alias("purchased_quantity"),
            F.sum("order_revenue").alias("_revenue"),
            F.datediff(F.max(F.to_date("order_timestamp")), F.min(F.to_date("order_timestamp"))).alias(
                "customer_lifespan_days"
            ),
        )
    )
    return agg.select(
        "customer_key", "customer_id", "first_order_timestamp", "last_order_timestamp", "order_count",
        "active_purchase_days", "country_count", "purchased_quantity",
        money("_revenue").alias("gross_revenue"),
        exact_mean("_revenue", "order_count", total_scale=4).alias("average_order_value"),
        "customer_lifespan_days",
    )

