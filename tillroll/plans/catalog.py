"""The warehouse in the session catalog: schemas, tables and views with descriptions.

``publish`` registers the stored layers as external tables and saves the seven
analytical views as SQL text, so any session of the application -- and, where the
catalog is a shared metastore, any application -- can query them by name.  Every
schema, table, column and view carries its description in the catalog;
``descriptions`` reads them back from there.

The enriched view joins the calendar on the day and on the fact's month folder: a
filter on calendar attributes then prunes folders at run time (Spark's dynamic
partition pruning).  Views count invoices on rows combined per invoice first, so no
fact line is expanded for a distinct count; per product there are about as many of these
as fact lines, so they hold flags only there, and the sums are taken beside them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.money import ratio_sql
from tillroll.operators.views import ENRICHED_COLUMNS, ORDER_REVENUE
from tillroll.plans.session import builds_dir

SCHEMA_COMMENTS = {
    "raw": "Source lines as text, exactly as they were read.",
    "staging": "Typed and classified lines, one per source line.",
    "warehouse": "Star schema: dimensions with unknown members and the sales fact.",
    "analytics": "Views with the measures that reports are made of.",
}

VIEW_COMMENTS = {
    "v_sales_enriched": "Every fact line with its customer, product, country and calendar attributes.",
    "v_order_summary": "Positive sales per invoice, customer and country.",
    "v_kpi_overview": "One row of headline figures over all sales.",
    "v_monthly_kpis": "Orders, quantities and revenue per calendar month.",
    "v_country_kpis": "Orders, customers and revenue per country.",
    "v_product_kpis": "Orders, quantities and revenue per known product.",
    "v_customer_kpis": "Purchases of each identified customer.",
}

_TABLES = tuple(S.TABLE_COMMENTS)
# application -> root of the build that its catalog shows
_SHOWN: dict[str, str] = {}


def _money(x: str) -> str:
    return f"CAST(round({x}, 2) AS DECIMAL(18,2))"


def _percent(part: str, whole: str) -> str:
    return ratio_sql(part, whole, factor=100)


_AOV = ratio_sql("gross", "orders", num_scale=4)
_CANCEL_RATE = _percent("cancels", "orders + cancels")

#: Per invoice (and group): whether it sold and was cancelled, and its sums.
_INVOICE = {
    "sold": "bool_or(is_positive_sale)",
    "cancelled": "bool_or(is_cancelled)",
    "sale_lines": "count_if(is_positive_sale)",
    **{
        f"{name}_{unit}": f"sum({column}) FILTER (WHERE {condition})"
        for name, condition in {
            "sale": "is_positive_sale",
            "cancel": "is_cancelled",
            "net": f"record_type IN ({', '.join(repr(t) for t in S.NET_RECORD_TYPES)})",
            "stock": "is_stock_adjustment",
        }.items()
        for unit, column in (("units", "quantity"), ("amount", "line_amount"))
    },
}
#: Over the invoices of a group.
_GROUP = {
    "lines": "CAST(coalesce(sum(sale_lines), 0) AS BIGINT)",
    "orders": "count(DISTINCT CASE WHEN sold THEN invoice_no END)",
    "cancels": "count(DISTINCT CASE WHEN cancelled THEN invoice_no END)",
    **{f"{n}_units": f"CAST(coalesce(sum({n}_units), 0) AS BIGINT)" for n in ("sale", "cancel", "net", "stock")},
    "gross": "coalesce(sum(sale_amount), 0)",
    "cancelled_amount": "coalesce(sum(cancel_amount), 0)",
    "net": "coalesce(sum(net_amount), 0)",
}
# An invoice has one row here, so counting rows is counting invoices.
_ONE_ROW_EACH = {"orders": "count_if(sold)", "cancels": "count_if(cancelled)"}


def _aliased(columns: dict[str, str]) -> str:
    return ", ".join(f"{x} AS {n}" for n, x in columns.items())


def _by_invoice(source: str, group: list[str], grouped: dict[str, str], out: dict[str, str], extra: dict[str, str] | None = None) -> str:
    """Rows per invoice and ``group`` (``extra`` beside the sums), combined by
    ``grouped``, a part of the group, and shown as ``out``."""
    keys = ", ".join(["invoice_no", *group])
    inner = f"SELECT {keys}, {_aliased({**_INVOICE, **(extra or {})})} FROM {source} GROUP BY {keys}"
    by = [n for n, x in grouped.items() if n == x]
    middle = f"SELECT {_aliased(grouped)} FROM ({inner})" + (f" GROUP BY {', '.join(by)}" if by else "")
    return f"SELECT {_aliased(out)} FROM ({middle})"


def _product_sql(attributes: list[str], out: dict[str, str]) -> str:
    """Per known product: sums, of which a task sends one row per product, beside counts
    of invoices, whose rows per invoice hold no more than keys and two flags.  Attributes
    are joined to the few grouped rows."""
    fact = f"FROM warehouse.fact_sales WHERE product_key <> {S.UNKNOWN_KEY}"
    flags = {n: _INVOICE[n] for n in ("sold", "cancelled")}
    sums = {n: x for n, x in _INVOICE.items() if n not in flags and n != "sale_lines"}
    counts = {"orders": "count_if(sold)", "cancels": "count_if(cancelled)"}
    invoices = f"SELECT product_key, {_aliased(flags)} {fact} GROUP BY product_key, invoice_no"
    totals = {n: x for n, x in _GROUP.items() if n not in (*counts, "lines")}
    return f"""SELECT {_aliased({k: f"p.{k}" if k in attributes else x for k, x in out.items()})}
        FROM (SELECT product_key, {_aliased(totals)} FROM (SELECT product_key, {_aliased(sums)} {fact} GROUP BY product_key) GROUP BY product_key) AS s
        JOIN (SELECT product_key, {_aliased(counts)} FROM ({invoices}) GROUP BY product_key) AS n ON n.product_key = s.product_key
        JOIN warehouse.dim_product AS p ON p.product_key = s.product_key"""


def _enriched_sql() -> str:
    tables = {"dim_customer": "c", "dim_product": "p", "dim_country": "n"}
    owner = {"customer_id": "c", "country_name": "n", "stock_code": "p", "product_description": "p", "product_category": "p", "is_merchandise": "p"}
    fact = {f.name for f in _fact_fields()}
    columns = [f"{owner.get(c) or ('f' if c in fact else 'd')}.{c}" for c in ENRICHED_COLUMNS]
    joins = [f"JOIN warehouse.{t} AS {a} ON {a}.{t[4:]}_key = f.{t[4:]}_key" for t, a in tables.items()]
    calendar = "JOIN warehouse.dim_date AS d ON d.date_key = f.date_key AND CAST(d.date_key DIV 100 AS INT) = f.sales_month"
    return f"SELECT {', '.join(columns)} FROM warehouse.fact_sales AS f {' '.join(joins)} {calendar}"


def _fact_fields():
    from pyspark.sql import types as T

    from tillroll.operators import facts

    return T.StructType.fromDDL(facts.FACT_DDL).fields


def view_sql() -> dict[str, str]:
    """The views' SQL, in dependency order."""
    sales = "analytics.v_sales_enriched"
    keys = {k: k for k in ("customer_key", "country_key")}
    customers = f"count(DISTINCT CASE WHEN sold AND customer_key <> {S.UNKNOWN_KEY} THEN customer_key END)"
    countries = f"count(DISTINCT CASE WHEN sold AND country_key <> {S.UNKNOWN_KEY} THEN country_key END)"
    revenue = {"gross_revenue": _money("gross"), "cancellation_amount": _money("abs(cancelled_amount)"), "net_revenue": _money("net")}
    month = ["year_month", "calendar_year", "month_number", "month_name"]
    product = ["product_key", "stock_code", "product_description", "product_category", "is_merchandise"]
    order_keys = "invoice_no, customer_key, customer_id, country_key, country_name"
    first, last = "min(order_timestamp)", "max(order_timestamp)"
    return {
        "v_sales_enriched": _enriched_sql(),
        "v_order_summary": f"""SELECT {order_keys}, min(date_key) AS date_key, min(invoice_timestamp) AS order_timestamp,
            count(*) AS line_count, count(DISTINCT product_key) AS distinct_product_count, CAST(sum(quantity) AS BIGINT) AS order_quantity,
            CAST(round(sum(line_amount), 4) AS {ORDER_REVENUE}) AS order_revenue
            FROM {sales} WHERE is_positive_sale GROUP BY {order_keys}""",
        "v_kpi_overview": _by_invoice(
            sales, list(keys), {**_GROUP, "customers": customers, "countries": countries},
            {"positive_sale_lines": "lines", "positive_order_count": "orders", "cancelled_invoice_count": "cancels",
             "identified_customer_count": "customers", "sales_country_count": "countries", "sold_quantity": "sale_units",
             **revenue, "average_order_value": _AOV, "cancellation_invoice_rate_pct": _CANCEL_RATE},
        ),
        "v_monthly_kpis": _by_invoice(
            sales, month, {**{k: k for k in month}, "month_start": "min(first_day)", **_GROUP, **_ONE_ROW_EACH},
            {**{k: k for k in month}, "month_start": "month_start", "positive_order_count": "orders", "cancelled_invoice_count": "cancels",
             "sold_quantity": "sale_units", "cancelled_quantity": "abs(cancel_units)", **revenue,
             "average_order_value": _AOV, "cancellation_invoice_rate_pct": _CANCEL_RATE},
            {"first_day": "min(full_date)"},
        ),
        "v_country_kpis": _by_invoice(
            sales, ["country_key", "country_name", "customer_key"],
            {"country_key": "country_key", "country_name": "country_name", **_GROUP, "customers": customers},
            {"country_key": "country_key", "country_name": "country_name", "positive_order_count": "orders",
             "identified_customer_count": "customers", "sold_quantity": "sale_units", **revenue, "average_order_value": _AOV},
        ),
        "v_product_kpis": _product_sql(
            product,
            {**{k: k for k in product}, "positive_order_count": "orders", "cancellation_invoice_count": "cancels", "sold_quantity": "sale_units",
             "cancelled_quantity": "abs(cancel_units)", "net_quantity": "net_units", "stock_adjustment_quantity": "abs(stock_units)", **revenue,
             "cancelled_units_pct_of_sold": _percent("abs(cancel_units)", "sale_units")},
        ),
        "v_customer_kpis": f"""SELECT customer_key, customer_id, first_order_timestamp, last_order_timestamp, orders AS order_count,
            active_purchase_days, country_count, units AS purchased_quantity, {_money("gross")} AS gross_revenue,
            {_AOV} AS average_order_value, datediff(last_order_timestamp, first_order_timestamp) AS customer_lifespan_days
            FROM (SELECT customer_key, customer_id, {first} AS first_order_timestamp, {last} AS last_order_timestamp, count(*) AS orders,
                CAST(size(collect_set(to_date(order_timestamp))) AS BIGINT) AS active_purchase_days,
                CAST(size(collect_set(country_key)) AS BIGINT) AS country_count,
                CAST(sum(order_quantity) AS BIGINT) AS units, sum(order_revenue) AS gross
                FROM analytics.v_order_summary WHERE customer_key <> {S.UNKNOWN_KEY} GROUP BY customer_key, customer_id)""",
    }


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish(wh) -> None:
    """Show this build in the catalog: replaces the tables' locations and the views.
    The tables are external, so dropping their entries deletes no file."""
    spark, app = wh.spark, wh.spark.sparkContext.applicationId
    if _SHOWN.get(app) == wh.root:
        return
    for name, comment in SCHEMA_COMMENTS.items():
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION {_text(f'{builds_dir(spark)}/catalog-{app}/{name}')}")
        spark.sql(f"COMMENT ON SCHEMA {name} IS {_text(comment)}")
    for stored in _TABLES:
        layer, name = stored.split("/")
        fact = name == "fact_sales"
        fields = (wh.fact_files if fact else wh.table(stored)).schema.fields
        notes = S.COLUMN_COMMENTS.get(stored, {})
        columns = [f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {_text(notes[f.name])}" if f.name in notes else "") for f in fields]
        spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
        spark.sql(
            f"CREATE TABLE {layer}.{name} ({', '.join(columns)}) USING parquet {'PARTITIONED BY (sales_month)' if fact else ''} "
            f"COMMENT {_text(S.TABLE_COMMENTS[stored])} LOCATION {_text(wh.path(stored))}"
        )
        if fact:
            spark.sql(f"ALTER TABLE {layer}.{name} RECOVER PARTITIONS")
    for name, sql in view_sql().items():
        spark.sql(f"CREATE OR REPLACE VIEW analytics.{name} COMMENT {_text(VIEW_COMMENTS[name])} AS {sql}")
    _SHOWN[app] = wh.root


def view(wh, name: str) -> DataFrame:
    """A saved view of this build, by its name in the catalog."""
    publish(wh)
    return wh.spark.table(f"analytics.{name}")


def descriptions(wh) -> DataFrame:
    """A10: what schemas, tables, columns and views are, as the catalog tells it, with
    the rows of each table and view, a column's values, a schema's tables and views."""
    publish(wh)
    catalog, parts = wh.spark.catalog, []
    for schema in SCHEMA_COMMENTS:
        held = sorted(t.name for t in catalog.listTables(schema) if not t.isTemporary)
        told = [("schema", schema, "", catalog.getDatabase(schema).description, F.lit(len(held)).cast("long"))]
        parts.append(_told(wh.spark.range(1), told))
        for name in held:
            full = f"{schema}.{name}"
            entry, columns = catalog.getTable(full), [c for c in catalog.listColumns(full) if c.description]
            kind = "view" if entry.tableType == "VIEW" else "table"
            told = [(kind, full, "", entry.description, F.count(F.lit(1)))]
            if kind == "table":
                told += [("column", full, c.name, c.description, F.count(F.col(c.name))) for c in columns]
            parts.append(_told(wh.spark.table(full), told))
    return reduce(DataFrame.unionByName, parts)


def _told(df: DataFrame, told: list[tuple]) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[n.alias(f"_n{k}") for k, (*_, n) in enumerate(told)])
    rows = [
        F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.lit(c).alias("column_name"), F.lit(text).alias("description"), F.col(f"_n{k}").alias("counted"))
        for k, (kind, name, c, text, _) in enumerate(told)
    ]
    return counts.select(F.inline(F.array(*rows)))


def quarter_sales(wh, year: int, quarter: int) -> DataFrame:
    """Sales per month and country of one quarter, by the enriched view.  The
    filtered calendar prunes the fact to the quarter's month folders."""
    publish(wh)
    return wh.spark.sql(
        f"""SELECT year_month, country_name, count(*) AS line_count, CAST(sum(quantity) AS BIGINT) AS units,
            {_money("coalesce(sum(line_amount) FILTER (WHERE is_positive_sale), 0)")} AS gross_revenue
        FROM analytics.v_sales_enriched WHERE calendar_year = {year} AND calendar_quarter = {quarter}
        GROUP BY year_month, country_name"""
    )
