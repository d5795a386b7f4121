"""Data-quality profile of the raw text layer.

Every measure of a group is a filtered aggregate in one scan.  Checks that
parse text without a format guard use ``strict`` casts (a malformed value
aborts them, as in the original); the guarded ones use a regex first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.money import money
from tillroll.functions.text import is_blank, is_cancel_invoice, matches, missing_label

# Prices as numbers: 20 digits before the point and 18 after it.
PROFILE_NUMERIC = "decimal(38,18)"
# A price times a quantity must fit 38 digits: ten of the quantity, and ten decimals.
REVENUE_PRICE = "decimal(27,10)"


def strict_cast(c: str | Column, target: str, what: str) -> Column:
    """Cast that raises on a malformed value whatever the session's ANSI setting."""
    c = F.col(c) if isinstance(c, str) else c
    v = c.try_cast(target)
    return F.when(c.isNull() | v.isNotNull(), v).otherwise(
        F.raise_error(F.concat(F.lit(f"cannot cast {what} value: "), c)).cast(target)
    )


def _qty() -> Column:
    return strict_cast(F.trim(F.col("quantity")), "int", "quantity")


def _price() -> Column:
    return strict_cast(F.trim(F.col("unit_price")), PROFILE_NUMERIC, "unit_price")


def price_sign(c: str | Column) -> Column:
    """-1, 0 or 1 of a well-formed decimal text, exact whatever its length."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~c.rlike("[1-9]"), F.lit(0)).when(c.startswith("-"), F.lit(-1)).otherwise(F.lit(1))


def _cancel() -> Column:
    return is_cancel_invoice("invoice_no")


def row_count(raw: DataFrame) -> DataFrame:
    """B1."""
    return raw.agg(F.count(F.lit(1)).alias("total_raw_rows"))


def distinct_values(raw: DataFrame) -> DataFrame:
    """B2: exact distinct counts on raw values: one narrow distinct per column
    (each a scan of that column), never one over expanded rows."""
    columns = {
        "distinct_invoices": "invoice_no",
        "distinct_products": "stock_code",
        "distinct_customers": "customer_id",
        "distinct_countries": "country",
    }
    parts = [raw.select(c).filter(F.col(c).isNotNull()).distinct().agg(F.count(F.lit(1)).alias(out)) for out, c in columns.items()]
    return reduce(DataFrame.crossJoin, parts)  # one row each


def missing_values(raw: DataFrame) -> DataFrame:
    """Blank-or-null count per column, one scan."""
    return raw.agg(*[F.count_if(is_blank(c)).alias(f"missing_{c}") for c in S.RAW_COLUMNS])


def invalid_formats(raw: DataFrame) -> DataFrame:
    """Non-null values failing their format (tested untrimmed)."""
    checks = {
        "invalid_quantity_format": ("quantity", S.INTEGER_PATTERN),
        "invalid_unit_price_format": ("unit_price", S.DECIMAL_PATTERN),
        "invalid_customer_id_format": ("customer_id", S.DIGITS_PATTERN),
        "invalid_invoice_date_format": ("invoice_date", S.TIMESTAMP_PATTERN),
    }
    return raw.agg(
        *[F.count_if(F.col(c).isNotNull() & ~matches(c, p)).alias(name) for name, (c, p) in checks.items()]
    )


def business_anomalies(raw: DataFrame) -> DataFrame:
    """Guarded parse, then sign counts and cancellation / missing counts."""
    qty = F.when(matches("quantity", S.INTEGER_PATTERN), strict_cast("quantity", "int", "quantity"))
    price = F.when(matches("unit_price", S.DECIMAL_PATTERN), price_sign("unit_price"))
    return raw.agg(
        F.count_if(qty < 0).alias("negative_quantity_rows"),
        F.count_if(qty == 0).alias("zero_quantity_rows"),
        F.count_if(price < 0).alias("negative_unit_price_rows"),
        F.count_if(price == 0).alias("zero_unit_price_rows"),
        F.count_if(_cancel()).alias("cancelled_invoice_rows"),
        F.count_distinct(F.when(_cancel(), F.col("invoice_no"))).alias("distinct_cancelled_invoices"),
        F.count_if(is_blank("customer_id")).alias("rows_without_customer"),
        F.count_if(is_blank("description")).alias("rows_without_description"),
    )


def date_range(raw: DataFrame) -> DataFrame:
    """Over well-formed timestamps only."""
    ts = strict_cast("invoice_date", "timestamp_ntz", "invoice_date")
    return raw.filter(matches("invoice_date", S.TIMESTAMP_PATTERN)).agg(
        F.min(ts).alias("first_transaction_date"), F.max(ts).alias("last_transaction_date")
    )


def _duplicate_groups(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy(*S.RAW_COLUMNS)
        .agg(F.count(F.lit(1)).alias("occurrence_count"))
        .filter(F.col("occurrence_count") > 1)
    )


def duplicate_census(raw: DataFrame) -> DataFrame:
    """Exact duplicate groups over the eight raw columns (pre-aggregated
    map-side, so a huge group costs one row per task)."""
    g = _duplicate_groups(raw)
    return g.agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum("occurrence_count"), F.lit(0)).cast("long").alias("rows_in_duplicate_groups"),
        F.coalesce(F.sum(F.col("occurrence_count") - 1), F.lit(0)).cast("long").alias("excess_duplicate_rows"),
    )


def top_countries(raw: DataFrame, k: int = S.TOP_COUNTRIES_ROWS) -> DataFrame:
    """B8 (tie-break: country)."""
    return (
        raw.groupBy("country")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.col("row_count").desc(), F.col("country").asc_nulls_last())
        .limit(k)
    )


def cancel_consistency(raw: DataFrame) -> DataFrame:
    """B9."""
    q, c = _qty(), _cancel()
    return raw.agg(
        F.count_if(c & (q < 0)).alias("cancelled_with_negative_quantity"),
        F.count_if(c & (q >= 0)).alias("cancelled_without_negative_quantity"),
        F.count_if(~c & (q < 0)).alias("negative_quantity_without_cancel_prefix"),
    )


def _code_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.col("stock_code"), missing_label("description").alias("description")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(_qty()).cast("long").alias("total_quantity")
    )


def negative_no_cancel(raw: DataFrame, k: int = S.TOP_PROFILE_ROWS) -> DataFrame:
    """B10 (tie-break: code, description)."""
    rows = raw.filter((_qty() < 0) & ~_cancel())
    return (
        _code_summary(rows)
        .orderBy(
            F.col("row_count").desc(), F.col("total_quantity").asc(),
            F.col("stock_code").asc_nulls_last(), F.col("description").asc(),
        )
        .limit(k)
    )


def negative_price_rows(raw: DataFrame) -> DataFrame:
    """Every row with a negative price."""
    return (
        raw.filter(_price() < 0)
        .select("raw_row_id", "invoice_no", "stock_code", "description", "quantity", "unit_price", "customer_id", "country")
        .orderBy("raw_row_id")
    )


def zero_price_products(raw: DataFrame, k: int = S.TOP_PROFILE_ROWS) -> DataFrame:
    """B12 (tie-break: code, description)."""
    rows = raw.filter(_price() == 0)
    return (
        _code_summary(rows)
        .orderBy(F.col("row_count").desc(), F.col("stock_code").asc_nulls_last(), F.col("description").asc())
        .limit(k)
    )


def missing_customer_profile(raw: DataFrame) -> DataFrame:
    """Rows without a customer."""
    rows = raw.filter(is_blank("customer_id"))
    q, p, c = _qty(), _price(), _cancel()
    positive = ~c & (q > 0) & (p > 0)
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows_without_customer"),
        F.count_distinct("invoice_no").alias("invoices_without_customer"),
        F.count_if(positive).alias("positive_sales_rows_without_customer"),
        money(F.sum(F.when(positive, q.cast("decimal(10,0)") * p.cast(REVENUE_PRICE)))).alias("positive_revenue_without_customer"),
        F.count_if(c).alias("cancelled_rows_without_customer"),
        F.count_if(q < 0).alias("negative_quantity_rows_without_customer"),
        F.count_if(p == 0).alias("zero_price_rows_without_customer"),
    )


def duplicate_examples(raw: DataFrame, k: int = S.TOP_PROFILE_ROWS) -> DataFrame:
    """The largest duplicate groups (tie-break: all eight columns)."""
    order = [F.col("occurrence_count").desc()] + [F.col(c).asc_nulls_last() for c in S.RAW_COLUMNS]
    return _duplicate_groups(raw).orderBy(*order).limit(k)

