"""Star-schema dimensions, each with an unknown member at key 0.

All dimensions are built from every staging row, duplicates included.
Surrogate keys are dense, from 1, in natural-key order, assigned by the
distributed ``row_number_global`` (no single-task window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions import calendar
from tillroll.functions.codes import is_merchandise, product_category
from tillroll.operators.ranking import row_number_global
from tillroll.plans.session import materialize, run_root

CUSTOMER_COLUMNS = ("customer_key", "customer_id", "first_seen_at", "last_seen_at", "is_unknown", "created_at")
PRODUCT_COLUMNS = (
    "product_key",
    "stock_code",
    "product_description",
    "product_category",
    "is_merchandise",
    "first_seen_at",
    "last_seen_at",
    "is_unknown",
    "created_at",
)
COUNTRY_COLUMNS = ("country_key", "country_name", "is_unknown", "created_at")
DATE_COLUMNS = (
    "date_key", "full_date", "calendar_year", "calendar_quarter", "month_number", "month_name",
    "year_month", "week_of_year", "day_of_month", "day_of_week", "day_name", "is_weekend", "is_unknown",
)

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _unknown(spark: SparkSession, like: DataFrame, values: dict) -> DataFrame:
    """One literal row with the frame's schema: given values, NULL elsewhere."""
    cols = []
    for f in like.schema.fields:
        v = values.get(f.name)
        lit = v if isinstance(v, Column) else F.lit(v)
        cols.append(lit.cast(f.dataType).alias(f.name))
    return spark.range(1).select(*cols)


def _keyed(df: DataFrame, natural: str, key: str, work: str | None) -> DataFrame:
    """Dense key in natural-key order.  The aggregated rows are written first, as
    the ranking reads them twice."""
    work = work or run_root(df.sparkSession, key)
    numbered, _ = row_number_global(materialize(df, f"{work}/{key}"), [natural], key, work=f"{work}/{key}-ranked")
    return numbered


def dim_customer(stg: DataFrame, *, work: str | None = None) -> DataFrame:
    """One row per identified customer with first / last seen."""
    seen = (
        stg.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.min("invoice_date").alias("first_seen_at"), F.max("invoice_date").alias("last_seen_at"))
    )
    keyed = _keyed(seen, "customer_id", "customer_key", work).select(
        "customer_key",
        "customer_id",
        "first_seen_at",
        "last_seen_at",
        F.lit(False).alias("is_unknown"),
        F.current_timestamp().alias("created_at"),
    )
    unknown = _unknown(
        stg.sparkSession, keyed, {"customer_key": S.UNKNOWN_KEY, "is_unknown": True, "created_at": F.current_timestamp()}
    )
    return unknown.unionByName(keyed)


def _code_description_counts(stg: DataFrame) -> DataFrame:
    """Lines, first and last use per (normalised code, description), NULL description included."""
    return (
        stg.filter(F.col("stock_code").isNotNull())
        .groupBy("stock_code", "description")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("invoice_date").alias("first_used"),
            F.max("invoice_date").alias("last_used"),
        )
    )


def _best_description() -> Column:
    """The most frequent description, then the most recently used, then
    the alphabetically first — a minimum over (-count, -last use, text), so
    it is a partially pre-aggregated aggregate rather than a window.  A
    NULL last use sorts first, as in a descending order with NULLs first."""
    age = F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, last_used)")
    key = F.struct((-F.col("n")).alias("n"), (-age).alias("t"), F.col("description").alias("d"))
    return F.min(F.when(F.col("description").isNotNull(), key))["d"]


def canonical_descriptions(stg: DataFrame) -> DataFrame:
    """D2b as its own frame: one row per code that has a description."""
    return (
        _code_description_counts(stg)
        .filter(F.col("description").isNotNull())
        .groupBy("stock_code")
        .agg(_best_description().alias("product_description"))
    )


def dim_product(stg: DataFrame, *, work: str | None = None) -> DataFrame:
    """Activity per normalised code + canonical description + category,
    from one two-level aggregation (code, description) -> code."""
    described = (
        _code_description_counts(stg)
        .groupBy("stock_code")
        .agg(
            F.min("first_used").alias("first_seen_at"),
            F.max("last_used").alias("last_seen_at"),
            _best_description().alias("product_description"),
        )
    )
    keyed = _keyed(described, "stock_code", "product_key", work).select(
        "product_key",
        "stock_code",
        "product_description",
        product_category("stock_code").alias("product_category"),
        is_merchandise("stock_code").alias("is_merchandise"),
        "first_seen_at",
        "last_seen_at",
        F.lit(False).alias("is_unknown"),
        F.current_timestamp().alias("created_at"),
    )
    unknown = _unknown(
        stg.sparkSession,
        keyed,
        {
            "product_key": S.UNKNOWN_KEY,
            "stock_code": S.UNKNOWN_NAME,
            "product_description": S.UNKNOWN_PRODUCT_DESCRIPTION,
            "product_category": S.UNKNOWN_CATEGORY,
            "is_merchandise": False,
            "is_unknown": True,
            "created_at": F.current_timestamp(),
        },
    )
    return unknown.unionByName(keyed)


def dim_country(stg: DataFrame, *, work: str | None = None) -> DataFrame:
    """D3: distinct non-null countries."""
    names = stg.filter(F.col("country").isNotNull()).select(F.col("country").alias("country_name")).distinct()
    keyed = _keyed(names, "country_name", "country_key", work).select(
        "country_key", "country_name", F.lit(False).alias("is_unknown"), F.current_timestamp().alias("created_at")
    )
    unknown = _unknown(
        stg.sparkSession,
        keyed,
        {"country_key": S.UNKNOWN_KEY, "country_name": S.UNKNOWN_NAME, "is_unknown": True, "created_at": F.current_timestamp()},
    )
    return unknown.unionByName(keyed)


def dim_date(stg: DataFrame) -> DataFrame:
    """Every day from the first to the last invoice date.

    The row count is bounded by the span of the data in days, not by its
    volume; the days are generated from a single (min, max) row.
    """
    bounds = stg.agg(
        F.min(F.to_date("invoice_date")).alias("lo"), F.max(F.to_date("invoice_date")).alias("hi")
    ).filter(F.col("lo").isNotNull())
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    attrs = calendar.attributes("d")
    known = days.select(*[c.alias(n) for n, c in attrs.items()], F.lit(False).alias("is_unknown"))
    unknown = _unknown(stg.sparkSession, known, {"date_key": S.UNKNOWN_KEY, "is_unknown": True})
    return unknown.unionByName(known)

