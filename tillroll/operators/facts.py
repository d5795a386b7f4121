"""Fact load: first occurrences of each exact duplicate group, keyed to the dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions import calendar
from tillroll.functions.money import amount
from tillroll.operators.ranking import dense_lookup, number_kept

FACT_DDL = """sales_key long, raw_row_id long, date_key int, customer_key long, product_key long, country_key long,
invoice_no string, invoice_timestamp timestamp_ntz, quantity int, unit_price decimal(18,4), line_amount decimal(20,4),
record_type string, is_cancelled boolean, is_stock_adjustment boolean, is_accounting_adjustment boolean,
is_zero_price boolean, is_missing_customer boolean, is_missing_description boolean, is_positive_sale boolean,
source_duplicate_group_size long, source_file string, raw_ingested_at timestamp, warehouse_loaded_at timestamp"""

REQUIRED = ("invoice_no", "invoice_date", "quantity", "unit_price", "line_amount")
# Staging columns that the fact is made of.
NUMBERED = (
    "raw_row_id", "customer_id", "stock_code", "country", *REQUIRED, "record_type", "is_cancelled", "is_stock_adjustment",
    "is_accounting_adjustment", "is_zero_price", "is_missing_customer", "is_missing_description", "is_positive_sale",
    "duplicate_group_size", "source_file", "raw_ingested_at",
)


def _required(c: str) -> Column:
    return F.when(F.col(c).isNull(), F.raise_error(F.lit(f"fact_sales.{c} must not be NULL"))).otherwise(F.col(c))


def lookup_key(rows: DataFrame, dim: DataFrame, natural: str, dim_natural: str, key: str, *, row_id: str = "raw_row_id") -> DataFrame:
    """LEFT JOIN on the natural key of the known members; no match -> key 0.

    Whether the dimension is broadcast is Spark's choice by the size of its files.
    In a shuffle join a NULL key carries the row's own id beside it, which matches
    nothing, so such rows stay where the hash of their id puts them."""
    known = dim.filter(~F.col("is_unknown")).select(
        F.col(dim_natural).alias("_nk"), F.lit(0).cast("long").alias("_own"), F.col(key).alias("_key")
    )
    left = rows.withColumn("_row", F.when(F.col(natural).isNull(), F.col(row_id)).otherwise(0))
    joined = left.join(known, (left[natural] == known["_nk"]) & (left["_row"] == known["_own"]), "left")
    return joined.withColumn(key, F.coalesce(F.col("_key"), F.lit(S.UNKNOWN_KEY)).cast("long")).drop("_nk", "_own", "_row", "_key")


FLAGS = (
    "is_cancelled", "is_stock_adjustment", "is_accounting_adjustment", "is_zero_price", "is_missing_customer",
    "is_missing_description", "is_positive_sale",
)
_CODE_SHIFT = 2 * len(FLAGS)


def packed(rows: DataFrame) -> DataFrame:
    """The flags and the record type as one number (``_marks``), an invoice number of digits
    as a number (``_no``, below zero if cancelled): rows that are exchanged take half the
    bytes.  Record types and invoice numbers of another form go beside them."""
    bits = [F.when(F.col(f), F.lit(1 << k)).when(F.col(f).isNull(), F.lit(1 << len(FLAGS) + k)).otherwise(F.lit(0)) for k, f in enumerate(FLAGS)]
    code = F.coalesce(F.array_position(F.array(*map(F.lit, S.RECORD_TYPES)), F.col("record_type")), F.lit(0)).cast("int")
    marks = reduce(lambda a, b: a + b, bits) + code * F.lit(1 << _CODE_SHIFT)
    invoice = F.col("invoice_no")
    number = F.when(invoice.rlike(f"^{S.CANCEL_PREFIX}[1-9][0-9]{{0,17}}$"), -F.substring(invoice, len(S.CANCEL_PREFIX) + 1, 18).try_cast("long"))
    number = F.when(invoice.rlike("^[1-9][0-9]{0,17}$"), invoice.try_cast("long")).otherwise(number)
    columns = {"_marks": marks, "_other": F.when(code == 0, F.col("record_type")), "_no": number, "_text": F.when(number.isNull(), invoice)}
    return rows.withColumns(columns).drop(*FLAGS, "record_type", "invoice_no")


def unpacked(rows: DataFrame) -> DataFrame:
    """The columns that ``packed`` took away."""
    bit = lambda k: F.bit_get(F.col("_marks"), F.lit(k)) == 1
    code = F.shiftright("_marks", _CODE_SHIFT)
    label = F.when(code > 0, F.element_at(F.array(*map(F.lit, S.RECORD_TYPES)), F.greatest(code, F.lit(1)))).otherwise(F.col("_other"))
    flags = {f: F.when(~bit(len(FLAGS) + k), bit(k)) for k, f in enumerate(FLAGS)}
    digits = F.abs("_no").cast("string")
    invoice = F.coalesce(F.when(F.col("_no") < 0, F.concat(F.lit(S.CANCEL_PREFIX), digits)).otherwise(digits), F.col("_text"))
    return rows.withColumns({**flags, "record_type": label, "invoice_no": invoice}).drop("_marks", "_other", "_no", "_text")


def keyed_rows(
    stg: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_country: DataFrame,
    *,
    strict: bool = True,
    work: str | None = None,
) -> DataFrame:
    """E1-E3 as narrow rows, which ``fact_columns`` completes: numbered, with the keys of
    the dimensions.  Customer keys are dense by an integral id and looked up by bits
    (``dense_lookup``); product and country are joined."""
    first = F.col("is_first_occurrence")
    if not strict:
        first = first & F.expr(" AND ".join(f"{c} IS NOT NULL" for c in REQUIRED))
    numbered = number_kept(stg.select(*NUMBERED, "is_first_occurrence"), first, "raw_row_id", "sales_key", work=work)
    # The amount follows from quantity and price, which are required as well.
    narrow = packed(numbered.drop("line_amount", "is_first_occurrence"))
    narrow = narrow.withColumn("_left", F.col("raw_row_id") - F.col("sales_key")).drop("sales_key")
    known = dim_customer.filter(~F.col("is_unknown"))
    keyed = dense_lookup(narrow, known, "customer_id", "customer_id", "customer_key", "raw_row_id", work=work and f"{work}/customers")
    keyed = keyed.withColumn("customer_key", F.coalesce("customer_key", F.lit(S.UNKNOWN_KEY).cast("long"))).drop("customer_id")
    keyed = lookup_key(keyed, dim_product, "stock_code", "stock_code", "product_key").drop("stock_code")
    return lookup_key(keyed, dim_country, "country", "country_name", "country_key").drop("country")


def date_key() -> Column:
    """Computed from the invoice date (YYYYMMDD): the calendar spans every invoice date,
    so the lookup always succeeds and needs no join."""
    return F.coalesce(calendar.date_key(F.to_date("invoice_date")), F.lit(S.UNKNOWN_KEY))


def fact_columns(keyed: DataFrame, *more: str) -> DataFrame:
    """The fact's columns (and ``more``) of ``keyed_rows``.  A NULL in a required column raises."""
    full = unpacked(keyed).withColumn("line_amount", amount(F.col("quantity"), F.col("unit_price")))
    full = full.withColumn("sales_key", F.col("raw_row_id") - F.col("_left"))
    return full.withColumns({c: _required(c) for c in REQUIRED}).select(
        "sales_key",
        "raw_row_id",
        date_key().alias("date_key"),
        "customer_key",
        "product_key",
        "country_key",
        "invoice_no",
        F.col("invoice_date").alias("invoice_timestamp"),
        "quantity",
        "unit_price",
        "line_amount",
        "record_type",
        *FLAGS,
        F.col("duplicate_group_size").alias("source_duplicate_group_size"),
        "source_file",
        "raw_ingested_at",
        F.current_timestamp().alias("warehouse_loaded_at"),
        *more,
    )


def fact_sales(
    stg: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_country: DataFrame,
    *,
    strict: bool = True,
    work: str | None = None,
) -> DataFrame:
    """E1-E4.  A NULL in a required column raises (``strict``) or, in the
    tolerant load, leaves the row out of the fact (the quarantine lists it)."""
    return fact_columns(keyed_rows(stg, dim_customer, dim_product, dim_country, strict=strict, work=work))
