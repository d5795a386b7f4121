"""Staging: normalise, type, classify and mark exact duplicates (one row per raw row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.money import amount
from tillroll.functions.text import blank_to_null, is_cancel_invoice, matches
from tillroll.operators.ranking import rank_repeated

STAGING_COLUMNS = (
    "raw_row_id",
    "invoice_no",
    "source_stock_code",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
    "line_amount",
    "is_cancelled",
    "is_stock_adjustment",
    "is_accounting_adjustment",
    "is_zero_price",
    "is_missing_customer",
    "is_missing_description",
    "is_positive_sale",
    "record_type",
    "duplicate_rank",
    "duplicate_group_size",
    "is_exact_duplicate",
    "is_first_occurrence",
    "source_file",
    "raw_ingested_at",
    "staged_at",
)

# Text column -> (target type, format pattern that must hold first or None).
TYPED = {
    "quantity": ("int", S.INTEGER_PATTERN),
    "invoice_date": ("timestamp_ntz", S.TYPED_TIMESTAMP_PATTERN),
    "unit_price": (S.PRICE.simpleString(), None),
    "customer_id": ("int", S.INTEGER_PATTERN),
}
# Normalised texts without which a line cannot be a fact.
FACT_TEXTS = ("invoice_no", "invoice_date_text", "quantity_text", "unit_price_text")


def normalized(raw: DataFrame, *carry: str) -> DataFrame:
    """Blank-to-null trim of every text column; upper-case product code."""
    return raw.select(
        "raw_row_id",
        blank_to_null("invoice_no").alias("invoice_no"),
        blank_to_null("stock_code").alias("source_stock_code"),
        F.upper(blank_to_null("stock_code")).alias("stock_code"),
        blank_to_null("description").alias("description"),
        blank_to_null("quantity").alias("quantity_text"),
        blank_to_null("invoice_date").alias("invoice_date_text"),
        blank_to_null("unit_price").alias("unit_price_text"),
        blank_to_null("customer_id").alias("customer_id_text"),
        blank_to_null("country").alias("country"),
        "source_file",
        F.col("ingested_at").alias("raw_ingested_at"),
        *carry,
    )


def _parsed(text: Column, target: str, pattern: str | None) -> Column:
    value = text.try_cast(target)
    if pattern is not None:
        value = F.when(matches(text, pattern), value)
    return value


def _strict(name: str, text: Column, target: str, pattern: str | None) -> Column:
    value = _parsed(text, target, pattern)
    return F.when(text.isNull(), F.lit(None).cast(target)).when(value.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit(f"malformed {name} value: "), text)).cast(target)
    )


def malformed() -> list[Column]:
    """One reason per non-blank text value that does not parse."""
    reasons = []
    for name, (target, pattern) in TYPED.items():
        text = F.col(f"{name}_text")
        reasons.append(F.when(text.isNotNull() & _parsed(text, target, pattern).isNull(), F.lit(f"malformed {name}")))
    return reasons


def missing() -> list[Column]:
    """One reason per blank value that the fact must have."""
    return [F.when(F.col(c).isNull(), F.lit(f"missing {c.removesuffix('_text')}")) for c in FACT_TEXTS]


def typed(df: DataFrame, *, strict: bool = True) -> DataFrame:
    """Text -> int / timestamp / decimal(18,4) / int.

    ``strict`` raises on the first malformed value (the original load
    aborts); otherwise malformed values become NULL.
    """
    cols = {}
    for name, (target, pattern) in TYPED.items():
        text = F.col(f"{name}_text")
        cols[name] = _strict(name, text, target, pattern) if strict else _parsed(text, target, pattern)
    return df.withColumns(cols).drop(*[f"{n}_text" for n in TYPED])


def classified(df: DataFrame) -> DataFrame:
    """Signed line amount, seven flags and the record type."""
    cancelled = is_cancel_invoice("invoice_no")
    qty, price = F.col("quantity"), F.col("unit_price")
    false = F.lit(False)
    record_type = F.lit(S.OTHER_RECORD_TYPE)
    for label, condition in reversed(S.RECORD_TYPE_RULES):
        record_type = F.when(F.expr(condition), F.lit(label)).otherwise(record_type)
    return df.withColumns(
        {
            "line_amount": amount(qty, price),
            "is_cancelled": F.coalesce(cancelled, false),
            "is_stock_adjustment": F.coalesce((qty < 0) & ~cancelled, false),
            "is_accounting_adjustment": F.coalesce(price < 0, false),
            "is_zero_price": F.coalesce(price == 0, false),
            "is_missing_customer": F.col("customer_id").isNull(),
            "is_missing_description": F.col("description").isNull(),
            "is_positive_sale": F.coalesce(~cancelled & (qty > 0) & (price > 0), false),
            "record_type": record_type,
        }
    )


def with_duplicates(raw: DataFrame, *, work: str | None = None) -> DataFrame:
    """C7-C9 on the raw, untrimmed, case-preserved values (NULLs group together).
    Most rows have no duplicate and are not exchanged."""
    ranked = rank_repeated(raw, list(S.RAW_COLUMNS), "raw_row_id", "duplicate_rank", "duplicate_group_size", work=work)
    return ranked.withColumns(
        {
            "is_exact_duplicate": F.col("duplicate_group_size") > 1,
            "is_first_occurrence": F.col("duplicate_rank") == 1,
        }
    )


def staging(raw: DataFrame, *, strict: bool = True, work: str | None = None) -> DataFrame:
    """The staging table, every raw row kept."""
    dup_cols = ["duplicate_rank", "duplicate_group_size", "is_exact_duplicate", "is_first_occurrence"]
    staged = classified(typed(normalized(with_duplicates(raw, work=work), *dup_cols), strict=strict))
    return staged.select(*STAGING_COLUMNS[:-1], F.current_timestamp().alias("staged_at"))


def quarantine(raw: DataFrame) -> DataFrame:
    """Raw rows that the tolerant load leaves out of the fact, with the reasons:
    malformed values and missing ones (tolerant-load side table)."""
    rows = normalized(raw, *[F.col(c).alias(f"raw_{c}") for c in S.RAW_COLUMNS])
    reasons = F.array_compact(F.array(*malformed(), *missing())).alias("reasons")
    return rows.select("raw_row_id", *[F.col(f"raw_{c}").alias(c) for c in S.RAW_COLUMNS], reasons).filter(F.size("reasons") > 0)
