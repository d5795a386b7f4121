"""Validation suite: reconciliation, uniqueness, domains and references.

Every rule is a lazy one-row aggregate ``(rule, expected, actual, passed)``
over the materialised layers; ``report`` unions them, and ``assert_valid``
collects that handful of rows once and raises listing every failed rule
(all rules run before raising).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.operators.staging import STAGING_COLUMNS

RULE_SCHEMA = "rule string, expected long, actual long, passed boolean"


def _count(df: DataFrame, cond: Column | None = None) -> DataFrame:
    return df.agg((F.count(F.lit(1)) if cond is None else F.count_if(cond)).alias("actual"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _table_rules(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Several violation counts of one table in a single aggregate scan, as rule rows."""
    agg = df.agg(*[expr.alias(f"_r{i}") for i, (_, expr) in enumerate(rules)])
    rows = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").cast("long").alias("actual")) for i, (name, _) in enumerate(rules)]
    )
    return agg.select(F.inline(rows)).select(
        "rule", F.lit(0).cast("long").alias("expected"), "actual", (F.col("actual") == 0).alias("passed")
    )


def not_null(c: str) -> Column:
    return F.count_if(F.col(c).isNull())


def excess(df: DataFrame, c: str, out: str) -> DataFrame:
    """One row: the rows beyond the first per non-null value, 0 iff the column is
    unique.  The key alone is grouped; no row is expanded."""
    per_key = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(out))


def _unique_rule(df: DataFrame, name: str, c: str) -> DataFrame:
    return excess(df, c, "actual").select(
        F.lit(name).alias("rule"), F.lit(0).cast("long").alias("expected"), "actual", (F.col("actual") == 0).alias("passed")
    )


DIMENSION_KEYS = (
    ("dim_date", "date_key"),
    ("dim_customer", "customer_key"),
    ("dim_product", "product_key"),
    ("dim_country", "country_key"),
)


#: What the rules need of a layer and a single pass over it can count: the load
#: observes these while it writes the layer.
RAW_MEASURES = {"raw_rows": "count(1)"}
STAGING_MEASURES = {
    "staging_rows": "count(1)",
    "first_rows": "count_if(is_first_occurrence)",
    "non_upper_codes": "count_if(stock_code <> upper(stock_code))",
}
FACT_MEASURES = {"fact_rows": "count(1)"}


def _measured(df: DataFrame, measures: dict[str, str]) -> DataFrame:
    return df.agg(*[F.expr(c).alias(n) for n, c in measures.items()])


def _raw_metrics(wh) -> DataFrame:
    return _measured(wh.raw, RAW_MEASURES)


def _staging_metrics(wh) -> DataFrame:
    return _measured(wh.staging, STAGING_MEASURES)


def _code_metrics(wh) -> DataFrame:
    codes = wh.staging.select("stock_code").filter("stock_code is not null").distinct()
    return codes.agg(F.count(F.lit(1)).alias("normalized_products"))


def _fact_metrics(wh) -> DataFrame:
    return _measured(wh.fact, FACT_MEASURES)


def _lineage_metrics(wh) -> DataFrame:
    return excess(wh.fact, "raw_row_id", "fact_repeated_lineage")


def _orphan_metrics(wh) -> DataFrame:
    """Fact rows whose key is in no dimension: the fact is counted per key, and
    the distinct keys are anti-joined, so a frequent key is one row."""
    parts = []
    for dim, key in DIMENSION_KEYS:
        used = wh.fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        lost = used.join(getattr(wh, dim).select(key), key, "left_anti")
        parts.append(lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(f"orphan_{key}")))
    return reduce(lambda a, b: a.crossJoin(b), parts)


def _unknown_metrics(wh) -> DataFrame:
    members = _union([getattr(wh, dim).select(F.lit(dim).alias("dim"), F.col(key).cast("long").alias("key"), "is_unknown") for dim, key in DIMENSION_KEYS])
    found = (F.col("key") == S.UNKNOWN_KEY) & F.col("is_unknown")
    return members.agg(*[F.count_if(found & (F.col("dim") == dim)).alias(f"unknown_{dim}") for dim, _ in DIMENSION_KEYS])


# rule -> (metric frames needed, actual metric, expected metric or constant name)
_RULES = {
    "raw_row_count": (("raw",), "raw_rows", "expected_raw_rows"),
    "normalized_product_count": (("codes",), "normalized_products", "expected_products"),
    "raw_equals_staging": (("raw", "staging"), "staging_rows", "raw_rows"),
    "first_occurrences_equal_fact": (("staging", "fact"), "fact_rows", "first_rows"),
    "stock_code_uppercase": (("staging",), "non_upper_codes", 0),
    "fact_raw_row_id_unique": (("lineage",), "fact_repeated_lineage", 0),
    **{f"orphan_{k}": (("orphans",), f"orphan_{k}", 0) for _, k in DIMENSION_KEYS},
    **{f"unknown_member_{d}": (("unknown",), f"unknown_{d}", 1) for d, _ in DIMENSION_KEYS},
}
_METRICS = {
    "raw": _raw_metrics,
    "staging": _staging_metrics,
    "codes": _code_metrics,
    "fact": _fact_metrics,
    "lineage": _lineage_metrics,
    "orphans": _orphan_metrics,
    "unknown": _unknown_metrics,
}


#: Metric frames that the load has observed, by what they measure.
_OBSERVED = {"raw": RAW_MEASURES, "staging": STAGING_MEASURES, "fact": FACT_MEASURES}


def rules(
    wh, names, *, raw_rows: int = S.EXPECTED_RAW_ROWS, products: int = S.EXPECTED_NORMALIZED_PRODUCTS, observed: bool = False
) -> DataFrame:
    """The named rules as (rule, expected, actual, passed) rows; each table
    involved is aggregated once, whatever the number of rules on it.  With
    ``observed`` what the load has counted while it wrote a layer is used, and a
    layer without such counts is scanned."""
    frames = sorted({f for n in names for f in _RULES[n][0]}, key=list(_METRICS).index)
    known = {}
    if observed:
        told = [f for f in frames if f in _OBSERVED and set(_OBSERVED[f]) <= set(wh.metrics)]
        known = {m: F.lit(wh.metrics[m]) for f in told for m in _OBSERVED[f]}
        frames = [f for f in frames if f not in told]
    scanned = [_METRICS[f](wh) for f in frames] or [wh.spark.range(1).select()]
    metrics = reduce(lambda a, b: a.crossJoin(b), scanned)
    metrics = metrics.withColumns({"expected_raw_rows": F.lit(raw_rows), "expected_products": F.lit(products), **known})

    def value(v):
        return F.lit(v) if isinstance(v, int) else F.col(v)

    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("rule"),
                value(_RULES[n][2]).cast("long").alias("expected"),
                value(_RULES[n][1]).cast("long").alias("actual"),
            )
            for n in names
        ]
    )
    return metrics.select(F.inline(rows)).withColumn("passed", F.col("expected") == F.col("actual"))


def expected_counts(wh, **expected) -> DataFrame:
    """H1, H4: fixed counts of the full source (parameters)."""
    return rules(wh, ["raw_row_count", "normalized_product_count"], **expected)


def reconciliation(wh) -> DataFrame:
    """H2, H3: raw = staging; first occurrences = fact."""
    return rules(wh, ["raw_equals_staging", "first_occurrences_equal_fact"])


def uppercase(wh) -> DataFrame:
    """H5: normalised codes are upper case."""
    return rules(wh, ["stock_code_uppercase"])


def unique_lineage(wh) -> DataFrame:
    """H6: no raw_row_id twice in the fact (excess rows)."""
    return rules(wh, ["fact_raw_row_id_unique"])


def orphans(wh) -> DataFrame:
    """Fact keys present in no dimension."""
    return rules(wh, [f"orphan_{k}" for _, k in DIMENSION_KEYS])


def unknown_members(wh) -> DataFrame:
    """H8: key 0 flagged unknown exists in all four dimensions."""
    return rules(wh, [f"unknown_member_{d}" for d, _ in DIMENSION_KEYS])


def row_counts(wh) -> DataFrame:
    """H9: one row of layer sizes."""
    parts = [
        _count(wh.raw).withColumnRenamed("actual", "raw_rows"),
        _count(wh.staging).withColumnRenamed("actual", "staging_rows"),
        _count(wh.fact).withColumnRenamed("actual", "fact_rows"),
        _count(wh.dim_customer).withColumnRenamed("actual", "customer_dimension_rows"),
        _count(wh.dim_product).withColumnRenamed("actual", "product_dimension_rows"),
        _count(wh.dim_country).withColumnRenamed("actual", "country_dimension_rows"),
        _count(wh.dim_date).withColumnRenamed("actual", "date_dimension_rows"),
    ]
    return reduce(lambda a, b: a.crossJoin(b), parts)


STAGING_FLAGS = tuple(c for c in STAGING_COLUMNS if c.startswith("is_"))
FACT_NOT_NULL = (
    "raw_row_id", "date_key", "customer_key", "product_key", "country_key", "invoice_no",
    "invoice_timestamp", "quantity", "unit_price", "line_amount", "record_type", "source_file",
)


# Columns without repeated values, per table.
UNIQUE = {
    "staging": ("raw_row_id",),
    "dim_customer": ("customer_key", "customer_id"),
    "dim_product": ("product_key", "stock_code"),
    "dim_country": ("country_key", "country_name"),
    "dim_date": ("date_key", "full_date"),
    "fact_sales": ("sales_key", "raw_row_id"),
}


def constraint_rules() -> dict[str, list[tuple[str, Column]]]:
    """H11, H12 per table: (rule, violation-count aggregate)."""
    col = F.col
    return {
        "staging": [
            *[(f"staging.{c}_not_null", not_null(c))
              for c in ("raw_row_id", *STAGING_FLAGS, "record_type", "duplicate_rank", "duplicate_group_size", "source_file")],
            ("staging.record_type_domain", F.count_if(~col("record_type").isin(*S.RECORD_TYPES))),
            ("staging.duplicate_rank_positive", F.count_if(col("duplicate_rank") < 1)),
            ("staging.duplicate_group_size_positive", F.count_if(col("duplicate_group_size") < 1)),
        ],
        "dim_customer": [
            ("dim_customer.unknown_iff_null_id", F.count_if(col("is_unknown") != col("customer_id").isNull())),
        ],
        "dim_product": [
            *[(f"dim_product.{c}_not_null", not_null(c)) for c in ("stock_code", "product_category", "is_merchandise", "is_unknown")],
            ("dim_product.category_domain",
             F.count_if(~col("product_category").isin(*S.PRODUCT_CATEGORIES, S.UNKNOWN_CATEGORY))),
            ("dim_product.merchandise_iff_category",
             F.count_if(col("is_merchandise") != (col("product_category") == S.MERCHANDISE_CATEGORY))),
            ("dim_product.unknown_iff_key_0", F.count_if(col("is_unknown") != (col("product_key") == S.UNKNOWN_KEY))),
        ],
        "dim_country": [
            *[(f"dim_country.{c}_not_null", not_null(c)) for c in ("country_name", "is_unknown")],
        ],
        "dim_date": [
            ("dim_date.unknown_iff_key_0", F.count_if(col("is_unknown") != (col("date_key") == S.UNKNOWN_KEY))),
        ],
        "fact_sales": [
            *[(f"fact_sales.{c}_not_null", not_null(c)) for c in FACT_NOT_NULL],
            ("fact_sales.record_type_domain", F.count_if(~col("record_type").isin(*S.RECORD_TYPES))),
            ("fact_sales.source_duplicate_group_size_positive", F.count_if(col("source_duplicate_group_size") < 1)),
        ],
    }


def constraints(wh) -> DataFrame:
    """Not-null and domain rules as violation counts in one scan per
    table, key rules as one narrow grouping per column."""
    tables = {
        "staging": wh.staging, "dim_customer": wh.dim_customer, "dim_product": wh.dim_product,
        "dim_country": wh.dim_country, "dim_date": wh.dim_date, "fact_sales": wh.fact,
    }
    keys = [_unique_rule(tables[t].select(c), f"{t}.{c}_unique", c) for t, columns in UNIQUE.items() for c in columns]
    return _union([_table_rules(tables[t], rules) for t, rules in constraint_rules().items()] + keys)


def report(wh, *, observed: bool = True, **expected) -> DataFrame:
    """Every rule of H1-H8 in one frame.  Counts that the load observed are
    not taken again; codes, orphans, lineage and unknown members are."""
    return rules(wh, list(_RULES), observed=observed, **expected)


class ValidationError(AssertionError):
    pass


def assert_valid(wh, *, include_constraints: bool = True, **expected) -> list[tuple]:
    """Run all rules, collect the (few) rule rows once, raise on any failure."""
    frames = [report(wh, **expected)] + ([constraints(wh)] if include_constraints else [])
    rows = [tuple(r) for r in _union(frames).collect()]
    failed = [r for r in rows if not r[3]]
    if failed:
        raise ValidationError("validation failed: " + "; ".join(f"{r[0]} expected={r[1]} actual={r[2]}" for r in failed))
    return rows

