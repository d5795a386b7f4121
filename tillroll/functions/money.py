"""Exact decimal arithmetic for money, ratios and percentages.

Spark's decimal division keeps a limited scale and rounds it, and a later
``round(x, 2)`` rounds a second time; ``avg`` of a decimal does the same.
Every ratio here is therefore computed on scaled integers and rounded once,
half away from zero, so that it equals the exact quotient rounded to the
requested scale.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.text import col

WIDE_INT = "decimal(38,0)"


def money(c: str | Column, scale: int = 2) -> Column:
    """ROUND(x, scale) as decimal(18, scale)."""
    return F.round(col(c), scale).cast(f"decimal(18,{scale})")


def ratio_sql(num: str, den: str, *, num_scale: int = 0, den_scale: int = 0, factor: int = 1, scale: int = 2) -> str:
    """SQL text of round(factor * num / den, scale), exact, half away from zero.

    ``num`` / ``den`` are SQL expressions whose decimal scale is at most
    ``num_scale`` / ``den_scale``; both are scaled to wide integers, the
    quotient is rounded once by integer division, NULL when den is 0 or NULL.
    """
    shift = 10 ** max(num_scale, den_scale)
    n = f"CAST(CAST(({num}) AS DECIMAL(38,{num_scale})) * {shift} AS {WIDE_INT})"
    d = f"CAST(CAST(({den}) AS DECIMAL(38,{den_scale})) * {shift} AS {WIDE_INT})"
    units = f"((2 * abs({n}) * {factor * 10**scale} + abs({d})) div (2 * abs({d})))"
    sign = f"CAST(signum({n}) * signum({d}) AS INT)"
    unit = Decimal(1).scaleb(-scale)
    value = f"CAST(CAST({sign} * {units} AS DECIMAL(20,0)) * {unit} AS DECIMAL(18,{scale}))"
    return f"CASE WHEN {d} <> 0 THEN {value} END"


def exact_ratio(
    num: str, den: str, *, num_scale: int = 0, den_scale: int = 0, factor: int = 1, scale: int = 2
) -> Column:
    """round(factor * num / den, scale) exactly; NULL when den is 0 or NULL.
    ``num`` and ``den`` are column names or SQL expressions."""
    return F.expr(ratio_sql(num, den, num_scale=num_scale, den_scale=den_scale, factor=factor, scale=scale))


def exact_mean(total: str, count: str, *, total_scale: int = 0, scale: int = 2) -> Column:
    """round(sum / count, scale) with the rounding done once."""
    return exact_ratio(total, count, num_scale=total_scale, scale=scale)


def percent(num: str, den: str, *, num_scale: int = 0, den_scale: int = 0) -> Column:
    """round(100 * num / den, 2)."""
    return exact_ratio(num, den, num_scale=num_scale, den_scale=den_scale, factor=100)


def amount(quantity: str | Column, price: str | Column) -> Column:
    """Signed line amount as decimal(20,4); overflow raises under ANSI."""
    return (col(quantity).cast("decimal(10,0)") * col(price)).cast(S.AMOUNT)
