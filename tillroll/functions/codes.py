"""Product classification by normalised stock code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.text import col


def product_category(code: str | Column) -> Column:
    c = col(code)
    voucher = F.left(c, F.lit(len(S.GIFT_VOUCHER_PREFIX))) == S.GIFT_VOUCHER_PREFIX
    out = F.when(voucher, F.lit(S.VOUCHER_CATEGORY)).otherwise(F.lit(S.MERCHANDISE_CATEGORY))
    for label, codes in S.CATEGORY_CODES:
        out = F.when(c.isin(*codes), F.lit(label)).otherwise(out)
    return out


def is_merchandise(code: str | Column) -> Column:
    """NULL codes have no category of their own; they are no merchandise."""
    return F.when(col(code).isNotNull(), product_category(code) == S.MERCHANDISE_CATEGORY)
