"""Exact ratio helper against Python's decimal arithmetic."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.functions.money import exact_ratio

nums = st.integers(min_value=-10**15, max_value=10**15)
dens = st.integers(min_value=-10**6, max_value=10**6)


def _expected(n: int, d: int, factor: int) -> Decimal | None:
    """factor * (n / 10^4) / d rounded half away from zero to cents."""
    if d == 0:
        return None
    exact = Decimal(factor * n) / (Decimal(d) * 10**4)
    return exact.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(nums, dens), min_size=1, max_size=40), st.sampled_from([1, 100]))
def test_exact_ratio_matches_decimal(spark, pairs, factor):
    import decimal

    decimal.getcontext().prec = 60
    rows = [(Decimal(n).scaleb(-4), d) for n, d in pairs]
    df = spark.createDataFrame(rows, "n decimal(38,4), d long")
    got = [r[0] for r in df.select(exact_ratio("n", "d", num_scale=4, factor=factor)).collect()]
    want = [_expected(n, d, factor) for n, d in pairs]
    assert got == want
