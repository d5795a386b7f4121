"""Calendar attributes of a date, shared by the date dimension and the views.

Names come from fixed lists rather than ``date_format`` so they do not depend
on the JVM locale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import schemas as S
from tillroll.functions.text import col


def _lookup(index: Column, names: tuple[str, ...]) -> Column:
    expr = None
    for i, name in enumerate(names, start=1):
        expr = (F.when(index == i, F.lit(name)) if expr is None else expr.when(index == i, F.lit(name)))
    return expr


def iso_weekday(d: str | Column) -> Column:
    return F.extract(F.lit("DAYOFWEEK_ISO"), col(d))


def date_key(d: str | Column) -> Column:
    """YYYYMMDD as int."""
    d = col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_month(d: str | Column) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def attributes(d: str | Column) -> dict[str, Column]:
    """Calendar columns of the date dimension, in table order."""
    d = col(d)
    dow = iso_weekday(d)
    return {
        "date_key": date_key(d),
        "full_date": d,
        "calendar_year": F.year(d).cast("short"),
        "calendar_quarter": F.quarter(d).cast("short"),
        "month_number": F.month(d).cast("short"),
        "month_name": _lookup(F.month(d), S.MONTH_NAMES),
        "year_month": year_month(d),
        "week_of_year": F.weekofyear(d).cast("short"),
        "day_of_month": F.dayofmonth(d).cast("short"),
        "day_of_week": dow.cast("short"),
        "day_name": _lookup(dow, S.DAY_NAMES),
        "is_weekend": dow.isin(*S.WEEKEND_ISO_DAYS),
    }
