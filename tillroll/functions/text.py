"""Text helpers for the all-text raw layer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll import schemas as S


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: str | Column) -> Column:
    """Trim spaces at both ends; an empty result becomes NULL."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def is_blank(c: str | Column) -> Column:
    return blank_to_null(c).isNull()


def java_anchored(pattern: str) -> str:
    """Java's ``$`` also matches before a final newline; ``\\z`` does not."""
    return pattern[:-1] + r"\z" if pattern.endswith("$") else pattern


def matches(c: str | Column, pattern: str) -> Column:
    return col(c).rlike(java_anchored(pattern))


def is_cancel_invoice(c: str | Column) -> Column:
    """Invoice number starting with the cancellation prefix (NULL stays NULL)."""
    return col(c).startswith(S.CANCEL_PREFIX)


def missing_label(c: str | Column) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(S.MISSING_DESCRIPTION_LABEL))
