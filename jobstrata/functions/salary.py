"""Salary rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobstrata import vocab


def has_salary_info(has_salary: Column, low: Column, high: Column, widen: bool = False) -> Column:
    """The stated flag, else whether a bound is known.

    A source that always states false hides later values; ``widen`` ORs the two instead.
    """
    known = low.isNotNull() | high.isNotNull()
    if widen:
        return F.coalesce(has_salary, F.lit(False)) | known
    return F.coalesce(has_salary, known)


def payload_has_salary(low: Column, high: Column, text: Column) -> Column:
    return low.isNotNull() | high.isNotNull() | text.isNotNull()


def salary_spread(low: Column, high: Column) -> Column:
    """Upper minus lower bound; NULL unless both are known."""
    return high - low


def is_premium(low: Column, bound: float = vocab.PREMIUM_SALARY) -> Column:
    return F.coalesce(low > bound, F.lit(False))


def bounds_from_text(text: Column) -> Column:
    """Struct of ``low`` and ``high`` from text such as ``R$ 1,000 - R$ 2,000``."""
    amount = lambda pattern: F.regexp_replace(
        F.regexp_extract(text, pattern, 1), ",", ""
    ).try_cast("double")
    return F.struct(amount(r"R\$ ([0-9,]+)").alias("low"), amount(r"- R\$ ([0-9,]+)").alias("high"))
