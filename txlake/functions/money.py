"""Order-independent money arithmetic.

Amounts arrive as doubles. A sum of doubles depends on the order in which
partitions are merged, so sums run on decimals of eight places and go back to
double at the end, rounded to six. An amount is off by 5e-9 at most, a total of n
amounts by n * 5e-9 + 5e-7. NaN, infinite amounts and those of 1e20 and more are no
money: they become null here, and the quality rules set them aside.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,8)"
PLACES = 6


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return _col(c).try_cast(MONEY)


def as_double(total: Column) -> Column:
    """A sum of money as a double."""
    return F.round(total, PLACES).cast("double")


def exact_sum(c: Column | str) -> Column:
    return as_double(F.sum(money(c)))


def exact_avg(c: Column | str) -> Column:
    """Mean of the non-null amounts, null for none."""
    return F.try_divide(exact_sum(c), F.count(_col(c)))


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.try_divide(part.cast("double") * 100, whole), digits)
