"""Sums and means that do not depend on the order of the rows.

Adding doubles gives a result that changes with the partitioning and with task retries. Amounts are therefore added as
decimals with four places, which is exact for prices in cents and for interpolated quartiles of them, and only the
finished sum is turned into a double. That holds for amounts and counts only: the general statistics, which take any column,
add doubles (``exact=False``), as four places would round small values away and large or infinite ones don't fit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT = "decimal(18,4)"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def total(column: Column | str, over=None, exact: bool = True) -> Column:
    value = F.sum(_col(column).cast(AMOUNT)) if exact else F.sum(_col(column))
    value = value if over is None else value.over(over)
    return value.cast("double")


def mean(column: Column | str, over=None, exact: bool = True) -> Column:
    """Mean of the non-null values; null if there are none."""
    if not exact:
        value = F.avg(_col(column))
        return value if over is None else value.over(over)
    count = F.count(_col(column))
    count = count if over is None else count.over(over)
    return F.try_divide(total(column, over), count.cast("double"))


def row_count() -> Column:
    return F.count(F.lit(1))


def summary(name: str, column: Column | str, over=None, exact: bool = False) -> Column:
    """One of the summary functions that the rolling and group features offer."""
    value = _col(column)
    plain: dict[str, Callable[[], Column]] = {
        "std": lambda: F.stddev_samp(value),
        "min": lambda: F.min(value),
        "max": lambda: F.max(value),
        "count": lambda: F.count(value),
    }
    if name == "mean":
        return mean(value, over, exact)
    if name == "sum":
        return total(value, over, exact)
    if name not in plain:
        raise ValueError(f"unknown summary function: {name}")
    result = plain[name]()
    return result if over is None else result.over(over)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """n / d; 0 if d is zero, null if d is null."""
    n, d = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(d == 0, F.lit(0.0)).otherwise(F.try_divide(n, d))
