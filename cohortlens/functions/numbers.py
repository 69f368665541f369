"""Sums that do not depend on the order in which partitions arrive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,8)"
# For shares of a month, which are small: all digits that a double of their size has.
EXACT_SHARE = "decimal(38,18)"


def exact_sum_sql(value: str) -> str:
    """Sum a fractional SQL expression as decimals, giving a double.

    Floating-point addition is not associative, so a plain sum of doubles would change in its last digits
    with the partitioning.
    """
    return f"CAST(sum(CAST({value} AS {EXACT})) AS double)"


def exact_sum(value: str) -> Column:
    return F.expr(exact_sum_sql(value))


def ordered_sum(value: Column) -> Column:
    """Sum a few doubles of a group, such as one metric's rows by status, in ascending order, so that the result is
    the same on every run and nothing is rounded before; NULL where there are none."""
    values = F.sort_array(F.collect_list(value))
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda total, x: total + x))


def weighted_mean(value: str, weight: str) -> Column:
    """``sum(value * weight) / sum(weight)``; the weight of a NULL value still counts."""
    return F.expr(f"try_divide({exact_sum_sql(f'({value}) * ({weight})')}, {exact_sum_sql(weight)})")


# Money has four decimals, so ten-thousandths are whole numbers. Sums of them are sums of longs: several times
# faster than decimal sums where many are kept per row, and still exact. They reach to 9e14 and fail beyond.
TICKS = 10000


def to_ticks(money: str) -> str:
    return f"CAST(({money}) * {TICKS} AS bigint)"


def from_ticks(ticks: str) -> str:
    return f"({ticks}) / {TICKS}D"


def is_yes(flag: str) -> Column:
    return F.coalesce(F.col(flag) == "Y", F.lit(False))
