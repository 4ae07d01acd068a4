"""Order-independent sums of money held as DOUBLE.

A sum of doubles depends on the order in which tasks finish. Amounts are therefore
summed as decimals. What no decimal of this width can hold (NaN, infinity, 10^16
and more) is summed beside it as a double, so nothing is left out: one NaN makes
its group NaN, just as a plain double sum would.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def exact_amount(amount: Column) -> Column:
    return amount.try_cast(MONEY)


def inexact_amount(amount: Column) -> Column:
    return F.when(exact_amount(amount).isNull(), amount)


def revenue(exact_sum: Column, inexact_sum: Column) -> Column:
    """The total as DOUBLE, from the two sums."""
    exact = exact_sum.cast("double")
    return F.when(inexact_sum.isNull(), exact).otherwise(
        F.coalesce(exact, F.lit(0.0)) + inexact_sum
    )


def average(exact_sum: Column, inexact_sum: Column, count: Column) -> Column:
    """The mean rounded half up to cents, as DOUBLE.

    The quotient of these two types keeps 16 digits after the point. No quotient of
    whole cents comes that close to half a cent without being it, so rounding again
    to cents gives the exactly rounded mean. Larger sums divide as doubles.
    """
    exact = F.try_divide(exact_sum.try_cast("decimal(24,2)"), count.try_cast("decimal(13,0)"))
    total = revenue(exact_sum, inexact_sum)
    return F.when(
        inexact_sum.isNull() & exact.isNotNull(), F.round(exact, 2).cast("double")
    ).otherwise(F.round(F.try_divide(total, count), 2))
