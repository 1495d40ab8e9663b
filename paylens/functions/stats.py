"""Aggregate expressions for money columns: plain double sums, means and deviations.

No amount is dropped or rounded on the way: what is counted is also summed.
NaN and infinite amounts make sum and average NaN or infinite, as doubles do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_sum(c: str = "amount") -> Column:
    return F.sum(c)


def money_avg(c: str = "amount") -> Column:
    return F.avg(c)


def money_stddev(c: str = "amount") -> Column:
    """Sample standard deviation; NULL for fewer than two values."""
    return F.stddev_samp(c)
