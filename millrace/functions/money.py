"""Exact money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.schemas import MARGIN, MONEY


def to_money(amount: Column) -> Column:
    """Double to decimal(18,4) through its shortest decimal text, HALF_UP beyond
    four places; null when it does not fit."""
    return amount.try_cast(MONEY)


def margin_pct(profit: Column, revenue: Column) -> Column:
    """profit / revenue in percent, HALF_UP to 0.01, on decimal operands.

    Zero revenue gives 0.00. Null means the margin does not fit decimal(6,2).
    """
    ratio = F.try_divide(profit, revenue) * 100
    return (
        F.when(revenue == 0, F.lit("0.00").cast(MARGIN))
        .otherwise(F.round(ratio, 2).try_cast(MARGIN))
    )


def exact_mean(amount: Column, scale: int) -> Column:
    """Mean of a decimal column rounded once. ``avg`` would round to six places
    first and then again."""
    total = F.sum(amount.cast("decimal(18,2)")).cast("decimal(38,18)")
    return F.round(total / F.count(amount), scale)
