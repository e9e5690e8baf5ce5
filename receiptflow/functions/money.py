"""Sums of money."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_sum(amount: Column | str, exact: bool = True) -> Column:
    """Sum a DOUBLE amount.

    ``exact`` adds decimals of eight places: the answer does not depend on the order of addition, so a
    retried task or another partitioning gives the same bits. Amounts of up to 20 digits before and 8
    after the point are added as they are; larger ones and those that are no number raise, which
    the decoder keeps from coming here. ``exact=False`` adds the doubles as they are.
    """
    amount = F.col(amount) if isinstance(amount, str) else amount
    if not exact:
        return F.sum(amount)
    return F.sum(amount.cast("decimal(28,8)")).cast("double")
