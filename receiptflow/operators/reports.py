"""Reports over the stored transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from receiptflow.functions.money import money_sum


def monthly_spend(tx: DataFrame, exact: bool = True) -> DataFrame:
    """Spend per customer and calendar month. Columns: customer_id, y, m, spend, n."""
    return tx.groupBy(
        "customer_id",
        F.year("receipt_date").alias("y"),
        F.month("receipt_date").alias("m"),
    ).agg(money_sum("total_amount", exact).alias("spend"), F.count("*").alias("n"))


def peak_periods(events: DataFrame, at: Column | str = "receipt_date") -> DataFrame:
    """Hours of the day ranked by number of rows, busiest first. Columns: h, n, rk."""
    per_hour = events.groupBy(F.hour(at).alias("h")).agg(F.count("*").alias("n"))
    return ranked(per_hour)


def ranked(per_hour: DataFrame) -> DataFrame:
    """Hours with their counts, ranked."""
    # The unpartitioned window sees at most 25 rows: the hours and a null.
    return per_hour.select("h", "n", F.rank().over(Window.orderBy(F.desc("n"))).alias("rk"))
