"""The test tables, shaped as the records the transforms take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.session import prepare

# Fixed value: 2024-01-01 00:00 UTC in microseconds, where the event table starts.
START_US = 1704067200000000
#: The columns of a line item that make it a transaction.
LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, with its zoneless timestamps read as UTC instants (watermarks need those)."""
    prepare(spark)
    return instants(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def instants(df: DataFrame) -> DataFrame:
    zoneless = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as transactions. Receipts repeat; ``arrival`` orders their copies."""
    return as_transactions(load(spark, sf_dir, "lineitem"), spark, sf_dir)


def as_transactions(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items as transactions.

    Orders are joined last: that brings all copies of a receipt into one task, and a step that keeps one of them can
    drop the others before its exchange.
    """
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    parts = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    grade = F.substring("o_orderpriority", 1, 1)
    payment = (
        F.when(grade == "1", "Voucher")
        .when(grade == "2", "Invoice")
        .when(grade == "3", "Cash")
        .when(grade == "4", "Bank transfer")
        .otherwise("Store credit")
    )
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("receipt_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.concat(F.lit("pr-"), F.col("l_partkey")).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_retailprice").alias("product_price"),
            F.col("l_quantity").cast("int").alias("product_quantity"),
            F.col("l_extendedprice").alias("total_amount"),
            F.col("l_shipdate").alias("receipt_date"),
            payment.alias("payment_method"),
            F.struct("l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey").alias("arrival"),
        )
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    birthdate = F.concat(1950 + key % 50, F.lit("-0"), 1 + key % 9, F.lit("-1"), key % 10)
    return load(spark, sf_dir, "customer").select(
        key.cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), key, F.lit("@example.org")).alias("email"),
        birthdate.alias("birthdate"),
    )


def fraud_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items of every tenth order, marked a day after shipping; marks repeat."""
    return as_marks(load(spark, sf_dir, "lineitem")).drop("arrival")


def as_marks(lines: DataFrame) -> DataFrame:
    return lines.filter("l_orderkey % 10 = 0").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("receipt_id"),
        (F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")).alias("detected_ts"),
        F.col("l_shipdate").alias("arrival"),
    )


def spend_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as purchases, in time compressed 10,000-fold so that windows hold several rows."""
    return as_spend(load(spark, sf_dir, "events"))


def as_spend(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("value").alias("total_amount"),
        F.timestamp_micros(compressed()).alias("receipt_date"),
    )


def compressed() -> Column:
    return F.expr(f"{START_US} + (unix_micros(ts) - {START_US}) div 10000")


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_purchases(load(spark, sf_dir, "events"))


def signups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_signups(load(spark, sf_dir, "events"))


def as_purchases(events: DataFrame) -> DataFrame:
    """Purchase events as transactions; ``arrival`` is the event id."""
    return events.filter("event_type = 'purchase'").select(
        F.concat(F.lit("ev-"), "event_id").alias("receipt_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.concat(F.lit("pr-"), F.get_json_object("props", "$.k")).alias("product_id"),
        F.col("event_type").alias("product_name"),
        F.col("value").alias("product_price"),
        F.lit(1).alias("product_quantity"),
        F.col("value").alias("total_amount"),
        F.date_trunc("millisecond", "ts").alias("receipt_date"),
        F.lit("Cash").alias("payment_method"),
        F.col("event_id").alias("arrival"),
    )


def as_signups(events: DataFrame) -> DataFrame:
    """Signup events as customer records; a repeated signup is a newer version of the customer."""
    return events.filter("event_type = 'signup'").select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.concat(F.lit("user "), "user_id", F.lit(" v"), "event_id").alias("name"),
        F.concat(F.lit("u"), "user_id", F.lit("@example.org")).alias("email"),
        F.concat(F.lit("19"), 50 + F.col("user_id") % 50, F.lit("-01-01")).alias("birthdate"),
        F.col("event_id").alias("arrival"),
    )
