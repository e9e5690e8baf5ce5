"""Record types. Inside Spark every record uses snake_case columns; JSON uses camelCase names."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    json: str
    column: str
    type: T.DataType


@dataclass(frozen=True)
class Record:
    name: str
    topic: str
    table: str
    key: str
    fields: tuple[Field, ...]

    @property
    def columns(self) -> list[str]:
        return [f.column for f in self.fields]

    @property
    def json_names(self) -> list[str]:
        return [f.json for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.column, f.type) for f in self.fields])


# Topic, table, field and column names of the records, in declared order.
TRANSACTION = Record(
    name="Transaction",
    topic="transactions_topic",
    table="Raw_Transactions",
    key="receipt_id",
    fields=(
        Field("receiptId", "receipt_id", T.StringType()),
        Field("customerId", "customer_id", T.StringType()),
        Field("productId", "product_id", T.StringType()),
        Field("productName", "product_name", T.StringType()),
        Field("productPrice", "product_price", T.DoubleType()),
        Field("productQuantity", "product_quantity", T.IntegerType()),
        Field("totalAmount", "total_amount", T.DoubleType()),
        Field("receiptDate", "receipt_date", T.TimestampType()),
        Field("paymentMethod", "payment_method", T.StringType()),
    ),
)

CUSTOMER = Record(
    name="Customer",
    topic="customer_topic",
    table="Customer",
    key="customer_id",
    fields=(
        Field("customerId", "customer_id", T.StringType()),
        Field("name", "name", T.StringType()),
        Field("email", "email", T.StringType()),
        Field("birthdate", "birthdate", T.StringType()),
    ),
)

FRAUD_MARK = Record(
    name="FraudTransaction",
    topic="fraud_transactions_topic",
    table="Fraud_Transactions",
    key="receipt_id",
    fields=(
        Field("receiptId", "receipt_id", T.StringType()),
        Field("detectedTs", "detected_ts", T.TimestampType()),
    ),
)

CUSTOMER_TRANSACTION = Record(
    name="CustomerTransaction",
    topic="customer_transactions_topic",
    table="Customer_Transactions",
    key="receipt_id",
    fields=TRANSACTION.fields
    + (
        Field("customerName", "customer_name", T.StringType()),
        Field("customerEmail", "customer_email", T.StringType()),
        Field("customerBirthdate", "customer_birthdate", T.StringType()),
    ),
)

RECORDS = (TRANSACTION, CUSTOMER, FRAUD_MARK, CUSTOMER_TRANSACTION)

KAFKA_ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
