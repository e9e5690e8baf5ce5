"""Topics as DataFrames in the Kafka shape: key, value, topic, partition, offset, timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from receiptflow.functions.codec import decode
from receiptflow.schemas import KAFKA_ENVELOPE, Record

GROUP_PREFIX = "receiptflow"


def kafka_options(
    topic: str,
    servers: str,
    starting: str = "earliest",
    group_prefix: str = GROUP_PREFIX,
    per_trigger: int | None = None,
    min_partitions: int | None = None,
    more: dict[str, str] | None = None,
) -> dict[str, str]:
    """``starting`` counts for a new checkpoint only: a restarted query goes on from its own offsets.

    ``per_trigger`` bounds the messages of one micro-batch; ``min_partitions`` cuts large topic
    partitions so that a replay is read by more tasks than the topic has partitions; ``more`` are
    further options of the connector, such as those for security.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "groupIdPrefix": group_prefix,
        "failOnDataLoss": "true",
    }
    if per_trigger:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options | (more or {})


def kafka_source(spark: SparkSession, topic: str, servers: str, stream: bool = True, **options) -> DataFrame:
    """A topic through Spark's Kafka connector; ``stream=False`` reads what it holds now."""
    reader = spark.readStream if stream else spark.read
    settings = kafka_options(topic, servers, **options)
    if not stream:
        settings.pop("maxOffsetsPerTrigger", None)
    return reader.format("kafka").options(**settings).load()


def kafka_files(
    spark: SparkSession, path: str, topic: str | None = None, stream: bool = True, files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files with the Kafka columns: an archived topic, or a stand-in for a broker."""
    reader = (spark.readStream if stream else spark.read).schema(KAFKA_ENVELOPE)
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.parquet(path)
    return rows if topic is None else rows.filter(F.col("topic") == topic)


def arrival() -> Column:
    """The order of arrival of a message: broker time, then its place in the topic."""
    return F.struct(
        F.unix_micros("timestamp").alias("at"),
        F.col("partition").cast("bigint").alias("partition"),
        F.col("offset").alias("offset"),
    )


def read_topic(messages: DataFrame, record: Record, mode: str = "failfast") -> DataFrame:
    """Decoded records with their ``arrival``; the message key takes no part."""
    return decode(messages.select("value", arrival().alias("arrival")), record, mode)
