"""Stream writers: Kafka topic, console, and a function per micro-batch."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from receiptflow.functions.codec import encode
from receiptflow.schemas import CUSTOMER_TRANSACTION, Record


def kafka_sink(df: DataFrame, servers: str, record: Record = CUSTOMER_TRANSACTION, topic: str | None = None):
    """A writer that puts each record on its topic as JSON without a key, at least once.

    Returns a stream writer for a stream and a batch writer for a batch.
    """
    values = encode(df, record)
    writer = values.writeStream if df.isStreaming else values.write
    return writer.format("kafka").options(**{"kafka.bootstrap.servers": servers, "topic": topic or record.topic})


def console_sink(df: DataFrame, mode: str = "update") -> DataStreamWriter:
    return df.writeStream.format("console").outputMode(mode).option("truncate", "false")


def with_retries(write: Callable[[DataFrame, int], None], retries: int = 5, pause: float = 1.0):
    """Repeat a micro-batch write that fails; ``write`` must be safe to repeat.

    Errors in the query itself do not heal and are raised at once.
    """

    def attempt(batch: DataFrame, batch_id: int) -> None:
        for tried in range(retries + 1):
            try:
                return write(batch, batch_id)
            except (AnalysisException, ParseException):
                raise
            except Exception:
                if tried == retries:
                    raise
                time.sleep(pause * 2**tried)

    return attempt
