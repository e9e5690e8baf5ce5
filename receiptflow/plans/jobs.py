"""The whole job: every stream from its topic to its sinks, as named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from receiptflow.functions.codec import bad, decode, good
from receiptflow.operators.spend import spend
from receiptflow.schemas import CUSTOMER, CUSTOMER_TRANSACTION, FRAUD_MARK, TRANSACTION
from receiptflow.session import prepare
from receiptflow.sinks import jdbc
from receiptflow.sinks.stream import console_sink, kafka_sink
from receiptflow.sources.kafka import arrival, kafka_source
from receiptflow.streaming.batches import enrich_batches
from receiptflow.streaming.corrections import correct, interleaved
from receiptflow.streaming.enrich import enrich_stream

INPUTS = (TRANSACTION, CUSTOMER, FRAUD_MARK)
#: Columns without which a record cannot be used; such messages are bad.
REQUIRED = {
    TRANSACTION.name: ("receipt_id", "customer_id", "receipt_date"),
    CUSTOMER.name: ("customer_id",),
    FRAUD_MARK.name: ("receipt_id",),
}
TABLES = (TRANSACTION, CUSTOMER, FRAUD_MARK, CUSTOMER_TRANSACTION)

Sink = Callable[[DataFrame], DataStreamWriter]
Batch = Callable[[DataFrame, int], None]


@dataclass
class Job:
    """What to run and where to put it.

    ``topics`` gives the message stream of each input record; ``enriched`` publishes a micro-batch of
    enriched records; ``tables`` gives, per record, a function that stores a micro-batch of its rows
    (both as for ``foreachBatch``); ``bad_messages``, if given, makes a writer for the
    messages of a table that do not decode, which otherwise stop the job; ``corrected``, if given, takes the signed
    changes of ``streaming.corrections`` in micro-batches, such as ``reports.maintain`` folds: sums over
    them count each receipt once and none that is marked as fraud, also when the mark comes later.
    """

    checkpoints: str
    topics: dict[str, DataFrame]
    enriched: Batch
    totals: Sink = console_sink
    tables: dict[str, Batch] = field(default_factory=dict)
    bad_messages: Callable[[DataFrame, str], DataStreamWriter] | None = None
    corrected: Batch | None = None
    window: str = "10 seconds"
    window_time: str = "processing"
    lateness: str | None = None  # see operators.spend: a delay lets windows be dropped, and rows with them
    enrich_mode: str = "asof"
    enrich_form: str = "state_store"  # or "batches", see streaming.batches
    salts: int = 8
    hot_keys: list[str] | None = None  # customers whose transactions are spread over the salts; default all
    trigger: dict = field(default_factory=lambda: {"processingTime": "1 second"})

    def start(self) -> dict[str, StreamingQuery]:
        """Start all queries; each keeps its own checkpoint and resumes from it."""
        records, writers = {}, {}
        for record in INPUTS:
            messages = self.topics[record.name].select("value", arrival().alias("arrival"))
            required = REQUIRED[record.name]
            if self.bad_messages is None:
                records[record.name] = decode(messages, record, required=required)
            else:
                decoded = decode(messages, record, "quarantine", required=required)
                records[record.name] = good(decoded)
                writers[f"bad_{record.table}"] = self.bad_messages(bad(decoded).select("problem", "raw"), record.table)
        tx, customers = records[TRANSACTION.name], records[CUSTOMER.name]
        if self.enrich_form == "batches":
            state = f"{self.checkpoints}/enrich_state"
            enriched = enrich_batches(tx, customers, self._publish, state, self.enrich_mode)
        else:
            rows = enrich_stream(tx, customers, self.enrich_mode, self.salts, self.hot_keys)
            enriched = rows.writeStream.foreachBatch(self._publish)
        writers["spend_per_window"] = self.totals(spend(tx, self.window_time, self.window, self.lateness))
        writers[CUSTOMER_TRANSACTION.topic] = enriched
        if self.corrected is not None:
            log = interleaved(tx, records[FRAUD_MARK.name])
            writers["corrected_spend"] = log.writeStream.foreachBatch(correct(self.corrected, f"{self.checkpoints}/receipts"))
        for record in INPUTS:
            if record.name in self.tables:
                writers[record.table] = records[record.name].writeStream.foreachBatch(self.tables[record.name])
        return {
            name: writer.queryName(name)
            .option("checkpointLocation", f"{self.checkpoints}/{name}")
            .trigger(**self.trigger)
            .start()
            for name, writer in writers.items()
        }

    def _publish(self, batch: DataFrame, batch_id: int) -> None:
        """Publish and store enriched records from one run of the stateful join."""
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.enriched(batch.select(*CUSTOMER_TRANSACTION.columns), batch_id)
            if CUSTOMER_TRANSACTION.name in self.tables:
                rows = batch.withColumnRenamed("tx_arrival", "arrival")
                self.tables[CUSTOMER_TRANSACTION.name](rows, batch_id)
        finally:
            batch.unpersist()


def kafka_job(
    spark: SparkSession,
    servers: str,
    target: jdbc.JdbcTarget,
    checkpoints: str,
    per_trigger: int = 10_000_000,
    min_partitions: int | None = None,
    kafka: dict[str, str] | None = None,
    **options,
) -> Job:
    """The job between Kafka and a relational database. Creates missing tables first.

    ``kafka`` holds further options of the connector, such as those for security.
    """
    prepare(spark)
    jdbc.ensure_tables(spark, target, list(TABLES))
    return Job(
        checkpoints=checkpoints,
        topics={
            r.name: kafka_source(spark, r.topic, servers, per_trigger=per_trigger, min_partitions=min_partitions, more=kafka)
            for r in INPUTS
        },
        enriched=lambda batch, batch_id: kafka_sink(batch, servers).options(**(kafka or {})).save(),
        tables={r.name: jdbc.upsert(r, target, r.table.lower()) for r in TABLES},
        **options,
    )


def run(spark: SparkSession, job: Job) -> None:
    """Run until a query stops; an error in it is raised here."""
    job.start()
    spark.streams.awaitAnyTermination()
