"""The whole job over the test tables: topics as files in Kafka's shape, all sinks as Parquet folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.functions.codec import encode
from receiptflow.operators.spend import TOTALS
from receiptflow.plans.jobs import INPUTS, TABLES, Job
from receiptflow.schemas import CUSTOMER, CUSTOMER_TRANSACTION, FRAUD_MARK, TRANSACTION, Record
from receiptflow.session import work_folder
from receiptflow.sinks import tables as table_sink
from receiptflow.sources import tables
from receiptflow.sources.kafka import kafka_files

#: Times that messages arrive and the job catches up with them, each time from its checkpoints.
ARRIVALS = 2
_done: dict[tuple[str, str], str] = {}


def _messages(df: DataFrame, record: Record, place: Column) -> DataFrame:
    """Rows as messages of the record's topic; ``place`` is their order."""
    keyed = df.withColumn("_place", place.cast("bigint"))
    value = F.to_json(F.struct(*[_text(f).alias(f.json) for f in record.fields]), {"ignoreNullFields": "false"})
    return keyed.select(
        F.col(record.key).cast("binary").alias("key"), value.cast("binary").alias("value"), F.lit(record.topic).alias("topic"),
        F.pmod("_place", F.lit(2)).cast("int").alias("partition"), F.col("_place").alias("offset"),
        F.timestamp_micros(tables.START_US + F.col("_place")).alias("timestamp"),
    )


def _text(field) -> Column:
    return F.date_format(field.column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if field.type == T.TimestampType() else F.col(field.column)


def _run(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a finished run over the tables; one run serves all queries of a session."""
    known = (spark.sparkContext.applicationId, sf_dir)
    if known in _done:
        return _done[known]
    folder = work_folder(spark, "job")
    marks = tables.as_marks(tables.load(spark, sf_dir, "lineitem"))
    topics = {
        TRANSACTION: _messages(tables.purchases(spark, sf_dir), TRANSACTION, F.col("arrival")),
        CUSTOMER: _messages(tables.signups(spark, sf_dir), CUSTOMER, F.col("arrival")),
        FRAUD_MARK: _messages(marks, FRAUD_MARK, F.unix_micros("detected_ts") - tables.START_US),
    }
    cuts = {r: rows.agg(F.min("offset"), F.max("offset")).first() for r, rows in topics.items()}
    for arrival in range(ARRIVALS):
        for record, rows in topics.items():
            low, high = cuts[record]
            width = ((high or 0) - (low or 0)) // ARRIVALS + 1
            mine = F.floor((F.col("offset") - F.lit(low or 0)) / width) == arrival
            rows.where(mine).write.mode("append").parquet(f"{folder}/topics/{record.topic}")
        job = Job(
            checkpoints=f"{folder}/checkpoints",
            topics={r.name: kafka_files(spark, f"{folder}/topics/{r.topic}", r.topic) for r in INPUTS},
            enriched=lambda batch, batch_id: table_sink.append_batch(f"{folder}/enriched")(encode(batch, CUSTOMER_TRANSACTION), batch_id),
            totals=lambda df: df.writeStream.outputMode("update").foreachBatch(table_sink.append_batch(f"{folder}/totals")),
            tables={r.name: table_sink.upsert(r, f"{folder}/tables/{r.table}") for r in TABLES},
            bad_messages=lambda df, table: df.writeStream.format("parquet").option("path", f"{folder}/bad/{table}"),
            window_time="event",
            enrich_form="batches",
            trigger={"availableNow": True},
        )
        for query in job.start().values():
            query.awaitTermination()
    _done[known] = folder
    return folder


def forget() -> None:
    """Let the next query run the job anew."""
    _done.clear()


def job_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published JSON, read back field by field."""
    written = spark.read.parquet(f"{_run(spark, sf_dir)}/enriched")
    kinds = {f: "bigint" if f.type == T.TimestampType() else f.type.simpleString() for f in CUSTOMER_TRANSACTION.fields}
    names = {f: f"{f.column}_ms" if f.type == T.TimestampType() else f.column for f in kinds}
    return written.select(*[F.get_json_object("value", f"$.{f.json}").cast(kinds[f]).alias(names[f]) for f in kinds])


def job_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table_sink.read_changes(spark, f"{_run(spark, sf_dir)}/totals", ["customer_id", "window_start"], TOTALS)
    return rows.select("customer_id", F.unix_millis("window_start").alias("window_start_ms"), "total", "n")


def job_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and different keys of the four tables."""
    folder, out = _run(spark, sf_dir), None
    for record in TABLES:
        rows = table_sink.read_table(spark, f"{folder}/tables/{record.table}", record)
        counts = rows.agg(F.count("*").alias("n"), F.count_distinct(record.key).alias("keys"))
        counts = counts.select(F.lit(record.table).alias("name"), "n", "keys")
        out = counts if out is None else out.unionByName(counts)
    return out


QUERIES = {"job_enriched": job_enriched, "job_totals": job_totals, "job_tables": job_tables}
