"""Upserts, Kafka options, retries. No broker and no database is started: statements are checked as
text and on the engine that also runs the comparison SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from receiptflow.plans import jobs
from receiptflow.schemas import CUSTOMER, CUSTOMER_TRANSACTION, FRAUD_MARK, RECORDS, TRANSACTION
from receiptflow.sinks import jdbc, tables
from receiptflow.sinks.stream import kafka_sink, with_retries
from receiptflow.sources.kafka import kafka_files, kafka_options, read_topic

TARGET = jdbc.JdbcTarget("jdbc:postgresql://db/shop", "user", "secret")


def versions(seed, size, keys):
    rng = random.Random(seed)
    return [(f"c{rng.randrange(keys)}", f"n{i}", None if i % 3 else f"e{i}", "1990-01-01", i) for i in range(size)]


SCHEMA = "customer_id string, name string, email string, birthdate string, arrival bigint"


@pytest.mark.parametrize("batches", [1, 4, 9])
def test_upsert_does_not_depend_on_batches(spark, tmp_path, batches):
    rows = versions(1, 300, 40)
    expected = {r[0]: r[:4] for r in rows}
    write = tables.upsert(CUSTOMER, str(tmp_path))
    for i in range(batches):
        part = rows[i * len(rows) // batches : (i + 1) * len(rows) // batches]
        for _ in range(2):  # a batch may run twice
            write(spark.createDataFrame(part, SCHEMA), i)
    stored = tables.read_table(spark, str(tmp_path), CUSTOMER, "customers_now").collect()
    assert {r[0]: tuple(r) for r in stored} == expected and len(stored) == len(expected)
    assert spark.sql("SELECT count(*) FROM customers_now").first()[0] == len(expected)


def test_new_run_wins_over_stale_batches(spark, tmp_path):
    first = tables.upsert(CUSTOMER, str(tmp_path))
    for i in range(3):
        first(spark.createDataFrame([("a", f"old {i}", None, None, i)], SCHEMA), i)
    tables.upsert(CUSTOMER, str(tmp_path), run=1)(spark.createDataFrame([("a", "new", None, None, 9)], SCHEMA), 0)
    assert [r["name"] for r in tables.read_table(spark, str(tmp_path), CUSTOMER).collect()] == ["new"]


def test_compaction_keeps_the_table(spark, tmp_path):
    write = tables.upsert(CUSTOMER, str(tmp_path))
    write(spark.createDataFrame([("a", "x", None, None, 1), ("b", "y", None, None, 2)], SCHEMA), 0)
    write(spark.createDataFrame([("a", "z", None, None, 3)], SCHEMA), 1)
    run = tables.compact(spark, str(tmp_path), CUSTOMER)
    assert len(tables.batches(spark, str(tmp_path))) == 1
    rows = lambda: {r[0]: r[1] for r in tables.read_table(spark, str(tmp_path), CUSTOMER).collect()}
    assert rows() == {"a": "z", "b": "y"}
    tables.upsert(CUSTOMER, str(tmp_path), run)(spark.createDataFrame([("b", "w", None, None, 4)], SCHEMA), 0)
    assert rows() == {"a": "z", "b": "w"}


def test_unfinished_batches_and_empty_tables(spark, tmp_path):
    assert tables.read_table(spark, str(tmp_path), CUSTOMER).collect() == []
    spark.createDataFrame([("a", "x", None, None, 1)], SCHEMA).write.parquet(f"{tmp_path}/run=0/batch=0")
    (tmp_path / "run=0" / "batch=0" / "_SUCCESS").unlink()
    assert tables.read_table(spark, str(tmp_path), CUSTOMER).collect() == []


def test_password_is_not_shown():
    assert "secret" not in repr(jdbc.JdbcTarget("jdbc:postgresql://db/x", "user", "secret"))


def test_later_batch_wins(spark, tmp_path):
    write = tables.upsert(CUSTOMER, str(tmp_path))
    write(spark.createDataFrame([("a", "new", None, None, 9), (None, "no key", None, None, 10)], SCHEMA), 0)
    write(spark.createDataFrame([("a", "newest", None, None, 1)], SCHEMA), 1)
    assert [tuple(r) for r in tables.read_table(spark, str(tmp_path), CUSTOMER).collect()] == [("a", "newest", None, None)]


def test_statements():
    assert jdbc.create_sql(FRAUD_MARK) == (
        "CREATE TABLE IF NOT EXISTS Fraud_Transactions (receipt_id VARCHAR PRIMARY KEY, detected_ts TIMESTAMP)"
    )
    assert jdbc.merge_sql(FRAUD_MARK, "s") == (
        "INSERT INTO Fraud_Transactions (receipt_id, detected_ts) SELECT receipt_id, detected_ts FROM s "
        "ON CONFLICT (receipt_id) DO UPDATE SET detected_ts = EXCLUDED.detected_ts"
    )
    for record in (TRANSACTION, CUSTOMER, CUSTOMER_TRANSACTION):
        assert all(c in jdbc.create_sql(record) for c in record.columns)


@pytest.mark.parametrize("batches", [1, 5])
def test_jdbc_upsert_flow(spark, batches):
    """Tables first, then stage and merge per batch, with the statements run for real."""
    engine, log = duckdb.connect(), []

    def run(_spark, _target, statement):
        log.append(statement.split(" ")[0])
        engine.execute(statement)

    def put(df, _target, staging):
        frame = df.toPandas()
        assert frame[CUSTOMER.key].is_unique
        engine.execute(f"DROP TABLE IF EXISTS {staging}")
        engine.register("staged", frame)
        engine.execute(f"CREATE TABLE {staging} AS SELECT * FROM staged")

    rows = versions(2, 200, 30) + [(None, "no key", None, None, 999)]
    for _ in range(2):
        jdbc.ensure_tables(spark, TARGET, list(RECORDS), run)
    write = jdbc.upsert(CUSTOMER, TARGET, "customer", run, put)
    for i in range(batches):
        write(spark.createDataFrame(rows[i * len(rows) // batches : (i + 1) * len(rows) // batches], SCHEMA), i)
    stored = engine.execute("SELECT customer_id, name, email, birthdate FROM Customer").fetchall()
    assert {r[0]: r for r in stored} == {r[0]: r[:4] for r in rows if r[0]} and len(stored) == len({r[0] for r in stored})
    assert log == ["CREATE"] * 8 + ["INSERT"] * batches


def test_jdbc_options():
    options = TARGET.options("Customer")
    assert (options["batchsize"], TARGET.retries, options["driver"]) == ("1000", 5, "org.postgresql.Driver")
    assert options["dbtable"] == "Customer" and options["url"].startswith("jdbc:postgresql:")


def test_driver_class_is_instantiated(spark):
    assert jdbc._instance(spark, "java.util.Properties").size() == 0


def test_kafka_job_is_wired(spark, tmp_path, monkeypatch):
    created, read = [], []
    monkeypatch.setattr(jdbc, "execute", None)
    monkeypatch.setattr(jdbc, "ensure_tables", lambda _spark, _target, records: created.extend(r.table for r in records))

    def source(_spark, topic, servers, per_trigger, min_partitions, more):
        read.append((topic, servers, per_trigger, min_partitions, more))
        return kafka_files(spark, str(tmp_path))

    monkeypatch.setattr(jobs, "kafka_source", source)
    job = jobs.kafka_job(
        spark, "b:9092", TARGET, "/checkpoints", per_trigger=7, min_partitions=9, kafka={"kafka.security.protocol": "SSL"}, window="1 minute"
    )
    assert created == ["Raw_Transactions", "Customer", "Fraud_Transactions", "Customer_Transactions"]
    topics = ("transactions_topic", "customer_topic", "fraud_transactions_topic")
    assert read == [(topic, "b:9092", 7, 9, {"kafka.security.protocol": "SSL"}) for topic in topics]
    assert set(job.tables) == {r.name for r in RECORDS} and job.window == "1 minute"


def test_retries(spark):
    calls = []

    def flaky(batch, batch_id):
        calls.append(batch_id)
        if len(calls) < 4:
            raise OSError("connection lost")

    with_retries(flaky, retries=5, pause=0)(None, 7)
    assert calls == [7] * 4
    calls.clear()
    with pytest.raises(OSError):
        with_retries(flaky, retries=1, pause=0)(None, 1)
    assert len(calls) == 2


def test_kafka_options():
    options = kafka_options("transactions_topic", "b:9092", per_trigger=5, min_partitions=64)
    assert options == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "transactions_topic",
        "startingOffsets": "earliest",
        "groupIdPrefix": "receiptflow",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "5",
        "minPartitions": "64",
    }


def test_kafka_sink_writes_values_without_key(spark):
    row = {c: None for c in CUSTOMER_TRANSACTION.columns}
    df = spark.createDataFrame([tuple(row.values())], CUSTOMER_TRANSACTION.schema)
    assert kafka_sink(df, "b:9092")._df.columns == ["value"]


def test_kafka_files(spark, tmp_path):
    rows = spark.range(3).select(
        F.lit(None).cast("binary").alias("key"),
        F.concat(F.lit('{"receiptId":"'), "id", F.lit('"}')).cast("binary").alias("value"),
        F.when(F.col("id") < 2, "fraud_transactions_topic").otherwise("other").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
        F.timestamp_micros(F.col("id") + 5).alias("timestamp"),
    )
    rows.write.parquet(f"{tmp_path}/topic")
    messages = kafka_files(spark, f"{tmp_path}/topic", "fraud_transactions_topic", stream=False)
    decoded = read_topic(messages, FRAUD_MARK).orderBy("receipt_id").collect()
    assert [(r.receipt_id, tuple(r.arrival)) for r in decoded] == [("0", (5, 0, 0)), ("1", (6, 0, 1))]
    assert kafka_files(spark, f"{tmp_path}/topic", files_per_trigger=1).isStreaming
