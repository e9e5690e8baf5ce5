"""Windows, late rows, cleaning, reports, and the whole job over files in the Kafka shape."""

import datetime as dt
import json
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from receiptflow.operators import quality, reports
from receiptflow.operators.skew import profile
from receiptflow.operators.spend import TOTALS, spend
from receiptflow.plans import catalog
from receiptflow.plans.jobs import INPUTS, TABLES, Job
from receiptflow.schemas import CUSTOMER, CUSTOMER_TRANSACTION, FRAUD_MARK, TRANSACTION
from receiptflow.session import CHANGES, FREED, work_folder
from receiptflow.sinks import tables as table_sink
from receiptflow.sinks.stream import console_sink, kafka_sink
from receiptflow.sources.kafka import kafka_files
from receiptflow.streaming import corrections
from receiptflow.streaming import reports as kept_reports
from receiptflow.streaming.metrics import PROGRESS, ProgressListener, observed, recent_progress
from receiptflow.streaming.replay import catch_up, replay

SALE = "customer_id string, total_amount double, receipt_date timestamp, receipt_id string"


def sale(customer, amount, second, receipt=None):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    return customer, amount, start + dt.timedelta(seconds=second), receipt or f"{customer}-{second}"


def totals(df):
    rows = df.select("customer_id", F.unix_seconds("window_start") % 3600, "total", "n").collect()
    return sorted(tuple(r) for r in rows)


def test_windows_are_aligned_and_half_open(spark):
    rows = [sale("a", 1.1, 0), sale("a", 2.2, 9.999), sale("a", 4.4, 10), sale("b", 8.8, 9), ("a", 5.0, None, "r")]
    batch = spark.createDataFrame(rows, SALE)
    assert totals(spend(batch)) == [("a", 0, 3.3, 2), ("a", 10, 4.4, 1), ("b", 0, 8.8, 1)]
    assert totals(spend(batch, size="1 minute", exact=False)) == [("a", 0, 1.1 + 2.2 + 4.4, 3), ("b", 0, 8.8, 1)]
    with pytest.raises(ValueError):
        spend(batch, time="ingestion")


def test_no_stray_customer(spark):
    """The sum has no placeholder result for missing rows."""
    assert spend(spark.createDataFrame([], SALE)).count() == 0


def test_cents_do_not_depend_on_order(spark):
    rows = [sale("a", 0.1, 1)] * 1000 + [sale("a", 1e9 + 0.01, 1)]
    got = {spend(spark.createDataFrame(rows, SALE).repartition(n)).first().total for n in (1, 3, 7)}
    assert got == {1000000100.01}


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    slices = [[sale("a", 1.0, 5)], [sale("a", 2.0, 3605)], [sale("a", 4.0, 6), sale("a", 8.0, 3606)]]
    dropped, out = [], f"{tmp_path}/out"
    for rows in slices:
        spark.createDataFrame(rows, SALE).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(SALE).parquet(f"{tmp_path}/in")
        writer = spend(source, delay="0 seconds").writeStream.queryName("late").outputMode("update").foreachBatch(table_sink.append_batch(out))
        query = writer.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        query.awaitTermination()
        figures = recent_progress(spark, query)
        assert figures.schema == PROGRESS
        dropped.append(figures.agg(F.sum("late_rows_dropped")).first()[0])
    assert dropped == [0, 0, 1]
    assert totals(table_sink.read_changes(spark, out, ["customer_id", "window_start"], TOTALS)) == [("a", 0, 1.0, 1), ("a", 0, 10.0, 2)]


def test_sum_takes_amounts_as_they_are(spark):
    rows = spark.createDataFrame([sale("a", 0.004, 0)] * 1000, SALE)
    assert totals(spend(rows, size="1 minute"))[0][2] == 4.0


def test_dedupe(spark, tmp_path):
    rows = [sale("a", float(i), i % 7, f"r{i % 10}") + (i,) for i in range(50)]
    batch = spark.createDataFrame(rows, SALE + ", seq bigint")
    last = quality.dedupe(batch, "seq")
    assert sorted((r.receipt_id, r.seq) for r in last.collect()) == [(f"r{i}", 40 + i) for i in range(10)]
    with pytest.raises(ValueError):
        quality.dedupe(batch)
    out = f"{tmp_path}/out"

    def start(stream):
        return quality.dedupe(stream).writeStream.format("parquet").option("path", out)

    replay(batch, "seq", start, 4, folder=str(tmp_path))
    receipts = [r.receipt_id for r in spark.read.parquet(out).collect()]
    assert sorted(receipts) == [f"r{i}" for i in range(10)]


def test_a_replay_starts_from_whole_states(spark, tmp_path):
    """Not from the changes of all runs before; other streams keep changes."""
    rows = spark.createDataFrame([sale("a", float(i), i % 7, f"r{i % 10}") + (i,) for i in range(50)], SALE + ", seq bigint")

    def start(stream):
        return quality.dedupe(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out")

    before = spark.conf.get(CHANGES, None)
    replay(rows, "seq", start, 3, folder=str(tmp_path))
    kept = {f.suffix for f in (tmp_path / "checkpoint" / "state").rglob("*") if f.suffix in (".zip", ".changelog")}
    assert kept == {".zip"} and spark.conf.get(CHANGES, None) == before
    assert sorted(r.receipt_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [f"r{i}" for i in range(10)]


def test_a_replay_leaves_no_slices_and_shuffles(spark, tmp_path):
    rows = spark.createDataFrame([sale("a", float(i), i % 7, f"r{i % 10}") + (i,) for i in range(50)], SALE + ", seq bigint")

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {int(name.split("_")[1]) for name in names if name.startswith("shuffle_")}

    def start(stream):
        return quality.dedupe(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out")

    before, freed = shuffles(), spark.conf.get(FREED, None)
    replay(rows, "seq", start, 4, folder=str(tmp_path))
    deadline = time.monotonic() + 30
    # One is that of the least and largest number, from before the stream.
    while len(shuffles() - before) > 1 and time.monotonic() < deadline:
        time.sleep(0.2)
    assert len(shuffles() - before) <= 1
    assert not (tmp_path / "in").exists() and spark.conf.get(FREED, None) == freed
    assert sorted(r.receipt_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [f"r{i}" for i in range(10)]


def test_a_receipt_is_checked_in_the_part_of_its_order(spark):
    keys = [(k, n) for k in (0, 1, -1, 12, -345, 2**63 - 1, -(2**63)) for n in (1, -2, None)]
    rows = spark.createDataFrame(keys, "l_orderkey bigint, l_linenumber int")
    receipt = F.concat_ws("-", "l_orderkey", "l_linenumber")
    order = catalog.order_of(receipt).cast("bigint")
    parts = rows.select("l_orderkey", order.alias("order"), catalog.part_of_order(order).alias("a"), catalog.part_of_order(F.col("l_orderkey")).alias("b")).collect()
    assert all(r.order == r.l_orderkey and r.a == r.b and 0 <= r.a < catalog.CHECKS for r in parts)


def test_rows_with_copies(spark):
    """Absent values are equal, each row stays once, and a row that differs in one column is no copy."""
    row = ("r1", "c", "pr-1", "kettle", 1.0, 2, 2.0, None, "Cash")
    make = lambda rows: spark.createDataFrame(rows, TRANSACTION.schema)
    copies = make([row, row, ("r2", *row[1:]), ("r3", *row[1:])])
    got = catalog.with_copies(make([row, row, ("r2", *row[1:8], "Invoice"), ("r4", *row[1:])]), copies)
    assert sorted((r.receipt_id, r.payment_method, r.is_copy) for r in got.collect()) == [
        ("r1", "Cash", True), ("r1", "Cash", True), ("r2", "Invoice", False), ("r4", "Cash", False)
    ]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 0


def test_drop_fraud(spark):
    tx = spark.createDataFrame([sale("a", 1.0, i, f"r{i % 4}") for i in range(400)] + [("a", 1.0, None, None)], SALE)
    marks = spark.createDataFrame([("r1",), ("r1",), ("unknown",), (None,)], "receipt_id string")
    for hot in (None, profile(tx, "receipt_id", chunks=20)):
        assert hot is None or hot.chunks
        kept = quality.drop_fraud(tx, marks, hot).groupBy("receipt_id").count().collect()
        assert {r[0]: r[1] for r in kept} == {"r0": 100, "r2": 100, "r3": 100, None: 1}


def test_reports(spark):
    rows = [sale("a", 1.5, 0), sale("a", 2.5, 86400 * 40), sale("a", 4.0, 86400 * 40 + 1), sale("b", 1.0, 3600)]
    tx = spark.createDataFrame(rows, SALE)
    months = reports.monthly_spend(tx).orderBy("customer_id", "y", "m").collect()
    assert [tuple(r) for r in months] == [("a", 2024, 1, 1.5, 1), ("a", 2024, 2, 6.5, 2), ("b", 2024, 1, 1.0, 1)]
    assert [tuple(r) for r in reports.peak_periods(tx).orderBy("rk", "h").collect()] == [(0, 3, 1), (1, 1, 2)]


def test_observed(spark):
    df, observation = observed(spark.range(10), "counts", top=F.max("id"))
    df.write.format("noop").mode("overwrite").save()
    assert observation.get == {"rows": 10, "top": 9}


def test_work_folder_lies_in_the_shared_folder(spark):
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir"))


# The whole job


def topic(spark, record, values, start):
    rows = [(None, json.dumps(v) if isinstance(v, dict) else v, record.topic, i % 2, start + i, start + i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset bigint, at bigint")
    return df.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), "topic", "partition",
        "offset", F.timestamp_micros("at").alias("timestamp"),
    )


def receipt(i, customer):
    return {
        "customerId": customer, "productId": "pr-1", "productName": "blue kettle", "productPrice": 600.25,
        "productQuantity": 2, "totalAmount": 1200.5, "receiptId": f"r{i}", "receiptDate": f"2024-01-01T00:00:{i:02d}.000000",
        "paymentMethod": "Zelle",
    }


def person(name, version):
    return {"customerId": name, "name": f"{name} {version}", "email": f"{name}@example.org", "birthdate": "1990-01-01"}


@pytest.mark.parametrize("form", ["state_store", "batches"])
def test_whole_job(spark, tmp_path, form):
    """Two runs on the same checkpoints; the second goes on where the first stopped."""
    seen = []
    listener = ProgressListener(seen.append)
    spark.streams.addListener(listener)

    def write(values, start):
        for record in INPUTS:
            topic(spark, record, values[record.name], start).write.mode("append").parquet(f"{tmp_path}/{record.topic}")

    def run():
        job = Job(
            checkpoints=f"{tmp_path}/checkpoints",
            topics={r.name: kafka_files(spark, f"{tmp_path}/{r.topic}", r.topic) for r in INPUTS},
            enriched=table_sink.append_batch(f"{tmp_path}/enriched"),
            totals=lambda df: df.writeStream.outputMode("update").foreachBatch(table_sink.append_batch(f"{tmp_path}/totals")),
            tables={r.name: table_sink.upsert(r, f"{tmp_path}/tables/{r.table}") for r in TABLES},
            bad_messages=lambda df, table: df.writeStream.format("parquet").option("path", f"{tmp_path}/bad/{table}"),
            corrected=kept_reports.maintain(kept_reports.MONTHLY_SPEND, f"{tmp_path}/monthly"),
            enrich_form=form,
            salts=2,
            trigger={"availableNow": True},
        )
        queries = job.start()
        for query in queries.values():
            query.awaitTermination()
        return queries

    write(
        {
            TRANSACTION.name: [receipt(1, "ann"), receipt(2, "bob"), "{broken", receipt(3, "ann")],
            CUSTOMER.name: [person("ann", 1), "null"],
            FRAUD_MARK.name: [{"receiptId": "r2", "detectedTs": "2024-01-01T00:01:00.000000"}],
        },
        100,
    )
    queries = run()
    assert set(queries) == {
        "spend_per_window", "customer_transactions_topic", "Raw_Transactions", "Customer", "Fraud_Transactions",
        "bad_Raw_Transactions", "bad_Customer", "bad_Fraud_Transactions", "corrected_spend",
    }

    def monthly():
        rows = corrections.counted(kept_reports.read_report(spark, kept_reports.MONTHLY_SPEND, f"{tmp_path}/monthly"))
        return {r["customer_id"]: (r["n"], r["spend"]) for r in rows.collect()}

    assert monthly() == {"ann": (2, 2401.0)}
    enriched = spark.read.schema(CUSTOMER_TRANSACTION.schema).parquet(f"{tmp_path}/enriched")
    assert sorted(r.receipt_id for r in enriched.collect()) == ["r1", "r3"]
    write(
        {
            TRANSACTION.name: [receipt(4, "bob"), {**receipt(1, "ann"), "paymentMethod": "PayPal"}],
            CUSTOMER.name: [person("bob", 1), person("ann", 2)],
            FRAUD_MARK.name: [{"receiptId": r, "detectedTs": "2024-01-01T00:02:00.000000"} for r in ("r2", "r3")],
        },
        200,
    )
    run()
    spark.streams.removeListener(listener)
    # The first receipt came again and counts once; the mark of the third takes it back.
    assert monthly() == {"ann": (1, 1200.5), "bob": (1, 1200.5)}
    enriched = spark.read.schema(CUSTOMER_TRANSACTION.schema).parquet(f"{tmp_path}/enriched")
    assert sorted(r.receipt_id for r in enriched.collect()) == ["r1", "r1", "r2", "r3", "r4"]

    def stored(record):
        return {r[record.key]: r for r in table_sink.read_table(spark, f"{tmp_path}/tables/{record.table}", record).collect()}

    assert set(stored(TRANSACTION)) == {"r1", "r2", "r3", "r4"}
    assert stored(TRANSACTION)["r1"].payment_method == "PayPal"
    assert {k: v.name for k, v in stored(CUSTOMER).items()} == {"ann": "ann 2", "bob": "bob 1"}
    assert stored(FRAUD_MARK)["r2"].detected_ts.minute == 2
    kept = stored(CUSTOMER_TRANSACTION)
    assert set(kept) == {"r1", "r2", "r3", "r4"}
    # The new receipt and the new customer record have the same broker time: the record comes first.
    assert kept["r1"].payment_method == "PayPal" and kept["r1"].customer_name == "ann 2"
    letters = spark.read.parquet(f"{tmp_path}/bad/Raw_Transactions").collect()
    assert [(r.problem, r.raw) for r in letters] == [("not a JSON object", "{broken")]
    assert {row[0] for row in seen} >= {"spend_per_window", "Raw_Transactions"}


def test_console_and_kafka_writers(spark, tmp_path):
    spark.createDataFrame([sale("a", 1.0, 5)], SALE).write.parquet(f"{tmp_path}/in")
    totals = spend(spark.readStream.schema(SALE).parquet(f"{tmp_path}/in"))
    catch_up(console_sink(totals).queryName("shown"), f"{tmp_path}/c")
    with pytest.raises(PySparkException, match="(?i)kafka"):  # there is no connector here
        enriched = spark.createDataFrame([], CUSTOMER_TRANSACTION.schema)
        kafka_sink(enriched, "b:9092").save()


def test_bad_message_stops_the_job_without_dead_letters(spark, tmp_path):
    topic(spark, CUSTOMER, ["{broken"], 0).write.parquet(f"{tmp_path}/in")
    from receiptflow.sources.kafka import read_topic

    rows = read_topic(kafka_files(spark, f"{tmp_path}/in"), CUSTOMER)
    with pytest.raises(PySparkException):
        catch_up(rows.writeStream.foreachBatch(table_sink.upsert(CUSTOMER, f"{tmp_path}/out")), f"{tmp_path}/c")
