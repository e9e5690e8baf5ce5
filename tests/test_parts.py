"""State in buckets, rows set aside as late, and signed corrections, batch by batch and with batches that run again."""

import datetime as dt
import os

from pyspark.sql import functions as F

from receiptflow.operators.enrich import interleave
from receiptflow.streaming import batches, corrections, late, reports
from receiptflow.streaming.parts import State, bucket, folders

ROW = "customer_id string, total_amount double, receipt_date timestamp"
TX = "receipt_id string, arrival bigint, customer_id string, total_amount double, receipt_date timestamp"


def at(second):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=second)


def files(path):
    return {os.path.join(where, f) for where, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_an_untouched_bucket_keeps_its_files(spark, tmp_path):
    path, make = f"{tmp_path}/s", lambda rows: spark.createDataFrame(rows, "k string, v int")
    first = make([(str(i), i) for i in range(40)])
    State(first, 0, path, "k", 4).write(first)
    before = folders(spark, path)
    assert len(before) == 4
    batch = make([("7", 70)])
    touched = batch.select(bucket("k", 4)).first()[0]
    untouched = {f for part, paths in before.items() if part != touched for f in files(paths[-1].removeprefix("file:"))}
    for _ in range(2):  # a batch that runs again finds what it found before
        state = State(batch, 1, path, "k", 4)
        assert state.touched == [touched]
        old = state.before()
        expected = first.where(bucket("k", 4) == touched)
        assert sorted(map(tuple, old.collect())) == sorted(map(tuple, expected.collect()))
        state.write(batch)
    after = folders(spark, path)
    assert {p for p in after if len(after[p]) > 1} == {touched}
    assert files(path) >= untouched
    # Nothing left in a bucket is a state, too.
    State(batch, 2, path, "k", 4).write(batch.limit(0))
    assert State(batch, 3, path, "k", 4).before().isEmpty()
    assert len(folders(spark, path)[touched]) == 2, "folders that nothing needs are gone"


def test_enrichment_reads_the_buckets_of_its_customers(spark, tmp_path):
    """A batch of one customer leaves the states of others, and their waiting transactions, where they are."""
    tx = spark.sql("""
        SELECT concat('r', id) AS receipt_id, IF(id < 30, concat('c', id), 'c0') AS customer_id, 'p' AS product_id, 'n' AS product_name, 1D AS product_price,
            1 AS product_quantity, 1D AS total_amount, TIMESTAMP '2024-01-01' AS receipt_date, 'Cash' AS payment_method, id AS arrival FROM range(32)
    """)
    customers = spark.sql("SELECT concat('c', id % 30) AS customer_id, 'n' AS name, 'e' AS email, 'b' AS birthdate, 100 + id AS arrival FROM range(30)")
    for mode in ("asof", "pair_buffer"):
        log, path, out = interleave(tx, customers), f"{tmp_path}/{mode}", []
        step = {"asof": batches._asof_step, "pair_buffer": batches._pair_buffer_step}[mode]

        def run(rows, batch_id, step=step, path=path, out=out):
            state = State(rows, batch_id, path, "customer_id", 8)
            step(rows, state.before(), lambda r: out.extend(r.select("receipt_id").collect()), state.write)
            return state.touched

        assert len(run(log.where("arrival < 31"), 0)) == 8 and not out
        assert len(run(log.where("customer_id = 'c0' AND arrival >= 31"), 1)) == 1
        assert {r[0] for r in out} >= {"r31"}
        run(log.where("customer_id <> 'c0' AND arrival >= 100"), 2)
        assert {r[0] for r in out} >= {f"r{i}" for i in range(1, 30)}
        assert len(out) == len({r[0] for r in out})


def test_late_rows_are_set_aside_and_added_back(spark, tmp_path):
    slices = [[("a", 1.0, at(5)), ("b", 0.5, None)], [("a", 2.0, at(3605))], [("a", 4.0, at(6)), ("a", None, at(7)), ("a", 8.0, at(3606))], []]
    path, write = f"{tmp_path}/l", late.keep_late(f"{tmp_path}/l")
    for i, rows in enumerate(slices):
        for _ in range(2):
            write(spark.createDataFrame(rows, ROW), i)
    rows = lambda df: sorted((r["customer_id"], r["window_start"].second + r["window_start"].minute * 60, *r[2:]) for r in df.collect())
    assert [r["n"] for r in late.read_windows(spark, path).orderBy("window_start").collect()] == [1, 2]
    assert sorted(map(str, late.read_late(spark, path, ROW).select("total_amount").toPandas()["total_amount"])) == ["0.5", "4.0", "nan"]
    assert [r[2:] for r in rows(late.added_back(spark, path, ROW))] == [(5.0, 3, 2), (10.0, 2, 0)]


def test_a_delay_keeps_windows_open(spark, tmp_path):
    write = late.keep_late(f"{tmp_path}/l", delay="2 hours")
    for i, second in enumerate([5, 3605, 6]):
        write(spark.createDataFrame([("a", 1.0, at(second))], ROW), i)
    assert late.read_late(spark, f"{tmp_path}/l", ROW).isEmpty()
    assert late.read_windows(spark, f"{tmp_path}/l").agg(F.sum("n")).first()[0] == 3


def test_late_marks_and_newer_copies_correct_the_sums(spark, tmp_path):
    """Against sums over all that has come so far, with marks before, with and after their receipts."""
    script = [
        ([("r1", 1, "a", 1.0), ("r2", 1, "a", 2.0), ("r3", 1, "b", 4.0), (None, 1, "b", 9.0)], ["r9"]),
        ([("r1", 2, "b", 0.1), ("r9", 1, "a", 8.0), ("r4", 1, "c", 16.0)], ["r2", "r2", "r4"]),
        ([("r1", 1, "a", 1.0), ("r2", 5, "a", 32.0), ("r3", 1, "b", 4.0)], [None]),
        ([], ["r1"]),
        ([("r5", 1, None, None)], []),
    ]
    report, newest, marked = reports.MONTHLY_SPEND, {}, set()
    write = corrections.correct(reports.maintain(report, f"{tmp_path}/out"), f"{tmp_path}/receipts", buckets=3)
    for i, (rows, marks) in enumerate(script):
        tx = spark.createDataFrame([(*r, at(0)) for r in rows], TX)
        log = corrections.interleaved(tx, spark.createDataFrame([(m,) for m in marks], "receipt_id string"))
        for _ in range(2):
            write(log, i)
        for receipt, arrival, customer, amount in rows:
            if receipt and arrival >= newest.get(receipt, (0,))[0]:
                newest[receipt] = (arrival, customer, amount)
        marked |= set(marks)
        sums = {}
        for receipt, (_, customer, amount) in newest.items():
            if receipt not in marked:
                n, total = sums.get(customer, (0, None))
                sums[customer] = (n + 1, total if amount is None else (total or 0) + amount)
        found = corrections.counted(reports.read_report(spark, report, f"{tmp_path}/out"))
        assert {r["customer_id"]: (r["n"], r["spend"]) for r in found.collect()} == sums
