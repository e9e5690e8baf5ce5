"""Reports that are folded batch by batch, and windows that fire once."""

import os

from pyspark.sql import functions as F

from receiptflow.operators import reports as batch_reports
from receiptflow.operators.spend import TOTALS
from receiptflow.sinks import tables as table_sink
from receiptflow.streaming import reports
from receiptflow.streaming.replay import run_until
from receiptflow.streaming.spend import spend_fired

TX = "customer_id string, total_amount double, receipt_date timestamp"


def month(df):
    return sorted((tuple(r) for r in df.select("customer_id", "y", "m", "spend", "n").collect()), key=str)


def test_a_batch_writes_the_months_it_touches_only(spark, tmp_path):
    path, write = f"{tmp_path}/r", reports.maintain(reports.MONTHLY_SPEND, f"{tmp_path}/r")
    rows = spark.sql(f"""
        SELECT * FROM VALUES (0, 'a', 0.1D, TIMESTAMP '2024-01-05'), (0, 'b', 0.2D, TIMESTAMP '2024-02-05'), (1, 'a', 0.2D, TIMESTAMP '2024-01-31'),
            (1, 'c', CAST(NULL AS DOUBLE), TIMESTAMP '2024-01-01'), (2, NULL, 1D, NULL), (3, 'a', 5D, TIMESTAMP '2024-01-09') AS t(batch, {', '.join(c.split()[0] for c in TX.split(', '))})
    """)
    batch = lambda i: rows.where(F.col("batch") == i).drop("batch")
    february = None
    for i in range(4):
        write(batch(i), i)
        known = reports.folders(spark, path)
        february = february or known[202402]
        assert known[202402] == february, "an untouched month was written"
        # A batch that runs again changes nothing.
        before = month(reports.read_report(spark, reports.MONTHLY_SPEND, path))
        write(batch(i), i)
        assert month(reports.read_report(spark, reports.MONTHLY_SPEND, path)) == before
        assert before == month(batch_reports.monthly_spend(rows.where(F.col("batch") <= i)))
    assert len(known[202401]) == 2 and -1 in known, "folders that nothing needs are gone"
    write(batch(9), 4)  # no rows
    assert month(reports.read_report(spark, reports.MONTHLY_SPEND, path)) == before


def test_a_batch_without_success_is_not_read(spark, tmp_path):
    path, report = f"{tmp_path}/r", reports.peak_hours()
    assert reports.read_report(spark, report, path).count() == 0
    day = spark.sql("SELECT TIMESTAMP '2024-01-01 07:00:00' AS receipt_date UNION ALL SELECT NULL")
    reports.maintain(report, path)(day, 0)
    reports.maintain(report, path)(day, 1)
    assert sorted(map(tuple, reports.read_peak_hours(spark, path).collect()), key=str) == [(7, 2, 1), (None, 2, 1)]
    os.remove(f"{path}/batch=1/_SUCCESS")
    assert {r["n"] for r in reports.read_report(spark, report, path).collect()} == {1}


def test_windows_fire_once_by_time_alone(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0.1, None), ("a", 0.2, None), ("b", None, None), (None, 3.0, None)], TX)
    rows.write.parquet(f"{tmp_path}/in")
    out, schema = f"{tmp_path}/out", f"{TOTALS}, fired_at timestamp"
    fired = spend_fired(spark.readStream.schema(TX).parquet(f"{tmp_path}/in"), "1 second")
    result = lambda: table_sink.read_batches(spark, out, schema)
    run_until(fired.writeStream.foreachBatch(table_sink.append_batch(out)), f"{tmp_path}/c", lambda _: result().count() >= 3, 60)
    assert sorted(((r["customer_id"], r["total"], r["n"]) for r in result().collect()), key=str) == [("a", 0.3, 2), ("b", None, 1), (None, 3.0, 1)]
    assert result().where("fired_at < window_end").isEmpty()


def test_changes_of_no_batch(spark, tmp_path):
    assert table_sink.read_changes(spark, f"{tmp_path}/none", ["customer_id", "window_start"], TOTALS).count() == 0


def test_customers_share_timers_and_parts_of_a_window_add_up():
    """A bucket asks the state store as often for many customers as for one."""
    from decimal import Decimal

    import pandas as pd

    from receiptflow.streaming.spend import WindowTotals

    calls = []

    class MapState(dict):
        def getValue(self, key):
            calls.append(key)
            return self.get(key)

        def updateValue(self, key, value):
            calls.append(key)
            self[key] = value

        def removeKey(self, key):
            calls.append(key)
            del self[key]

    class Handle:
        timers = []

        def getMapState(self, *_):
            return MapState()

        def registerTimer(self, end):
            self.timers.append(end)

    class Times:
        getCurrentProcessingTimeInMs = staticmethod(lambda: 1500)
        getExpiryTimeInMs = staticmethod(lambda: 2000)

    totals, many = WindowTotals(1000), [str(i) for i in range(500)]
    totals.init(Handle())
    for amount in ("0.10000000", "0.20000000"):
        rows = pd.DataFrame({"customer_id": [*many, None], "amount": [*[Decimal(amount)] * 500, None]})
        assert list(totals.handleInputRows((0,), iter([rows.head(300), rows.tail(201)]), Times)) == []
    assert len(calls) == 6 and Handle.timers == [2000]
    (out,) = totals.handleExpiredTimer((0,), Times, Times)
    assert set(zip(out["customer_id"], out["total"], out["n"])) == {*((c, "0.30000000", 2) for c in many), (None, None, 2)}
    assert set(out["end_ms"]) == {2000} and not totals.open and not totals.parts
    assert list(totals.handleExpiredTimer((0,), Times, Times)) == []
