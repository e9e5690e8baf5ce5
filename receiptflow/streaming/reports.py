"""Reports that are kept up to date: each micro-batch folds its partial sums into the parts it touches.

A part is a slice of the report (a month, an hour of the day); ``streaming.parts`` says how parts are kept. A batch that
runs again starts from the folders of earlier batches only, so nothing counts twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from receiptflow.operators.reports import ranked
from receiptflow.streaming.parts import drop, folders


@dataclass(frozen=True)
class Report:
    """``keys`` with the type of each, ``sums`` likewise, and the whole number that names a row's part.

    ``partial`` gives the keys and sums of some rows. A report's parts must be few: their names reach the driver.
    """

    keys: dict[str, str]
    sums: dict[str, str]
    part: Callable[[], Column]
    partial: Callable[[DataFrame], DataFrame]

    @property
    def schema(self) -> str:
        return ", ".join(f"{name} {kind}" for name, kind in (self.keys | self.sums).items())

    def added(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[F.sum(s).cast(kind).alias(s) for s, kind in self.sums.items()])


def _months(tx: DataFrame) -> DataFrame:
    # Signed changes (``streaming.corrections``) may take rows back.
    sign = F.col("sign") if "sign" in tx.columns else F.lit(1)
    amount = F.sum(sign * F.col("total_amount").cast("decimal(28,8)")).cast("decimal(38,8)")
    keys = ["customer_id", F.year("receipt_date").alias("y"), F.month("receipt_date").alias("m")]
    return tx.groupBy(*keys).agg(amount.alias("spend"), F.sum(sign).cast("bigint").alias("n"))


def _hours(at: str) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: rows.groupBy(F.hour(at).alias("h")).agg(F.count("*").alias("n"))


#: ``operators.reports.monthly_spend``, by month; rows without a date are part -1.
MONTHLY_SPEND = Report(
    {"customer_id": "string", "y": "int", "m": "int"}, {"spend": "decimal(38,8)", "n": "bigint"},
    lambda: F.coalesce(F.col("y") * 100 + F.col("m"), F.lit(-1)), _months,
)


def peak_hours(at: str = "receipt_date") -> Report:
    """The counts of ``operators.reports.peak_periods``."""
    return Report({"h": "int"}, {"n": "bigint"}, lambda: F.coalesce("h", F.lit(-1)), _hours(at))


def _read(spark: SparkSession, report: Report, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], report.schema)
    return spark.read.schema(report.schema).parquet(*paths)


def maintain(report: Report, path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that folds each batch into the report under ``path``.

    A part's folder is deleted once two later batches have written that part.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = report.partial(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = [r[0] for r in fresh.select(report.part()).distinct().collect()]
            known = folders(spark, path, before=batch_id)
            old = _read(spark, report, [known[p][-1] for p in touched if p in known])
            whole = report.added(fresh.select(*report.keys, *report.sums).unionByName(old))
            whole.withColumn("part", report.part()).write.mode("overwrite").partitionBy("part").parquet(f"{path}/batch={batch_id}")
            for part in touched:
                for folder in known.get(part, [])[:-1]:
                    drop(spark, folder)
        finally:
            fresh.unpersist()

    return write


def read_report(spark: SparkSession, report: Report, path: str) -> DataFrame:
    """The report as it stands; decimal sums as doubles."""
    rows = _read(spark, report, [paths[-1] for paths in folders(spark, path).values()])
    return rows.select(*report.keys, *[F.col(s).cast("double").alias(s) if kind.startswith("decimal") else F.col(s) for s, kind in report.sums.items()])


def read_peak_hours(spark: SparkSession, path: str) -> DataFrame:
    """Columns: h, n, rk."""
    return ranked(read_report(spark, peak_hours(), path))
