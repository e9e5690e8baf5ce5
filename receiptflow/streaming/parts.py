"""Tables in parts: a micro-batch reads and writes anew the parts that it touches, and leaves the others alone.

A batch that touches a part writes it into its own folder, ``batch=<id>/part=<part>``, from the part as the batches
before have left it. The table is the newest folder of each part, of batches that are complete (Spark writes
``_SUCCESS`` last). A batch that runs again starts from the folders of earlier batches only. Parts are whole numbers;
their names reach the driver, so they must be few: a period of time, or a hash bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def paths(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def number_in(path: str, name: str) -> int:
    return int(path.split(f"/{name}=", 1)[1].split("/", 1)[0])


def drop(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folders(spark: SparkSession, path: str, before: int | None = None) -> dict[int, list[str]]:
    """The folders of each part, oldest first, of complete batches (``before`` a batch)."""
    done = {number_in(p, "batch") for p in paths(spark, f"{path}/batch=*/_SUCCESS")}
    parts: dict[int, list[str]] = {}
    for folder in sorted(paths(spark, f"{path}/batch=*/part=*"), key=lambda p: number_in(p, "batch")):
        if number_in(folder, "batch") in done and (before is None or number_in(folder, "batch") < before):
            parts.setdefault(number_in(folder, "part"), []).append(folder)
    return parts


def bucket(key: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


class State:
    """A table of rows like those of a micro-batch, in hash buckets of ``key``, as that batch sees it."""

    def __init__(self, batch: DataFrame, batch_id: int, path: str, key: str, buckets: int):
        self.spark, self.batch_id, self.path, self.key, self.schema, self.buckets = batch.sparkSession, batch_id, path, key, batch.schema, buckets
        self.touched = [r[0] for r in batch.select(bucket(key, buckets)).distinct().collect()]
        self.known = folders(self.spark, path, before=batch_id)

    def before(self) -> DataFrame:
        """What the batches before have left in the buckets that this one touches."""
        found = [self.known[part][-1] for part in self.touched if part in self.known]
        if not found:
            return self.spark.createDataFrame([], self.schema)
        schema = T.StructType([*self.schema.fields, T.StructField("_held", T.BooleanType())])
        return self.spark.read.schema(schema).parquet(*found).where("_held").drop("_held")

    def write(self, rows: DataFrame) -> None:
        """Leave ``rows`` in the touched buckets. A bucket that has none left is written as well, as one empty row.

        A bucket's folder is deleted once two later batches have written that bucket.
        """
        empty = self.spark.createDataFrame([(part, False) for part in self.touched], "part int, _held boolean")
        held = rows.withColumns({"part": bucket(self.key, self.buckets), "_held": F.lit(True)})
        # Adaptive execution cuts a bucket that is too large for one task.
        whole = held.unionByName(empty, allowMissingColumns=True).hint("rebalance", "part")
        whole.write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/batch={self.batch_id}")
        for part in self.touched:
            for folder in self.known.get(part, [])[:-1]:
                drop(self.spark, folder)
