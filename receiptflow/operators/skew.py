"""Finding keys that hold a large share of the rows, and spreading them over many tasks.

``profile`` looks at a small sample, as Spark's own range partitioner does. What it finds only
decides where work runs: any profile, even a wrong one, gives the same results.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_PER_CHUNK = 20  # sampled rows that stand for one chunk


@dataclass(frozen=True)
class Profile:
    """The hot keys of a table: how many chunks each should be cut into, and where.

    The chunks of all hot keys together number at most ``4 x spark.sql.shuffle.partitions``, so
    everything kept here is bounded by the size of the cluster, not of the data.
    """

    key_type: T.DataType | None = None
    order_type: T.DataType | None = None
    chunks: dict = field(default_factory=dict)  # key -> number of chunks, two or more
    splits: dict = field(default_factory=dict)  # key -> ascending order values that start a chunk

    @property
    def empty(self) -> bool:
        return not self.chunks

    def salts(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([T.StructField("_hot", self.key_type), T.StructField("_salts", T.IntegerType())])
        return F.broadcast(spark.createDataFrame(list(self.chunks.items()), schema))

    def chunk_list(self, spark: SparkSession, key: str) -> DataFrame:
        """One row per chunk of each hot key."""
        rows = [(k, i) for k, splits in self.splits.items() for i in range(len(splits) + 1)]
        schema = T.StructType([T.StructField(key, self.key_type), T.StructField("_chunk", T.IntegerType())])
        return spark.createDataFrame(rows, schema)

    def cuts(self, spark: SparkSession) -> DataFrame:
        """One row per hot key for ``add_chunk``; the splits lie in equal-width bins of the order."""
        rows = []
        for key, splits in self.splits.items():
            leads = [_lead(s) for s in splits]
            low, bins = float(leads[0]), len(splits)
            width = max(float(leads[-1]) - low, 1.0)
            binned = [[] for _ in range(bins)]
            for split, lead in zip(splits, leads):
                binned[min(int((float(lead) - low) * bins / width), bins - 1)].append(split)
            before, total = [], 0
            for group in binned:
                before.append(total)
                total += len(group)
            rows.append((key, low, width, bins, before, binned))
        schema = T.StructType(
            [
                T.StructField("_hot", self.key_type),
                T.StructField("_low", T.DoubleType()),
                T.StructField("_width", T.DoubleType()),
                T.StructField("_bins", T.IntegerType()),
                T.StructField("_before", T.ArrayType(T.IntegerType())),
                T.StructField("_binned", T.ArrayType(T.ArrayType(self.order_type))),
            ]
        )
        return F.broadcast(spark.createDataFrame(rows, schema))


def _lead(order):
    return order[0] if isinstance(order, tuple) else order


def profile(
    df: DataFrame,
    key: str,
    order: str | None = None,
    chunks: int | None = None,
    seed: int = 11,
) -> Profile:
    """Find the hot keys of a batch.

    A key is hot when it holds at least two of ``chunks`` equal parts of all rows (default: four
    parts per shuffle partition). ``order`` is a BIGINT column, or a struct of BIGINTs; when given,
    the profile also holds the points that cut each hot key into even runs of that order. Only the
    shares of the keys count, not the size of the input.
    """
    if df.isStreaming:
        return Profile()
    spark = df.sparkSession
    chunks = chunks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = df.select(F.col(key).alias("k"), (F.col(order) if order else F.lit(0)).alias("o"))
    narrow = narrow.filter("k IS NOT NULL")
    rows = narrow.count()
    if rows == 0:
        return Profile()
    fraction = min(1.0, SAMPLE_PER_CHUNK * chunks / rows)
    per_chunk = rows * fraction / chunks
    # About SAMPLE_PER_CHUNK x chunks rows in all are grouped here, whatever the size of the input.
    hot = (
        narrow.sample(fraction, seed)
        .groupBy("k")
        .agg(F.count("*").alias("n"), F.sort_array(F.collect_list("o")).alias("o"))
        .filter(F.col("n") >= 2 * per_chunk)
        .filter("n >= 2")
    )
    counts, splits = {}, {}
    for row in hot.collect():  # at most one row per two chunks
        n = min(int(row.n / per_chunk), row.n)
        points = [row.o[i * row.n // n] for i in range(1, n)]
        counts[row.k] = n
        splits[row.k] = sorted(set(points))
    return Profile(narrow.schema["k"].dataType, narrow.schema["o"].dataType, counts, splits)


def add_chunk(df: DataFrame, key: str, order: str, hot: Profile) -> DataFrame:
    """Add ``_chunk``: 0 for ordinary keys, else the run of the order the row falls into.

    Within a key ``_chunk`` never falls as the order rises, so work that goes through a key in order
    can go through its chunks side by side and pass a one-row summary from each to the next.
    """
    if hot.empty:
        return df.withColumn("_chunk", F.lit(0))
    is_struct = isinstance(df.schema[order].dataType, T.StructType)
    lead = F.col(order).getField(df.schema[order].dataType.names[0]) if is_struct else F.col(order)
    # The same double arithmetic as in Profile.cuts. It never falls as the lead rises, so splits in
    # lower bins are below the row and those in higher bins above it; one short bin is compared.
    place = (lead.cast("double") - F.col("_low")) * F.col("_bins") / F.col("_width")
    bin_ = F.floor(F.least(F.greatest(place, F.lit(0.0)), (F.col("_bins") - 1).cast("double"))).cast("int")
    below = F.size(F.filter(F.get("_binned", bin_), lambda split: split <= F.col(order)))
    chunk = F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(F.get("_before", bin_) + below)
    cuts = hot.cuts(df.sparkSession)
    return df.join(cuts, df[key] == cuts["_hot"], "left").select(*df.columns, chunk.alias("_chunk"))


def join_unique(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", hot: Profile | None = None
) -> DataFrame:
    """Join to a side that has one row per key (``inner``, ``left`` or ``left_anti``).

    Spark broadcasts ``right`` if it is below its threshold, else both sides are shuffled, and adaptive
    execution splits what a hot key makes large. With a profile, rows of a hot key on the left are
    spread over that key's salts, and its single right row is copied to each.
    """
    if hot is None or hot.empty:
        return left.join(right, key, how)
    salts = hot.salts(left.sparkSession)
    # The task number spreads even rows that are copies of each other, and a rerun task keeps it.
    salt = F.pmod(F.spark_partition_id(), F.coalesce("_salts", F.lit(1)))
    spread = left.join(salts, left[key] == salts["_hot"], "left").select(*left.columns, salt.alias("_salt"))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    copied = right.join(salts, right[key] == salts["_hot"], "left").select(*right.columns, copies.alias("_salt"))
    return spread.join(copied, [key, "_salt"], how).drop("_salt")
