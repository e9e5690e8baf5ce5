"""Lines that many documents share, found with levelled sorted runs of line hashes.

Documents come in batches. A batch's line hashes are merge-anti-joined with the runs of settled keys
(lines already known to be common), and what is left becomes a new sorted run of counts. When
``fanout`` runs of a level have gathered they are compacted: equal hashes are added up, those that
have reached the threshold move to a settled run, the others form one run of the next level.

A line's key is the line without white space (x20, x09-x0D) at both ends and with A-Z lower-cased; it is
known by a 128-bit hash. Empty keys are never common. A row is a document: a repeated row counts again.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.llm.text import SPACE, arrow, bounded, pieces, plus, row_key, schema_of
from receiptflow.session import work_folder

COUNTS = schema_of("batch int, line binary, n long")
PLACES = schema_of("_k1 long, _k2 long, line binary")


def line_keys(text: bytes) -> list[bytes]:
    """The hash of each line's key; empty for an empty key."""
    keys = (line.strip(SPACE).lower() for line in text.split(b"\n"))
    return [xxhash.xxh3_128_digest(key) if key else b"" for key in keys]


def count_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in pieces(batches):
        counts: Counter = Counter()
        for number, text in zip(rows.column("batch").to_pylist(), texts, strict=True):
            counts.update((number, key) for key in set(line_keys(text)) if key)
        yield arrow({"batch": [b for b, _ in counts], "line": [k for _, k in counts], "n": list(counts.values())}, COUNTS)


def place_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in pieces(batches):
        k1, k2 = rows.column("_k1").to_pylist(), rows.column("_k2").to_pylist()
        found = [(i, key) for i, text in enumerate(texts) for key in set(line_keys(text)) if key]
        yield arrow({"_k1": [k1[i] for i, _ in found], "_k2": [k2[i] for i, _ in found], "line": [k for _, k in found]}, PLACES)


class Runs:
    """Runs of line counts by level, and runs of settled lines, as sorted Parquet folders."""

    def __init__(self, spark, min_docs: int, fanout: int):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.folder, self.written = work_folder(spark, "line-runs"), 0
        self.levels: list[list[str]] = [[]]
        self.settled: list[str] = []

    def path(self) -> str:
        self.written += 1
        return f"{self.folder}/run{self.written:06d}"

    def read(self, path: str) -> DataFrame:
        return self.spark.read.schema("line binary, n long").parquet(path)

    def fresh(self, counts: DataFrame) -> DataFrame:
        """Without the lines that are settled."""
        return reduce(lambda left, run: left.join(self.read(run).hint("merge"), "line", "left_anti"), self.settled, counts)

    def add(self, counts: DataFrame) -> None:
        """Add a batch's own run, then compact every level that is full."""
        path = self.path()
        self.fresh(counts.groupBy("line").agg(F.sum("n").alias("n"))).sortWithinPartitions("line").write.parquet(path)
        self.levels[0].append(path)
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                self.compact(level)

    def compact(self, level: int) -> None:
        path = self.path()
        rows = reduce(DataFrame.unionByName, map(self.read, self.levels[level]))
        merged = self.fresh(rows.groupBy("line").agg(F.sum("n").alias("n")))
        merged = merged.withColumn("settled", F.col("n") >= self.min_docs).sortWithinPartitions("settled", "line")
        merged.write.partitionBy("settled").parquet(path)
        written = self.spark.read.schema("line binary, n long, settled boolean").parquet(path)
        kinds = {r[0] for r in written.select("settled").distinct().collect()}
        if True in kinds:
            self.settled.append(f"{path}/settled=true")
        self.levels[level] = []
        if len(self.levels) == level + 1:
            self.levels.append([])
        if False in kinds:
            self.levels[level + 1].append(f"{path}/settled=false")

    def common(self) -> DataFrame:
        """All settled lines, after a last compaction of what is left."""
        self.levels = [[run for level in self.levels for run in level]]
        if self.levels[0]:
            self.compact(0)
        if not self.settled:
            return self.spark.createDataFrame([], "line binary")
        return reduce(DataFrame.unionByName, map(self.read, self.settled)).select("line")


def common_lines(docs: DataFrame, min_docs: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """The hashes of the lines found in at least ``min_docs`` documents."""
    spark = docs.sparkSession
    runs = Runs(spark, min_docs, fanout)
    counts = f"{runs.folder}/batches"
    number = F.pmod(F.monotonically_increasing_id(), F.lit(batches)).cast("int")
    bounded(docs).select(number.alias("batch"), "text").mapInArrow(count_lines, COUNTS).write.partitionBy("batch").parquet(counts)
    rows = spark.read.schema("line binary, n long, batch int").parquet(counts)
    for batch in range(batches):
        runs.add(rows.where(F.col("batch") == batch).select("line", "n"))
    return runs.common()


def without(schema: T.StructType):
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in pieces(batches):
            valid = rows.column("text").is_valid().to_pylist()
            out, totals, drops = [], [], []
            for text, common in zip(texts, rows.column("_common").to_pylist(), strict=True):
                lines = text.split(b"\n")
                totals.append(len(lines))
                if common:
                    gone = set(common)
                    lines = [line for line, key in zip(lines, line_keys(text), strict=True) if key not in gone]
                    text = b"\n".join(lines)
                drops.append(totals[-1] - len(lines))
                out.append(text)
            named = {f.name: rows.column(f.name) for f in schema.fields if f.name in rows.schema.names}
            kept = pa.array([t if ok else None for t, ok in zip(out, valid, strict=True)], pa.binary())
            yield arrow(named | {"text": kept, "n_lines": totals, "n_dropped": drops}, schema)

    return rewrite


def drop_common_lines(docs: DataFrame, min_docs: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with all common lines gone from ``text``; adds ``n_lines`` (before) and ``n_dropped``.

    Every other column stays; columns of these two names are replaced. A null text has one empty line
    and stays null; a text whose lines are all common becomes empty. Repeated rows are treated alike.
    An empty table gives an empty table. Common lines meet their documents in a join that adaptive
    execution can split where one line occurs in very many documents.
    """
    common = common_lines(docs, min_docs, batches, fanout)
    names = docs.columns
    identity = [c for c in ("doc_id", "text") if c in names]
    placed = docs.select(*row_key(*identity), "text").mapInArrow(place_lines, PLACES)
    gone = placed.join(common, "line").groupBy("_k1", "_k2").agg(F.collect_set("line").alias("_common"))
    rows = docs.select("*", *row_key(*identity)).join(gone, ["_k1", "_k2"], "left").drop("_k1", "_k2")
    schema = plus(docs.schema, "n_lines long, n_dropped long")
    return rows.mapInArrow(without(schema), schema)
