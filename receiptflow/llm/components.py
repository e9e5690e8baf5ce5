"""Connected components of an undirected graph of long ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from receiptflow.session import work_folder


def keep(rows: DataFrame, path: str, compression: str = "snappy") -> DataFrame:
    """Write ``rows`` to the shared folder and read them back: a plan without their past."""
    rows.write.parquet(path, compression=compression)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def pointed(edges: DataFrame) -> DataFrame:
    """One large star, then one small star: edges (a, b) with a > b, closer to stars around least nodes."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
    return small.select("e.a", "e.b").where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; a component is named by its least node.

    ``edges`` has the long columns a and b; loops and repeated edges do no harm. Neighbourhoods are only
    ever aggregated or joined, never gathered, so a node may have any number of edges.
    """
    folder = work_folder(edges.sparkSession, "components")
    now = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{folder}/0")
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before, step = mark(now), 0
    while before[0]:
        step += 1
        now = keep(pointed(now), f"{folder}/{step}")
        after = mark(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
