"""Labelled rows for the classifiers: a bounded sample of the training part of ``labels``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many labelled rows are learned from, those least by a hash of their doc_id.
SAMPLE = 8000


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the documents whose labels are never learned from (a null id is one)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, text, label) of at most ``sample`` training documents.

    Rows without an id or a label are left out; of repeated labels for a document the greatest counts,
    of repeated documents one.
    """
    rows = labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # The limit bounds what is broadcast: so many ids and labels.
    return docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id").dropDuplicates(["doc_id"])
