"""A corpus from raw documents: each stage works on what the one before has kept.

A stage is a function of (spark, docs, sf_dir), its result is written and read again as the next one's
documents. All stages but the last return the columns of ``documents``; the last adds each
document's place in the mix. Null texts are no words and one empty line; rows are documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from receiptflow.llm import decontam, lines, mixing, neardup, rules
from receiptflow.llm.components import keep
from receiptflow.llm.text import table
from receiptflow.session import work_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers of their language and source go."""
    return rules.passing(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten or more documents go from all of them; ``n_chars`` follows the text."""
    whole = docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", "text")
    rows = lines.drop_common_lines(whole)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicate documents the one with the least id stays."""
    return neardup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix, with ``slot`` and ``in_mix``."""
    return mixing.mixed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("source mix", source_mix),
]
#: The robust outliers of the first stage can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), work_folder(spark, "corpus")
    for number, (_, stage) in enumerate(STAGES):
        docs = keep(stage(spark, docs, sf_dir), f"{folder}/{number}")
    return docs
