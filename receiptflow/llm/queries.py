"""The queries of this package over the test tables: each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from receiptflow.llm import bpe, decontam, lines, mixing, neardup, ngram, pii, quality, repeats, rules, toxicity, trie, whitening
from receiptflow.llm.text import table
from receiptflow.llm.training import held_out


def digest(text) -> F.Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def predictions(scores: DataFrame, threshold: float) -> DataFrame:
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op1_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents, also in disguise."""
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


def op2_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bradley-Terry scores of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return predictions(quality.score(docs, model), quality.AT_THRESHOLD)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by the string-kernel machine."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return predictions(toxicity.score(docs, machine), 0.5)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingles are similar to 0.75 or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = neardup.near_duplicates(docs)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op5_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes in strings of 100 bytes that have occurred before, cut from all documents."""
    rows = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots of all documents in a mix of sources by the roots of their sizes, in the fixed period of its SQL."""
    return mixing.slots(table(spark, sf_dir, "documents").select("doc_id", "source"), period=mixing.PERIOD)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents, dropped everywhere."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = lines.drop_common_lines(docs, min_docs=10)
    return rows.select("doc_id", "n_lines", "n_dropped", digest(F.col("text")).alias("kept_sha256"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules, and outliers of each language and source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return rules.judge(docs).drop("lang", "source")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of the benchmark in every document, by the positional index."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"), size=10)
    names = F.array_join("items", ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff scores of all documents by the bigram model of all documents."""
    return ngram.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each with the first turns of the first one of its twenty."""
    conv = F.col("conv_id")
    head = F.crc32(conv.cast("string").cast("binary")) % 4
    return trie.prefix_trie(table(spark, sf_dir, "conversations"), base=conv - conv % 20, head=head)


def op12_bpe_tokens(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """All documents as ids of a public vocabulary, and back."""
    import public_tokenizers

    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
    return bpe.decode(coded, path).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), digest(F.col("decoded")).alias("decoded_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened on their four leading components."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors)
    rows = whitening.transform(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(float(e)) for e in model.explained]) if len(model.explained) else F.lit(None).cast("array<double>")
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, "at").alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )


QUERIES = {
    "op1_pii_spans": op1_pii_spans,
    "op2_quality_ranking": op2_quality_ranking,
    "op3_toxicity": op3_toxicity,
    "op4_near_dedup": op4_near_dedup,
    "op5_repeated_strings": op5_repeated_strings,
    "op6_source_mix": op6_source_mix,
    "op7_line_dedup": op7_line_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_decontamination": op9_decontamination,
    "op10_lm_scores": op10_lm_scores,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_bpe_tokens": op12_bpe_tokens,
    "op13_embedding_whitening": op13_embedding_whitening,
}
