"""Quality rules: counts per document, and robust outliers among documents of a kind.

Documents of one language and source form a group. Its minimum-covariance-determinant estimate is the
mean and covariance of those 75 % of its documents whose covariance is smallest: from medians and
median deviations, concentration steps take the closest share, estimate again, and so on. Every step is
a grouped aggregate over all documents, so a group may hold any share of them. A document is
rejected if its vector of transformed statistics is too far from its group by Mahalanobis distance.

Groups under ``MIN_GROUP`` documents are estimated together with the other small groups of their language.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.llm.components import keep
from receiptflow.llm.text import SPACE, Hashes, arrow, bounded, flat, joined, mix, pieces, plus, starts, windows
from receiptflow.session import work_folder

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
#: The transformed statistics: mean word length, and shares of symbols, of words equal to the word
#: before, of capitals and of punctuation.
FEATURES = 5
STATS = f"{COUNTS}, x array<double>"
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = bytes(i for i in range(33, 127) if not chr(i).isalnum())
CAPITALS = bytes(range(65, 91))
CONTINUED = bytes(range(0x80, 0xC0))
#: Share of a group that an estimate is made from, and steps.
CORE, STEPS, MIN_GROUP = 0.75, 4, 50
#: Least variance of each statistic within a group, so that constant ones give no singular estimate.
FLOOR = 0.04**2
#: The angle of a share over n words has this variance over n by chance.
NOISE = 0.25
#: Documents beyond this squared distance are rejected.
CUTOFF = 25.0


def repeated_words(texts: list[list[bytes]], hashes: Hashes) -> np.ndarray:
    """For each text, how many words lie in windows of 8 words that it holds twice or more.

    Windows are compared by 64-bit hashes.
    """
    words = [hashes.of(w) for w in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    if not sizes.sum():
        return np.zeros(len(texts), np.int64)
    begin = starts(sizes)
    count = np.maximum(0, sizes - WINDOW + 1)
    runs = windows(joined(words), WINDOW)
    at = flat(begin[:-1], count)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), count)
    key = mix(runs[at] ^ mix(owner + np.uint64(1)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(begin[-1] + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    return inside[begin[1:]] - inside[begin[:-1]]


def share(part: float, whole: float) -> float:
    """An angle for a share, with variance about 1 / (4 whole) at any share."""
    return float(np.arcsin(np.sqrt(min(1.0, part / whole)))) if whole else 0.0


def measure(schema: T.StructType):
    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for rows, texts in pieces(batches):
            words = [t.split() for t in texts]
            repeats = repeated_words(words, hashes).tolist()
            out: dict[str, list] = {name.split()[0]: [] for name in STATS.split(", ")}
            for text, own, n_repeat in zip(texts, words, repeats, strict=True):
                n = len(own)
                chars = len(text.translate(None, SPACE + CONTINUED))
                symbols = len(text) - len(text.translate(None, SYMBOLS))
                marks = len(text) - len(text.translate(None, PUNCTUATION))
                capitals = len(text) - len(text.translate(None, CAPITALS))
                lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
                dup = len(lines) - len(set(lines))
                failed = n < 20 or 100 * n_repeat > 30 * n
                x = [np.log(chars / n) if n else 0.0, share(symbols, chars), share(sum(map(eq, own, own[1:])), n), share(capitals, chars), share(marks, chars)]
                for name, value in zip(out, (n, chars, symbols, dup, n_repeat, failed, x), strict=True):
                    out[name].append(value)
            named = {f.name: rows.column(f.name) for f in schema.fields if f.name in rows.schema.names}
            yield arrow(named | out, schema)

    return stats


def document_stats(docs: DataFrame) -> DataFrame:
    """``docs`` and the counts and statistics of each row; columns of these names are replaced."""
    schema = plus(docs.schema, STATS)
    return bounded(docs).mapInArrow(measure(schema), schema)


def distances(x: np.ndarray, n: np.ndarray, mean: np.ndarray, cov: np.ndarray, noise: float) -> np.ndarray:
    """Squared Mahalanobis distances, the covariance widened by the chance variance of short texts."""
    wide = cov + (noise / np.maximum(n, 1))[:, None, None] * np.eye(FEATURES)
    d = x - mean
    return np.einsum("ni,ni->n", d, np.linalg.solve(wide, d[:, :, None])[:, :, 0])


def matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False)).reshape(len(column), -1)


def measure_distance(schema: T.StructType, noise: float):
    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            cov = matrix(rows.column("_cov")).reshape(-1, FEATURES, FEATURES)
            d2 = distances(matrix(rows.column("x")), rows.column("n_words").to_numpy(), matrix(rows.column("_mean")), cov, noise)
            named = {f.name: rows.column(f.name) for f in schema.fields if f.name in rows.schema.names}
            yield arrow(named | {"distance": d2}, schema)

    return far


def with_distance(stats: DataFrame, estimates: DataFrame, noise: float = NOISE) -> DataFrame:
    """``stats`` (with ``_group``) and each row's distance from its group; 0 for groups without an estimate."""
    default = F.array(*[F.lit(0.0)] * FEATURES), F.array(*[F.lit(1e9 if i % (FEATURES + 1) == 0 else 0.0) for i in range(FEATURES**2)])
    rows = stats.join(estimates.select("_group", "_mean", "_cov"), "_group", "left")
    rows = rows.withColumns({"_mean": F.coalesce("_mean", default[0]), "_cov": F.coalesce("_cov", default[1])})
    schema = plus(stats.schema, "distance double")
    return rows.mapInArrow(measure_distance(schema, noise), schema)


def own_group() -> Column:
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))
    return F.concat_ws("\n", name("lang"), name("source"))


def group_sizes(stats: DataFrame) -> DataFrame:
    """(_own, _size): how many documents of each language and source pass the base rules."""
    return stats.where(~F.col("base_failed")).groupBy(own_group().alias("_own")).agg(F.count("*").alias("_size"))


def grouped(stats: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds ``_group``, a text that names language and source, or the small groups of a language."""
    rows = stats.withColumn("_own", own_group()).join(sizes, "_own", "left")
    small = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))
    return rows.withColumn("_group", F.when(F.col("_size") >= MIN_GROUP, F.col("_own")).otherwise(small)).drop("_own", "_size")


def moments(rows: DataFrame) -> DataFrame:
    """Mean and covariance of ``x`` in each group, variances at least ``FLOOR``."""
    x = [F.col("x")[i] for i in range(FEATURES)]
    sums = [F.avg(x[i]).alias(f"m{i}") for i in range(FEATURES)]
    sums += [F.covar_pop(x[min(i, j)], x[max(i, j)]).alias(f"c{i}_{j}") for i in range(FEATURES) for j in range(i, FEATURES)]
    cell = lambda i, j: F.col(f"c{min(i, j)}_{max(i, j)}") + F.lit(FLOOR if i == j else 0.0)
    return rows.groupBy("_group").agg(*sums).select(
        "_group",
        F.array(*[F.col(f"m{i}") for i in range(FEATURES)]).alias("_mean"),
        F.array(*[cell(i, j) for i in range(FEATURES) for j in range(FEATURES)]).alias("_cov"),
    )


def first_estimate(rows: DataFrame) -> DataFrame:
    """Medians, and squared median deviations on the diagonal."""
    x = [F.col("x")[i] for i in range(FEATURES)]
    quart = rows.groupBy("_group").agg(*[F.percentile_approx(x[i], F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i in range(FEATURES)])
    spread = lambda i: F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) + F.lit(FLOOR)
    return quart.select(
        "_group",
        F.array(*[F.col(f"q{i}")[1] for i in range(FEATURES)]).alias("_mean"),
        F.array(*[spread(i) if i == j else F.lit(0.0) for i in range(FEATURES) for j in range(FEATURES)]).alias("_cov"),
    )


def estimates(stats: DataFrame, steps: int = STEPS, core: float = CORE) -> DataFrame:
    """The estimate of each group (``_group``, ``_mean``, ``_cov``) from ``grouped`` rows that pass the base rules.

    Each step's few numbers per group are written to the shared work folder, which keeps plans short.
    """
    spark, folder = stats.sparkSession, work_folder(stats.sparkSession, "mcd")
    rows = stats.where(~F.col("base_failed")).select("_group", "x", "n_words")
    now = first_estimate(rows)
    for step in range(steps + 1):
        now.write.parquet(f"{folder}/{step}")
        now = spark.read.schema("_group string, _mean array<double>, _cov array<double>").parquet(f"{folder}/{step}")
        if step == steps:
            return now
        far = with_distance(rows, now)
        limit = far.groupBy("_group").agg(F.percentile_approx("distance", core).alias("_limit"))
        now = moments(far.join(limit, "_group").where(F.col("distance") <= F.col("_limit")))


def fitted(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The statistics of ``docs`` without their texts, the sizes of the groups and their estimates, all written."""
    spark, folder = docs.sparkSession, work_folder(docs.sparkSession, "stats")
    stats = keep(document_stats(docs).drop("text"), f"{folder}/stats")
    sizes = keep(group_sizes(stats), f"{folder}/sizes")
    return stats, sizes, estimates(grouped(stats, sizes))


def with_kinds(docs: DataFrame) -> DataFrame:
    for c in ("lang", "source"):
        docs = docs if c in docs.columns else docs.withColumn(c, F.lit(None).cast("string"))
    return docs


def verdicts(stats: DataFrame, sizes: DataFrame, found: DataFrame, cutoff: float) -> DataFrame:
    far = with_distance(grouped(stats, sizes), found)
    return far.withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= cutoff)).drop("_group", "x")


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """One row per row of ``docs`` (any columns but ``text`` stay): its counts, ``distance`` and ``kept``.

    ``kept`` is false for texts that fail the base rules (under 20 words, or over 30 % of the words in
    repeated windows; a null text has no words) and for outliers of their group. Null languages and
    sources form groups of their own; missing columns lang and source count as null. Columns with
    the names of results are replaced.
    """
    stats, sizes, found = fitted(with_kinds(docs))
    return verdicts(stats, sizes, found, cutoff)


def passing(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    Statistics are taken twice, for the estimates and here, instead of joining verdicts to texts.
    """
    rows = with_kinds(docs)
    _, sizes, found = fitted(rows.select("text", "lang", "source"))
    whole = rows.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"), "text", "lang", "source")
    return verdicts(document_stats(whole), sizes, found, cutoff).where("kept").select("_doc.*")
