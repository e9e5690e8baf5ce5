"""Helpers that several operators share: Arrow batches of texts, words and their hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What ``bytes.split`` and ``bytes.strip`` take as white space: x20 and x09 to x0D.
SPACE = b" \t\n\x0b\x0c\r"
PIECE = 1 << 20


def bounded(docs: DataFrame) -> DataFrame:
    """``docs``, after its session was told to send texts to Python in batches of bounded size."""
    conf = docs.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return docs


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = PIECE) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows with about ``size`` bytes of text, and the texts as UTF-8 (null: empty)."""
    for batch in batches:
        start, total, texts = 0, 0, []
        for at, text in enumerate(batch.column(column).cast(pa.large_binary()).to_pylist()):
            if texts and total + len(text or b"") > size:
                yield batch.slice(start, at - start), texts
                start, total, texts = at, 0, []
            texts.append(text or b"")
            total += len(texts[-1])
        if texts:
            yield batch.slice(start), texts
        del texts
        pa.default_memory_pool().release_unused()


def arrow(columns: dict, schema: T.StructType) -> pa.RecordBatch:
    """A batch of columns (arrays, lists) in the types of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    wanted = to_arrow_schema(schema)
    arrays = []
    for field in wanted:
        values = columns[field.name]
        arrays.append(values.cast(field.type) if isinstance(values, pa.Array) else pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=wanted)


TYPES = {
    "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
    "binary": T.BinaryType(), "boolean": T.BooleanType(), "span": T.StructType().add("start", "integer").add("words", "integer"),
}


def schema_of(ddl: str) -> T.StructType:
    """Columns as in ``a long, b array<double>``, without the session that Spark's parser asks for."""
    out = T.StructType()
    for name, kind in (part.split() for part in ddl.split(",")):
        inner = kind.removeprefix("array<").removesuffix(">")
        out.add(name, T.ArrayType(TYPES[inner]) if inner != kind else TYPES[kind])
    return out


def plus(schema: T.StructType, ddl: str) -> T.StructType:
    """``schema`` without the columns of ``ddl``, then these."""
    more = schema_of(ddl)
    names = {f.name.lower() for f in more.fields}
    return T.StructType([f for f in schema.fields if f.name.lower() not in names] + more.fields)


class Hashes(dict):
    """64-bit hashes of words, the same on every worker; remembers words up to a bound."""

    def __init__(self, bound: int = 100_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` successive word hashes; empty if there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mix(out)


def joined(arrays: list[np.ndarray], kind=np.uint64) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, kind)


def starts(lengths: np.ndarray) -> np.ndarray:
    """Where each of some runs begins when they are laid end to end, and last the total."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def flat(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [begin, begin + length), range by range."""
    length = length.astype(np.int64)
    shift = np.repeat(begin.astype(np.int64) - (np.cumsum(length) - length), length)
    return np.arange(len(shift), dtype=np.int64) + shift


def row_key(*columns: str) -> list[Column]:
    """Two columns that together tell rows apart by the values of ``columns``."""
    return [F.xxhash64(F.lit(seed), *columns).alias(f"_k{seed}") for seed in (1, 2)]


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
