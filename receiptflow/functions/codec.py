"""JSON decoding and encoding of the records, as column expressions on a whole DataFrame.

Decoding binds strictly by field name. Text that is no JSON object, a field the record does not have,
or a value its type cannot take (for a number also NaN, an infinity, or 1e18 and more) makes the message bad; the JSON text ``null`` is no message at all.
Numbers may come as text, a fraction given for a whole number is cut off, absent numbers are 0 and
absent texts or times are null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from receiptflow.schemas import Field, Record

PROBLEM = "problem"

# Fixed pattern: the date and date-time texts accepted for a timestamp (no zone means UTC).
ISO_TIME = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
#: Amounts and prices must be below this.
MOST = 1e18
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def decode(df: DataFrame, record: Record, mode: str = "failfast", value: str = "value", required: Sequence[str] = ()) -> DataFrame:
    """Decode the JSON in ``value`` into the record's columns, next to the other columns of ``df``.

    ``failfast`` raises on the first bad message. ``quarantine`` keeps every message and adds a
    ``problem`` column that says what is wrong with it (null for a good one) and the ``raw`` text;
    ``good`` and ``bad`` split the result. A message without a value for a ``required`` column is bad:
    a key that is absent, or a time that later steps cannot do without.
    """
    if mode not in ("failfast", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    other = [c for c in df.columns if c != value]
    parsed = F.from_json("raw", T.MapType(T.StringType(), T.StringType()), STRICT_JSON)
    keys = F.map_keys("_map")
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    strange = F.array_except(keys, F.array(*[F.lit(name) for name in record.json_names]))
    # As many entries as different known fields: none is repeated and none is strange.
    plain = F.size(keys) == sum((F.array_contains(keys, name).cast("int") for name in record.json_names), F.lit(0))
    strange = F.when(plain, F.array().cast("array<string>")).otherwise(strange)
    text = {f: f"_text_{f.column}" for f in record.fields}
    typed = {f: f"_typed_{f.column}" for f in record.fields}
    # Each step names what the next ones use more than once, so that it is worked out once. The two
    # generators (of one row each) keep later filters from being pushed down into a second decoding.
    messages = df.select(*other, F.col(value).cast("string").alias("raw"))
    messages = messages.select(*other, "raw", F.explode(F.array(parsed)).alias("_map"))
    messages = messages.filter("_map IS NOT NULL OR raw IS NULL OR trim(raw) <> 'null'")
    messages = messages.withColumns({"_map": F.when(~plain & repeated, _last_wins("_map")).otherwise(F.col("_map")), "_strange": strange})
    messages = messages.withColumns({text[f]: F.col("_map").getItem(f.json) for f in record.fields})
    messages = messages.withColumns({typed[f]: _typed(f, F.col(text[f])) for f in record.fields})
    problem = F.coalesce(
        F.when(F.col("_map").isNull(), "not a JSON object"),
        F.when(F.size("_strange") > 0, F.concat(F.lit("unknown field "), F.get("_strange", F.lit(0)))),
        *[F.when(_wrong(f, F.col(text[f]), F.col(typed[f])), f"bad value for {f.json}") for f in record.fields],
        *[F.when(F.col(typed[f]).isNull(), f"no value for {f.json}") for f in record.fields if f.column in required],
    )
    messages = messages.withColumn(PROBLEM, problem)
    values = {f.column: _present(f, F.col(typed[f])) for f in record.fields}
    if mode == "quarantine":
        kept = [F.when(F.col(PROBLEM).isNull(), v).alias(c) for c, v in values.items()]
        row = F.struct(*kept, PROBLEM)
        return messages.select(*other, F.inline(F.array(row)), "raw")
    what = F.concat(F.lit(f"bad {record.name} message, "), PROBLEM, F.lit(": "), F.coalesce("raw", F.lit("null")))
    row = F.struct(*[v.alias(c) for c, v in values.items()])
    # Raised inside the generator, which runs whichever columns are read.
    checked = F.when(F.col(PROBLEM).isNull(), F.array(row)).otherwise(F.raise_error(what))
    return messages.select(*other, F.inline(checked))


def good(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col(PROBLEM).isNull()).drop(PROBLEM, "raw")


def bad(decoded: DataFrame) -> DataFrame:
    """The dead letters: the problem, the raw text, and whatever came with the message."""
    return decoded.filter(F.col(PROBLEM).isNotNull())


def _last_wins(entries: str) -> Column:
    """A map whose repeated keys keep their last value."""
    pairs = F.map_entries(entries)

    def last_value(key: Column) -> Column:
        return F.element_at(F.filter(pairs, lambda pair: pair["key"] == key), -1)["value"]

    keys = F.array_distinct(F.map_keys(entries))
    return F.map_from_arrays(keys, F.transform(keys, last_value))


def _typed(field: Field, text: Column) -> Column:
    """The value a text stands for; null if there is none or the text does not fit."""
    if isinstance(field.type, T.StringType):
        return text
    if isinstance(field.type, T.TimestampType):
        iso = F.when(text.rlike(ISO_TIME), F.date_trunc("millisecond", text.try_cast("timestamp")))
        millis = F.when(text.rlike(r"^-?\d+$"), F.timestamp_millis(text.try_cast("bigint")))
        return F.coalesce(iso, millis)
    if isinstance(field.type, T.IntegerType):
        # A fraction is cut off; outside the range of an int try_cast gives null.
        return F.coalesce(text.try_cast("int"), text.try_cast("double").try_cast("int"))
    return text.try_cast("double")


def _present(field: Field, typed: Column) -> Column:
    return typed if isinstance(field.type, (T.StringType, T.TimestampType)) else F.coalesce(typed, F.lit(0).cast(field.type))


def _wrong(field: Field, text: Column, typed: Column) -> Column:
    # What the field holds in the message itself; asked only where the text leaves it open.
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json("raw"), f"$.{field.json}", "variant"))
    if isinstance(field.type, T.StringType):
        looks_nested = text.startswith("{") | text.startswith("[")
        return F.when(looks_nested, kind.startswith("OBJECT") | kind.startswith("ARRAY")).otherwise(F.lit(False))
    # Blank text and the word null stand for an absent number or time, as null does.
    unread = typed.isNull() & text.isNotNull() & ~F.trim(text).isin("", "null")
    if isinstance(field.type, T.IntegerType):
        # A fraction is cut off if it is a JSON number, but text must hold a whole number.
        cut_off = typed.isNotNull() & text.try_cast("int").isNull()
        return F.when(cut_off, F.coalesce(kind == "STRING", F.lit(False))).otherwise(unread)
    if isinstance(field.type, T.DoubleType):
        # Neither NaN nor the infinities nor what no sum of money can hold.
        return unread | F.coalesce(~(F.abs(typed) < MOST), F.lit(False))
    return unread


def encode(df: DataFrame, record: Record, times: str = "millis", key: str | None = None) -> DataFrame:
    """Encode the record's columns as one JSON ``value`` (and a ``key``, if a column is named).

    Absent values are written as null. Times are written as epoch milliseconds, the output form, or
    with ``times="iso"`` as the text form the input topics carry.
    """
    columns = [_json_form(f, times).alias(f.json) for f in record.fields]
    value = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).alias("key"), value)


def _json_form(field: Field, times: str) -> Column:
    if not isinstance(field.type, T.TimestampType):
        return F.col(field.column)
    if times == "iso":
        return F.date_format(field.column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.unix_millis(field.column)
