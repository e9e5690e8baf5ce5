"""Decoder cases, and the encoder's output."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from receiptflow.functions.codec import bad, decode, encode, good
from receiptflow.schemas import CUSTOMER, CUSTOMER_TRANSACTION, FRAUD_MARK, RECORDS, TRANSACTION

OK = None
NOT_JSON = "not a JSON object"

# message, problem, and the values expected in some columns of a good one
CASES = [
    ('{"receiptId":"r","productPrice":1.5,"productQuantity":2}', OK, {"receipt_id": "r", "product_price": 1.5, "product_quantity": 2}),
    ('{"receiptId":"r"}', OK, {"product_price": 0.0, "product_quantity": 0, "total_amount": 0.0, "customer_id": None, "receipt_date": None}),
    ('{"productQuantity":null,"productName":null}', OK, {"product_quantity": 0, "product_name": None}),
    ("{}", OK, {"receipt_id": None, "total_amount": 0.0}),
    ('{"receiptId":"r","extra":1}', "unknown field extra", None),
    ("", NOT_JSON, None),
    (None, NOT_JSON, None),
    ('{"receiptId":', NOT_JSON, None),
    ("[1]", NOT_JSON, None),
    ("5", NOT_JSON, None),
    ("{'receiptId':'r'}", NOT_JSON, None),
    ('{"productPrice":NaN}', NOT_JSON, None),
    ('{"productPrice":"1.5","productQuantity":"4"}', OK, {"product_price": 1.5, "product_quantity": 4}),
    ('{"productPrice":"","productQuantity":"null"}', OK, {"product_price": 0.0, "product_quantity": 0}),
    ('{"productQuantity":2.7}', OK, {"product_quantity": 2}),
    ('{"productQuantity":"2.7"}', "bad value for productQuantity", None),
    ('{"productQuantity":1e3}', OK, {"product_quantity": 1000}),
    ('{"productQuantity":" 4 "}', OK, {"product_quantity": 4}),
    ('{"productQuantity":-2.7}', OK, {"product_quantity": -2}),
    ('{"productQuantity":2147483647}', OK, {"product_quantity": 2147483647}),
    ('{"productQuantity":3000000000}', "bad value for productQuantity", None),
    ('{"productQuantity":"many"}', "bad value for productQuantity", None),
    ('{"productQuantity":true}', "bad value for productQuantity", None),
    ('{"productPrice":{"a":1}}', "bad value for productPrice", None),
    ('{"productName":{"a":1}}', "bad value for productName", None),
    ('{"productName":["a"]}', "bad value for productName", None),
    ('{"productName":"{\\"a\\":1}"}', OK, {"product_name": '{"a":1}'}),
    ('{"productName":"[x"}', OK, {"product_name": "[x"}),
    ('{"productName":12}', OK, {"product_name": "12"}),
    ('{"productName":"d\\u00e9j\\u00e0"}', OK, {"product_name": "déjà"}),
    ('{"productQuantity":2,"productQuantity":3}', OK, {"product_quantity": 3}),
    ('{"receiptDate":"yesterday"}', "bad value for receiptDate", None),
    ('{"receiptDate":"2024-13-01T00:00:00"}', "bad value for receiptDate", None),
    ('{"receiptDate":"10:00"}', "bad value for receiptDate", None),
    ('{"receiptDate":""}', OK, {"receipt_date": None}),
]

# timestamp text -> epoch milliseconds
TIMES = {
    '"2024-01-01T10:00:00.123456"': 1704103200123,
    '"2024-01-01T10:00:00.999999"': 1704103200999,
    '"2024-01-01T10:00:00"': 1704103200000,
    '"2024-01-01T10:00"': 1704103200000,
    '"2024-01-01"': 1704067200000,
    '"2024-01-01T10:00:00Z"': 1704103200000,
    '"2024-01-01T10:00:00.5+0100"': 1704099600500,
    '"2024-01-01T10:00:00-01:30"': 1704108600000,
    '"1969-12-31T23:59:59.9999"': -1,
    "1704103200123": 1704103200123,
    '"1704103200123"': 1704103200123,
    "-1": -1,
}


def messages(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")


def test_each_case(spark):
    rows = decode(messages(spark, [c[0] for c in CASES]), TRANSACTION, "quarantine").collect()
    assert len(rows) == len(CASES)
    for row in rows:
        text, problem, values = CASES[row.i]
        assert (row.problem, row.raw) == (problem, text), text
        for column in TRANSACTION.columns if problem else ():
            assert row[column] is None, text
        for column, value in (values or {}).items():
            assert row[column] == value, text


def test_times(spark):
    texts = ['{"receiptDate":%s}' % t for t in TIMES]
    rows = decode(messages(spark, texts), TRANSACTION).select("i", F.unix_millis("receipt_date").alias("ms")).collect()
    assert {texts[r.i]: r.ms for r in rows} == dict(zip(texts, TIMES.values()))


def test_null_is_no_message(spark):
    df = messages(spark, ["null", " null ", '{"receiptId":"a","detectedTs":null}'])
    assert [r.i for r in decode(df, FRAUD_MARK).collect()] == [2]
    assert [r.i for r in decode(df, FRAUD_MARK, "quarantine").collect()] == [2]


def test_split(spark):
    decoded = decode(messages(spark, [c[0] for c in CASES]), TRANSACTION, "quarantine")
    assert good(decoded).columns == ["i", *TRANSACTION.columns]
    assert good(decoded).count() == sum(c[1] is None for c in CASES)
    assert bad(decoded).count() == sum(c[1] is not None for c in CASES)


@pytest.mark.parametrize("text", [c[0] for c in CASES if c[1] is not None])
def test_failfast_raises_whatever_is_read(spark, text):
    decoded = decode(messages(spark, ['{"receiptId":"ok"}', text]), TRANSACTION)
    for read in (decoded.select("receipt_id"), decoded.groupBy().count()):
        with pytest.raises(PySparkException, match="bad Transaction message"):
            read.collect()


def test_bytes_are_read_as_text(spark):
    df = spark.createDataFrame([(bytearray('{"customerId":"ü"}'.encode()),)], "value binary")
    assert decode(df, CUSTOMER).first().customer_id == "ü"


def test_one_parse_per_message(spark):
    """The filters on the decoded columns must not parse the text a second time."""
    decoded = good(decode(messages(spark, ["{}"]), TRANSACTION, "quarantine")).filter("total_amount > 1")
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode(spark):
    values = {"receiptDate": "2024-01-01T10:00:00.123", "totalAmount": 2.5, "productQuantity": 3, "customerName": "a \"b\""}
    source = {f.json: values.get(f.json) for f in CUSTOMER_TRANSACTION.fields}
    df = decode(messages(spark, [json.dumps(source)]), CUSTOMER_TRANSACTION)
    written = encode(df, CUSTOMER_TRANSACTION).first().value
    expected = {**source, "receiptDate": 1704103200123, "productPrice": 0.0}
    assert json.loads(written) == expected
    assert list(json.loads(written)) == CUSTOMER_TRANSACTION.json_names
    assert encode(df, CUSTOMER_TRANSACTION, key="receipt_id").columns == ["key", "value"]


@pytest.mark.parametrize("record", RECORDS, ids=lambda r: r.name)
@pytest.mark.parametrize("times", ["millis", "iso"])
def test_encode_then_decode(spark, record, times):
    values = {f.json: {"double": 1.25, "int": 7, "timestamp": "2024-02-29T23:59:59.125"}.get(f.type.simpleString(), f.json) for f in record.fields}
    first = decode(messages(spark, [json.dumps(values)]), record).drop("i")
    again = decode(encode(first, record, times), record)
    assert again.collect() == first.collect()
    assert again.schema.names == record.schema.names
    assert [f.dataType for f in again.schema] == [f.dataType for f in record.schema]


def test_only_odd_messages_pay_for_sets_of_names(spark):
    names = ["customerId", "name", "email", "birthdate"]
    whole = dict.fromkeys(names, "x")
    texts = {
        "plain": json.dumps(whole),
        "fewer": '{"customerId": "a"}',
        "again": '{"customerId": "a", "customerId": "b", "name": "n", "email": "e"}',  # as many entries as fields
        "other": '{"customerId": "a", "name": "n", "email": "e", "extra": 1}',
        "both": '{"customerId": "a", "customerId": "b", "extra": 1, "extra": 2}',
        "none": "{}",
    }
    rows = spark.createDataFrame(list(texts.items()), "kind string, value string")
    decoded = decode(rows, CUSTOMER, "quarantine")
    found = {r.kind: (r.customer_id, r.problem) for r in decoded.collect()}
    assert found == {
        "plain": ("x", None), "fewer": ("a", None), "again": ("b", None), "other": (None, "unknown field extra"),
        "both": (None, "unknown field extra"), "none": (None, None),
    }
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    before = plan[: plan.index("array_except")].rsplit("\n", 1)[-1]
    assert before.count("array_contains") >= len(names)  # asked first, and the rest only if it fails
