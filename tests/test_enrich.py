"""The ordered enrichment rules against a row-by-row model, in all their forms."""

import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from receiptflow.operators.enrich import enrich, interleave
from receiptflow.operators.skew import Profile, add_chunk, join_unique, profile
from receiptflow.sinks import tables as table_sink
from receiptflow.streaming.batches import enrich_batches
from receiptflow.streaming.enrich import enrich_stream
from receiptflow.streaming.replay import replay

EVENT = "k string, seq bigint, kind string"


def pair_buffer_model(events):
    """events: (key, seq, kind) in any order -> set of (key, tx seq, customer seq)."""
    out, held, known = [], {}, {}
    for key, seq, kind in sorted(events, key=lambda e: e[1]):
        if kind == "T":
            if key in known:
                out.append((key, seq, known[key]))
            else:
                held[key] = seq
        elif key in held:
            out.append((key, held.pop(key), seq))
        else:
            known[key] = seq
    return sorted(out)


def asof_model(events):
    out, known, waiting = [], {}, {}
    for key, seq, kind in sorted(events, key=lambda e: e[1]):
        if kind == "C":
            out += [(key, tx, seq) for tx in waiting.pop(key, [])]
            known[key] = seq
        elif key in known:
            out.append((key, seq, known[key]))
        else:
            waiting.setdefault(key, []).append(seq)
    return sorted(out)


MODELS = {"asof": asof_model, "pair_buffer": pair_buffer_model}


def make_tx(events):
    return events.filter("kind = 'T'").select(
        F.concat(F.lit("r"), "seq").alias("receipt_id"),
        F.col("k").alias("customer_id"),
        F.lit("pr-1").alias("product_id"),
        F.lit("é \"quoted\"").alias("product_name"),
        F.lit(0.1).alias("product_price"),
        F.lit(2).alias("product_quantity"),
        F.col("seq").cast("double").alias("total_amount"),
        F.when(F.col("seq") % 3 > 0, F.timestamp_micros(F.col("seq") * 1001)).alias("receipt_date"),
        F.lit("Zelle").alias("payment_method"),
        F.col("seq").alias("arrival"),
    )


def make_customers(events):
    return events.filter("kind = 'C'").select(
        F.col("k").alias("customer_id"),
        F.concat(F.lit("v"), "seq").alias("name"),
        F.lit(None).cast("string").alias("email"),
        F.lit("1990-01-01").alias("birthdate"),
        F.col("seq").alias("arrival"),
    )


def pairs(df):
    rows = df.select("customer_id", "tx_arrival", "customer_arrival", "customer_name", "receipt_id").collect()
    for row in rows:
        assert row.customer_name == f"v{row.customer_arrival}" and row.receipt_id == f"r{row.tx_arrival}"
    return sorted((r.customer_id, r.tx_arrival, r.customer_arrival) for r in rows)


def random_events(seed, size, hot_share=0.34, keys=30, tx_share=0.7):
    rng = random.Random(seed)
    return [
        ("hot" if rng.random() < hot_share else f"k{rng.randrange(keys)}", seq, "T" if rng.random() < tx_share else "C")
        for seq in range(size)
    ]


@pytest.mark.parametrize("mode", list(MODELS))
@pytest.mark.parametrize("tx_share", [0.3, 0.5, 0.9, 0.995])
def test_batch_forms_equal_model(spark, mode, tx_share):
    events = [e for seed in range(3) for e in random_events(seed, 2500, tx_share=tx_share)]
    events = [(k, i, kind) for i, (k, _, kind) in enumerate(events)]
    expected = MODELS[mode](events)
    log = spark.createDataFrame(events, EVENT)
    plain = enrich(make_tx(log), make_customers(log), mode, Profile())
    assert pairs(plain) == expected
    hot = profile(interleave(make_tx(log), make_customers(log)), "customer_id", "arrival", chunks=60)
    assert hot.chunks["hot"] > 10
    assert pairs(enrich(make_tx(log), make_customers(log), mode, hot)) == expected


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    kinds=st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("TC")), min_size=1, max_size=40),
    cuts=st.lists(st.integers(0, 40), max_size=12),
)
def test_any_cuts_give_the_same_result(spark, kinds, cuts):
    """Where a key is cut is a matter of speed only."""
    events = [(k, i, kind) for i, (k, kind) in enumerate(kinds)]
    log = spark.createDataFrame(events, EVENT)
    schema = interleave(make_tx(log), make_customers(log)).schema
    splits = sorted(set(cuts)) or [3]
    hot = Profile(schema["customer_id"].dataType, schema["arrival"].dataType, {"a": len(splits) + 1}, {"a": splits})
    for mode, model in MODELS.items():
        assert pairs(enrich(make_tx(log), make_customers(log), mode, hot)) == model(events)


def test_order_by_struct(spark):
    """Kafka order: time, partition, offset; many rows share one time."""
    events = random_events(5, 3000)
    log = spark.createDataFrame(events, EVENT)

    def placed(df):
        order = F.struct((F.col("arrival") / 1500).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("p"), F.col("arrival").alias("o"))
        return df.withColumn("arrival", order)

    tx, customers = placed(make_tx(log)), placed(make_customers(log))
    hot = profile(interleave(tx, customers), "customer_id", "arrival", chunks=40)
    assert hot.chunks["hot"] > 8
    for mode, model in MODELS.items():
        rows = enrich(tx, customers, mode, hot).select("customer_id", "tx_arrival.o", "customer_arrival.o")
        assert sorted(tuple(r) for r in rows.collect()) == model(events)


def test_chunks_follow_the_order_and_are_even(spark):
    events = [("hot", i * i, "T") for i in range(4000)] + [(f"k{i}", i, "T") for i in range(4000)]
    log = spark.createDataFrame(events, EVENT)
    hot = profile(log, "k", "seq", chunks=40)
    assert list(hot.chunks) == ["hot"]
    chunked = add_chunk(log, "k", "seq", hot).filter("k = 'hot'").groupBy("_chunk")
    sizes = chunked.agg(F.count("*").alias("n"), F.min("seq").alias("a"), F.max("seq").alias("b")).orderBy("_chunk").collect()
    assert len(sizes) == hot.chunks["hot"] and max(s.n for s in sizes) < 3 * 4000 / len(sizes)
    assert all(x.b < y.a for x, y in zip(sizes, sizes[1:]))
    assert add_chunk(log, "k", "seq", hot).filter("k <> 'hot' AND _chunk <> 0").count() == 0


def test_shares_count_not_sizes(spark):
    assert profile(spark.range(10).withColumn("k", F.lit("a")), "k").chunks == {"a": 10}
    assert profile(spark.range(4000).withColumn("k", F.col("id") % 2000), "k", chunks=100).empty


@pytest.mark.parametrize("how", ["inner", "left", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 50) END AS k", "id")
    left = left.repartition(6).unionByName(spark.createDataFrame([(None, -1)], "k string, id bigint"))
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("none", 3)], "k string, v int")
    hot = profile(left, "k", chunks=30)
    assert hot.chunks["hot"] >= 5
    salted, plain = join_unique(left, right, "k", how, hot), join_unique(left, right, "k", how, Profile())
    assert sorted(map(str, salted.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("mode", list(MODELS))
@pytest.mark.parametrize("slices", [1, 5])
def test_streams_equal_model(spark, tmp_path, mode, slices):
    events = random_events(9, 400, keys=12)
    expected = MODELS[mode](events)
    table = spark.createDataFrame(events, EVENT)
    out = f"{tmp_path}/state_store"

    def by_state_store(log):
        rows = enrich_stream(make_tx(log), make_customers(log), mode, salts=3)
        return rows.writeStream.format("parquet").option("path", out)

    replay(table, "seq", by_state_store, slices, folder=f"{tmp_path}/a")
    streamed = spark.read.parquet(out)
    assert pairs(streamed) == expected
    batch = enrich(make_tx(table), make_customers(table), mode)
    assert streamed.select(batch.columns).exceptAll(batch).count() == 0

    out = f"{tmp_path}/batches"

    def by_batches(log):
        emit = table_sink.append_batch(out)
        return enrich_batches(make_tx(log), make_customers(log), emit, f"{tmp_path}/state", mode)

    replay(table, "seq", by_batches, slices, folder=f"{tmp_path}/b")
    assert pairs(spark.read.parquet(out)) == expected


@pytest.mark.parametrize("mode", list(MODELS))
def test_customers_share_calls(spark, tmp_path, monkeypatch, mode):
    """All customers of a bucket in one call, whatever its state: as the model, and far fewer calls than customers."""
    from receiptflow.streaming import enrich as form

    events = random_events(21, 900, keys=150)
    table = spark.createDataFrame(events, EVENT)
    calls = spark.sparkContext.accumulator(0)
    plain = form._InOrder.handleInputRows

    def counted(self, key, rows, times):
        calls.add(1)
        return plain(self, key, rows, times)

    monkeypatch.setattr(form._InOrder, "handleInputRows", counted)

    def start(log):
        rows = enrich_stream(make_tx(log), make_customers(log), mode, salts=1, buckets=2)
        return rows.writeStream.format("parquet").option("path", f"{tmp_path}/out")

    replay(table, "seq", start, 4, folder=f"{tmp_path}/in")
    assert pairs(spark.read.parquet(f"{tmp_path}/out")) == MODELS[mode](events)
    assert 1 <= calls.value <= 2 * 4


def test_stream_spreads_only_named_keys(spark, tmp_path):
    events = random_events(3, 300, keys=6)
    table = spark.createDataFrame(events, EVENT)
    out = f"{tmp_path}/out"

    def start(log):
        rows = enrich_stream(make_tx(log), make_customers(log), "asof", salts=4, hot_keys=["hot"])
        return rows.writeStream.format("parquet").option("path", out)

    replay(table, "seq", start, 2, folder=f"{tmp_path}/in")
    assert pairs(spark.read.parquet(out)) == asof_model(events)


def test_stream_with_expiry(spark, tmp_path):
    """With an expiry Spark goes on with empty batches, so the query is stopped from outside."""
    events = random_events(4, 60, keys=3)
    spark.createDataFrame(events, EVENT).write.parquet(f"{tmp_path}/in")
    log = spark.readStream.schema(EVENT).parquet(f"{tmp_path}/in")
    rows = enrich_stream(make_tx(log), make_customers(log), "asof", salts=2, ttl="1 day")
    query = rows.writeStream.format("memory").queryName("expiring").option("checkpointLocation", f"{tmp_path}/c").start()
    try:
        deadline = time.time() + 60
        while spark.table("expiring").count() < len(asof_model(events)) and time.time() < deadline:
            time.sleep(0.5)
    finally:
        query.stop()
    assert pairs(spark.table("expiring")) == asof_model(events)


def test_rows_without_customer_are_left_out(spark):
    log = spark.createDataFrame([(None, 1, "T"), (None, 2, "C"), ("a", 3, "C"), ("a", 4, "T")], EVENT)
    for mode in MODELS:
        assert pairs(enrich(make_tx(log), make_customers(log), mode)) == [("a", 4, 3)]


@pytest.mark.parametrize("salted", [False, True])
def test_current_takes_the_latest_version(spark, salted):
    events = random_events(6, 2000, tx_share=0.8) + [("nobody", 9000, "T")]
    log = spark.createDataFrame(events, EVENT)
    hot = profile(make_tx(log), "customer_id", chunks=30) if salted else Profile()
    assert hot.empty != salted
    latest = {k: seq for k, seq, kind in events if kind == "C"}
    rows = enrich(make_tx(log), make_customers(log), "current", hot)
    got = sorted((r.receipt_id, r.customer_id, r.customer_name) for r in rows.collect())
    assert got == sorted((f"r{s}", k, f"v{latest[k]}") for k, s, kind in events if kind == "T" and k in latest)


def test_unknown_mode(spark):
    log = spark.createDataFrame([("a", 1, "T")], EVENT)
    with pytest.raises(ValueError):
        enrich(make_tx(log), make_customers(log), "nearest")


def test_state_store_output_is_parsed_once_a_side(spark):
    from receiptflow.streaming.enrich import enrich_stream

    log = spark.createDataFrame([("T", "a", 1), ("C", "a", 2)], "kind string, k string, seq bigint")
    rows = enrich_stream(make_tx(log), make_customers(log))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2
