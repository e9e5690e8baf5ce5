"""Classifiers by held-out accuracy; duplicates, repeats, mixing and the pipeline against plain models."""

import os
import random
import sys
import zlib
from itertools import combinations
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import clashing, edges, no_docs  # noqa: F401

from receiptflow.llm import components, mixing, neardup, quality, repeats, toxicity
from receiptflow.llm.queries import QUERIES
from receiptflow.llm.text import table

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
TESTDATA = os.environ.get("TESTDATA_DIR", "/root/testdata")
sys.path.insert(0, ROOT)
DOC = "doc_id long, text string"


def accuracy(spark, name, label):
    sf_dir = f"{TESTDATA}/sf0.01"
    rows = QUERIES[name](spark, sf_dir)
    assert rows.count() == table(spark, sf_dir, "documents").count()
    assert rows.where("score < 0 OR score > 1").count() == 0
    held = rows.where("held_out").join(table(spark, sf_dir, "labels"), "doc_id")
    return held.where(f"predicted = {label}").count() / held.count()


def test_quality_accuracy(spark):
    assert accuracy(spark, "op2_quality_ranking", "quality") > 0.97


def test_toxicity_accuracy(spark):
    assert accuracy(spark, "op3_toxicity", "toxic") > 0.93


def test_pairwise_ranking_orders_pairs():
    draw = np.random.default_rng(0)
    label = (draw.random(400) < 0.7).astype(int)
    x = draw.normal(size=(400, 3)) + label[:, None] * np.array([2.0, 0.0, -1.0])
    model = quality.Ranking(x, label)
    score, best = model.rank(x), x @ np.array([2.0, 0.0, -1.0])
    ordered = lambda s: (s[label == 1][:, None] > s[label == 0][None, :]).mean()
    assert ordered(score) > ordered(best) - 0.01
    assert abs((score < quality.AT_THRESHOLD).mean() - (label == 0).mean()) < 0.02


def test_one_class_or_no_labels(spark, edges, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        assert {r.score for r in quality.score(edges, quality.fit(edges, some)).collect()} == {0.5}
        assert {r.score for r in toxicity.score(edges, toxicity.fit(edges, some)).collect()} == {0.0}
    assert quality.score(no_docs, quality.fit(no_docs, labels)).count() == 0
    assert toxicity.score(no_docs, toxicity.fit(no_docs, labels)).count() == 0


def naive_kernel(a: bytes, b: bytes) -> float:
    """Both windows' subsequences by trying all places, met pair by pair."""
    found = []
    for window in (a, b):
        some: dict[bytes, float] = {}
        for size in toxicity.LENGTHS:
            for begin in range(toxicity.BEGINS):
                for rest in combinations(range(begin + 1, min(begin + size + 1, len(window))), size - 1):
                    key = bytes(window[i] for i in (begin, *rest))
                    some[key] = some.get(key, 0.0) + toxicity.DECAY ** (rest[-1] - begin + 1 - size)
        found.append(some)
    return sum(v * found[1].get(k, 0.0) for k, v in found[0].items()) / (toxicity.BEGINS * sum(toxicity.DECAY ** (2 * (p[-1] - len(p))) for p in toxicity.PATTERNS))


SYLLABLES = ["an", "the", "or", "ti", "sh", "re", "ed", "wh", "ou", "ble", "er", "ing", "on", "ha", "st", "ly"]


def test_string_kernel_is_the_naive_one():
    draw = random.Random(5)
    windows = [toxicity.coded("".join(draw.choices("ab cd", k=toxicity.WIDTH)).encode())[: draw.randint(4, toxicity.WIDTH)] for _ in range(30)]
    some = toxicity.entries(windows)
    fast = toxicity.kernel(some, some)
    slow = np.array([[naive_kernel(a, b) for b in windows] for a in windows])
    assert np.allclose(fast, slow, atol=1e-5)
    weights = np.bincount(np.maximum(some[0], 0), toxicity.VALUES, 1 << toxicity.BITS)
    weights[0] = 0
    assert np.allclose(toxicity.decisions(windows, weights)[0], slow[0], atol=1e-5)


def test_text_as_the_kernel_sees_it():
    assert toxicity.coded(b"You i d i o t, id-iot! 1d10t 2020") == toxicity.coded(b"you  idiot idiot idiot 2020")


def test_shares_go_through_many_sentences_at_a_time(monkeypatch):
    draw, calls, keys_of = random.Random(8), [], toxicity.keys_of
    texts = [toxicity.coded("".join(draw.choices("abc d", k=draw.choice([0, 3, 9, 40]))).encode()) for _ in range(600)]
    labels = [draw.randint(0, 1) for _ in texts]
    counts = [Counter(), Counter()]
    for text, label in zip(texts, labels, strict=True):
        counts[label].update({int(k) for keys in keys_of(toxicity.laid([text])[0]) for k in keys if k})
    monkeypatch.setattr(toxicity, "keys_of", lambda codes: calls.append(len(codes)) or keys_of(codes))
    batch = pa.RecordBatch.from_pydict({"label": pa.array(labels, pa.int32()), "sentence": pa.array(texts, pa.binary())})
    (found,) = toxicity.shares(iter([batch]))
    assert len(calls) < 10  # before: one call for each sentence
    assert {r["key"]: (r["clean"], r["toxic"]) for r in found.to_pylist()} == {k: (counts[0][k], counts[1][k]) for k in counts[0] | counts[1]}


def test_decisions_do_not_depend_on_blocks(monkeypatch):
    draw = random.Random(9)
    texts = [toxicity.coded("".join(draw.choices("abc d1é", k=draw.choice([0, 2, 20, 300]))).encode()) for _ in range(40)]
    weights = np.random.default_rng(4).standard_normal(1 << toxicity.BITS).astype(np.float32)
    weights[0] = 0
    whole = toxicity.window_sums(texts, weights)
    monkeypatch.setattr(toxicity, "BLOCK", 100)
    for a, b in zip(whole, toxicity.window_sums(texts, weights), strict=True):
        assert (a == b).all()


def test_insults_made_of_ordinary_syllables(spark):
    draw = random.Random(30)
    word = lambda: "".join(draw.choices(SYLLABLES, k=draw.randint(2, 4)))
    ordinary = [word() for _ in range(3000)]
    insults = [w for w in ("".join(draw.choices(SYLLABLES, k=3)) for _ in range(200)) if not any(w in o for o in ordinary)][:30]
    docs, labels = [], []
    for i in range(4000):
        words, toxic = draw.choices(ordinary, k=draw.randint(20, 60)), int(draw.random() < 0.4)
        for _ in range(2 * toxic):
            words[draw.randrange(len(words))] = draw.choice(insults)
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    judge = toxicity.fit(spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, "doc_id long, toxic int"))
    held = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5 == 0]
    said = judge.toxic([docs[i][1].encode() for i in held]) >= 0.5
    truth = np.array([labels[i][1] for i in held]) == 1
    assert said[truth].mean() > 0.9 and said[~truth].mean() < 0.1


def test_kernel_leaps_over_one_character():
    windows = [toxicity.coded(w)[: toxicity.WIDTH] for w in (b"idiot", b"idxiot", b"id iot", b"1diot!", b"treaty", b"indoor")]
    same, gapped, spaced, spelled, *other = toxicity.kernel(toxicity.entries(windows), toxicity.entries(windows[:1]))[:, 0]
    assert min(gapped, spaced, spelled) > 2 * max(other)


def linked(texts):
    """Components by comparing all pairs."""
    sets = {}
    for i, text in texts.items():
        words = (text or "").encode().lower().split()
        k = min(5, len(words))
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} if words else set()
    root = {i: i for i in texts}
    find = lambda i: i if root[i] == i else find(root[i])
    ids = sorted(texts)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("k, wide, family", [(64, 512, 4000), (64, 128, 7)])
def test_near_duplicates(spark, monkeypatch, k, wide, family):
    monkeypatch.setattr(neardup, "WIDE", wide)
    monkeypatch.setattr(neardup, "LEAST_SHARED", {64: 27, wide: {512: 325, 128: 66}[wide]})
    monkeypatch.setattr(neardup, "FAMILY", family)
    draw = random.Random(k + wide)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = {}
    for length, copies, edits in [(150, 40, 4), (40, 30, 2), (300, 40, 9), (12, 10, 1), (700, 12, 14), (5, 4, 1), (3, 3, 0)]:
        base = draw.choices(vocabulary, k=length)
        common = draw.choices(vocabulary, k=20)
        for _ in range(copies):
            own = list(base)
            for _ in range(draw.randint(0, edits)):
                own[draw.randrange(len(own))] = draw.choice(vocabulary)
            # Chains: each copy may begin from the one before.
            base = own if draw.random() < 0.5 else base
            texts[len(texts)] = " ".join(own + (common if draw.random() < 0.3 else [])).title()
    texts |= {len(texts): None, len(texts) + 1: "", len(texts) + 2: " \n"}
    rows = neardup.near_duplicates(spark.createDataFrame(list(texts.items()), DOC)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == linked(texts)


def test_blocks_of_a_family_are_bounded(spark, monkeypatch, tmp_path):
    # 600 classes of one family in components of their own: groups hold a block of askers and one of members.
    seen = spark.sparkContext.accumulator(0)
    largest = spark.sparkContext.accumulator(0)
    inner = neardup.across

    def counted(group):
        seen.add(1)
        largest.add(group.num_rows > 2 * 2 * 50)
        return inner(group)

    monkeypatch.setattr(neardup, "across", counted)
    monkeypatch.setattr(neardup, "FAMILY", 50)
    rows = [(i, 20, sorted([i * 100 + k for k in range(1, 20)] + [-1])) for i in range(600)]
    sets = spark.createDataFrame([(i, n, v, b"") for i, n, v in rows], neardup.SETS)
    listed = spark.createDataFrame([(-1, i, n, i) for i, n, _ in rows], "v long, id long, n long, comp long")
    labels = listed.select("id", "comp")
    classes = sets.select("id", "n", "sketch")
    assert neardup.last_links(listed, classes, sets, labels, str(tmp_path)).count() == 0
    assert seen.value >= 12 * 12 and largest.value == 0


def test_near_duplicates_on_edges(edges, no_docs, clashing):
    assert neardup.near_duplicates(no_docs).count() == 0
    rows = [(r.doc_id, r.component_id) for r in neardup.near_duplicates(edges).collect()]
    assert Counter(rows) == Counter([(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (5, 4), (None, None), (7, 7), (8, 8)])
    kept = neardup.deduplicated(clashing)
    assert kept.columns == clashing.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 7, 8]


def test_components(spark):
    draw = random.Random(4)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(90)] + [(i, i + 1) for i in range(300, 360)] + [(5, 5)]
    root = {}
    find = lambda i: i if root.setdefault(i, i) == i else find(root[i])
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    expected = {i: find(i) for e in edges if e[0] != e[1] for i in e}
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == expected
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def cut(texts, length=100):
    seen, out = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            part = data[at : at + length]
            if part in seen:
                gone[at : at + length] = True
            seen.add(part)
        spans = int(np.diff(np.concatenate([[0], gone.astype(int), [0]])).clip(0).sum())
        out[i] = (np.frombuffer(data, np.uint8)[~gone].tobytes(), len(data), int(gone.sum()), spans)
    return out


@pytest.mark.parametrize("crowded", [20_000, 3])
def test_repeats(spark, crowded):
    draw = random.Random(crowded)
    prose = lambda n: "".join(draw.choices("abcdef é\n", k=n))
    passages = [prose(n) for n in (99, 100, 101, 160, 400)]
    texts = {i: prose(draw.randint(0, 200)) + draw.choice(passages) + prose(draw.randint(0, 80)) + draw.choice(passages) for i in range(60)}
    texts |= {60: texts[7], 61: "ab" * 300, 62: "x" * 500, 63: None, 64: "", 65: prose(99), 66: "x" * 100, 67: "漢字" * 60}
    rows = repeats.without_repeats(spark.createDataFrame(list(texts.items()), DOC), crowded).collect()
    assert {r.doc_id: (bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in rows} == cut(texts)


def test_repeats_on_edges(edges, no_docs, clashing):
    assert repeats.without_repeats(no_docs).count() == 0
    rows = {r.doc_id: r for r in repeats.without_repeats(edges).collect()}
    assert rows[7].n_removed == 150_000 - 5 and rows[5].n_removed == 0 and rows[1].n_bytes == 0
    assert repeats.without_repeats(clashing).count() == 9


@pytest.mark.parametrize("wanted, period", [({"a": 5, "b": 3, "c": 1}, 100), ({None: 1, "x": 1}, 7), ({chr(97 + i): i * i + 1 for i in range(20)}, 1000)])
def test_schedule_keeps_within_a_block(wanted, period):
    weights = mixing.shares(wanted, period)
    assert sum(weights.values()) == period and min(weights.values()) >= 1
    counts = Counter()
    for slot, source in enumerate(mixing.schedule(weights, period), 1):
        counts[source] += 1
        assert all(abs(counts[s] - slot * w / period) < 1 for s, w in weights.items())
    assert counts == weights
    with pytest.raises(ValueError):
        mixing.shares(wanted, 1)


def test_mix(spark):
    rows = [(i, None if i % 10 == 9 else "ab"[i % 3 > 0]) for i in range(1000)] + [(5, "b"), (None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, source string").withColumn("slot", mixing.F.lit("mine"))
    mixed = mixing.mixed(docs, {"a": 1, "b": 2}, block=4, period=10).collect()
    assert len(mixed) == len(rows)
    slots = {}
    for r in mixed:
        slots.setdefault(r.slot, []).append(r.source)
    assert all(len(set(s)) == 1 and len(s) <= 5 for s in slots.values())
    weights = mixing.shares({"a": 1, "b": 2, None: 0}, 10)
    inside = sorted({r.slot for r in mixed if r.in_mix})
    assert inside == list(range(len(inside)))
    counts = Counter()
    for n, slot in enumerate(inside, 1):
        counts[slots[slot][0]] += 1
        assert all(abs(counts[s] - n * w / 10) < 1 for s, w in weights.items())


@pytest.mark.parametrize("longest", [mixing.SLOTS, 50])
def test_mix_keeps_targets(spark, longest):
    # One source of half of the target among 1500 others of equal ones, one of which has a single document.
    sizes = {"big": 3000} | {f"s{i}": 1 if i == 7 else 2 for i in range(1500)}
    docs = spark.createDataFrame([(i, s) for s, n in sizes.items() for i in range(n)], "doc_id long, source string")
    rows = mixing.slots(docs, {s: 1500 if s == "big" else 1 for s in sizes}, block=1, longest=longest).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(sum(sizes.values())))
    assert {r.source for r in rows[:10]} >= {"big"} and all(r.in_mix for r in rows[:5900])
    count = 0
    for n, r in enumerate(rows[:5900], 1):
        count += r.source == "big"
        assert abs(count - n / 2) <= 4


@pytest.mark.parametrize("longest", [mixing.SLOTS, 40])
def test_phases_deal_all_blocks_by_target(longest):
    blocks, wanted = [700, 1, 40, 333, 5], [50, 25, 20, 5, 0]
    dealt, slot = [0] * 5, 0
    for p in mixing.phases(blocks, wanted, longest):
        assert p.start == slot and p.weights.sum() == p.period
        total = sum(wanted[i] for i in p.sources)
        if total:
            assert all(abs(w - p.period * wanted[i] / total) < 1 for i, w in zip(p.sources, p.weights.tolist()))
        assert p.first.tolist() == [dealt[i] for i in p.sources]
        for i, w in zip(p.sources, p.weights.tolist()):
            dealt[i] += w * p.periods
        slot += p.period * p.periods
    assert dealt == blocks


def test_mix_on_edges(edges, no_docs, clashing):
    assert mixing.mixed(no_docs).count() == 0
    assert mixing.mixed(edges).count() == 9
    assert set(mixing.mixed(clashing).columns) == set(clashing.columns)


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf_dir = f"{TESTDATA}/sf0.001"
    docs = table(spark, sf_dir, "documents")
    columns = docs.columns
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = components.keep(stage(spark, docs, sf_dir), f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name.replace(' ', '-')}-{os.getpid()}")
        assert docs.columns == columns
        after = {r.doc_id for r in docs.collect()}
        assert after <= before and docs.count() == len(after)
        before = after
    final = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in final.collect()} == before
    assert final.columns == [*columns, "slot", "in_mix"]
    good = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0")
    assert final.join(good, "doc_id").count() > 0.6 * good.count()


def test_pipeline_on_edges(spark, edges, no_docs, clashing):
    import corpus_pipeline

    sf_dir = f"{TESTDATA}/sf0.001"
    for docs in (edges, no_docs, clashing):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, docs, sf_dir)
            assert set(docs.columns) <= set(rows.columns)
            assert rows.count() <= docs.count()
