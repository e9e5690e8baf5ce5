"""The prefix trie against a trie of dictionaries, and totals through tiny shards and queues."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from receiptflow.llm import trie

CONVS = "conv_id long, turn long, role string, text string"
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, base=lambda c: c, head=lambda c: 0):
    """The same nodes by a tree of dictionaries."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    whole = {c: turns.get(base(c), [])[: head(c)] + ts[head(c) :] for c, ts in turns.items()}
    # A node is the pair of its parent's number and its last turn, so that long paths cost no more than their turns.
    nodes, up, turn, depth, members, ends = {}, [None], [None], [0], [[]], [[]]
    for c, ts in sorted(whole.items()):
        node = 0
        members[0].append(c)
        for t in ts:
            if (node, t) not in nodes:
                nodes[node, t] = len(up)
                up.append(node)
                turn.append(t)
                depth.append(depth[node] + 1)
                members.append([])
                ends.append([])
            node = nodes[node, t]
            members[node].append(c)
        ends[node].append(c)
    if not whole:
        return set()
    children = Counter(up[1:])
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t[1])) if t else 0 for t in turn]
    leaves = [int(not children[i]) for i in range(len(up))]
    saved = [(len(members[i]) - 1) * words[i] for i in range(len(up))]
    for i in range(len(up) - 1, 0, -1):  # a parent has a smaller number
        leaves[up[i]] += leaves[i]
        saved[up[i]] += saved[i]
    digest = lambda cs: hashlib.sha256(",".join(map(str, cs)).encode()).hexdigest()
    return {
        (members[i][0], depth[i], members[up[i]][0] if i else None, len(members[i]), children[i], leaves[i], saved[i], digest(ends[i]))
        for i in range(len(up))
    }


def found(df):
    rows = [tuple(r) for r in df.select(*RESULT).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def some(seed, convs=60, words=3):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-50, 200), convs):
        for turn in range(r.randrange(1, 7)):
            role = r.choice(["user", "assistant", None]) if turn % 3 else "user"
            rows.append((c, None if r.random() < 0.1 else turn, role, r.choice([None, "", "a b\tc", "hi", "so so"][:words])))
    rows += r.sample(rows, 5)  # repeated rows
    return rows + [(None, 0, "user", "nobody")]


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_plain_trie(spark, seed):
    rows = some(seed, words=2 + seed)
    df = spark.createDataFrame(rows, CONVS).repartition(5).withColumns({n: F.lit("mine") for n in ("hash", "parent", "depth", "words", "key", "shard", "place", "n")})
    # Python's remainder has the sign of the divisor, SQL's that of the number.
    base, head = lambda c: c - (abs(c) % 20) * (1 if c >= 0 else -1), lambda c: zlib.crc32(str(c).encode()) % 4
    assert found(trie.prefix_trie(df)) == plain(rows)
    conv = F.col("conv_id")
    rebuilt = trie.prefix_trie(df, conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4)
    assert found(rebuilt) == plain(rows, base, head)


def test_a_conversation_cut_by_partition_borders(spark):
    rows = [(7, t, "user", f"word {t % 3}") for t in range(3000)] + [(c, t, "user", f"word {t % 3}") for c in (6, 8) for t in range(40)]
    df = spark.createDataFrame(rows, CONVS)
    runs = trie.in_order(df).mapInArrow(trie.hashed_runs, trie.RUN).cache()
    assert len(trie.carried(runs)) > 0, "no border cuts a conversation"
    assert found(trie.prefix_trie(df, F.lit(6).cast("long"), F.lit(2))) == plain(rows, lambda c: 6, lambda c: 2)
    assert found(trie.prefix_trie(df)) == plain(rows)


def test_totals_through_tiny_shards_and_queues(spark):
    r = random.Random(3)
    owner, rows = {(0, 0): None}, []
    for conv in range(1, 300):
        up = r.choice(list(owner))
        for depth in range(up[1] + 1, up[1] + 1 + r.randrange(1, 4)):
            owner[conv, depth] = up if depth == up[1] + 1 else (conv, depth - 1)
    has_child = set(owner.values())
    expected = defaultdict(lambda: [0, 0])
    for node, up in owner.items():
        leaf, saved = node not in has_child, r.randrange(5)
        rows.append((*node, up[0] if up else None, int(leaf), saved))
        while node:
            expected[node][0] += leaf
            expected[node][1] += saved
            node = owner[node]
    tree = spark.createDataFrame(r.sample(rows, len(rows)), "conv_id long, depth long, parent_conv_id long, leaves long, saved long")
    for block, layer, queue in ((10_000, 4096, 2), (7, 2, 3), (1, 1, 100)):
        totals = {(x[0], x[1]): [x[2], x[3]] for x in trie.subtree_totals(tree, block, layer, queue).collect()}
        assert totals == dict(expected)


def test_messages_spill_and_come_back_in_order():
    messages, sent = trie.Messages(limit=10), []
    r = random.Random(1)
    for _ in range(500):
        sent.append((("s", r.randrange(50), r.randrange(5)), (1, r.randrange(9))))
        messages.send(*sent[-1])
    assert messages.spills > 10 and len(messages.heap) <= 10
    for node in sorted({to for to, _ in sent}):
        assert messages.take(node) == tuple(sum(v[i] for to, v in sent if to == node) for i in range(2))


def test_digest_of_a_node_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 50)
    rows = spark.range(1000).select(F.lit(b"x" * 16).alias("hash"), F.col("id").alias("conv_id")).union(spark.createDataFrame([(b"y" * 16, 5)], "hash binary, conv_id long"))
    got = {bytes(r[0]): r[1] for r in trie.ends_digest(rows.repartition(7)).collect()}
    assert got == {b"x" * 16: hashlib.sha256(",".join(map(str, range(1000))).encode()).hexdigest(), b"y" * 16: hashlib.sha256(b"5").hexdigest()}


def test_no_conversations(spark):
    assert found(trie.prefix_trie(spark.createDataFrame([], CONVS))) == set()
    assert found(trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "x")], CONVS))) == set()
