import random
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa

from checking import compare, connect
from paddockflow.llm import conversations
from paddockflow.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, digest string, depth int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """All nodes by definition, from (conv_id, turn, role, text) rows."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        origin = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = turns.get(origin, [])[:h] + turns[c][h:]
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        saved[node] = sum(saved[x] for x in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children.get(node, [])),
            leaves[node], saved[node], sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def run(spark, rows, parts=3, **options):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)
    got = conversations.trie(table, **options).drop("digest")
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=str)


def test_query_equals_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = QUERIES["op11_conversation_prefix_trie"](spark, sf_dir)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == plain(map(tuple, rows))


def some_rows():
    draw = random.Random(11)
    rows = []
    for c in [*range(-205, -95), *range(0, 130), 250, 301]:
        for turn in range(draw.choice([1, 2, 2, 3, 9])):
            rows.append((c, turn, draw.choice(["user", "bot"]), draw.choice(["", "a", "bé", "long text " * 5])))
    return rows


def test_odd_rows_and_many_tables(spark):
    """Nulls, ties, repeated rows, negative ids, missing origins; small tables make several rounds."""
    rows = some_rows()
    rows += rows[:40] + [(3, None, None, None), (3, None, "user", "z"), (5, 2, "a", "b"), (5, 2, "a", "a"), (5, 2, None, "c")]
    rows += [(None, 1, "user", "lost"), (400, None, None, None), (400, None, None, None), (777, 0, "user", "é" * 70_000)]
    want = plain(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, weight=4, at_once=16) == want


def test_a_first_turn_and_a_conversation_that_many_share(spark):
    rows = [(c, t, "user", f"t{t}" if t < 3 or c % 2 else f"own {c}") for c in range(1000, 1400) for t in range(5)]
    assert run(spark, rows, weight=8) == plain(rows)


def test_a_conversation_over_many_tasks(spark):
    rows = [(7, t, "user", f"t{t % 5}") for t in range(900)] + [(c, t, "user", f"t{t}") for c in (0, 6, 8) for t in range(4)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert conversations._carries(conversations._placed(conversations._sorted_turns(
            spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))))
        assert run(spark, rows) == plain(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_nothing(spark):
    assert run(spark, []) == [] and run(spark, [(None, 1, "a", "b")]) == []


def test_slots_are_minimal_perfect_and_verified():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 62, (5000, 2)).astype(np.uint64), axis=0)
    table = conversations.NodeTable(keys)
    assert sorted(table.slots(keys)) == list(range(len(keys)))
    assert (table.slots(keys ^ np.uint64(1)) == -1).all()
    assert len(conversations.NodeTable(keys[:0]).slots(keys)) == len(keys)


def test_query_equals_sql(spark, sf_dir):
    good, message = compare(QUERIES["op11_conversation_prefix_trie"](spark, sf_dir), connect(sf_dir), ORACLES["op11_conversation_prefix_trie"])
    assert good, message
