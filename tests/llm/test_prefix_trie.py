import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import prose

from skyledger.llm import prefix_trie as module
from skyledger.llm import queries
from skyledger.llm.prefix_trie import NodeTable, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, hi long, band int, depth int, stage string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            found[conv].append((turn is not None, turn or 0, key, role, text))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in found.items()}


def branched(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        # The remainder has the sign of the id, as in SQL.
        base = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
    rows = []
    for node, who in members.items():
        below = [p for p in members if p[: len(node)] == node]
        childless = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        children = sum(len(p) == len(node) + 1 for p in below)
        rows.append((min(who), len(node), parent, len(who), children, len(childless), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows)


def got(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


def branch_columns():
    conv_id = F.col("conv_id")
    return conv_id - conv_id % 5, F.crc32(conv_id.cast("string")) % 9


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, "x") for r in rows], SCHEMA).repartition(3)


ODD = [
    *[(c, t, ("user", "assistant", None)[t % 3], prose(t % 4, 3)) for c in range(0, 40) for t in range(c % 7 + 1)],
    (50, None, "user", "first"), (50, 0, "user", None), (50, 0, None, ""), (50, 0, "user", "tie"), (50, 0, "user", "tie"),
    (51, 3, "üser", "ß" * 40_000), (52, 0, "a", "bc"), (53, 0, "ab", "c"), (-3, 0, "user", "minus"), (-10, 2, "user", "minus"),
    (None, 0, "user", "nobody"), (None, None, None, None), (57, None, None, None),
]


@pytest.mark.parametrize(("least", "shard"), [(20_000, 200_000), (3, 5), (0, 1)])
def test_odd_rows(spark, least, shard):
    found = prefix_trie(frame(spark, ODD), least_limit=least, shard_nodes=shard)
    assert got(found) == brute(conversations(ODD))


@pytest.mark.parametrize("least", [20_000, 2])
def test_branches(spark, least):
    found = prefix_trie(frame(spark, ODD), *branch_columns(), least_limit=least)
    assert got(found) == brute(branched(conversations(ODD)))


def test_long_conversations_are_cut_into_bands(spark, monkeypatch):
    monkeypatch.setattr(module, "BAND", 4)
    rows = [(c, t, "user", f"{t if t < 4 * c else (c, t)}") for c in range(5) for t in range(17 + c)] + [(9, t, "user", f"{t}") for t in range(8)]
    for least in (20_000, 1):
        assert got(prefix_trie(frame(spark, rows), least_limit=least, shard_nodes=3)) == brute(conversations(rows))


def test_hot_turns_are_split(spark):
    rows = [(c, t, "user", "hot" if t == 0 or c % 3 == 0 else f"{c % 50}") for c in range(400) for t in range(3)]
    assert got(prefix_trie(frame(spark, rows), least_limit=20, shard_nodes=10)) == brute(conversations(rows))


def test_nothing(spark):
    found = prefix_trie(frame(spark, []))
    assert found.columns == COLUMNS and found.collect() == []
    assert got(prefix_trie(frame(spark, [(None, 1, "a", "b")]))) == []


def test_turnless_branches_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "only") for c in range(1, 5)]
    convs = branched(conversations(rows))
    assert any(not turns for turns in convs.values())
    assert got(prefix_trie(frame(spark, rows), *branch_columns())) == brute(convs)


def test_node_table():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, (5000, 2), dtype=np.uint64)
    table = NodeTable(keys)
    assert sorted(table.slots(keys)) == list(range(5000))
    others = rng.integers(0, 1 << 63, (5000, 2), dtype=np.uint64)
    others[:2500, 0] = keys[:2500, 0]
    assert (table.slots(others) == -1).all()
    assert len(NodeTable(keys[:0]).slots(keys)) == 5000 and (NodeTable(keys[:0]).slots(keys) == -1).all()
    with pytest.raises(ValueError, match="distinct"):
        NodeTable(np.concatenate([keys, keys[:1]]))


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.op11_prefix_trie(spark, folder)) == brute(branched(conversations(rows)))
