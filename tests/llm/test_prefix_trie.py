"""The prefix trie against one built of all prefixes."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pagemill import lineage
from pagemill.llm import prefix_trie as trie, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes", "ends_sha256"]


def said(role, text):
    role, text = role or "", text or ""
    return f"{len(role.encode())}:{role}{text}", len(text.encode())


def ordered(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            key = hashlib.sha256(said(role, text)[0].encode()).digest()[:16]
            out[conv].append((turn is not None, turn or 0, key, said(role, text)))
    return {c: [t[-1] for t in sorted(turns)] for c, turns in out.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        base = c - int(np.fmod(c, 5))
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def nodes(convs):
    members, sizes = defaultdict(list), {(): 0}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            p = tuple(t[0] for t in turns[:d])
            members[p].append(c)
            if d:
                sizes[p] = turns[d - 1][1]
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(own) - 1) * sizes[p]
    out = []
    for p, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(own), len(p), parent, len(own), children.get(p, 0), leaves[p], saved[p], digest))
    return sorted(out, key=str)


def found(turns, **options):
    return sorted((tuple(r) for r in trie.prefix_trie(turns, **options).select(*COLUMNS).collect()), key=str)


def family(seed, n, depth=6, words=3):
    """Conversations that share turns at random depths, with copies and one hot beginning."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in rng.permutation(n).tolist():
        hot = c % 3 == 0
        for t in range(int(rng.integers(1, depth + 1))):
            text = "hello" if hot and t < 2 else "é" * int(rng.integers(1, words + 1))
            rows.append((c, t, ["user", "assistant"][t % 2], text))
    return rows


@pytest.mark.parametrize("rows, limits", [(60, (1, 1 << 20)), (60, (2, 3)), (250, (7, 1 << 20)), (250, (64, 40)), (250, (1 << 14, 1 << 17))])
def test_against_all_prefixes(spark, rows, limits):
    data = family(rows, rows)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert found(trie.sequences(df), block_rows=limits[0], block_turns=limits[1]) == nodes(ordered(data))
    built = trie.rebuilt(trie.sequences(df))
    assert found(built, block_rows=limits[0], block_turns=limits[1]) == nodes(rebuilt(ordered(data)))


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(lineage, "BROADCAST_ROWS", 0)
    data = family(9, 90)
    df = spark.createDataFrame(data, SCHEMA)
    assert found(trie.sequences(df), block_rows=4) == nodes(ordered(data))


def test_copies_over_many_blocks_end_in_one_hash(spark):
    """A conversation of which there are more copies than a block holds, and longer ones behind it."""
    data = [(c, t, "user", f"t{t}") for c in range(200, 320) for t in range(3 + (c > 300))]
    data += [(c, 0, "user", "t0") for c in range(40)]
    df = spark.createDataFrame(data, SCHEMA)
    assert found(trie.sequences(df), block_rows=6) == nodes(ordered(data))


def test_hard_rows(spark):
    data = [
        (0, None, "user", "first"), (0, 0, "user", None), (0, 0, "user", ""), (0, 0, None, "user"), (0, 5, "a", "b"),
        (1, 1, "", "x" * 300_000), (1, 2, "x", "y"), (1, 2, "", "xy"), (1, 2, "", "xy"), (2, 1, None, None),
        (None, 1, "user", "nobody"), (-3, 1, "user", "ü"), (-4, 0, "user", "ü"), (2**62, 1, "user", "big"), (2**62 + 1, 7, "user", "big"),
        (5, 1, "user", "1"), (7, 1, "user", "short"),
    ]
    df = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("z") for c in ("turns", "block", "key", "depth", "_family", "t")})
    for limits in ({}, {"block_rows": 1}, {"block_rows": 2}):
        assert found(trie.sequences(df), **limits) == nodes(ordered(data))
        assert found(trie.rebuilt(trie.sequences(df)), **limits) == nodes(rebuilt(ordered(data)))


def test_turnless_conversations_and_an_empty_table(spark):
    """A rebuilt conversation may have no turns: its family's first is absent and its own are cut."""
    lost = [c for c in range(1, 400) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 1][:30]
    data = [(c, 0, "user", "gone") for c in lost]
    built = trie.rebuilt(trie.sequences(spark.createDataFrame(data, SCHEMA)))
    want = nodes(rebuilt(ordered(data)))
    assert len(want) == 1 and want[0][5] == 1
    assert found(built) == want and found(built, block_rows=3) == want
    data += [(401, 0, "user", "x"), (400, 0, "user", "y"), (400, 1, "user", "z")]
    built = trie.rebuilt(trie.sequences(spark.createDataFrame(data, SCHEMA)))
    assert found(built, block_rows=4) == nodes(rebuilt(ordered(data)))
    assert found(trie.sequences(spark.createDataFrame([], SCHEMA))) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=40), st.integers(0, 7))
def test_searches_of_the_sparse_table(values, depth):
    values, table = np.array(values), trie.Sparse(np.array(values))
    at = np.arange(len(values))
    depths = np.full(len(values), depth)
    low = np.flatnonzero(values < depth)
    assert table.right(at, depths).tolist() == [min([x for x in low if x >= i], default=len(values)) for i in at]
    assert table.left(at, depths).tolist() == [max([x for x in low if x <= i], default=-1) for i in at]
    a, b = np.triu_indices(len(values))
    assert table.least(a, b).tolist() == [values[i : j + 1].min() for i, j in zip(a, b)]


def test_query_reads_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op11_prefix_trie(spark, sf_dir).withColumnRenamed("saved_tokens", "saved_bytes").select(*COLUMNS).collect()
    assert sorted((tuple(r) for r in got), key=str) == nodes(rebuilt(ordered(data)))
