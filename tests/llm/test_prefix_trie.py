"""The conversation trie against plain dictionaries."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tablemart.llm import prefix_trie as module
from tablemart.llm.parentheses import Parentheses, bits_of_paths
from tablemart.llm.prefix_trie import conversation_trie


def nodes_by_loops(paths):
    """paths: {conv_id: turns}."""
    nodes = {}
    for conv, turns in sorted(paths.items()):
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(conv)
    out = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[: len(node)] == node]
        ends = [str(c) for c in members if len(paths[c]) == len(node)]
        out.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members),
            sum(len(n) == len(node) + 1 for n in below),
            sum(not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below) for n in below),
            sum((len(nodes[n]) - 1) * len(n[-1][1]) for n in below if n), hashlib.sha256(",".join(ends).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def rebuilt(rows, block=100, heads=6):
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            own.setdefault(conv, []).append((role or "", text or ""))
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % heads
        base = conv - (abs(conv) % block) * (1 if conv >= 0 else -1)
        out[conv] = own.get(base, [])[:h] + turns[h:]
    return out


@settings(max_examples=150, deadline=None)
@given(st.sets(st.lists(st.integers(0, 2), max_size=7).map(tuple), min_size=1, max_size=40))
def test_parentheses(paths):
    paths = sorted(paths)
    shared = [0] + [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(paths, paths[1:])]
    tree = Parentheses(bits_of_paths(np.array([len(p) for p in paths]), np.array(shared)))
    nodes = sorted({p[:d] for p in paths for d in range(len(p) + 1)})
    assert tree.depth.tolist() == [len(n) for n in nodes]
    assert tree.after.tolist() == [i + sum(m[: len(n)] == n for m in nodes) for i, n in enumerate(nodes)]
    assert tree.parents().tolist() == [nodes.index(n[:-1]) if n else -1 for n in nodes]
    assert tree.leaf_pairs().tolist() == [not any(m != n and m[: len(n)] == n for m in nodes) for n in nodes]
    assert tree.ancestors(len(nodes) - 1).tolist() == [nodes.index(nodes[-1][:d]) for d in range(len(nodes[-1]) + 1)]


def test_long_parentheses():
    """A chain deeper than many blocks, and a root with very many children."""
    for sizes, shared in (([5000], [0]), ([1] * 5000, [0] * 5000)):
        tree = Parentheses(bits_of_paths(np.array(sizes), np.array(shared)))
        assert tree.after.tolist() == ([5001] * 5001 if len(sizes) == 1 else [5001, *range(2, 5002)])
        assert tree.parents().tolist() == ([*range(-1, 5000)] if len(sizes) == 1 else [-1, *[0] * 5000])


def odd_rows():
    rng, rows = random.Random(6), []
    for conv in [*range(0, 60), *range(-30, 0, 3), *range(-140, -90), 100, 101, 205, 300, 2**53 + 1, 2**53 + 3]:
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, turn if turn or rng.random() < 0.7 else None, rng.choice(["user", None, "u"]), rng.choice(["hi", "ser", "", None, "é中😀"])))
    rows += [(c, 0, "user", "hello") for c in range(400, 460)]
    rows += [(None, 1, "user", "lost"), (None, None, None, None)]
    rows += [(500, t, "user", f"t{t}") for t in range(3000)] + [(501, t, "user", f"t{t}") for t in range(2990)]
    return rows


@pytest.mark.parametrize("shard, held", [(1, 3), (7, 10**6), (1 << 17, 10**6)])
def test_nodes_against_loops(spark, monkeypatch, shard, held):
    monkeypatch.setattr(module, "SHARD_NODES", shard)
    monkeypatch.setattr(module, "HELD", held)
    rows = [r for r in odd_rows() if r[0] is None or r[0] not in (500, 501)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS base", "'x' AS path", "2 AS n", "3 AS depth"
    ).repartition(4)
    got = sorted((tuple(r) for r in conversation_trie(frame, 100, 6).collect()), key=str)
    assert got == nodes_by_loops(rebuilt(rows))
    plain = sorted((tuple(r) for r in conversation_trie(frame).collect()), key=str)
    assert plain == nodes_by_loops(rebuilt(rows, 1, 1))


def test_deep_conversations(spark, monkeypatch):
    monkeypatch.setattr(module, "SHARD_NODES", 500)
    rows = [r for r in odd_rows() if r[0] in (500, 501)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["depth"]): r for r in conversation_trie(frame).collect()}
    assert len(got) == 3001 and got[500, 0]["n_leaves"] == 1 and got[500, 2990]["n_convs"] == 2
    assert got[500, 0]["saved_tokens"] == sum(len(f"t{t}") for t in range(2990))


def test_no_conversations(spark):
    frame = spark.createDataFrame([(None, 1, "a", "b")], "conv_id long, turn long, role string, text string")
    assert conversation_trie(frame).count() == 0
    assert conversation_trie(frame.limit(0), 100, 6).count() == 0
