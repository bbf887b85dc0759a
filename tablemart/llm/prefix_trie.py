"""The prefix trie of conversations, in shards of balanced parentheses.

A turn is a digest of role and text, so no text moves. Conversations with equal paths become one row per
task; rows are range-sorted by path, and every task cuts its stretch of paths into shards. What two
shards can have in common lies on the path of the first or of the last conversation of a shard, its
spines: those nodes are merged by the hash of their path, every shard reads the merged counts back, and
sums over their subtrees are added up over the shards. All other nodes are whole in their shard.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tablemart.llm.parentheses import Parentheses, bits_of_paths, preorder_steps
from tablemart.storage import via_table

STEP = 16
#: Conversations that a task holds before it passes them on, and bytes of their paths.
HELD, HELD_BYTES = 100_000, 16 << 20
#: Nodes after which a shard is cut, at the next new path.
SHARD_NODES = 1 << 17
NOTHING = hashlib.sha256(b"").hexdigest()
PATH = "path binary, sizes binary, n long, least long, ids binary"
SPINE = "array<struct<node: long, key: binary, n: long, least: long, inner: boolean>>"
SHARD_COLUMNS = ["shard", "bits", "n_bits", "chars", "ends", "counts", "leasts", "hashes", "spine"]
SHARD = (
    "shard long, bits binary, n_bits long, chars binary, ends binary, counts binary, leasts binary, hashes binary, "
    f"spine {SPINE}"
)
NODE = (
    "key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def _conversations(batches):
    """base, conv_id, head, path, sizes (int64) of one conversation after another, across batches."""
    held = None
    for batch in batches:
        conv = batch["conv_id"].to_numpy(np.int64)
        sizes = batch["chars"].to_numpy(np.int64)
        digests = batch["digest"].tolist()
        bounds = [0, *(np.flatnonzero(np.diff(conv)) + 1).tolist(), len(conv)]
        for low, high in zip(bounds, bounds[1:]):
            if held and held[1] == conv[low]:
                held[3].extend(digests[low:high])
                held[4].append(sizes[low:high])
                continue
            if held:
                yield (*held[:3], b"".join(held[3]), np.concatenate(held[4]))
            held = (int(batch["base"].iloc[low]), int(conv[low]), int(batch["head"].iloc[low]), digests[low:high], [sizes[low:high]])
    if held:
        yield (*held[:3], b"".join(held[3]), np.concatenate(held[4]))


def _rebuilt(batches, most):
    """conv_id, path, sizes of rebuilt conversations, by rising conv_id within a task."""
    current, first, waiting = None, (b"", np.zeros(0, dtype=np.int64)), None
    for base, conv, head, path, sizes in _conversations(batches):
        if base != current:
            if waiting:
                yield waiting
            current, first, waiting = base, (b"", np.zeros(0, dtype=np.int64)), None
        if conv == base:
            # It comes first in its block, for the others to read its head.
            first, waiting = (path[: most * STEP], sizes[:most]), (conv, path, sizes)
            continue
        if waiting and conv > base:
            yield waiting
            waiting = None
        yield conv, first[0][: head * STEP] + path[head * STEP :], np.concatenate([first[1][:head], sizes[head:]])
    if waiting:
        yield waiting


def _paths(most):
    """Equal paths of a task as one row: how many, the smallest conv_id, and all of them, rising."""

    def paths(batches):
        held, count, weight = {}, 0, 0

        def flush():
            rows = [
                (path, sizes.tobytes(), len(ids), ids[0], np.array(ids, dtype=np.int64).tobytes())
                for path, (sizes, ids) in held.items()
            ]
            return pd.DataFrame(rows, columns=[c.split()[0] for c in PATH.split(", ")])

        for conv, path, sizes in _rebuilt(batches, most):
            if path not in held:
                held[path] = (sizes, [])
                weight += len(path)
            held[path][1].append(conv)
            count += 1
            if count >= HELD or weight >= HELD_BYTES:
                yield flush()
                held, count, weight = {}, 0, 0
        if held:
            yield flush()

    return paths


def conversation_paths(conversations, block=1, heads=1):
    """PATH rows: distinct sequences of turns with the conversations that have them."""
    conv = F.col("conv_id").cast("long")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # With the length of the role, so that no sign moves between role and text unseen.
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.filter(conv.isNotNull()).select(
        conv.alias("conv_id"), (conv - conv % block).alias("base"),
        (F.crc32(conv.cast("string").cast("binary")) % heads).alias("head"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * STEP)).alias("digest"), F.length(text).cast("long").alias("chars"),
    )
    dealt = turns.repartitionByRange("base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", F.asc_nulls_first("turn"), "digest"
    )
    return dealt.mapInPandas(_paths(heads - 1), PATH)


def _distinct(batches):
    """path, sizes, count, smallest conv_id, SHA-256 of all conv_ids, of one path after another."""
    path, held = None, None
    for batch in batches:
        for row in batch.itertuples():
            ids = ",".join(map(str, np.frombuffer(row.ids, np.int64).tolist())).encode()
            if row.path == path:
                held[2] += row.n
                held[4].update(b"," + ids)
                continue
            if held:
                yield row.part, held
            path = row.path
            held = [path, np.frombuffer(row.sizes, np.int64), row.n, row.least, hashlib.sha256(ids)]
            part = row.part
    if held:
        yield part, held


def _keys(path):
    """Hash of every prefix of a path, the empty one first."""
    state, out = hashlib.sha256(), []
    for low in range(0, len(path) + 1, STEP):
        out.append(state.digest())
        state.update(path[low : low + STEP])
    return out


def _common(left, right):
    """Steps that two paths share."""
    size = min(len(left), len(right)) // STEP * STEP
    if left[:size] == right[:size]:
        return size // STEP
    a, b = np.frombuffer(left, np.uint8, size), np.frombuffer(right, np.uint8, size)
    return int((a != b).argmax()) // STEP


class Shard:
    """The trie of some sorted distinct paths, and what ends at its nodes."""

    def __init__(self, bits, chars, ends, counts, leasts, hashes):
        self.tree = Parentheses(bits)
        self.bits, self.chars, self.ends = bits, chars, ends
        self.counts, self.leasts, self.hashes = counts, leasts, hashes

    @staticmethod
    def of_paths(held):
        sizes = np.array([len(h[0]) // STEP for h in held], dtype=np.int64)
        shared = np.array([0] + [_common(a[0], b[0]) for a, b in zip(held, held[1:])], dtype=np.int64)
        which, step = preorder_steps(sizes, shared)
        lows = np.cumsum(sizes) - sizes
        chars = np.concatenate([[0], np.concatenate([h[1] for h in held])[lows[which] + step]])
        return Shard(
            bits_of_paths(sizes, shared), chars, np.cumsum(sizes - shared),
            np.array([h[2] for h in held]), np.array([h[3] for h in held]), b"".join(h[4].digest() for h in held),
        )

    def members(self):
        """Per node: conversations below it, and the smallest of them."""
        count = np.zeros(len(self.chars), dtype=np.int64)
        least = np.full(len(self.chars), np.iinfo(np.int64).max)
        count[self.ends], least[self.ends] = self.counts, self.leasts
        return self.tree.subtree_sums(count), self.tree.subtree_least(least)

    def spine(self, first, last):
        """The nodes on the first and the last path, with the hash of their path and what is below."""
        count, least = self.members()
        left, right = _keys(first), _keys(last)
        keys = dict(enumerate(left))
        keys.update(zip(self.tree.ancestors(len(self.chars) - 1).tolist(), right))
        inner = ~self.tree.leaf_pairs()
        return [
            {"node": n, "key": k, "n": int(count[n]), "least": int(least[n]), "inner": bool(inner[n])}
            for n, k in keys.items()
        ]

    def packed(self):
        return (
            np.packbits(self.bits).tobytes(), len(self.bits), self.chars.tobytes(), self.ends.tobytes(),
            self.counts.tobytes(), self.leasts.tobytes(), self.hashes,
        )

    @staticmethod
    def unpacked(row):
        bits = np.unpackbits(np.frombuffer(row.bits, np.uint8), count=row.n_bits).astype(bool)
        numbers = [np.frombuffer(c, np.int64) for c in (row.chars, row.ends, row.counts, row.leasts)]
        return Shard(bits, *numbers, row.hashes)


def _shards(batches):
    held, nodes, number, part = [], 1, 0, 0

    def close():
        made = Shard.of_paths(held)
        row = (part << 32 | number, *made.packed(), made.spine(held[0][0], held[-1][0]))
        return pd.DataFrame([row], columns=SHARD_COLUMNS)

    for now, path in _distinct(batches):
        if nodes >= SHARD_NODES:
            yield close()
            held, nodes, number = [], 1, number + 1
        part = int(now)
        nodes += len(path[0]) // STEP - (_common(held[-1][0], path[0]) if held else 0)
        held.append(path)
    if held:
        yield close()


def _nodes(batches):
    """All nodes of each shard, with the merged counts of its spine nodes. Those have their hash as
    key, and children, leaves and savings as far as this shard is the one to count them."""
    for batch in batches:
        for row in batch.itertuples():
            shard = Shard.unpacked(row)
            tree, size = shard.tree, len(shard.chars)
            count, least = (v.copy() for v in shard.members())
            spine = np.array([s["node"] for s in row.merged], dtype=np.int64)
            count[spine], least[spine] = [s["n"] for s in row.merged], [s["least"] for s in row.merged]
            own, inner = np.ones(size, dtype=np.int64), np.zeros(size, dtype=bool)
            own[spine], inner[spine] = [s["own"] for s in row.merged], [s["inner"] for s in row.merged]
            parent = tree.parents()
            keys, ends = np.full(size, None, dtype=object), np.full(size, None, dtype=object)
            keys[spine] = [s["key"] for s in row.merged]
            hashes = shard.hashes.hex()
            ends[shard.ends] = [hashes[n : n + 64] for n in range(0, len(hashes), 64)]
            yield pd.DataFrame({
                "key": keys, "conv_id": least, "depth": tree.depth,
                "parent_conv_id": pd.array([None, *least[parent[1:]].tolist()], dtype="Int64"),
                "n_convs": count,
                "n_children": np.bincount(parent[1:], own[1:], size).astype(np.int64),
                "n_leaves": tree.subtree_sums((tree.leaf_pairs() & ~inner).astype(np.int64)),
                "saved_tokens": tree.subtree_sums((count - 1) * shard.chars * own), "ends_sha256": ends,
            })


def path_trie(paths):
    """The nodes of the trie of PATH rows."""
    paths = via_table(paths, "paths")
    dealt = paths.repartitionByRange("path").sortWithinPartitions("path", "least")
    shards = via_table(dealt.withColumn("part", F.spark_partition_id().cast("long")).mapInPandas(_shards, SHARD), "shards")
    spines = shards.select("shard", F.inline("spine"))
    merged = spines.groupBy("key").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.min("shard").alias("owner"), F.max("inner").alias("inner")
    )
    told = spines.select("shard", "node", "key").join(merged, "key").groupBy("shard").agg(F.collect_list(F.struct(
        "node", "key", "n", "least", "inner", (F.col("owner") == F.col("shard")).cast("long").alias("own")
    )).alias("merged"))
    nodes = via_table(shards.drop("spine").join(told, "shard").mapInPandas(_nodes, NODE), "nodes")
    same, added = ["conv_id", "depth", "parent_conv_id", "n_convs"], ["n_children", "n_leaves", "saved_tokens"]
    shared = nodes.filter("key is not null").groupBy("key").agg(
        *[F.max(c).alias(c) for c in same], *[F.sum(c).alias(c) for c in added], F.max("ends_sha256").alias("ends_sha256")
    )
    every = nodes.filter("key is null").unionByName(shared).drop("key")
    return every.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))


def conversation_trie(conversations, block=1, heads=1):
    """conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256 of every node of the prefix trie of conversations.

    Turns are ordered by turn (null first), equal ones by the hash of role and text; null role and text
    are empty. With `block` and `heads`, conversation c starts with the first h turns of c - c % block
    (h: crc32 of c as text, modulo heads) in place of its own first h. saved_tokens sums, over a
    subtree, members less one times the signs of a node's text; ends_sha256 is of the conv_ids that end
    at the node, rising, joined by commas. Rows without conv_id belong to no conversation and are left
    out; repeated rows are turns of their own; without conversations there are no nodes, not even a
    root; other columns are not looked at. One conversation's path, 24 bytes a turn, is held by one task.
    """
    return path_trie(conversation_paths(conversations, block, heads))
