"""Exact top-k by integer inner product: a ball tree per shard, searched best bound first."""

import numpy as np
import pandas as pd
from pyspark.sql import Window, functions as F

from tablemart.llm.tables import blocks_for
from tablemart.llm.vectors import pack, unpack, whole_vectors
from tablemart.storage import via_table

SHARD_ROWS = 4096
#: Beyond so many shards they grow, up to 16 times as many rows, before there are more of them.
SHARDS = 128
#: Bytes of the vectors, as doubles, of a shard and of a block of queries on average.
SHARD_BYTES = 32 << 20
BLOCK_BYTES = 256 << 10
BLOCK_ROWS = 512
#: Blocks that meet a tree in one task, blocks searched at once, and scores made at once.
BAND_BLOCKS = 512
BLOCKS_AT_ONCE = 8
SCORES_AT_ONCE = 1 << 18
#: A shard has at most about LEAVES leaves, of LEAF_ROWS rows at least.
LEAF_ROWS = 128
LEAVES = 64
#: The first round meets one shard, every later one this many times the shards met before.
ROUND = 15
TASKS = 2000
PACKED = "shard long, width int, blob binary"
FOUND = "query_id long, vec_id long, score long"
LONGEST = 2**63 - 1
NONE = -(2**63)


def _grid(vectors, scale):
    """floor(scale * x) as whole doubles."""
    return np.floor(float(scale) * np.stack([np.asarray(v, dtype=np.float64) for v in vectors]))


def _narrow(points):
    """The same whole numbers in the shortest type of three that holds them."""
    most = np.abs(points).max(initial=0)
    return points.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64)


def _lengths(points):
    with np.errstate(over="ignore"):
        return np.sqrt((points**2).sum(axis=1))


def _grow(points):
    """A ball tree over the rows: order of rows, and per node its range, children, centre and radius.

    A node is cut in two at the median of the coordinate that spreads most; equal rows may fall on
    both sides, which only costs bounds.
    """
    order, nodes, open_nodes = np.arange(len(points)), [], [(0, len(points), -1)]
    leaf = max(LEAF_ROWS, len(points) // LEAVES)
    while open_nodes:
        low, high, parent = open_nodes.pop()
        rows = points[order[low:high]]
        centre = rows.mean(axis=0)
        radius = float(_lengths(rows - centre).max())
        number = len(nodes)
        nodes.append([low, high, -1, -1, centre, radius])
        if parent >= 0:
            nodes[parent][2 if nodes[parent][2] < 0 else 3] = number
        if high - low > leaf and radius > 0:
            axis = int(np.argmax(rows.max(axis=0) - rows.min(axis=0)))
            middle = (high - low) // 2
            order[low:high] = order[low:high][np.argpartition(rows[:, axis], middle)]
            open_nodes += [(low, low + middle, number), (low + middle, high, number)]
    return order, nodes


def _pack_shard(scale):
    def build(key, rows):
        points, ids = _grid(rows["vector"], scale), rows["id"].to_numpy(np.int64)
        order, nodes = _grow(points)
        blob = pack(
            ids=ids[order], points=_narrow(points[order]), span=np.array([n[:4] for n in nodes], dtype=np.int64),
            centres=np.stack([n[4] for n in nodes]), radii=np.array([n[5] for n in nodes]), longest=_lengths(points).max(),
        )
        return pd.DataFrame({"shard": [key[0]], "width": [key[1]], "blob": [blob]})

    return build


def _pack_queries(scale):
    def build(key, rows):
        blob = pack(ids=rows["id"].to_numpy(np.int64), points=_narrow(_grid(rows["vector"], scale)),
                    floors=rows["floor"].to_numpy(np.int64))
        return pd.DataFrame({"shard": [key[0]], "width": [key[1]], "blob": [blob]})

    return build


def _number_type(reach):
    """The type in which inner products up to `reach`, and so all their partial sums, are exact; None
    if there is none."""
    return np.float32 if reach < 2.0**23 else np.float64 if reach < 2.0**52 else None


def _products(queries, points, number):
    """Inner products; without a number type by whole numbers of any length, held within a long."""
    if number:
        return queries @ points.T
    rows = [[int(x) for x in row] for row in points]
    return np.array([
        [max(-LONGEST, min(LONGEST, sum(a * b for a, b in zip(row, query)))) for row in rows]
        for query in ([int(x) for x in q] for q in queries)
    ], dtype=np.int64)


def _bounds(own, lengths, tree):
    """Node by query: upper bounds <q, centre> + |q| * radius, none above that of the parent node."""
    with np.errstate(all="ignore"):
        reach = tree["radii"][:, None] * lengths
        bounds = tree["centres"] @ own.T + reach
        bounds += 1e-9 * (_lengths(tree["centres"])[:, None] * lengths + reach) + 1e-6
    # What is too large for a double bounds nothing; no score is below -LONGEST.
    bounds = np.where(np.isnan(bounds), np.inf, np.maximum(bounds, float(NONE)))
    for node, (left, right) in enumerate(tree["span"][:, 2:]):
        if left >= 0:
            bounds[[left, right]] = np.minimum(bounds[[left, right]], bounds[node])
    return bounds


class _Best:
    """The k best rows so far of each query of a block: scores falling, of equal ones the smaller id first."""

    def __init__(self, queries, k):
        self.own, self.k = queries["ids"], k
        self.scores = np.full((len(self.own), k), NONE, dtype=np.int64)
        self.ids = np.full((len(self.own), k), LONGEST, dtype=np.int64)
        self.least = queries["floors"].copy()

    def take(self, rows, scores, ids):
        """Scores (row by candidate) of the queries in `rows` with the candidates `ids`."""
        limit = self.least[rows]
        if (limit == -LONGEST).any() and len(ids) > self.k:
            # Nothing is known yet: of these candidates only the best k can count.
            lowest = -np.inf if scores.dtype.kind == "f" else NONE
            scores = np.where(ids[None, :] == self.own[rows][:, None], lowest, scores)
            place = len(ids) - self.k
            limit = np.maximum(limit, np.partition(scores, place, axis=1)[:, place])
        at = np.flatnonzero(scores >= limit.astype(scores.dtype)[:, None])
        if not len(at):
            return
        query, ids, scores = rows[at // len(ids)], ids[at % len(ids)], scores.ravel()[at]
        fresh = (ids != self.own[query]) & (scores > NONE)
        fresh &= (scores > self.scores[query, -1]) | (ids < self.ids[query, -1])
        if fresh.any():
            self._merge(query[fresh], scores[fresh].astype(np.int64), ids[fresh])

    def _merge(self, query, scores, ids):
        met = np.unique(query)
        query = np.concatenate([np.repeat(met, self.k), query])
        scores = np.concatenate([self.scores[met].ravel(), scores])
        ids = np.concatenate([self.ids[met].ravel(), ids])
        order = np.lexsort((ids, ~scores, query))
        # Every query met has k rows at least, as it had k before.
        first = np.searchsorted(query[order], met)
        kept = order[first[:, None] + np.arange(self.k)]
        self.scores[met], self.ids[met] = scores[kept], ids[kept]
        self.least[met] = np.maximum(self.least[met], self.scores[met, -1])


def search_block(queries, shard, k):
    """Best k rows of one shard for each query of one block: a frame of query_id, vec_id, score.

    queries: ids, points, floors (a score that k rows elsewhere reach already). Every query visits the
    leaves by falling upper bound: the first, then the next 3, 12, 48 and so on, each time only those whose
    bound is not below its k-th score so far. The queries that visit a leaf in one turn are multiplied
    with it at once. Rows below the floor are not returned.
    """
    own = queries["points"].astype(np.float64)
    lengths = _lengths(own)
    number = _number_type(lengths.max(initial=0) * shard["longest"])
    leaves = np.flatnonzero(shard["span"][:, 2] < 0)
    bounds = _bounds(own, lengths, shard)[leaves]
    turns = np.searchsorted(4 ** np.arange(16), np.arange(len(leaves)), side="right").astype(np.int8)
    turn = np.empty(bounds.shape, dtype=np.int8)
    np.put_along_axis(turn, np.argsort(-bounds, axis=0), turns[:, None], axis=0)
    points = shard["points"] if number is None else shard["points"].astype(number)
    own = own if number is None else own.astype(number)
    best = _Best(queries, k)
    for now in range(turns[-1] + 1):
        for n, (begin, end) in enumerate(shard["span"][leaves, :2]):
            rows = np.flatnonzero((turn[n] == now) & (bounds[n] >= best.least))
            step = max(1, SCORES_AT_ONCE // (end - begin))
            for part in (rows[i : i + step] for i in range(0, len(rows), step)):
                best.take(part, _products(own[part], points[begin:end], number), shard["ids"][begin:end])
    row, place = np.nonzero((best.scores > NONE) & (best.scores >= queries["floors"][:, None]))
    found = {"query_id": queries["ids"][row], "vec_id": best.ids[row, place], "score": best.scores[row, place]}
    return pd.DataFrame(found, dtype=np.int64)


def _searcher(k):
    def search(trees, blocks):
        found = [pd.DataFrame(columns=["query_id", "vec_id", "score"], dtype=np.int64)]
        if len(trees):
            tree = dict(unpack(trees["blob"].iloc[0]))
            for low in range(0, len(blocks), BLOCKS_AT_ONCE):
                parts = [unpack(blob) for blob in blocks["blob"].iloc[low : low + BLOCKS_AT_ONCE]]
                queries = {name: np.concatenate([p[name] for p in parts]) for name in ("ids", "points", "floors")}
                found.append(search_block(queries, tree, k))
        return pd.concat(found, ignore_index=True)

    return search


def _best(found, k):
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _searched(blocks, trees, k, tasks):
    """Every band of blocks (shard, width, band, blob) against the tree of its shard, found once a band."""
    keys = ["shard", "width", "band"]
    sides = (side.repartition(tasks, *keys).groupBy(*keys) for side in (trees, blocks))
    return next(sides).cogroup(next(sides)).applyInPandas(_searcher(k), FOUND)


def _shards_for(rows, doubles, shard_rows):
    """How many shards: of shard_rows rows as long as they are few, none of more than SHARD_BYTES on average."""
    few = blocks_for(rows, shard_rows)
    return max(min(few, SHARDS), blocks_for(rows, 16 * shard_rows), blocks_for(8 * doubles, SHARD_BYTES))


def top_k(vectors, queries, key="vec_id", vector="embedding", k=5, scale=256, shard_rows=SHARD_ROWS):
    """query_id, rank, vec_id, score: for each query the k rows with the highest inner product.

    Components are floor(scale * x) with x as double, scores whole numbers (held within the range of
    a long), ties go to the smaller id. Rows that carry the query's own id are no candidates. Null
    ids and vectors that are null or hold null, NaN or infinity take no part; only vectors of equal
    length meet. Repeated ids are candidates row by row; a query id given more than once is searched
    with its smallest vector. No rows, no queries: no rows out. Other columns are not looked at.

    Candidates are hashed into shards of about shard_rows (more rows when shards are many), each stored
    once with its ball tree. Blocks of queries meet one shard first, then 15 more, then 15 times as many as
    before, until they have met all. The k-th scores of the rounds so far go with the blocks, and whole
    subtrees fall below them. A shard meets the blocks band by band: a task holds one tree and one band,
    whatever the number of vectors, and each (band, shard) can be redone on any executor.
    """
    rows = whole_vectors(vectors, key, vector).withColumn("width", F.size("vector")).filter("width > 0")
    asked = whole_vectors(queries, key, vector).groupBy("id").agg(F.min("vector").alias("vector"))
    asked = via_table(asked.withColumn("width", F.size("vector")).filter("width > 0"), "asked")
    size = F.count("*"), F.sum(F.col("width").cast("long"))
    total, doubles = rows.agg(*size).first()
    shards = _shards_for(total, doubles or 0, shard_rows)
    trees = via_table(
        rows.withColumn("shard", F.pmod(F.xxhash64("id", "vector", F.lit(7)), F.lit(shards)))
        .repartition(min(shards, TASKS), "shard", "width")
        .groupBy("shard", "width").applyInPandas(_pack_shard(scale), PACKED), "trees",
    )
    total, doubles = asked.agg(*size).first()
    blocks = max(blocks_for(total, BLOCK_ROWS), blocks_for(8 * (doubles or 0), BLOCK_BYTES))
    bands = blocks_for(blocks, BAND_BLOCKS)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    trees = trees.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))))

    def met(floors, low, high):
        """What the blocks find in the shards `low` to `high` after their own, with the floors known so far."""
        known = asked.withColumn("floor", F.lit(-LONGEST)) if floors is None else (
            asked.join(floors, asked["id"] == floors["query_id"], "left")
            .withColumn("floor", F.coalesce("floor", F.lit(-LONGEST)))
        )
        made = known.groupBy("block", "width").applyInPandas(_pack_queries(scale), PACKED)
        made = made.withColumn("step", F.explode(F.sequence(F.lit(low), F.lit(high - 1)))).select(
            F.pmod(F.col("shard") + F.col("step"), F.lit(shards)).alias("shard"), "width",
            F.floor(F.col("shard") / BAND_BLOCKS).cast("int").alias("band"), "blob",
        )
        return _searched(made, trees, k, min(shards * bands, TASKS))

    found, low = _best(met(None, 0, 1), k), 1
    while low < shards:
        seeds = via_table(found.drop("rank"), "seeds")
        floors = seeds.groupBy("query_id").agg(
            F.when(F.count("*") >= k, F.min("score")).otherwise(-LONGEST).alias("floor")
        )
        high = min(shards, (ROUND + 1) * low)
        found, low = _best(met(floors, low, high).unionByName(seeds), k), high
    return found.select("query_id", "rank", "vec_id", "score")
