"""Exact top-k and near-duplicate vectors against all pairs."""

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from tablemart.llm import near_vectors, topk
from tablemart.llm.components import components
from tablemart.llm.near_vectors import near_duplicate_vectors
from tablemart.llm.topk import top_k
from tablemart.llm.vectors import unpack

ODD = [
    (1, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 2), (4, None, 1), (5, [0.0, 0.0, 0.0], 1),
    (6, [1.0, None, 0.0], 1), (7, [float("nan"), 1.0, 0.0], 1), (8, [float("inf"), 1.0, 0.0], 1), (9, [1.0, 0.0, 0.0], None),
    (None, [1.0, 0.0, 0.0], 1), (10, [1.0, 0.0], 1), (11, [], 1), (12, [1.0, 0.1, 0.0], 1), (13, [0.0, 1.0, 0.0], 1),
    (1, [1.0, 0.0, 0.0], 1), (50, [1.0, 0.0, 0.0], 1), (14, [1e30, 1e30, 0.0], 3),
]


def odd(spark):
    frame = spark.createDataFrame(ODD, "vec_id long, embedding array<double>, label int")
    return frame.selectExpr("*", "vec_id AS id", "label AS rep", "embedding AS vector", "label AS shard")


def test_top_k_against_all_pairs(embeddings):
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in top_k(embeddings, embeddings.filter("vec_id % 50 = 0"), shard_rows=60).collect()}
    rows = embeddings.collect()
    ids = np.array([r["vec_id"] for r in rows])
    points = np.floor(256 * np.array([r["embedding"] for r in rows], dtype=np.float64)).astype(np.int64)
    want = {}
    for q in np.flatnonzero(ids % 50 == 0):
        scores = points @ points[q]
        order = [n for n in np.lexsort((ids, -scores)) if ids[n] != ids[q]][:5]
        want |= {(int(ids[q]), k + 1): (int(ids[n]), int(scores[n])) for k, n in enumerate(order)}
    assert got == want


def test_top_k_of_odd_rows(spark):
    frame = odd(spark)
    rows = top_k(frame, frame.filter("vec_id in (1, 10, 4, 14)"), k=4).collect()
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows}
    assert [got[1, n][0] for n in (1, 2, 3, 4)] == [14, 2, 3, 9]  # ties go to the smaller id; own id is out
    assert got[1, 1][1] > 2**60 and (10, 1) not in got and (4, 1) not in got
    assert got[14, 1] == (1, 2**63 - 1)  # scores beyond a long are held, and tie
    assert top_k(frame.limit(0), frame, k=3).count() == 0
    assert top_k(frame, frame.limit(0), k=3).count() == 0


def best_of_all(ids, points, asked, floors, k):
    """The k best rows of each query, from whole numbers of any length."""
    want = []
    for (own, query), floor in zip(asked, floors):
        scores = [max(1 - 2**63, min(2**63 - 1, sum(a * b for a, b in zip(row, query)))) for row in points]
        found = sorted((-score, i) for i, score in zip(ids, scores) if i != own)[:k]
        want += [(own, i, -score) for score, i in found if -score >= floor]
    return sorted(want)


@pytest.mark.parametrize("size", [2, 300, 2**22, 2**40])
def test_search_of_a_shard_with_ties_and_long_numbers(size):
    rng = np.random.default_rng(size)
    points = rng.integers(-size, size, (700, 6), endpoint=True).astype(np.float64)
    points[100:400] = points[100]  # a common vector: its ties go to the smaller ids
    ids = rng.permutation(690)[np.arange(700) % 690]  # ten ids are given twice
    shard = dict(unpack(topk._pack_shard(1)((0, 6), pd.DataFrame({"id": ids, "vector": list(points)}))["blob"][0]))
    asked = [*range(90, 130), 695]
    floors = np.where(np.arange(41) % 3, -topk.LONGEST, 2 * size**2 if size < 2**30 else 2**62)
    queries = {"ids": ids[asked], "points": points[asked], "floors": floors}
    got = topk.search_block(queries, shard, 5)
    whole = [[int(x) for x in row] for row in points]
    want = best_of_all(ids.tolist(), whole, [(int(ids[n]), whole[n]) for n in asked], floors.tolist(), 5)
    assert sorted(got.itertuples(index=False, name=None)) == want


def test_queries_meet_a_leaf_together(monkeypatch):
    rng = np.random.default_rng(1)
    points, ids, calls, products = rng.integers(-99, 99, (2000, 16)).astype(np.float64), np.arange(2000), [], topk._products
    shard = dict(unpack(topk._pack_shard(1)((0, 16), pd.DataFrame({"id": ids, "vector": list(points)}))["blob"][0]))
    monkeypatch.setattr(topk, "_products", lambda *args: calls.append(1) or products(*args))
    queries = {"ids": ids[:400], "points": points[:400], "floors": np.full(400, -topk.LONGEST)}
    assert len(topk.search_block(queries, shard, 5)) == 2000 and len(calls) < 100  # one by one: over 400


def test_top_k_hands_over_one_tree_and_one_band_at_a_time(embeddings, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 2)
    monkeypatch.setattr(topk, "BAND_BLOCKS", 2)
    searcher = topk._searcher

    def watched(k):
        search = searcher(k)

        def one_band(trees, blocks):
            assert len(trees) <= 1 and len(blocks) <= 2
            return search(trees, blocks)

        return one_band

    monkeypatch.setattr(topk, "_searcher", watched)
    # 25 shards: the blocks meet 1 of them, then 15, then the rest.
    got = top_k(embeddings, embeddings.filter("vec_id % 25 = 0"), shard_rows=20).collect()
    rows = embeddings.collect()
    points = np.floor(256 * np.array([r["embedding"] for r in rows], dtype=np.float64)).astype(np.int64).tolist()
    ids = [r["vec_id"] for r in rows]
    asked = [(i, p) for i, p in zip(ids, points) if i % 25 == 0]
    want = best_of_all(ids, points, asked, [-topk.LONGEST] * len(asked), 5)
    assert sorted((r["query_id"], r["vec_id"], r["score"]) for r in got) == want
    assert all(r["rank"] in range(1, 6) for r in got) and len(got) == 5 * len(asked) > 50


def test_shards_of_top_k_stay_bounded():
    shards = topk._shards_for
    assert [shards(n, 64 * n, 4096) for n in (0, 1, 4097, 500_000, 600_000)] == [1, 1, 2, 123, 128]
    for rows, width in ((10**6, 64), (16 * 10**6, 64), (10**9, 64), (10**7, 4096), (300, 10**6)):
        number = shards(rows, rows * width, 4096)
        assert rows <= 16 * 4096 * number and 8 * rows * width <= topk.SHARD_BYTES * number


def brute(rows, least=0.98):
    links = {}
    for label in {r["label"] for r in rows}:
        own = [r for r in rows if r["label"] == label]
        units = np.array([r["embedding"] for r in own], dtype=np.float64)
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        near = units @ units.T >= least
        np.fill_diagonal(near, False)
        links |= {r["vec_id"]: {own[n]["vec_id"] for n in np.flatnonzero(row)} for r, row in zip(own, near)}
    return links


def test_near_vectors_recall_and_no_false_links(spark, embeddings, monkeypatch):
    monkeypatch.setattr(near_vectors, "BLOCK_ROWS", 20)
    rng = np.random.default_rng(2)
    rows = [(int(n), rng.normal(size=64).tolist(), int(n % 3)) for n in range(300)]
    for n in range(150):
        base = np.array(rows[n % 5][1])
        near = base + rng.normal(size=64) * rng.choice((0.0, 0.05, 0.1, 0.14))
        rows.append((1000 + n, near.tolist(), rows[n % 5][2]))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for data in (frame, embeddings):
        want = brute(data.collect())
        got = {r["vec_id"]: r for r in near_duplicate_vectors(data).collect()}
        assert set(got) == set(want)
        assert all(got[k]["n_links"] <= len(v) for k, v in want.items())
        found, there = sum(r["n_links"] for r in got.values()), sum(map(len, want.values()))
        assert found >= 0.9 * there
        print("recall", found, "of", there)
        if found == there:
            low = {k: k for k in want}
            for _ in range(len(want)):
                low, old = {k: min([low[k], *[low[o] for o in v]]) for k, v in want.items()}, low
                if low == old:
                    break
            assert {k: r["component_id"] for k, r in got.items()} == low
            assert all(r["kept"] == (k == r["component_id"]) for k, r in got.items())


def test_lists_hold_every_direction_above_the_height():
    rng = np.random.default_rng(7)
    for width in (1, 3, 8, 40):
        tables, height = near_vectors.filters(width, 0.98)
        units = near_vectors._units(rng.normal(size=(20, width)))
        for table in tables:
            front, back = table.halves(units)
            every = (front[:, :, None] + back[:, None, :]).reshape(len(units), -1)
            for sums, found in zip(every, table.codes(units, height)):
                assert found.tolist() == np.flatnonzero(sums >= height).tolist()


def test_height_keeps_its_recall_on_fresh_pairs():
    rng = np.random.default_rng(8)
    for width in (8, 64, 256):
        tables, height = near_vectors.filters(width, 0.98)
        first, away = rng.normal(size=(2, 300, width))
        first = near_vectors._units(first)
        away = near_vectors._units(away - (away * first).sum(axis=1, keepdims=True) * first)
        second = 0.98 * first + np.sqrt(1 - 0.98**2) * away
        met = np.zeros(300, dtype=bool)
        for table in tables:
            lists = zip(table.codes(first, height), table.codes(second, height))
            met |= [len(np.intersect1d(a, b)) > 0 for a, b in lists]
        assert met.mean() >= 0.96


def test_pairs_met_in_an_earlier_cap():
    lists = [np.array(c, dtype=np.int64) for c in ([1, 5, 9], [5, 9], [2, 9], [1, 2, 9], [9])]
    met = near_vectors._met_before(lists, np.array([0, 1, 2]), np.array([2, 3, 4]), 9)
    assert met.tolist() == [[False, True, False], [False, False, False], [True, True, False]]


def test_near_vectors_of_odd_rows(spark):
    frame = odd(spark)
    got = near_duplicate_vectors(frame).collect()
    assert len(got) == len(ODD)
    by_id = {r["vec_id"]: r for r in got}
    for alone in (3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14):
        assert (by_id[alone]["n_links"], by_id[alone]["component_id"], by_id[alone]["kept"]) == (0, alone, True)
    assert by_id[None]["n_links"] == 0 and not by_id[None]["kept"]
    assert by_id[2]["component_id"] == by_id[12]["component_id"] == by_id[50]["component_id"] == 1
    assert near_duplicate_vectors(frame.limit(0)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(-60, 60, (70, 2))] + [(n, n + 1) for n in range(100, 160)] + [(5, 5)]
    low = {k: k for p in pairs for k in p}
    for _ in range(len(low)):
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    linked = {k for a, b in pairs if a != b for k in (a, b)}
    frame = spark.createDataFrame(pairs, "a long, b long")
    assert {r["node"]: r["component_id"] for r in components(frame).collect()} == {k: low[k] for k in linked}
    assert components(frame.filter(F.lit(False))).count() == 0
