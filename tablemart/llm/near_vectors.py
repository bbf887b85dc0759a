"""Near-duplicate vectors by spherical-cap filters: random product codes, listed per vector, joined."""

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tablemart.llm.components import components
from tablemart.llm.vectors import whole_vectors
from tablemart.storage import via_table

TABLES = 2
#: Share of pairs at the threshold, the hardest ones, that a height lets meet; closer pairs meet more often.
RECALL = 0.99
#: Random pairs that a height is fitted on. They follow from the seed alone; no data is looked at.
TRIALS = 400
BLOCK_ROWS = 1024
CAPS_AT_ONCE = 512
SEED = 20250101


class Caps:
    """Structured filter directions: one codeword of each half of a randomly turned vector.

    A table has 1024 * 1024 directions (32 * 32 below 32 components, 32 below 8). The list of a vector
    is decoded from its halves: codewords that cannot reach the height with the best of the other half
    are left out before halves are combined.
    """

    def __init__(self, width, table):
        rng = np.random.default_rng([SEED, width, table])
        self.turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
        self.words = []
        for cut in np.array_split(np.arange(width), 1 if width < 8 else 2):
            word = rng.standard_normal((32 if width < 32 else 1024, len(cut)))
            self.words.append((cut, word / np.linalg.norm(word, axis=1, keepdims=True)))

    def halves(self, units):
        """Inner products with the codewords of both halves; a narrow vector has an empty second half."""
        turned = units @ self.turn
        scores = [turned[:, cut] @ word.T for cut, word in self.words]
        return scores if len(scores) == 2 else [*scores, np.zeros((len(units), 1))]

    def codes(self, units, height):
        """Per vector, all directions whose inner product with it is at least the height."""
        for front, back in zip(*self.halves(units)):
            a = np.flatnonzero(front >= height - back.max())
            b = np.flatnonzero(back >= height - front.max())
            i, j = np.nonzero(front[a][:, None] + back[b][None, :] >= height)
            yield a[i] * back.size + b[j]

    def meeting(self, first, second, best=256):
        """Per pair, the largest height at which some direction holds both (sought among the best
        codewords of the pair, so it is never overstated)."""
        (front, back), (other_front, other_back) = self.halves(first), self.halves(second)
        for one, two, three, four in zip(front, other_front, back, other_back):
            a, b = np.argsort(-(one + two))[:best], np.argsort(-(three + four))[:best]
            yield np.minimum(one[a][:, None] + three[b], two[a][:, None] + four[b]).max()


@lru_cache(maxsize=64)
def filters(width, least):
    """The tables for vectors of a width and the one cap height all of them share: of TRIALS random pairs
    with cosine `least`, the share RECALL has a direction in some table that holds both."""
    tables = [Caps(width, table) for table in range(TABLES)]
    rng = np.random.default_rng([SEED, width])
    first, away = rng.standard_normal((2, TRIALS, width))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    away -= (away * first).sum(axis=1, keepdims=True) * first
    size = np.linalg.norm(away, axis=1, keepdims=True)
    # One component leaves no way to turn: the pair is equal then.
    second = least * first + np.sqrt(max(0.0, 1 - least * least)) * away / np.maximum(size, 1e-9)
    second /= np.linalg.norm(second, axis=1, keepdims=True)
    heights = np.max([list(table.meeting(first, second)) for table in tables], axis=0)
    # A hair lower, so that rounding does not decide about a pair of equal vectors.
    return tables, float(np.quantile(heights, 1 - RECALL, method="lower")) - 1e-9


def _units(vectors):
    points = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    points /= np.abs(points).max(axis=1, keepdims=True)
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def _list_caps(least):
    def listed(batches):
        for batch in batches:
            for width, rows in batch.groupby(batch["vector"].map(len)):
                units = _units(rows["vector"])
                tables, height = filters(width, least)
                for table, caps in enumerate(tables):
                    for low in range(0, len(rows), 256):
                        part = rows.iloc[low : low + 256]
                        found = list(caps.codes(units[low : low + 256], height))
                        repeat = [len(c) for c in found]
                        yield pd.DataFrame({
                            "rep": np.repeat(part["rep"].to_numpy(), repeat),
                            "area": np.repeat(part["area"].to_numpy(), repeat),
                            "cap": np.concatenate(found).astype(np.int64) * TABLES + table,
                        })

    return listed


def _reach(linked):
    """Smallest row index that each row reaches through links of a square matrix."""
    low = np.arange(len(linked))
    while True:
        near = np.where(linked, low[None, :], len(low)).min(axis=1)
        new = np.minimum(low, near)
        new = np.minimum(new, new[new])
        if (new == low).all():
            return low
        low = new


def _met_before(lists, left, right, cap):
    """Which rows of the left and of the right share a listed cap below `cap`."""
    sides = []
    for places in (left, right):
        own = [lists[place] for place in places]
        row, listed = np.repeat(np.arange(len(own)), [len(c) for c in own]), np.concatenate(own)
        sides.append((len(own), row[listed < cap], listed[listed < cap]))
    shared = np.intersect1d(sides[0][2], sides[1][2])
    met = np.zeros((len(left), len(right)), dtype=bool)
    for low in range(0, len(shared), CAPS_AT_ONCE):
        part, held = shared[low : low + CAPS_AT_ONCE], []
        for size, row, listed in sides:
            at = np.minimum(np.searchsorted(part, listed), len(part) - 1)
            here = part[at] == listed
            holds = np.zeros((size, len(part)), dtype=np.float32)
            holds[row[here], at[here]] = 1
            held.append(holds)
        met |= held[0] @ held[1].T > 0
    return met


ORDER = ["area", "cap", "first", "second"]


def _group_links(units, ids, copies, caps, left, right, cap, least):
    """(place, links, root) of the linked rows of two blocks of a cap, given in ascending ids. A pair
    counts in its first common cap only, its connection in every one."""
    linked = units[left] @ units[right].T >= least
    linked &= left[:, None] != right[None, :]
    if not linked.any():
        return None
    fresh = linked & ~_met_before(caps, left, right, cap)
    count = np.zeros(len(ids), dtype=np.int64)
    count[left] += (fresh * copies[right][None, :]).sum(axis=1)
    if left is not right:
        count[right] += (fresh * copies[left][:, None]).sum(axis=0)
    whole = np.zeros((len(ids), len(ids)), dtype=bool)
    whole[np.ix_(left, right)] = linked
    whole |= whole.T
    place = np.flatnonzero(whole.any(axis=1))
    return place, count[place], ids[_reach(whole)][place]


def _starts(rows):
    """Where the groups of sorted rows start."""
    new = np.zeros(len(rows), dtype=bool)
    new[:1] = True
    for name in ORDER:
        values = rows[name].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _verified(rows, starts, least):
    """Links of whole groups, given in the order of their keys and ids."""
    area, cap, first, second, block = (rows[n].to_numpy() for n in (*ORDER, "block"))
    ids, copies, caps = (rows[n].to_numpy() for n in ("rep", "copies", "caps"))
    found, units = [], None
    for low, high in zip(starts, [*starts[1:], len(rows)]):
        if units is None or area[low] != area[low - 1]:
            # Vectors of one area have one length.
            begin, end = low, low + int(np.argmin(np.append(area[low:] == area[low], False)))
            units = _units(rows["vector"].iloc[begin:end])
        if first[low] == second[low]:
            left = right = np.arange(high - low)
        else:
            left, right = (np.flatnonzero(block[low:high] == side) for side in (first[low], second[low]))
        got = _group_links(
            units[low - begin : high - begin], ids[low:high], copies[low:high], caps[low:high], left, right, cap[low], least
        )
        if got is not None:
            found.append((ids[low:high][got[0]], got[1], got[2]))
    columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
    return pd.DataFrame(dict(zip(("rep", "links", "root"), columns)))


def _verify(least):
    def check(batches):
        """Groups one after another; the last one of a batch waits, as it may go on in the next."""
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            starts = _starts(rows)
            if len(starts) > 1:
                yield _verified(rows.iloc[: starts[-1]], starts[:-1], least)
                rows = rows.iloc[starts[-1] :].reset_index(drop=True)
            held = rows
        if held is not None and len(held):
            yield _verified(held, np.array([0]), least)

    return check


def cap_links(groups, least):
    """(rep, links, root) rows of groups (rep, area, vector, copies): verified links found in a cap."""
    listed = via_table(groups.mapInPandas(_list_caps(least), "rep long, area string, cap long"), "caps")
    crowd = listed.groupBy("area", "cap").agg(F.count("*").alias("crowd")).filter("crowd > 1")
    shared = listed.join(crowd, ["area", "cap"])
    per_row = shared.groupBy("rep", "area").agg(
        F.array_sort(F.collect_list(F.struct("cap", "crowd"))).alias("listed")
    )
    rows = groups.join(per_row, ["rep", "area"]).withColumn("caps", F.col("listed.cap"))
    rows = rows.withColumn("at", F.explode("listed")).select(
        "rep", "area", "vector", "copies", "caps", F.col("at.cap").alias("cap"),
        F.ceil(F.col("at.crowd") / BLOCK_ROWS).cast("long").alias("blocks"),
    )
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    rows = rows.withColumn("block", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    rows = rows.withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))
    # Most caps hold two or three rows: a task takes many of them at a time, sorted, not one by one.
    return rows.repartition(*ORDER).sortWithinPartitions(*ORDER, "rep").mapInPandas(
        _verify(least), "rep long, links long, root long"
    )


def near_duplicate_vectors(frame, key="vec_id", vector="embedding", label="label", least=0.98):
    """One row per row of frame: key, n_links, component_id, kept.

    Vectors link when their labels are equal and their cosine in double precision is at least
    `least`; n_links counts the linked rows, component_id is the smallest key reachable, kept says
    that it is the row's own. Rows with null label, with a vector that is null, empty, zero or holds
    null, NaN or infinity, and rows without key link with nothing: n_links 0, own key. Equal vectors
    are folded into one before the search and all link; rows of one repeated key share their links.
    Only vectors of equal length meet. An empty frame gives no rows. Other columns are not looked at.

    Pairs come from common filters: every vector is listed in all caps it exceeds at one height, with no
    bound on the list. A pair can be missed (RECALL; the share is measured in the tests); none below the
    threshold is kept. Filters and heights are the same for every input; no data is fitted.
    """
    named = whole_vectors(frame.select(key, vector, label), key, vector, F.col(label).cast("string").alias("area"))
    named = named.filter(F.col("area").isNotNull() & F.exists("vector", lambda x: x != 0)).withColumn(
        "area", F.concat_ws(":", F.size("vector").cast("string"), "area")
    )
    groups = via_table(
        named.groupBy("area", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "groups"
    )
    found = via_table(cap_links(groups, least), "cap-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    reps = groups.join(links, "rep", "left").join(roots, groups["rep"] == roots["node"], "left").select(
        "area", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("component_id", "rep").alias("component_id"),
    )
    linked = named.join(reps, ["area", "vector"]).groupBy("id").agg(
        F.sum("links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    every = frame.select(F.col(key).cast("long").alias(key))
    own = F.coalesce(F.col("component_id"), F.col(key))
    return every.join(linked, F.col(key) == F.col("id"), "left").select(
        key, F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), own.alias("component_id"),
        F.coalesce(F.col(key) == own, F.lit(False)).alias("kept"),
    )
