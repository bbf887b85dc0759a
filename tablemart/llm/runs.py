"""Periodic runs of words by the branching-tandem test on an enhanced suffix array.

Every task makes the suffix array, its inverse and the LCP array of a group of whole documents; suffixes
are ranked within their own document. An LCP interval of depth d is split where its LCP values are d, and
of each two sides the smaller one is gone through: a suffix i whose partner i + d or i - d is on the other
side starts (or follows) a square of two d-word halves that ends where its run ends. Rotating a square to
the left, word by word, gives the run; squares inside a run of a smaller period with the same end add none.
Intervals are ranges found by minima of the LCP array, so no tree node is made.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tablemart.llm.arrays import RangeMin, spread
from tablemart.llm.tables import WORD, doc_rows, ids_as_numbers, ids_as_text

#: Documents are worked on together up to so many words; a longer one alone.
GROUP_WORDS = 1 << 17
PAIRS = 1 << 20
CELLS = 1 << 20
FOUND = (
    "doc_id string, n_words long, starts array<long>, lengths array<long>, periods array<long>, collapsed binary"
)


def suffix_order(names, lows, highs):
    """Slots of all suffixes by (document, words), and the ranks after 1, 2, 4, .. words.

    names: a number per word; lows, highs: bounds of the document of each word. Prefix doubling: only
    suffixes that are still equal to another are sorted again, by the rank of what follows.
    """
    size = len(names)
    keys = lows * (int(names.max()) + 1) + names
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    rank = np.empty(size, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(size), 0))
    ranks, width = [rank], 1
    slots = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(slots):
        members = order[slots]
        after = members + width
        # A document that ends comes first.
        second = np.where(after < highs[members], rank[np.minimum(after, size - 1)] + 1, 0)
        both = rank[members] * (size + 1) + second
        turn = np.argsort(both, kind="stable")
        members, both = members[turn], both[turn]
        order[slots] = members
        new = np.concatenate([[True], both[1:] != both[:-1]])
        rank = rank.copy()
        rank[members] = np.maximum.accumulate(np.where(new, slots, 0))
        ranks.append(rank)
        slots, width = slots[~(new & np.append(new[1:], True))], 2 * width
    return order, ranks


def common_prefixes(order, ranks, highs):
    """Words that each slot's suffix shares with the slot before; -1 before the first and behind the last."""
    before, own = order[:-1], order[1:]
    rows = np.flatnonzero(ranks[0][before] == ranks[0][own])
    x, y = before[rows], own[rows]
    shared = np.zeros(len(rows), dtype=np.int64)
    for level in reversed(range(len(ranks))):
        rank, a, b = ranks[level], x + shared, y + shared
        inside = (a < highs[x]) & (b < highs[y])
        same = inside & (rank[np.where(inside, a, 0)] == rank[np.where(inside, b, 0)])
        shared += same.astype(np.int64) << level
    out = np.zeros(len(order) + 1, dtype=np.int64)
    out[rows + 1] = shared
    out[0] = out[-1] = -1
    return out


def branching_squares(order, isa, lcp, lows, highs, exponent):
    """Start and half length of every square that ends with its run, for halves that fit `exponent`
    times into their document."""
    size = (highs - lows)[order]
    nodes = np.flatnonzero((lcp[1:-1] >= 1) & (exponent * lcp[1:-1] <= size[1:])) + 1
    if not len(nodes):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    depth, minima = lcp[nodes], RangeMin(lcp, int(size.max()))
    left, right = minima.last_at_most(nodes - 1, depth), minima.next_below(nodes + 1, depth)
    # The sides [left, node) and [node, right): the smaller is gone through, the other one looked into.
    smaller = nodes - left <= right - nodes
    low, high = np.where(smaller, left, nodes), np.where(smaller, nodes, right)
    other, above = np.where(smaller, nodes, left), np.where(smaller, right, nodes)
    counts, found = high - low, []
    cuts = np.searchsorted(np.cumsum(counts), np.arange(0, counts.sum() + PAIRS, PAIRS), side="left")
    for a, b in zip([0, *(cuts[1:-1] + 1)], [*(cuts[1:-1] + 1), len(nodes)]):
        which, slots = spread(low[a:b], counts[a:b])
        which, at = which + a, order[slots]
        half = depth[which]
        for partner, start in ((at + half, at), (at - half, at - half)):
            inside = (partner < highs[at]) & (partner >= lows[at])
            place = isa[np.where(inside, partner, 0)]
            hit = inside & (place >= other[which]) & (place < above[which])
            found.append((start[hit], half[hit]))
    return tuple(np.concatenate(f) for f in zip(*found))


def rotated(names, lows, starts, halves):
    """How far left each square can be rotated: the start of its run."""
    at, width, live = starts.copy(), 8, np.arange(len(starts))
    while len(live):
        going = []
        for low in range(0, len(live), max(1, CELLS // width)):
            rows = live[low : low + max(1, CELLS // width)]
            back = at[rows, None] - np.arange(1, width + 1)
            inside = back >= lows[starts[rows], None]
            back = np.where(inside, back, 0)
            same = inside & (names[back] == names[back + halves[rows, None]])
            full = same.all(axis=1)
            at[rows] -= np.where(full, width, same.argmin(axis=1))
            going.append(rows[full])
        live, width = np.concatenate(going), min(2 * width, CELLS)
    return at


def runs_of(names, lows, highs, exponent, least):
    """Start, end and smallest period of every run, by start and period."""
    order, ranks = suffix_order(names, lows, highs)
    isa = ranks[-1]
    starts, halves = branching_squares(order, isa, common_prefixes(order, ranks, highs), lows, highs, exponent)
    del ranks
    ends, found = starts + 2 * halves, [np.zeros((3, 0), dtype=np.int64)]
    turn = np.lexsort((halves, ends))
    starts, halves, ends = starts[turn], halves[turn], ends[turn]
    while len(ends):
        # Of the squares with one end, the shortest is its run's; those inside that run add nothing.
        first = np.concatenate([[True], ends[1:] != ends[:-1]])
        made = rotated(names, lows, starts[first], halves[first])
        found.append(np.stack([made, ends[first], halves[first]]))
        rest = ~first & (starts < made[np.cumsum(first) - 1])
        starts, halves, ends = starts[rest], halves[rest], ends[rest]
    start, end, period = np.concatenate(found, axis=1)
    kept = end - start >= np.maximum(least, exponent * period)
    start, end, period = start[kept], end[kept], period[kept]
    turn = np.lexsort((period, start))
    return start[turn], end[turn], period[turn]


def _group(docs, exponent, least):
    """Result rows of some documents: (id, words)."""
    sizes = np.array([len(words) for _, words in docs], dtype=np.int64)
    after = np.cumsum(sizes)
    before, total = after - sizes, int(sizes.sum())
    start = end = period = np.zeros(0, dtype=np.int64)
    gone = np.zeros(total, dtype=bool)
    if total:
        number = {}
        names = np.array([number.setdefault(w, len(number)) for _, words in docs for w in words], dtype=np.int64)
        start, end, period = runs_of(names, np.repeat(before, sizes), np.repeat(after, sizes), exponent, least)
        steps = np.bincount(start + period, minlength=total + 1) - np.bincount(end, minlength=total + 1)
        gone = np.cumsum(steps[:-1]) > 0
    cuts = np.searchsorted(start, [*before, total])
    rows = []
    for n, (doc, words) in enumerate(docs):
        low, part, drop = int(before[n]), slice(cuts[n], cuts[n + 1]), gone[before[n] : after[n]]
        if drop.any():
            words = [w for w, d in zip(words, drop.tolist()) if not d]
        rows.append((
            doc, int(sizes[n]), start[part] - low, end[part] - start[part], period[part], b" ".join(words),
        ))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in FOUND.split(", ")])


def find_runs(documents, exponent=4, least=6):
    """doc_id, n_words, runs (array of start, length, period, by start and period), collapsed of every row.

    Words are what stands between the six separators, numbered from 0. A run is a stretch of words with
    smallest period q, at least `least` words and `exponent` (2 or more) times q long, that no
    neighbouring word extends. collapsed is the text (binary) of the words that are left when each
    run keeps its first q words, joined by one space; a word goes if any run drops it. Null texts have
    no words. Null and repeated doc_ids keep their rows; an empty table gives no rows; other columns
    are not looked at. A document is one task's work and takes some hundred bytes a word there.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")

    def work(batches):
        for batch in batches:
            held, weight = [], 0
            for doc, text in zip(batch["doc_id"], batch["text"]):
                # Bytes split exactly at the six separators.
                held.append((doc, text.encode().split()))
                weight += len(held[-1][1])
                if weight >= GROUP_WORDS:
                    yield _group(held, exponent, least)
                    held, weight = [], 0
            if held:
                yield _group(held, exponent, least)

    made = ids_as_numbers(ids_as_text(doc_rows(documents)).mapInPandas(work, FOUND))
    zipped = F.arrays_zip(F.col("starts").alias("start"), F.col("lengths").alias("length"), F.col("periods").alias("period"))
    return made.select("doc_id", "n_words", zipped.alias("runs"), "collapsed")


def run_digest(documents, exponent=4, least=6):
    """doc_id, n_runs, start, length, period, exponent_milli (of the longest run; ties: smallest start,
    then period; null without runs), runs_sha256, collapsed_sha256."""
    found = find_runs(documents, exponent, least)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
    )))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def periodic_documents(documents):
    """The documents, every tenth of them (crc32 of the id as text divides by 10) made periodic: from
    word a on, its words repeat with period p, where a and p follow from the rest of the crc32 and
    the number of words. Texts so rebuilt have one space between words; rows without id stay."""
    code = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    chosen = F.coalesce(code % 10 == 0, F.lit(False))
    rows = doc_rows(documents).withColumn("g", F.floor(code / 10)).withColumn(
        "words", F.when(chosen, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    )
    rows = rows.withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.expr("CASE WHEN n > 0 THEN g % n END")).withColumn(
        "p", F.expr("1 + (n - a) div (3 + g % 8)")
    )
    rebuilt = F.expr(
        "array_join(transform(sequence(0L, n - 1L), i -> words[CAST(IF(i < a, i, a + (i - a) % p) AS INT)]), ' ')"
    )
    return rows.select("doc_id", F.when(F.col("n") > 0, rebuilt).otherwise(F.col("text")).alias("text"))
