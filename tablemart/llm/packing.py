"""Best-fit packing by linear grouping: a plan over the counts of lengths, then places for documents."""

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Window, functions as F

from tablemart.llm.encoder import encoder
from tablemart.llm.tables import doc_rows, ids_as_numbers, ids_as_text
from tablemart.operators.ranking import number_rows
from tablemart.storage import via_table

CAPACITY = 2048
#: Pieces up to this share of a sequence are small: they fill what the large ones leave.
SMALL = 1 / 8
GROUPS = 64
BATCH = 1000
PIECE = "doc_id string, piece int, start long, length long, ids_crc32 long"


def _pieces(path, end_id, capacity):
    """Ids of whole texts and the end id, cut where they are longer than a sequence."""
    tail = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        made = encoder(path)
        for batch in batches:
            for low in range(0, len(batch), BATCH):
                part, rows = batch.iloc[low : low + BATCH], []
                for doc, ids in zip(part["doc_id"], made.encode(part["text"].tolist())):
                    ids += tail
                    size = len(ids) // 4
                    first = size % capacity or min(size, capacity)
                    bounds = [0, *range(first, size + 1, capacity)]
                    rows += [
                        (doc, n, a, b - a, zlib.crc32(ids[4 * a : 4 * b]))
                        for n, (a, b) in enumerate(zip(bounds, bounds[1:]))
                    ]
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def token_pieces(documents, path, end_id=0, capacity=CAPACITY):
    """doc_id, piece, start, length, ids_crc32: the pieces of every document, the end id included.

    Null texts are empty: one piece with the end id alone. Only documents longer than `capacity` are
    cut; the first piece takes the remainder, all others are full.
    """
    return ids_as_numbers(ids_as_text(doc_rows(documents)).mapInPandas(_pieces(path, end_id, capacity), PIECE))


class _Plan:
    """Runs of equal pieces: (length, first rank, count, first sequence); rank and sequence rise
    together. Sequences are kept as ranges by the room they have left."""

    def __init__(self, capacity):
        self.capacity, self.sequences, self.runs, self.room = capacity, 0, [], {}

    def open(self, count):
        self.sequences += count
        return self.sequences - count

    def leave(self, room, first, count):
        if count and room:
            self.room.setdefault(room, []).append((first, count))


def _groups(counts, lengths):
    """Linear grouping: large pieces by falling length in groups of equal number, each as long as its
    longest. Returns the rounded size and the bounds (first rank, end rank) of each group."""
    amount = np.array([counts[v] for v in lengths])
    ends = np.cumsum(amount)
    cuts = np.unique(np.ceil(np.linspace(0, ends[-1], GROUPS + 1)).astype(np.int64))
    sizes = [int(lengths[np.searchsorted(ends, low, side="right")]) for low in cuts[:-1]]
    return sizes, cuts[:-1].tolist(), cuts[1:].tolist(), ends


def _configuration(sizes, left, capacity):
    """The fullest sequence of rounded sizes that holds the largest one left: pieces per group."""
    first = next(g for g, n in enumerate(left) if n)
    free = capacity - sizes[first]
    reached = np.zeros(free + 1, dtype=bool)
    reached[0] = True
    group = np.full(free + 1, -1)
    for g in range(first, len(sizes)):
        size, layer = sizes[g], reached.copy()
        for _ in range(min(left[g] - (g == first), free // size)):
            moved = np.zeros_like(layer)
            moved[size:] = layer[:-size] if size else layer
            layer = moved & ~reached
            if not layer.any():
                break
            reached |= layer
            group[layer] = g
        if reached[free]:
            break
    fill, used = int(np.flatnonzero(reached)[-1]), {first: 1}
    while fill:
        used[int(group[fill])] = used.get(int(group[fill]), 0) + 1
        fill -= sizes[group[fill]]
    return used


def _place_large(plan, counts, lengths):
    """Configurations as long as pieces are left; real pieces take the places of their group."""
    sizes, low, high, ends = _groups(counts, lengths)
    left, starts = [b - a for a, b in zip(low, high)], ends - np.array([counts[v] for v in lengths])
    while any(left):
        used = _configuration(sizes, left, plan.capacity)
        times = min(left[g] // n for g, n in used.items())
        first, bounds, slots = plan.open(times), {0, times}, []
        for g, n in used.items():
            for _ in range(n):
                rank = high[g] - left[g]
                left[g] -= times
                a, b = np.searchsorted(ends, [rank, rank + times - 1], side="right")
                bounds.update(int(e) - rank for e in ends[a:b])
                slots.append(rank)
        bounds = sorted(bounds)
        for a, b in zip(bounds, bounds[1:]):
            room = plan.capacity
            for rank in slots:
                k = int(np.searchsorted(ends, rank + a, side="right"))
                plan.runs.append((int(lengths[k]), int(rank + a - starts[k]), b - a, first + a))
                room -= int(lengths[k])
            plan.leave(room, first + a, b - a)


def _place_small(plan, length, count):
    """Best fit of equal pieces: the tightest room that holds one takes as many as fit, then the next."""
    rank = 0

    def fill(first, number, room):
        """Put up to room // length pieces into each of `number` sequences."""
        nonlocal rank
        each = room // length
        for size, per in ((min(number, (count - rank) // each), each), (1, (count - rank) % each)):
            if size and per and number:
                for _ in range(per):
                    plan.runs.append((length, rank, size, first))
                    rank += size
                plan.leave(room - per * length, first, size)
                first, number = first + size, number - size
        plan.leave(room, first, number)

    for room in sorted(r for r in plan.room if r >= length):
        for first, number in plan.room.pop(room):
            if rank < count:
                fill(first, number, room)
            else:
                plan.leave(room, first, number)
        if rank == count:
            return
    number = -(-(count - rank) // (plan.capacity // length))
    fill(plan.open(number), number, plan.capacity)


def plan_packing(counts, capacity=CAPACITY):
    """Runs (length, first rank, count, first sequence) and the number of sequences.

    counts: pieces per length; ranks count pieces of one length. Full pieces have a sequence each.
    The work depends on how many lengths there are, at most `capacity`, not on how many pieces.
    """
    plan, lengths = _Plan(capacity), sorted((v for v in counts if counts[v]), reverse=True)
    large = [v for v in lengths if capacity * SMALL < v < capacity]
    if counts.get(capacity):
        plan.runs.append((capacity, 0, counts[capacity], plan.open(counts[capacity])))
    if large:
        _place_large(plan, counts, np.array(large))
    for length in lengths:
        if length <= capacity * SMALL:
            _place_small(plan, length, counts[length])
    return plan.runs, plan.sequences


def _seats(runs, before):
    """sequence_id of numbered pieces: their run is found by length and rank."""
    table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 4)
    keys = table[:, 0] * 2**50 + table[:, 1]

    def seat(batches):
        for batch in batches:
            length = batch["length"].to_numpy(np.int64)
            rank = batch["number"].to_numpy(np.int64) - before[length]
            run = np.searchsorted(keys, length * 2**50 + rank, side="right") - 1
            batch["sequence_id"] = table[run, 3] + rank - table[run, 1]
            yield batch[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id"]]

    return seat


def pack_pieces(pieces, capacity=CAPACITY):
    """The pieces with sequence_id and offset, in as few sequences of `capacity` as the plan finds.

    pieces: doc_id, piece, start, length (1 to capacity), ids_crc32. What goes to the driver is one
    count per length. Pieces are numbered by one range sort over (length, doc_id, piece), which splits
    any frequent length; ties between equal rows are interchangeable. Offsets are running sums
    within a sequence, which holds `capacity` pieces at most. No pieces give no rows.
    """
    pieces = via_table(pieces, "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs, _ = plan_packing(counts, capacity)
    amounts = np.array([counts.get(v, 0) for v in range(capacity + 1)], dtype=np.int64)
    before = np.cumsum(amounts[::-1])[::-1] - amounts
    numbered = number_rows(pieces, (F.desc("length"), "doc_id", "piece", "start"), "number")
    seated = ids_as_numbers(ids_as_text(numbered).mapInPandas(_seats(runs, before), PIECE + ", sequence_id long"))
    earlier = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return seated.withColumn("offset", F.sum("length").over(earlier) - F.col("length"))


def pack_documents(documents, path, end_id=0, capacity=CAPACITY):
    """Pieces of all documents with their places: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. Null texts are empty; null and repeated doc_ids keep their rows; an empty
    table gives no rows; other columns are not looked at."""
    return pack_pieces(token_pieces(documents, path, end_id, capacity), capacity)
