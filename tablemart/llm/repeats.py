"""Repeated windows of documents: whole copies first, then sampled names, then the windows around
repeated samples.

A copy of a whole earlier text has no other result than to go, and nothing else can be found in it that
is not found in that text, so copies are folded before anything is sampled. Both substring operators share this exchange; they differ in their units (bytes or words) and in the
places they sample. Every window that occurs twice must hold samples of equal name at equal places,
which a difference cover guarantees for bytes and a minimal seed for words.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tablemart.llm.blocks import JSON_TIMES, Block, TextBlocks, answered, answers_of, asked, bucket_count, pack_sorted
from tablemart.llm.blocks import unpack_sorted, with_answers

RESULT = "doc_id long, units long, n_removed long, n_spans long, kept_sha256 string, kept binary, extra string"


class Units:
    """The windows of one block. Subclasses set `owner` (document of each unit), `window`, and say
    where samples are, which windows a repeated sample makes candidates, and what is kept."""

    def sampled(self):
        """Names of the samples."""
        raise NotImplementedError

    def candidates(self, repeated):
        """Starts of the windows that may repeat, rising."""
        raise NotImplementedError

    def named(self, starts):
        """Names of the windows at these starts."""
        raise NotImplementedError

    def kept(self, document, removed):
        """Bytes that are left of a document."""
        raise NotImplementedError


def _short(names, buckets):
    """Bucket and the low 32 bits of what identifies a name in it: samples only filter, so names
    that fall together by chance (one in thousands, at any size) cost a little work and no result."""
    bucket = names % np.uint64(buckets)
    return bucket << np.uint64(32) | ((names // np.uint64(buckets)) & np.uint64(0xFFFFFFFF))


def _sample_keys(units, buckets):
    keys, inverse, counts = np.unique(_short(units.sampled(), buckets), return_inverse=True, return_counts=True)
    return keys, inverse, counts, np.searchsorted(keys >> np.uint64(32), np.arange(buckets + 1))


def _repeated(units, buckets, answer):
    keys, inverse, counts, cuts = _sample_keys(units, buckets)
    found = counts > 1
    for bucket, bits in answer.items():
        low, high = cuts[bucket], cuts[bucket + 1]
        found[low:high] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=high - low).astype(bool)
    return found[inverse]


def _table(block, rows, counts):
    """The documents of a message: id, hash of text, row, number of names."""
    columns = [block.keys[rows], block.marks[rows], rows, counts]
    # Floats among them would round large ids.
    assert all(c.dtype.kind == "i" for c in columns)
    return np.array([len(rows)], dtype=np.int64).tobytes() + np.stack(columns).astype(np.int64).tobytes()


def _text_names(block):
    names = [hashlib.blake2b(t, digest_size=16).digest() for t in block.texts]
    both = np.frombuffer(b"".join(names), dtype=np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _copy_order(block, buckets):
    """The first row of every text of the block, by bucket; rows of each text; bucket bounds."""
    names, other = _text_names(block)
    _, first, inverse = np.unique(names, return_index=True, return_inverse=True)
    bucket = (other[first] % np.uint64(buckets)).astype(np.int64)
    turn = np.lexsort((first, bucket))
    return names, first, inverse, turn, np.searchsorted(bucket[turn], np.arange(buckets + 1))


def _ask_copies(buckets):
    def question(block, answers):
        names, first, _, turn, cuts = _copy_order(block, buckets)
        for bucket in np.flatnonzero(np.diff(cuts)):
            rows = first[turn[cuts[bucket] : cuts[bucket + 1]]]
            yield int(bucket), _table(block, rows, np.ones(len(rows), dtype=np.int64)) + names[rows].tobytes()

    return question


def _copies(block, buckets, answer):
    """Which rows of the block copy an earlier document, here or elsewhere."""
    _, first, inverse, turn, cuts = _copy_order(block, buckets)
    found = np.zeros(len(first), dtype=bool)
    for bucket, bits in answer.items():
        low, high = cuts[bucket], cuts[bucket + 1]
        found[turn[low:high]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=high - low)
    return found[inverse] | (first[inverse] != np.arange(len(inverse)))


def _ask_samples(kind, buckets):
    def question(block, answers):
        keys, _, _, cuts = _sample_keys(kind(block.part(~_copies(block, buckets, answers[0]))), buckets)
        for bucket in np.flatnonzero(np.diff(cuts)):
            part = keys[cuts[bucket] : cuts[bucket + 1]] & np.uint64(0xFFFFFFFF)
            yield int(bucket), pack_sorted(part)

    return question


def _compare_samples(blocks, payloads):
    parts = [unpack_sorted(p) for p in payloads]
    _, inverse, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    bits, ends = counts[inverse] > 1, np.cumsum([len(p) for p in parts])
    return [np.packbits(b).tobytes() for b in np.split(bits, ends[:-1])]


class Windows:
    """The candidate windows of one block: names, the first place of each name, and their buckets."""

    def __init__(self, units, buckets, answer):
        self.units = units
        self.starts = units.candidates(_repeated(units, buckets, answer))
        names = units.named(self.starts)
        _, first, self.inverse = np.unique(names, return_index=True, return_inverse=True)
        self.first = first
        order = np.argsort(first)
        bucket = (names[first[order]] % np.uint64(buckets)).astype(np.int64)
        turn = np.argsort(bucket, kind="stable")
        self.order = order[turn]
        self.sent = names[first[self.order]]
        self.cuts = np.searchsorted(bucket[turn], np.arange(buckets + 1))


def _ask_windows(kind, buckets):
    """Each window name once per block, in order of its first document there, with a table of these
    documents (id, hash of text, row, number of names)."""

    def question(block, answers):
        block = block.part(~_copies(block, buckets, answers[0]))
        windows = Windows(kind(block), buckets, answers[1])
        owner = windows.units.owner[windows.starts[windows.first[windows.order]]]
        for bucket in np.flatnonzero(np.diff(windows.cuts)):
            part = slice(windows.cuts[bucket], windows.cuts[bucket + 1])
            rows, counts = np.unique(owner[part], return_counts=True)
            yield int(bucket), _table(block, rows, counts) + windows.sent[part].tobytes()

    return question


def _compare_windows(blocks, payloads):
    """A bit per name: another block holds it in an earlier document."""
    tables, names, origin = [], [], []
    for block, data in zip(blocks, payloads):
        count = int(np.frombuffer(data, np.int64, 1)[0])
        tables.append(np.frombuffer(data, np.int64, 4 * count, 8).reshape(4, count))
        names.append(np.frombuffer(data, np.uint64, offset=8 + 32 * count))
        origin.append(np.full(count, block))
    keys, marks, rows, counts = np.concatenate(tables, axis=1)
    rank = np.empty(len(keys), dtype=np.int64)
    rank[np.lexsort((rows, np.concatenate(origin), marks, keys))] = np.arange(len(keys))
    every, rank = np.concatenate(names), np.repeat(rank, counts)
    order = np.lexsort((rank, every))
    bits = np.zeros(len(every), dtype=bool)
    bits[order[1:]] = every[order[1:]] == every[order[:-1]]
    return [np.packbits(b).tobytes() for b in np.split(bits, np.cumsum([len(n) for n in names])[:-1])]


def _covered(size, starts, window):
    """Units that a window at one of these starts covers."""
    steps = np.zeros(size + 1, dtype=np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    return np.cumsum(steps[:-1], dtype=np.int32) > 0


def _finish(kind, buckets, within, with_text):
    def finish(batches):
        for batch in batches:
            for r in batch.itertuples():
                found_copies, samples, earlier = [answers_of(r, f"answer{n}") for n in range(3)]
                every = Block.unpacked(r.blob)
                copies = _copies(every, buckets, found_copies)
                block = every.part(~copies)
                windows = Windows(kind(block), buckets, samples)
                units, found = windows.units, np.zeros(len(windows.order), dtype=bool)
                for bucket, bits in earlier.items():
                    low, high = windows.cuts[bucket], windows.cuts[bucket + 1]
                    found[low:high] = np.unpackbits(np.frombuffer(bits, np.uint8), count=high - low)
                known = np.zeros(len(windows.order), dtype=bool)
                known[windows.order] = found
                first = windows.first[windows.inverse]
                if within:
                    again = first != np.arange(len(first))
                else:
                    again = units.owner[windows.starts[first]] != units.owner[windows.starts]
                starts = windows.starts[known[windows.inverse] | again]
                gone, rows = _covered(len(units.owner), starts, units.window), []
                low = np.searchsorted(units.owner, np.arange(len(block.keys) + 1))
                for n, key in enumerate(block.keys.tolist()):
                    part = gone[low[n] : low[n + 1]]
                    kept = units.kept(n, part) if part.any() else units.whole(n)
                    rows.append((
                        key if block.known[n] else None, len(part), int(part.sum()),
                        int(np.count_nonzero(np.diff(part, prepend=False) & part)),
                        hashlib.sha256(kept).hexdigest(), kept if with_text else None,
                        block.extras[n].decode() if with_text else None,
                    ))
                copied = every.part(copies)
                units = kind(copied)
                low = np.searchsorted(units.owner, np.arange(len(copied.keys) + 1))
                for n, size in enumerate(np.diff(low).tolist()):
                    kept = units.whole(n) if size < units.window else b""
                    rows.append((
                        int(copied.keys[n]) if copied.known[n] else None, size, size if size >= units.window else 0,
                        int(size >= units.window), hashlib.sha256(kept).hexdigest(), kept if with_text else None,
                        copied.extras[n].decode() if with_text else None,
                    ))
                ids, *others = zip(*rows)
                names = [c.split()[0] for c in RESULT.split(", ")]
                yield pd.DataFrame(dict(zip(names, [pd.array(ids, dtype="Int64"), *others])))

    return finish


def without_repeats(documents, kind, within, keep=(), with_text=False, size=None):
    """RESULT rows: every document without the units of windows that start earlier as well.

    kind makes the Units of a block; within: earlier starts in the same document count too. keep:
    columns that come back as JSON in `extra`, with the kept bytes, if with_text is set.
    """
    blocks, buckets = TextBlocks(documents, keep, size), bucket_count(documents)
    blocks.pin(buckets)
    copies = answered(asked(blocks, _ask_copies(buckets)), _compare_windows, "copies")
    samples = answered(asked(blocks, _ask_samples(kind, buckets), copies), _compare_samples, "samples")
    windows = answered(asked(blocks, _ask_windows(kind, buckets), copies, samples), _compare_windows, "windows")
    return with_answers(blocks, copies, samples, windows).mapInPandas(
        _finish(kind, buckets, within, with_text), RESULT
    )


def with_kept_text(rows, schema):
    """Rows of without_repeats(with_text=True) as documents again: kept text and the kept columns."""
    kept = [f for f in schema.fields if f.name not in ("doc_id", "text")]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    back = F.from_json("extra", ddl, JSON_TIMES) if kept else F.lit(None)
    return rows.withColumn("_back", back).select(
        *[F.col(f.name) if f.name == "doc_id" else F.decode("kept", "utf-8").alias("text") if f.name == "text"
          else F.col("_back")[f.name].alias(f.name) for f in schema.fields]
    )
