"""Blocks of documents that ask buckets of names, and read the answers, without sending positions.

A block holds some documents of one input task. It sends each bucket (a residue of the 64-bit names)
the names it has there; the bucket compares what all blocks sent and answers one bit per name, in the
order of the question. The block, made again from the same input task, repeats its question to know
what each bit means. So a name travels once and no position travels at all.
"""

import zlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import functions as F

from tablemart.llm.tables import blocks_for
from tablemart.storage import pin, via_table

BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 32 << 20
#: Buckets of the smallest corpus: enough to keep many tasks at work.
LEAST_BUCKETS = 64
LEVEL = 3
SPREAD = 1024
#: What a row weighs besides its bytes, so that very short texts do not make a block of very many rows.
ROW_BYTES = 128
LAST = np.iinfo(np.int64).max
BLOCK = "block long, checksum long, blob binary"
#: Timestamps go through JSON with all their digits.
JSON_TIMES = {
    "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
MESSAGE = "block long, bucket int, payload binary"


class Block:
    """Documents in order of doc_id (nulls last) and of a hash of the text: ids, bytes, and whatever
    else goes with a row as bytes."""

    def __init__(self, keys, known, texts, extras):
        self.keys, self.known, self.texts, self.extras = keys, known, texts, extras
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.marks = np.array([zlib.crc32(t) for t in texts], dtype=np.int64)

    def part(self, rows):
        """The block of these rows (a mask)."""
        at = np.flatnonzero(rows).tolist()
        return Block(self.keys[rows], self.known[rows], [self.texts[n] for n in at], [self.extras[n] for n in at])

    def _body(self):
        head = np.array([len(self.keys)], dtype=np.int64).tobytes()
        more = np.array([len(e) for e in self.extras], dtype=np.int64)
        table = [self.keys, self.known.astype(np.int64), self.sizes, more]
        body = b"".join([head, *[t.tobytes() for t in table], *self.texts, *self.extras])
        return body

    def checksum(self):
        return zlib.crc32(self._body())

    def packed(self):
        body = self._body()
        return zlib.crc32(body), zstandard.ZstdCompressor(level=LEVEL).compress(body)

    @staticmethod
    def unpacked(blob):
        body = zstandard.ZstdDecompressor().decompress(blob)
        count = int(np.frombuffer(body, np.int64, 1)[0])
        keys, known, *sizes = np.frombuffer(body, np.int64, 4 * count, 8).reshape(4, count)
        both, low = np.concatenate(sizes), 8 + 32 * count
        ends = np.cumsum(both)
        parts = [body[low + e - s : low + e] for s, e in zip(both.tolist(), ends.tolist())]
        return Block(keys, known.astype(bool), parts[:count], parts[count:])


def _cut(batches, size):
    """(id, Block) of the rows of one input task."""
    task, number, held, weight = 0, 0, [], 0

    def close():
        held.sort(key=lambda d: (d[0], zlib.crc32(d[2])))
        keys, known, texts, extras = zip(*held)
        block = Block(np.array(keys, dtype=np.int64), np.array(known, dtype=bool), list(texts), list(extras))
        return task << 32 | number, block

    for batch in batches:
        for doc, known, text, extra, task in zip(*[batch[c] for c in batch.columns]):
            data = text.encode()
            more = (extra or "").encode()
            held.append((doc, known, data, more))
            weight += len(data) + len(more) + ROW_BYTES
            if weight >= size:
                yield close()
                number, held, weight = number + 1, [], 0
    if held:
        yield close()


class TextBlocks:
    """The documents of each input task in blocks of about `size` bytes; the columns to keep go along
    as one JSON text. Blocks are made anew in each pass, always from the same input split."""

    def __init__(self, documents, keep=(), size=None):
        self.size, self.pinned = size or BLOCK_BYTES, None
        extra = F.to_json(F.struct(*keep), JSON_TIMES) if keep else F.lit("")
        # Null ids have a flag of their own: pandas would turn a column with nulls into floats.
        self.rows = documents.select(
            F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))).alias("doc_id"),
            F.col("doc_id").isNotNull().alias("known"), F.coalesce("text", F.lit("")).alias("text"),
            extra.alias("extra"),
            # The index of the input split, which stays the same whatever stands above it in a plan.
            F.spark_partition_id().cast("long").alias("task"),
        )

    def packed(self):
        """block, checksum, blob rows, to be joined with answers."""
        if self.pinned is not None:
            return self.pinned
        size = self.size

        def make(batches):
            for number, block in _cut(batches, size):
                checksum, blob = block.packed()
                yield pd.DataFrame({"block": [number], "checksum": [checksum], "blob": [blob]})

        return self.rows.mapInPandas(make, BLOCK)


    def pin(self, buckets):
        """Store the packed blocks once, dealt by block, so that each later pass reads them there and
        joins its answers without moving a text again."""
        conf = self.rows.sparkSession.conf
        adaptive = conf.get("spark.sql.adaptive.enabled")
        # The adaptive wrapper of a plan would hide from the stored rows how they are dealt.
        conf.set("spark.sql.adaptive.enabled", "false")
        try:
            self.pinned = pin(self.packed().repartition(max(buckets // 2, 1), "block"))
        finally:
            conf.set("spark.sql.adaptive.enabled", adaptive)


def bucket_count(documents):
    """Buckets for the text there is, by the sum of all lengths."""
    total = documents.agg(F.sum(F.octet_length("text").cast("long"))).first()[0]
    return max(LEAST_BUCKETS, blocks_for(total, BUCKET_BYTES))


def pack_sorted(values):
    """Rising whole numbers as differences, each in as few bytes as the largest one needs."""
    steps = np.diff(values, prepend=values[:1] * 0).astype("<u8")
    width = max(1, -(-int(steps.max()).bit_length() // 8)) if len(steps) else 1
    return bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_sorted(data):
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    steps = np.zeros((len(raw), 8), dtype=np.uint8)
    steps[:, :width] = raw
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _questions(question, number, block, checksum, answers):
    found = list(question(block, answers))
    found.append((-1 - number % SPREAD, np.array([checksum], dtype=np.int64).tobytes()))
    buckets, payloads = zip(*found)
    return pd.DataFrame({"block": [number] * len(found), "bucket": buckets, "payload": payloads})


def asked(blocks, question, *replies):
    """(block, bucket, payload) rows: question(Block, answers) yields bucket and payload.

    Answers come with the block: one list of (bucket, bits) per reply table. A block without its
    answers means that the input gave other blocks than before, which must not pass unseen.
    """
    names, size = [f"answer{n}" for n in range(len(replies))], blocks.size

    def ask_first(batches):
        for number, block in _cut(batches, size):
            yield _questions(question, number, block, block.checksum(), [])

    def ask(batches):
        for batch in batches:
            for r in batch.itertuples():
                answers = [answers_of(r, n) for n in names]
                yield _questions(question, r.block, Block.unpacked(r.blob), r.checksum, answers)

    if not replies and blocks.pinned is None:
        return blocks.rows.mapInPandas(ask_first, MESSAGE)
    return with_answers(blocks, *replies).mapInPandas(ask, MESSAGE)


def with_answers(blocks, *replies):
    """Blocks with the answers of each reply table. Answers grow with the corpus, so they are never
    broadcast, not even where they are small; they are joined to each other before the blocks move."""
    if not replies:
        return blocks.packed()
    answers = replies[0].withColumnRenamed("answer", "answer0")
    for n, reply in enumerate(replies[1:], 1):
        answers = answers.join(reply.withColumnRenamed("answer", f"answer{n}").hint("merge"), "block", "full")
    return blocks.packed().join(answers.hint("merge"), "block", "left")


def answers_of(row, name):
    answer = getattr(row, name)
    found = {} if answer is None else {a["bucket"]: a["payload"] for a in answer}
    checksum = [found.pop(b) for b in list(found) if b < 0]
    if not checksum or int(np.frombuffer(checksum[0], np.int64)[0]) != row.checksum:
        raise RuntimeError("the input gave other blocks when it was read again")
    return found


def answered(messages, compare, label):
    """(block, answer) rows: compare(payloads) gives one payload of bits per payload of a bucket.

    A bucket gets names of all blocks, each name once per block; the number of buckets grows with
    the corpus, so what one task holds does not.
    """

    def reply(key, rows):
        if key[0] < 0:
            return rows
        rows = rows.sort_values("block", ignore_index=True)
        bits = compare(rows["block"].to_numpy(), rows["payload"].tolist())
        return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "payload": bits})

    every = messages.groupBy("bucket").applyInPandas(reply, MESSAGE)
    grouped = every.groupBy("block").agg(F.collect_list(F.struct("bucket", "payload")).alias("answer"))
    return via_table(grouped, label)
