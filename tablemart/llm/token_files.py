"""Token ids in shards of separately compressed documents with one trained dictionary."""

import hashlib

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import functions as F

from tablemart.llm.encoder import encoder
from tablemart.llm.tables import blocks_for, doc_rows, ids_as_numbers, ids_as_text
from tablemart.storage import shared_folder, via_table

#: Training sample: so many documents with the smallest hash of their id, so many ids of each.
SAMPLE_DOCUMENTS = 1000
SAMPLE_IDS = 2048
DICTIONARY_BYTES = 65_536
SHARD_BYTES = 1 << 20
LEVEL = 3
PARTS = 32
PART_BYTES = 64 << 20
BATCH = 1000
SHARD = (
    "part int, shard long, before long, dictionary_hash string, doc_ids array<long>, "
    "sizes array<long>, offsets array<long>, frames binary"
)


def _encoded(batch, path, end_id):
    tail = np.array([end_id], dtype="<u4").tobytes()
    for low in range(0, len(batch), BATCH):
        part = batch.iloc[low : low + BATCH]
        for doc, ids in zip(part["doc_id"], encoder(path).encode(part["text"].tolist())):
            yield doc, ids + tail


def train_dictionary(documents, path, end_id):
    """Dictionary bytes, trained on the serialized ids of a bounded sample of documents.

    Samples too few or too small to train on become the dictionary themselves; none at all give
    an empty one.
    """

    def sample(batches):
        for batch in batches:
            yield pd.DataFrame({"ids": [ids[: 4 * SAMPLE_IDS] for _, ids in _encoded(batch, path, end_id)]})

    ids = documents.select("doc_id").filter("doc_id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCUMENTS)
    # SAMPLE_DOCUMENTS ids: a proven bound for the broadcast. Of the rows of repeated ids, each task
    # and the driver keep SAMPLE_DOCUMENTS, those with the smallest hash.
    chosen = documents.join(F.broadcast(ids), "doc_id", "left_semi").mapInPandas(sample, "ids binary")
    samples = sorted(r["ids"] for r in chosen.orderBy(F.xxhash64("ids"), "ids").limit(SAMPLE_DOCUMENTS).collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def _frames(path, end_id, dictionary):
    def frames(batches):
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))
        for batch in batches:
            made = [(len(ids) // 4, packer.compress(ids)) for _, ids in _encoded(batch, path, end_id)]
            batch["size"], batch["frame"] = zip(*made) if made else ([], [])
            yield batch[["part", "doc_id", "mark", "size", "frame"]]

    return frames


def _shards(mark):
    def shards(batches):
        part, shard, before, held = -1, 0, 0, []

        def close():
            frames = [f for _, _, f in held]
            return pd.DataFrame({
                "part": [part], "shard": [shard], "before": [before], "dictionary_hash": [mark],
                "doc_ids": [[d for d, _, _ in held]], "sizes": [[n for _, n, _ in held]],
                "offsets": [np.cumsum([0, *map(len, frames)]).tolist()], "frames": [b"".join(frames)],
            })

        weight = 0
        for batch in batches:
            for now, doc, size, frame in zip(batch["part"], batch["doc_id"], batch["size"], batch["frame"]):
                if now != part:
                    if held:
                        yield close()
                    part, shard, before, held, weight = now, 0, 0, [], 0
                held.append((None if doc is None else int(doc), size, frame))
                weight += len(frame)
                if weight >= SHARD_BYTES:
                    yield close()
                    before += sum(n for _, n, _ in held)
                    shard, held, weight = shard + 1, [], 0
        if held:
            yield close()

    return shards


def write_token_files(documents, tokenizer, folder, end_id=1):
    """Write the ids of all documents, each with the end id, below `folder`, ordered by doc_id.

    `folder`/dictionary: one row, the dictionary and its SHA-256. `folder`/shards: one row per shard
    with its place (part, shard), ids written before it in its part, hash of the dictionary, and for
    its documents doc_ids, sizes in ids, byte offsets and the frames: each document is a zstandard
    frame of its own over little-endian unsigned 32-bit ids, so one is read without the others.

    Texts are encoded where they are read; only frames are shuffled, to parts that are ranges of
    doc_id with about equal numbers of documents. Parts and shards rise with doc_id. Parquet tasks
    commit whole files, so a lost executor leaves none half written. Null texts are empty (the end id
    alone); null doc_ids come first and are one part with the smallest ids, as all rows of a repeated
    doc_id are; an empty table gives a dictionary and no shards; other columns are not looked at.
    """
    spark, rows = documents.sparkSession, doc_rows(documents)
    dictionary = train_dictionary(rows, tokenizer, end_id)
    mark = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(mark, dictionary)], "dictionary_hash string, dictionary binary").write.parquet(
        f"{folder}/dictionary"
    )
    parts = max(PARTS, blocks_for(rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0], PART_BYTES))
    ranks = [n / parts for n in range(1, parts)]
    bounds = rows.agg(F.percentile_approx("doc_id", ranks, 100 * parts).alias("b")).first()["b"] or []
    bounds = F.lit(sorted(set(bounds))).cast("array<bigint>")
    part = F.coalesce(F.size(F.filter(bounds, lambda b: b <= F.col("doc_id"))), F.lit(0))
    framed = ids_as_text(rows.withColumn("part", part).withColumn("mark", F.xxhash64("text"))).mapInPandas(
        _frames(tokenizer, end_id, dictionary), "part int, doc_id string, mark long, size long, frame binary"
    )
    ranged = framed.repartitionById(parts, F.col("part")).sortWithinPartitions(
        "part", F.col("doc_id").cast("long"), "mark"
    )
    ranged.mapInPandas(_shards(mark), SHARD).write.option("compression", "uncompressed").parquet(f"{folder}/shards")


def _reader(dictionary_hash, dictionary):
    def read(batches):
        unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        for batch in batches:
            for r in batch.itertuples():
                if r.dictionary_hash != dictionary_hash:
                    raise ValueError(f"shard {r.part}/{r.shard} was written with another dictionary")
                starts = r.base + r.before + np.cumsum(r.sizes) - r.sizes
                ids = [unpacker.decompress(r.frames[a:b]) for a, b in zip(r.offsets, r.offsets[1:])]
                yield pd.DataFrame({
                    "doc_id": r.doc_ids, "start": starts, "n_tokens": [len(i) // 4 for i in ids], "ids": ids,
                })

    return read


def read_token_files(spark, folder):
    """doc_id, start (ids of all documents before it), n_tokens, ids (binary) of every document."""
    head = spark.read.parquet(f"{folder}/dictionary").first()
    shards = spark.read.schema(SHARD).parquet(f"{folder}/shards")
    sums = shards.select("part", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    sums = {r["part"]: r["n"] for r in sums.groupBy("part").agg(F.sum("n").alias("n")).collect()}
    # One number per write task, in the order of the tasks.
    parts = sorted(sums)
    bases = np.cumsum([0, *[sums[p] for p in parts]])[:-1].tolist()
    table = spark.createDataFrame(list(zip(parts, bases)), "part int, base long")
    placed = shards.join(via_table(table, "bases"), "part")
    return ids_as_numbers(placed.withColumn("doc_ids", F.col("doc_ids").cast("array<string>")).mapInPandas(
        _reader(head["dictionary_hash"], bytes(head["dictionary"])),
        "doc_id string, start long, n_tokens long, ids binary",
    ))


def digest_token_files(spark, folder):
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    return read_token_files(spark, folder).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def token_file_digest(documents, tokenizer, end_id=1, folder=None):
    """Write the files (into a new shared folder unless one is named) and read the digest back."""
    spark = documents.sparkSession
    folder = folder or shared_folder(spark, "token-files")
    write_token_files(documents, tokenizer, folder, end_id)
    return digest_token_files(spark, folder)
