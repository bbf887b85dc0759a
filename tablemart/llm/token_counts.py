"""Token counts of whole texts; huge ones are encoded in overlapping chunks that are spliced."""

import pandas as pd
from pyspark.sql import Window, functions as F

from tablemart.llm.encoder import CUT, encoder
from tablemart.llm.tables import blocks_for, doc_rows, ids_as_numbers, ids_as_text
from tablemart.storage import via_table

CHUNK = 65_536
OVERLAP = 512
#: Tasks that encode chunks: one for each CHUNKS of them, and at least CHUNK_TASKS.
CHUNKS, CHUNK_TASKS = 64, 64
BATCH = 1000
NAMES = ["start", "last", "tokens", "head", "tail"]
KEY = ["doc_id", "n_bytes", "mark"]
SEEN = "array<struct<at: long, before: long>>"


def _count_whole(path):
    def count(batches):
        made = encoder(path)
        for batch in batches:
            for low in range(0, len(batch), BATCH):
                part = batch.iloc[low : low + BATCH]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"], "n_bytes": part["n_bytes"],
                    "n_tokens": [len(ids) // 4 for ids in made.encode(part["text"].tolist())],
                })

    return count


def _chunks(step, overlap):
    """Chunks of `step` signs, each with the next `overlap` signs behind it."""

    def cut(batches):
        for batch in batches:
            for doc, size, mark, text in zip(*[batch[c] for c in ("doc_id", "n_bytes", "mark", "text")]):
                for start in range(0, len(text), step):
                    last = start + step >= len(text)
                    yield pd.DataFrame({
                        "doc_id": [doc], "n_bytes": [size], "mark": [mark], "start": [start], "last": [last],
                        "chunk": [text[start : start + step + (0 if last else overlap)]],
                    })

    return cut


def _encode_chunks(path, step, overlap):
    """Per chunk: its tokens, and the token starts at stable places in the two parts it shares with
    its neighbours, each with the number of tokens before it.

    A place is stable where CUT finds it: no id before it depends on what follows and no id after
    it on what came before. Only those where this chunk's own encoding starts a token are listed.
    """

    def encode(batches):
        made = encoder(path).tokenizer
        for batch in batches:
            rows = []
            for doc, size, mark, start, last, chunk in zip(*[batch[c] for c in batch.columns]):
                offsets = made.encode(chunk, add_special_tokens=False).offsets
                begins = {}
                for n, (low, _) in enumerate(offsets):
                    begins.setdefault(low, n)

                def seen(low, high, text=chunk, begins=begins, start=start):
                    found = []
                    for match in CUT.finditer(text, low, min(high, len(text))):
                        # Tokenizers that drop white space start the token behind the space.
                        at = next((a for a in (match.start(), match.end()) if a in begins), None)
                        if at is not None:
                            found.append({"at": start + match.start(), "before": begins[at]})
                    return found

                rows.append((
                    doc, size, mark, start, last, len(offsets), seen(0, overlap) if start else [],
                    [] if last else seen(step, step + overlap),
                ))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "mark", *NAMES])

    return encode


def _spliced(huge, path, step, overlap):
    """doc_id, n_bytes, n_tokens of texts longer than `step`; n_tokens is null where a seam has no
    common boundary or the boundaries behind it differ."""
    chunks = huge.mapInPandas(
        _chunks(step, overlap), "doc_id string, n_bytes long, mark long, start long, last boolean, chunk string"
    )
    # By a stated number, as chunks are few in bytes and dear to encode.
    spread = max(CHUNK_TASKS, blocks_for(huge.agg(F.sum(F.length("text").cast("long"))).first()[0], CHUNKS * step))
    encoded = chunks.repartition(spread, "doc_id", "start").mapInPandas(
        _encode_chunks(path, step, overlap),
        f"doc_id string, n_bytes long, mark long, start long, last boolean, tokens long, head {SEEN}, tail {SEEN}",
    )
    order = Window.partitionBy(*KEY, "copy").orderBy("start")
    encoded = via_table(encoded, "chunks").withColumn(
        "copy", F.row_number().over(Window.partitionBy(*KEY, "start").orderBy("tokens"))
    )
    seams = encoded.withColumn("next", F.lead("head").over(order))
    common = F.array_intersect(F.col("tail.at"), F.col("next.at"))
    seams = seams.withColumn("seam", F.try_element_at(common, F.lit(1)))
    after = [F.filter(F.col(c), lambda x: x["at"] >= F.col("seam")) for c in ("tail", "next")]
    agree = F.transform(after[0], lambda x: x["at"]) == F.transform(after[1], lambda x: x["at"])
    ends = F.when(agree, F.try_element_at(after[0], F.lit(1))["before"])
    begins = F.try_element_at(after[1], F.lit(1))["before"]
    parts = seams.select(
        *KEY, "copy", F.when(F.col("last"), F.col("tokens")).otherwise(ends).alias("ends"),
        F.when(F.col("last"), F.lit(0)).otherwise(begins).alias("skipped"),
    )
    # Tokens up to each seam, less those that the next chunk counts before the same seam.
    return parts.groupBy(*KEY, "copy").agg(
        F.when(F.count("ends") == F.count("*"), F.sum("ends") - F.sum("skipped")).alias("n_tokens")
    ).drop("copy")


def count_tokens(documents, path, limit=1024, step=CHUNK, overlap=OVERLAP):
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row.

    Token counts are those of the tokenizer file at `path` for the whole text without added special
    tokens; special strings inside a text are handled as the library does by default. Null texts
    are empty: 0 bytes, 0 tokens. Null or repeated doc_ids keep their rows; an empty table gives no
    rows; other columns are not looked at.

    Texts longer than `step` signs become chunks, one row each, that any executor can encode. A seam
    is the first stable boundary that both neighbours found in the overlap, and the boundaries
    behind it must be the same. Where a seam fails, the text is cut again with an overlap twice as
    wide, at last in one piece.
    """
    rows = ids_as_text(doc_rows(documents)).withColumn("n_bytes", F.octet_length("text").cast("long"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    schema = "doc_id string, n_bytes long, n_tokens long"
    small = rows.filter(F.length("text") <= step).mapInPandas(_count_whole(path), schema)
    huge = rows.filter(F.length("text") > step)
    done = []
    while True:
        tried = via_table(_spliced(huge, path, step, overlap), "token-counts")
        done.append(tried.filter("n_tokens is not null").drop("mark"))
        failed = tried.filter("n_tokens is null")
        if failed.isEmpty():
            break
        step, overlap = 2 * step, 2 * overlap
        huge = rows.join(failed.select("n_bytes", "mark").distinct(), ["n_bytes", "mark"], "left_semi")
        done.append(huge.filter(F.length("text") <= step).mapInPandas(_count_whole(path), schema))
        huge = huge.filter(F.length("text") > step)
    counts = small
    for part in done:
        counts = counts.unionByName(part)
    return ids_as_numbers(counts).withColumn("over_limit", F.col("n_tokens") > limit)
