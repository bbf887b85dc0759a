"""Words of documents that repeat passages of benchmark items, by multi-pattern search.

The windows of all items are the patterns. They are spread over blocks of bounded size by their hash;
each block is searched for in all documents in one pass that moves no text: the block's tables go to the
executors and every task searches what it reads. With several blocks, the rows of a pass are stored for
the next. A document carries the keys of the item sets it met, never the items themselves; sets
become items once for each combination of sets that occurs.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tablemart.llm.multi_pattern import PAD, Patterns
from tablemart.llm.tables import blocks_for, doc_rows, ids_as_numbers, ids_as_text
from tablemart.storage import via_table

WINDOW = 10
#: Bytes of the windows of one block: the bound of what is sent to every executor.
BLOCK_BYTES = 16 << 20
#: Bytes of text that are searched at a time; a longer text is searched alone.
BATCH_BYTES = 8 << 20
WINDOWS_AT_ONCE = 10_000
NOTHING = hashlib.sha256(b"").hexdigest()
FOUND = "doc_id string, n_words long, n_hit long, sets array<string>"
CARRIED = "doc_id string, hits binary, sets array<string>, text string"
_SPACE, _EDGE = 32, 0
#: Digits and letters, A-Z as a-z, and every byte beyond ASCII; all else separates words.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else _SPACE for b in range(256)
)


def normalized(texts):
    """All texts (bytes) as one array: words with one space before each and one behind the last, and a
    zero byte behind every text; PAD bytes more. And the places where words start, and their text."""
    joined = b"".join([b" " + t.translate(_LETTERS) + b" \0" for t in texts])
    data = np.frombuffer(joined, dtype=np.uint8)
    blank = data == _SPACE
    again = np.zeros(len(data), dtype=bool)
    again[1:] = blank[1:] & blank[:-1]
    data = np.concatenate([data[~again], np.full(PAD, _EDGE, dtype=np.uint8)])
    body = data[: len(data) - PAD]
    words = np.flatnonzero((body[1:] > _SPACE) & (body[:-1] == _SPACE)) + 1 if len(body) else np.zeros(0, dtype=np.int64)
    return data, words, np.searchsorted(np.flatnonzero(body == _EDGE), words)


def item_windows(benchmark, size=WINDOW):
    """item (text id, empty without one) and pattern (binary) of every window of every item: `size`
    consecutive words, or all of them where there are fewer, as ' word word .. word '."""

    def cut(batches):
        for batch in batches:
            items, patterns = [], []
            for item, text in zip(batch["item"], batch["text"]):
                words = text.encode().translate(_LETTERS).split(b" ")
                words = [w for w in words if w]
                for low in range(max(1, len(words) - size + 1) if words else 0):
                    items.append(item)
                    patterns.append(b" " + b" ".join(words[low : low + size]) + b" ")
                    if len(items) >= WINDOWS_AT_ONCE:
                        yield pd.DataFrame({"item": items, "pattern": patterns})
                        items, patterns = [], []
            yield pd.DataFrame({"item": items, "pattern": patterns})

    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return rows.mapInPandas(cut, "item string, pattern binary")


def _patterns_with_sets(benchmark, window):
    """pattern, key: each distinct window and the SHA-256 of its items, sorted and joined; and key,
    items. A window's items are one list, as the result's own list of them is."""
    grouped = item_windows(benchmark, window).groupBy("pattern").agg(F.array_sort(F.collect_set("item")).alias("items"))
    stored = via_table(grouped.withColumn("key", F.sha2(F.array_join("items", ","), 256)), "windows")
    return stored.select("pattern", "key"), stored.groupBy("key").agg(F.any_value("items").alias("items"))


def _batches(batch):
    """Slices of a batch with about BATCH_BYTES of text."""
    low, weight = 0, 0
    for n, text in enumerate(batch["text"]):
        weight += len(text)
        if weight >= BATCH_BYTES:
            yield batch.iloc[low : n + 1]
            low, weight = n + 1, 0
    if low < len(batch):
        yield batch.iloc[low:]


def _search(shared, last):
    """Mark the words inside occurrences of this block's patterns in `hits` (a bit per word)."""

    def search(batches):
        patterns, set_of, keys = shared.value
        for batch in batches:
            for part in _batches(batch):
                data, words, owner = normalized([t.encode() for t in part["text"]])
                starts, sizes, numbers = patterns.find(data)
                # Words at or behind the start of an occurrence and before its closing space.
                first, after = np.searchsorted(words, starts), np.searchsorted(words, starts + sizes - 1)
                steps = np.bincount(first, minlength=len(words) + 1) - np.bincount(after, minlength=len(words) + 1)
                hit = np.cumsum(steps[:-1]) > 0
                counts = np.bincount(owner, minlength=len(part))
                lows = np.cumsum(counts) - counts
                met = np.unique(owner[first] * len(keys) + set_of[numbers])
                bounds = np.searchsorted(met, np.arange(len(part) + 1) * len(keys))
                rows = []
                for n, (doc, old, before, text) in enumerate(zip(*[part[c] for c in ("doc_id", "hits", "sets", "text")])):
                    own = hit[lows[n] : lows[n] + counts[n]]
                    if old is not None:
                        own = own | np.unpackbits(np.frombuffer(old, np.uint8), count=counts[n]).astype(bool)
                    sets = sorted({*keys[met[bounds[n] : bounds[n + 1]] - n * len(keys)], *before})
                    if last:
                        rows.append((doc, len(own), int(own.sum()), sets))
                    else:
                        rows.append((doc, np.packbits(own).tobytes() if own.any() else None, sets, text))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in (FOUND if last else CARRIED).split(", ")])

    return search


def find_passages(documents, patterns):
    """doc_id, n_words, n_hit and the keys of all sets with an occurring window, for every row."""
    spark = documents.sparkSession
    blocks = blocks_for(patterns.agg(F.sum(F.octet_length("pattern").cast("long"))).first()[0], BLOCK_BYTES)
    rows = ids_as_text(doc_rows(documents)).select(
        "doc_id", F.lit(None).cast("binary").alias("hits"), F.array().cast("array<string>").alias("sets"), "text"
    )
    for block in range(blocks):
        # By hash of the window, so that a block has about BLOCK_BYTES however the items are.
        own = patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == block).orderBy("pattern").collect()
        keys = sorted({r["key"] for r in own})
        number, last = {k: n for n, k in enumerate(keys)}, block == blocks - 1
        set_of = np.array([number[r["key"]] for r in own], dtype=np.int64)
        made = Patterns([bytes(r["pattern"]) for r in own]), set_of, np.array(keys, dtype=object)
        rows = rows.mapInPandas(_search(spark.sparkContext.broadcast(made), last), FOUND if last else CARRIED)
        if not last:
            rows = via_table(rows, "passages")
    return ids_as_numbers(rows)


def decontaminate(documents, benchmark, window=WINDOW):
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of documents.

    Words are runs of digits, letters (A-Z as a-z) and signs beyond ASCII. A window is `window`
    consecutive words of an item, or all words of a shorter one; items without words have none. n_hit
    counts the words inside any occurrence of a window, n_items the items with occurring windows, and
    items_sha256 is of their ids, sorted as strings and joined by commas. Null texts have no words; an
    item without id counts as the id that is empty; items with one id are one. Null and repeated
    doc_ids keep their rows. Without documents there are no rows, without windows no hits. Other
    columns are not looked at.
    """
    patterns, items_of = _patterns_with_sets(benchmark, window)
    found = find_passages(documents, patterns).withColumn("combination", F.sha2(F.array_join("sets", ","), 256))
    found = via_table(found, "found")
    met = found.filter("n_hit > 0")
    # Combinations of sets are few, whatever the number of documents that hold them.
    items = met.groupBy("combination").agg(F.any_value("sets").alias("sets"))
    items = items.select("combination", F.explode("sets").alias("key")).join(items_of, "key")
    items = items.select("combination", F.explode("items").alias("item")).distinct()
    items = items.groupBy("combination").agg(F.array_sort(F.collect_list("item")).alias("items")).select(
        "combination", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    )
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"]
    clean = found.filter("n_hit = 0").withColumns({"n_items": F.lit(0).cast("long"), "items_sha256": F.lit(NOTHING)})
    every = met.join(items, "combination").select(*columns).unionByName(clean.select(*columns))
    return every.withColumn("contaminated", F.col("n_hit") > 0)
