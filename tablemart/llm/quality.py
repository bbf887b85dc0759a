"""Quality classifier: linear hinge loss over n-gram indicators scaled by class log-count ratios."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tablemart.llm.hashing import SEPARATOR, word_names
from tablemart.llm.tables import doc_rows, free_names, ids_as_numbers, ids_as_text

FEATURES = 1 << 18
#: The classifier is fitted on at most so many labelled rows, those with the smallest hash of doc_id,
#: and on so many bytes of text of them.
SAMPLE = 4000
SAMPLE_BYTES = 64 << 20
SMOOTHING = 1.0
PENALTY = 1.0
EPOCHS = 30
#: Byte classes: separators, digits, small and capital letters, letters beyond ASCII; every other
#: sign is a class of its own.
CLASS = np.arange(256, dtype=np.uint32)
CLASS[SEPARATOR], CLASS[48:58], CLASS[97:123], CLASS[65:91], CLASS[128:] = 0, 1, 2, 3, 4


def _slots(values, kind):
    return ((values + np.uint32(kind * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(2654435761)) >> np.uint32(14)


def ngrams(text):
    """Hashed indicators of one text (bytes), each once: one to three bytes, one to four runs of a
    byte class, and one to three word patterns (first and last class, same word as before)."""
    data, found = np.frombuffer(text, dtype=np.uint8).astype(np.uint32), []
    if len(data):
        classes = CLASS[data]
        turns = classes[np.flatnonzero(np.diff(classes, prepend=np.uint32(999)))]
        names, starts, ends = word_names(text)
        same = np.concatenate([[False], names[1:] == names[:-1]]).astype(np.uint32)[: len(names)]
        words = (classes[starts] * 2 + same) * 256 + classes[ends - 1]
        for kind, (stream, base, longest) in enumerate(((data, 256, 3), (turns, 251, 4), (words, 65599, 3))):
            value = np.zeros(len(stream), dtype=np.uint32)
            for size in range(1, longest + 1):
                if len(stream) < size:
                    break
                value = value[: len(stream) - size + 1] * np.uint32(base) + stream[size - 1 :]
                found.append(_slots(value, 8 * kind + size))
    slots = np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)
    return slots


class Distinct:
    """The distinct slots of one array after another, without sorting."""

    def __init__(self):
        self.last = np.zeros(FEATURES, dtype=np.int64)

    def __call__(self, slots):
        place = np.arange(len(slots))
        self.last[slots] = place
        return slots[self.last[slots] == place]


def fit(labels, rows, epochs=EPOCHS):
    """Weights per slot, ratios per slot and bias.

    ratio = log of the smoothed share of a slot among the indicators of label 1 over that of label 0.
    A row is its indicators times their ratios at length one, and a constant. The dual of the hinge
    loss is solved one coordinate at a time, in a shuffled order with a fixed seed. Without rows, or
    with one label only, weights are zero and the bias points to that label (to 1 without rows).
    """
    signs = np.where(np.asarray(labels) == 1, 1.0, -1.0)
    counts = {s: np.full(FEATURES, SMOOTHING) for s in (1.0, -1.0)}
    for sign, slots in zip(signs, rows):
        counts[sign][slots] += 1
    ratio = np.log(counts[1.0] / counts[1.0].sum()) - np.log(counts[-1.0] / counts[-1.0].sum())
    weights, bias = np.zeros(FEATURES), 0.0
    if len(set(signs)) < 2:
        return weights, ratio, float(signs[0]) if len(signs) else 1.0
    # One array for all rows: its memory goes back when it is done with.
    ends = np.cumsum([len(slots) for slots in rows])
    values = np.split(np.empty(ends[-1]), ends[:-1])
    for value, slots in zip(values, rows):
        value[:] = ratio[slots] / max(np.sqrt((ratio[slots] ** 2).sum()), 1e-12)
    alpha, rng = np.zeros(len(rows)), np.random.default_rng(7)
    square = [float((v**2).sum()) + 1 for v in values]
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            slope = signs[i] * (weights[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), PENALTY)
            change = (new - alpha[i]) * signs[i]
            if change:
                weights[rows[i]] += change * values[i]
                bias += change
                alpha[i] = new
    return weights, ratio, bias


def score_margin(slots, weights, ratio, bias):
    """Margin of one row of distinct slots."""
    scale = ratio[slots]
    length = np.sqrt((scale**2).sum())
    return float(weights[slots] @ scale / length + bias) if length > 0 else float(bias)


def held_out(key):
    """Rows never learnt from: crc32 of the id as text leaves 1 over 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(documents, labels, target="quality", sample=SAMPLE):
    """Fit on at most `sample` labelled rows outside the held-out third: weights, ratios, bias.

    Equal texts of one doc_id teach once. Rows are chosen by narrow rows alone (id, hash and size of
    the text), whole texts only up to SAMPLE_BYTES.
    """
    known = labels.filter(F.col(target).isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")
    ).agg(F.max(F.col(target).cast("int")).alias("label")).filter("doc_id is not null")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def read(batches):
        distinct = Distinct()
        for batch in batches:
            slots = [distinct(ngrams(t.encode())).astype("<u4").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "slots": slots})

    # At most `sample` rows of two numbers: a proven bound for the broadcast.
    marked = documents.withColumn("mark", F.xxhash64("text")).join(F.broadcast(chosen), "doc_id")
    narrow = marked.select("doc_id", "label", "mark", F.octet_length("text").cast("long").alias("size")).distinct()
    narrow = narrow.orderBy(F.xxhash64("doc_id"), "doc_id", "mark").limit(sample).collect()
    sums = np.cumsum([r["size"] for r in narrow])
    narrow = [(r["doc_id"], r["mark"]) for r, total in zip(narrow, sums) if total <= SAMPLE_BYTES]
    wanted = F.broadcast(documents.sparkSession.createDataFrame(narrow, "doc_id long, mark long"))
    rows = marked.join(wanted, ["doc_id", "mark"]).select("doc_id", "label", "text")
    rows = rows.mapInPandas(read, "doc_id long, label int, slots binary").dropDuplicates()
    rows = sorted(rows.collect(), key=lambda r: (r["doc_id"], r["slots"]))
    return fit([r["label"] for r in rows], [np.frombuffer(r["slots"], dtype="<u4") for r in rows])


def score_quality(documents, labels, target="quality", sample=SAMPLE):
    """doc_id, held_out, score, predicted of every row of documents.

    score: 0 to 1, higher where label 1 is likelier, 0.5 at the margin; predicted: 1 where score is
    at least 0.5. Only the text goes into a score, all of it; null and empty texts get the score of
    the constant. Labels other than 0 and 1 and labels without text teach nothing; of several labels
    of a doc_id the largest counts; without any labels all documents score alike. Null and repeated
    doc_ids keep their rows; an empty table gives no rows; other columns are not looked at.
    """
    rows = doc_rows(documents)
    scored = _scored(rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), labels, target, sample)
    return ids_as_numbers(scored)


def _scored(rows, labels, target, sample):
    """doc_id (as text) and whatever else stands before `text`, with score and predicted."""
    model = rows.sparkSession.sparkContext.broadcast(train(rows, labels, target, sample))
    kept = rows.columns[: rows.columns.index("text")]

    def score(batches):
        weights, ratio, bias = model.value
        distinct = Distinct()
        for batch in batches:
            margins = np.array([
                score_margin(distinct(ngrams(t.encode())), weights, ratio, bias) for t in batch["text"]
            ])
            values = 1 / (1 + np.exp(-np.clip(4 * margins, -50, 50)))
            yield batch[kept].assign(score=values, predicted=(values >= 0.5).astype(np.int32))

    kinds = {**dict(rows.dtypes), "doc_id": "string"}
    ddl = ", ".join([*(f"{c} {kinds[c]}" for c in kept), "score double", "predicted int"])
    return ids_as_text(rows).mapInPandas(score, ddl)


def keep_good(documents, labels, target="quality", sample=SAMPLE):
    """The rows of documents whose text is not rejected (predicted 0); all their columns as they are.

    What decides is the text: equal texts are kept or rejected together, whatever their doc_ids, and
    rows without or with a repeated doc_id are judged each by its own text.
    """
    seeds = (0, 1)
    marks = [F.xxhash64(F.coalesce(F.col("text"), F.lit("")), F.lit(s)) for s in seeds]
    names = free_names(["_mark0", "_mark1"], documents.columns)
    rows = doc_rows(documents).select("doc_id", *[m.alias(n) for m, n in zip(marks, names)], "text")
    rejected = _scored(rows, labels, target, sample).filter("predicted = 0").select(*names).distinct()
    marked = documents.withColumns(dict(zip(names, marks)))
    return marked.join(rejected, names, "left_anti").select(*documents.columns)
