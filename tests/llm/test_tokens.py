"""Encoder, token counts, token files and packing against the library."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tablemart.llm import encoder, packing, token_files
from tablemart.llm.packing import pack_documents, plan_packing
from tablemart.llm.token_counts import count_tokens
from tablemart.llm.token_files import read_token_files, token_file_digest


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


def test_encoder_equals_the_library(documents, odd_documents, byte_path, word_path, encode, monkeypatch):
    monkeypatch.setattr(encoder, "REMEMBERED", 2000)
    texts = [r["text"] or "" for r in documents.collect()] + [r["text"] or "" for r in odd_documents.collect()]
    for path in (byte_path, word_path):
        made = encoder.Encoder(path)
        for low in range(0, len(texts), 50):
            part = texts[low : low + 50]
            assert [ids_of(d) for d in made.encode(part)] == [encode(path, t) for t in part]
        assert made.encode([]) == []


@pytest.mark.parametrize("step, overlap", [(400, 4), (900, 128), (1 << 16, 512)])
def test_spliced_counts(documents, odd_documents, byte_path, word_path, encode, step, overlap):
    for path in (byte_path, word_path):
        for frame in (documents, odd_documents):
            want = Counter((r["doc_id"], len((r["text"] or "").encode()), len(encode(path, r["text"]))) for r in frame.select("doc_id", "text").collect())
            got = count_tokens(frame, path, 100, step, overlap).collect()
            assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got) == want
            assert all(r["over_limit"] == (r["n_tokens"] > 100) for r in got)


def test_counts_of_nothing(no_documents, byte_path):
    assert count_tokens(no_documents, byte_path).count() == 0


def test_token_files_round_trip(spark, documents, odd_documents, no_documents, word_path, encode, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 5000)
    want, start = [], 0
    for r in sorted(documents.collect(), key=lambda r: r["doc_id"]):
        ids = np.array(encode(word_path, r["text"]) + [1], dtype="<u4").tobytes()
        want.append((r["doc_id"], start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    folder = str(tmp_path / "files")
    assert sorted(tuple(r) for r in token_file_digest(documents, word_path, folder=folder).collect()) == want
    # One document alone, through the index of its shard.
    import zstandard

    head = spark.read.parquet(f"{folder}/dictionary").first()
    shard = next(r for r in spark.read.parquet(f"{folder}/shards").toLocalIterator() if 77 in r["doc_ids"])
    at = shard["doc_ids"].index(77)
    words = zstandard.ZstdCompressionDict(bytes(head["dictionary"]))
    ids = zstandard.ZstdDecompressor(dict_data=words).decompress(bytes(shard["frames"])[shard["offsets"][at] : shard["offsets"][at + 1]])
    assert zlib.crc32(ids) == want[77][3] and shard["dictionary_hash"] == head["dictionary_hash"]
    got = token_file_digest(odd_documents, word_path).collect()
    assert Counter(r["n_tokens"] for r in got) == Counter(len(encode(word_path, r["text"])) + 1 for r in odd_documents.select("text").collect())
    starts = sorted((r["start"], r["n_tokens"]) for r in got)
    assert [s for s, _ in starts] == np.cumsum([0, *[n for _, n in starts]])[:-1].tolist()
    assert token_file_digest(no_documents, word_path).count() == 0


def test_shards_of_another_dictionary_are_refused(spark, documents, word_path, tmp_path):
    folder = str(tmp_path / "files")
    token_files.write_token_files(documents.limit(5), word_path, folder)
    spark.createDataFrame([("other", b"other")], "dictionary_hash string, dictionary binary").write.mode("overwrite").parquet(f"{folder}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        read_token_files(spark, folder).collect()


def whole(rows, frame, path, encode, capacity):
    """Pieces are whole documents, gapless in sequences that hold at most the capacity."""
    ids = Counter(tuple(encode(path, r["text"]) + [0]) for r in frame.select("text").collect())
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    assert sum(r["length"] for r in rows) == sum(len(k) * n for k, n in ids.items())
    sums = Counter()
    for key, n in ids.items():
        first = len(key) % capacity or min(len(key), capacity)
        cuts = [0, *range(first, len(key) + 1, capacity)]
        for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
            sums[number, a, b - a, zlib.crc32(np.array(key[a:b], dtype="<u4").tobytes())] += n
    assert Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sums
    return len(places), -(-sum(r["length"] for r in rows) // capacity)


def test_packing(documents, odd_documents, no_documents, byte_path, encode):
    used, least = whole(pack_documents(documents, byte_path).collect(), documents, byte_path, encode, 2048)
    assert used <= 1.05 * least + 1
    whole(pack_documents(odd_documents, byte_path, capacity=64).collect(), odd_documents, byte_path, encode, 64)
    assert pack_documents(no_documents, byte_path).count() == 0


def test_plans_place_every_piece_once():
    rng = np.random.default_rng(4)
    for capacity, many in ((2048, 3000), (64, 500), (2048, 1), (10, 50)):
        lengths = rng.integers(1, capacity + 1, many)
        counts = dict(Counter(lengths.tolist()))
        runs, sequences = plan_packing(counts, capacity)
        seen, fill = Counter(), np.zeros(sequences, dtype=int)
        for length, rank, count, first in runs:
            for n in range(count):
                seen[length, rank + n] += 1
                fill[first + n] += length
        assert seen == Counter((v, n) for v, c in counts.items() for n in range(c))
        assert fill.max() <= capacity and fill.min() > 0
        assert sequences <= 1.2 * lengths.sum() / capacity + 2
    assert plan_packing({}) == ([], 0)
    assert packing.plan_packing({2048: 3})[1] == 3


def test_words_are_asked_for_once_and_odd_ones_fall_out_of_their_block(word_path, monkeypatch):
    odd = ["", "a\x0cb", "\x0c", "x\n", "\ny", "a\nb", "ä", "日本", "a\tb", "w" * 60, "d'été", "plain", "x.\nY"]
    made = encoder.Encoder(word_path)
    text = " ".join(["start", *odd, *odd, *(f"word{n}" for n in range(1500))])
    want = np.array(made.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert made.encode([text, text]) == [want, want]

    asked = []

    class Counted(encoder.Words):
        def __getitem__(self, word):
            asked.append(word)
            return super().__getitem__(word)

    made.memory = Counted()
    words = ["one", "two", "one"]
    assert [b"".join(ids) for ids in made._ids_of([words])] == [b"".join(made._by_word(words)[w] for w in words)]
    assert asked == words

    # Words that failed are not remembered as words without ids.
    monkeypatch.setattr(made, "_by_word", lambda words: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        made._ids_of([["three"]])
    assert "three" not in made.memory
