"""Ids beyond the whole numbers a double can hold, beside nulls; blocks that hold only copies or nothing."""

import time

import pytest
from pyspark.sql import functions as F

from tablemart.llm import hashing
from tablemart.llm.jaccard_join import ngram_components
from tablemart.llm.mixing import mix_sources
from tablemart.llm.near_vectors import near_duplicate_vectors
from tablemart.llm.packing import pack_documents
from tablemart.llm.quality import score_quality
from tablemart.llm.substring_dedup import remove_repeated_words
from tablemart.llm.suffix_dedup import remove_repeated_bytes
from tablemart.llm.token_counts import count_tokens
from tablemart.llm.token_files import token_file_digest
from tablemart.llm.topk import top_k

BIG = 2**53
IDS = [BIG + 1, None, BIG + 3, BIG + 2, BIG + 4, BIG + 3]
TEXT = " ".join(f"w{n}" for n in range(90))


def rows_of(spark, rows, parts):
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return frame.repartition(parts) if parts > 1 else frame.coalesce(1)


@pytest.mark.parametrize("parts", [1, 3])
def test_ids_come_back_as_they_were(spark, byte_path, word_path, parts):
    frame = rows_of(spark, [(i, f"text {n} " + "x" * n, "s") for n, i in enumerate(IDS)], parts)
    labels = spark.createDataFrame([(BIG + 1, 1), (BIG + 2, 0)], "doc_id long, quality int")
    results = {
        "op1": remove_repeated_bytes(frame), "op2": remove_repeated_words(frame), "op3": score_quality(frame, labels),
        "op5": mix_sources(frame), "op6": count_tokens(frame, byte_path), "op7": ngram_components(frame),
        "op8": token_file_digest(frame, word_path), "op9": pack_documents(frame, byte_path),
    }
    for name, result in results.items():
        got = sorted((r["doc_id"] for r in result.collect()), key=lambda i: (i is None, i or 0))
        assert got == sorted(IDS, key=lambda i: (i is None, i or 0)), name
    vectors = spark.createDataFrame([(i, [1.0, float(n)], 1) for n, i in enumerate(IDS[:-1])], "vec_id long, embedding array<float>, label int")
    vectors = vectors.repartition(parts)
    got = {r["vec_id"] for r in near_duplicate_vectors(vectors).collect()}
    assert got >= {i for i in IDS if i is not None}
    found = top_k(vectors, vectors.filter("vec_id is not null"))
    assert {r["vec_id"] for r in found.collect()} <= {i for i in IDS if i is not None}


@pytest.mark.parametrize("order", [[BIG + 1, BIG], [BIG, BIG + 1]])
def test_the_smaller_of_two_large_ids_stays_whole(spark, order):
    frame = spark.createDataFrame([(i, TEXT, "s") for i in order], "doc_id long, text string, source string").repartition(2)
    for operator in (remove_repeated_bytes, remove_repeated_words):
        got = {r["doc_id"]: r["n_removed"] for r in operator(frame).collect()}
        assert got[BIG] == 0 and got[BIG + 1] > 0


def test_blocks_of_copies_only(spark):
    frame = rows_of(spark, [(4, TEXT, "s"), (None, TEXT, "s"), (9, TEXT, "s")], 1).repartition(4, F.coalesce("doc_id", F.lit(-1)))
    for operator in (remove_repeated_bytes, remove_repeated_words):
        got = {r["doc_id"]: (r["n_removed"], r[1]) for r in operator(frame).collect()}
        assert got[4][0] == 0 and all(got[i][0] == got[i][1] > 0 for i in (9, None))
    assert {r["component_id"] for r in ngram_components(frame).collect() if r["doc_id"]} == {4}


def test_only_empty_texts(spark, monkeypatch):
    assert len(hashing.word_names(b"")[0]) == 0
    frame = rows_of(spark, [(n, None if n % 2 else "", "s") for n in range(20)], 3)
    for operator in (remove_repeated_bytes, remove_repeated_words):
        assert {(r[1], r["n_removed"], r["n_spans"]) for r in operator(frame).collect()} == {(0, 0, 0)}
    assert ngram_components(frame).filter("component_id = doc_id").count() == 20


def test_many_empty_rows_of_one_task(spark):
    frame = spark.range(0, 200_000, 1, 1).selectExpr("id AS doc_id", "'' AS text")
    started = time.perf_counter()
    assert remove_repeated_bytes(frame).filter("n_removed = 0").count() == 200_000
    assert time.perf_counter() - started < 40


def test_long_texts_and_words(spark):
    long = "z" * 1_200_000
    many = " ".join(f"v{n}" for n in range(220_000))
    frame = spark.createDataFrame([(1, long), (2, many), (3, many + " more"), (4, long + " " + TEXT)], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:4] for r in remove_repeated_words(frame).collect()}
    assert got == {1: (1, 0, 0), 2: (220_000, 0, 0), 3: (220_001, 220_000, 1), 4: (91, 0, 0)}
    got = {r["doc_id"]: tuple(r)[1:3] for r in remove_repeated_bytes(frame).collect()}
    assert got[1] == (1_200_000, 1_199_999) and got[2] == (len(many), 0) and got[3] == (len(many) + 5, len(many))
    assert got[4][1] == 1_200_000
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(frame).collect()}
    assert got == {1: (1, 1), 2: (219_996, 2), 3: (219_997, 2), 4: (87, 4)}
