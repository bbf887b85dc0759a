"""Quality, mixing and the pipeline's stages."""

import os

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tablemart.llm import queries
from tablemart.llm.mixing import mix_sources, mix_sql
from tablemart.llm.quality import FEATURES, Distinct, fit, ngrams, score_quality
from test_text_dedup import shingles

FOLDER = "/root/testdata/sf0.01"


def test_fit_separates_and_handles_one_sided_labels():
    rows = [np.unique(np.array([1, 2, 3 + n % 4])) if n % 2 else np.unique(np.array([9, 10, 3 + n % 4])) for n in range(40)]
    weights, ratio, bias = fit([n % 2 for n in range(40)], rows)
    margins = [weights[r] @ ratio[r] / np.sqrt((ratio[r] ** 2).sum()) + bias for r in rows]
    assert all((m > 0) == bool(n % 2) for n, m in enumerate(margins))
    assert fit([], [])[2] == 1.0 and fit([0, 0], rows[:2])[2] == -1.0


def dense_solver(labels, rows, size, rounds=3000):
    """The same classifier by plain loops over dense vectors: ratios by counting, the dual by sweeps."""
    signs = [1.0 if y == 1 else -1.0 for y in labels]
    share = {}
    for sign in (1.0, -1.0):
        counts = [1.0 + sum(s == sign and slot in set(r.tolist()) for s, r in zip(signs, rows)) for slot in range(size)]
        rest = FEATURES - size
        share[sign] = [c / (sum(counts) + rest) for c in counts]
    ratio = np.log(share[1.0]) - np.log(share[-1.0])
    points = []
    for r in rows:
        x = np.zeros(size + 1)
        x[r] = ratio[r]
        x[:-1] /= np.sqrt((x[:-1] ** 2).sum())
        x[-1] = 1.0
        points.append(x)
    alpha, w = np.zeros(len(rows)), np.zeros(size + 1)
    for _ in range(rounds):
        for i, x in enumerate(points):
            old = alpha[i]
            alpha[i] = min(max(old - (signs[i] * (w @ x) - 1) / (x @ x), 0.0), 1.0)
            w += (alpha[i] - old) * signs[i] * x
    return np.array([w @ x for x in points])


def test_fit_against_a_dense_solver():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 40, 12)) for _ in range(60)]
    labels = [int((r < 12).sum() + rng.normal() > 3.6) for r in rows]
    weights, ratio, bias = fit(labels, rows, epochs=3000)
    got = np.array([weights[r] @ ratio[r] / np.sqrt((ratio[r] ** 2).sum()) + bias for r in rows])
    np.testing.assert_allclose(got, dense_solver(labels, rows, 40), atol=2e-3)


def test_stages_judge_rows_not_ids(spark):
    """Null, repeated and very large ids, columns with the stages' own names, and empty tables."""
    stages = dict(corpus_pipeline.STAGES)
    base = spark.read.parquet(f"{FOLDER}/documents.parquet").filter("n_chars > 400").limit(3)
    texts = [r["text"] for r in base.collect()]
    junk = "zz## " * 60
    big = 2**53
    rows = [
        (big + 1, texts[0]), (big + 1, texts[0]), (big + 2, texts[0] + " x"), (None, texts[1]), (None, texts[1]),
        (7, texts[2]), (7, junk), (8, None), (9, ""), (8, None),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars", "1 AS _row", "2 AS _group", "3 AS _mark0"
    )
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    near = stages["n-gram Jaccard join"](spark, frame, FOLDER)
    assert near.columns == frame.columns
    got = sorted(((r["doc_id"], r["text"]) for r in near.collect()), key=str)
    want = [(big + 1, texts[0]), (None, texts[1]), (7, texts[2]), (7, junk), (8, None), (8, None), (9, "")]
    assert got == sorted(want, key=str)
    kept = stages["quality classifier"](spark, frame, FOLDER)
    assert kept.columns == frame.columns
    scores = {r["doc_id"]: r for r in score_quality(frame.selectExpr("monotonically_increasing_id() AS doc_id", "text"), labels).collect()}
    assert kept.count() == sum(r["predicted"] for r in scores.values())
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame.limit(0), FOLDER).count() == 0, name


def test_ngrams_are_distinct_and_bounded():
    distinct = Distinct()
    for text in (b"", b" ", b"a", b"word " * 1000, "über Straße".encode()):
        slots = distinct(ngrams(text))
        assert len(set(slots.tolist())) == len(slots) and (len(slots) == 0 or slots.max() < FEATURES)
    assert set(distinct(ngrams(b"ab ab")).tolist()) == set(ngrams(b"ab ab").tolist())


def test_quality_on_held_out_rows(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = [r for r in score_quality(documents, labels).collect() if r["held_out"] and r["doc_id"] in known]
    assert len(rows) > 50
    right = sum(r["predicted"] == known[r["doc_id"]] for r in rows)
    assert right >= 0.95 * len(rows)
    good = [r for r in rows if known[r["doc_id"]] == 1]
    assert sum(r["predicted"] == 0 for r in good) <= 0.02 * len(good)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_quality_of_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame(
        [(1, 0, 9), (1, 1, 9), (None, 1, 9), (500, 1, 9), (7, None, 9), (8, 5, 9), (6, 0, 9)], "doc_id long, quality int, text int"
    )
    assert score_quality(odd_documents, labels).count() == odd_documents.count()
    assert score_quality(no_documents, labels).count() == 0
    assert {r["predicted"] for r in score_quality(odd_documents, labels.limit(0)).collect()} == {1}


def test_mix_meets_targets(spark):
    rng = np.random.default_rng(8)
    rows = [(n, " ".join(["w"] * int(rng.pareto(1.2) * 20)), f"s{n % 7}" if n % 9 else None) for n in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(frame).collect()
    taken, target = {}, {}
    source = {n: s for n, _, s in rows}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[source[r["doc_id"]]] = taken.get(source[r["doc_id"]], 0) + r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert abs(sum(target.values()) - sum(r["size"] for r in got)) < 1
    assert all(abs(taken[s] - t) <= 0.01 * t + 64 for s, t in target.items())
    assert sorted(map(tuple, mix_sources(frame).collect())) == sorted(map(tuple, got))


def test_mix_joins_its_rows_once(spark):
    """What the rounds found comes to the rows in one join, however many rounds there are."""
    rows = [(n, "w " * (n * 37 % 5000), f"s{n % 3}") for n in range(60)]
    mixed = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Union" not in plan


def test_mix_of_odd_rows(odd_documents, no_documents, spark):
    assert mix_sources(odd_documents).count() == odd_documents.count()
    assert mix_sources(no_documents).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r["size"], r["target"], r["taken"]) for r in mix_sources(empty).collect()} == {(0, 0.0, 0)}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    cursor = connection.execute(queries.ORACLES[name])
    names = [c[0] for c in cursor.description]
    got = sorted(tuple(r[n] for n in names) for r in queries.QUERIES[name](spark, FOLDER).collect())
    assert got == sorted(cursor.fetchall())
    assert mix_sql().count("taken0")


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    first = corpus_pipeline.quality(spark, docs, FOLDER)
    scores = {r["doc_id"]: r["predicted"] for r in queries.QUERIES["op3_quality_classifier"](spark, FOLDER).collect()}
    assert {r["doc_id"] for r in first.collect()} == {k for k, v in scores.items() if v == 1}
    second = corpus_pipeline.near_duplicates(spark, first, FOLDER)
    sets = {r["doc_id"]: shingles(r["text"]) for r in first.collect()}
    left = {r["doc_id"] for r in second.collect()}
    for gone in set(sets) - left:
        assert any(100 * len(sets[gone] & s) >= 80 * len(sets[gone] | s) for k, s in sets.items() if k != gone)
    third = corpus_pipeline.substrings(spark, second, FOLDER)
    assert third.schema == docs.schema and {r["doc_id"] for r in third.collect()} == left
    seen, want = {}, {}
    for r in sorted(second.collect(), key=lambda r: r["doc_id"]):
        words = [w.decode() for w in shingle_words(r["text"])]
        gone = [False] * len(words)
        for i in range(len(words) - 49):
            if seen.setdefault(tuple(words[i : i + 50]), r["doc_id"]) != r["doc_id"]:
                gone[i : i + 50] = [True] * 50
        want[r["doc_id"]] = " ".join(w for w, g in zip(words, gone) if not g)
    assert {r["doc_id"]: r["text"] for r in third.collect()} == want
    fourth = corpus_pipeline.mixed(spark, third, FOLDER)
    assert fourth.schema.names == docs.schema.names
    counts = {r["doc_id"]: r["count"] for r in fourth.groupBy("doc_id").count().collect()}
    mix = {r["doc_id"]: r["taken"] // r["size"] for r in mix_sources(third).collect() if r["taken"]}
    assert sum(counts.values()) == sum(mix.values())
    fifth = corpus_pipeline.packed(spark, fourth, FOLDER)
    assert fifth.filter("piece = 0").count() == fourth.count()


def shingle_words(text):
    from test_text_dedup import SPLIT

    return SPLIT.findall((text or "").encode())


def test_stage_list_and_entry():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and os.path.exists(corpus_pipeline.__file__)
    assert len([n for n in queries.QUERIES if n.startswith("op")]) == 13


def test_mix_survives_another_cut_of_the_input(spark, tmp_path, monkeypatch):
    """Executors come and go between two scans: the copies still go to the rows they were meant for."""
    rows = [(n, " ".join([f"t{n}"] * (5 + n % 40)), f"s{n % 4}", f"own {n}") for n in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `_row` string")
    docs.repartition(12).write.parquet(str(tmp_path / "documents"))
    docs = spark.read.parquet(str(tmp_path / "documents"))
    setting, before = "spark.sql.files.minPartitionNum", spark.conf.get("spark.sql.files.openCostInBytes")

    def mix_then_recut(frame):
        made = mix_sources(frame)
        spark.conf.set(setting, "12")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        return made

    monkeypatch.setattr(corpus_pipeline, "mix_sources", mix_then_recut)
    spark.conf.set(setting, "1")
    try:
        got = sorted(map(tuple, corpus_pipeline.mixed(spark, docs, FOLDER).collect()))
    finally:
        spark.conf.unset(setting)
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mix_sources(docs).collect()}
    assert sum(taken.values()) == len(got)
    # By source, size and number of copies: rows of one size are interchangeable.
    sizes = {n: (source, len(text.split())) for n, text, source, _ in rows}
    count = {}
    for r in got:
        count[r[0]] = count.get(r[0], 0) + 1
    per_got, per_want = {}, {}
    for n, key in sizes.items():
        per_got.setdefault(key, []).append(count.get(n, 0))
        per_want.setdefault(key, []).append(taken[n])
    assert {k: sorted(v) for k, v in per_got.items()} == {k: sorted(v) for k, v in per_want.items()}
    assert all(r in set(rows) for r in got)
