"""Suffix, substring and n-gram dedup against plain loops."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest

from tablemart.llm import blocks, hashing, suffix_dedup
from tablemart.llm.jaccard_join import PrefixTree, ngram_components
from tablemart.llm.substring_dedup import deduplicated_documents, remove_repeated_words
from tablemart.llm.suffix_dedup import COVER, PERIOD, remove_repeated_bytes

SPLIT = re.compile(rb"[^\x20\x09-\x0D]+")


def passages(spark, count=60, seed=5):
    """Documents that share passages, shifted, across and within documents, with null ids among them."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
    shared = [" ".join(word() for _ in range(rng.choice((20, 49, 50, 51, 90)))) for _ in range(12)]
    rows = []
    for n in range(count):
        parts = [" ".join(word() for _ in range(rng.randint(0, 60))) if rng.random() < 0.6 else rng.choice(shared) for _ in range(rng.randint(1, 6))]
        rows.append((n, " ".join(parts)))
    rows += [(200, rows[3][1]), (201, ""), (202, None), (None, rows[4][1])]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def removed(rows, units, window, within):
    """{doc_id: (units, removed, spans, hash)} by a table of every window; null ids come last."""
    seen, out = {}, {}
    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        parts = units((text or "").encode())
        gone, join = [False] * len(parts), b"".join if within else b" ".join
        starts = [bytes(parts[i : i + window]) if within else b" ".join(parts[i : i + window]) for i in range(len(parts) - window + 1)]
        for i, name in enumerate(starts):
            if name in seen and (within or seen[name] != (key,)):
                gone[i : i + window] = [True] * window
            seen.setdefault(name, (key,))
        kept = bytes(p for p, g in zip(parts, gone) if not g) if within else join(p for p, g in zip(parts, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[key] = (len(parts), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_cover_meets_every_shift():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_windows_name_equal_runs_equally():
    names = np.arange(300, dtype=np.uint64) % np.uint64(7)
    for size in (1, 5, 25, 50):
        made = hashing.windows(hashing.mix(names), size)
        assert len(made) == 301 - size
        assert len(np.unique(made)) == 7


def test_word_names_do_not_depend_on_place(monkeypatch):
    text = b" ".join(b"w%d" % (n % 50) for n in range(5000)) + b" " + b"y" * 9000
    want = hashing.word_names(text)
    monkeypatch.setattr(hashing, "SEGMENT", 1000)
    got = hashing.word_names(text)
    assert all((a == b).all() for a, b in zip(want, got))
    assert [text[a:b] for a, b in zip(*got[1:])] == SPLIT.findall(text)


def test_sorted_numbers_round_trip():
    for values in ([], [7], [0, 0, 5], [3, 2**40, 2**63 + 5]):
        got = blocks.unpack_sorted(blocks.pack_sorted(np.array(values, dtype=np.uint64)))
        assert got.tolist() == values


@pytest.mark.parametrize("block", [500, 1 << 22])
def test_bytes_and_words_against_loops(spark, monkeypatch, block):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    frame = passages(spark)
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    for operator, units, window, within in (
        (remove_repeated_bytes, lambda t: t, 100, True), (remove_repeated_words, SPLIT.findall, 50, False)
    ):
        want = removed(rows, units, window, within)
        got = {r[0]: tuple(r)[1:] for r in operator(frame, window).collect()}
        assert got == want
        assert sum(v[1] for v in want.values()) > 1000


def test_kept_text_keeps_the_columns(spark):
    frame = passages(spark).selectExpr("doc_id", "text", "doc_id * 2 AS n_chars", "cast(null AS string) AS source", "'x' AS `kept`")
    left = deduplicated_documents(frame)
    assert left.schema.names == frame.schema.names
    hashes = {r["doc_id"]: r["kept_sha256"] for r in remove_repeated_words(frame).collect()}
    for r in left.collect():
        assert hashlib.sha256(r["text"].encode()).hexdigest() == hashes[r["doc_id"]]
        assert (r["n_chars"], r["source"], r["kept"]) == (None if r["doc_id"] is None else 2 * r["doc_id"], None, "x")


def test_kept_columns_keep_microseconds(spark):
    frame = spark.createDataFrame([(1, "some words")], "doc_id long, text string").selectExpr(
        "*", "timestamp'2024-03-31 01:02:03.123456' AS seen", "timestamp_ntz'1850-01-01 01:02:03.000007' AS local",
        "timestamp'1850-01-01 01:02:03.5' AS old", "CAST(NULL AS timestamp) AS none",
    )
    micros = ["doc_id", "text", "unix_micros(seen) s", "CAST(local AS string) l", "unix_micros(old) o", "none"]
    got = deduplicated_documents(frame)
    assert got.schema.names == frame.schema.names
    assert got.selectExpr(*micros).collect() == frame.selectExpr(*micros).collect()


def test_odd_documents(odd_documents, no_documents):
    rows = odd_documents.count()
    for operator in (remove_repeated_bytes, remove_repeated_words):
        got = operator(odd_documents).collect()
        assert len(got) == rows
        # Of the copies of the long text all but the first lose everything.
        assert sum(r["n_removed"] == r[1] > 0 for r in got if r["doc_id"] in (3, 122, None)) >= 3
        assert operator(no_documents).count() == 0
    got = ngram_components(odd_documents)
    assert got.count() == rows
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[107]["component_id"] == 6 and by_id[106]["component_id"] == 6  # A-Z count as a-z
    assert by_id[0]["component_id"] == 0 and by_id[101]["component_id"] == 101  # empty links with nothing
    assert by_id[122]["component_id"] == 3
    assert ngram_components(no_documents).count() == 0


def shingles(text):
    words = SPLIT.findall((text or "").encode().lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) > 4 else frozenset([tuple(words)] if words else [])


def near_copies(spark, bases=8, copies=12):
    rng, rows = random.Random(3), []
    for base in range(bases):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice((6, 40, 200)))]
        for _ in range(copies):
            edited = [f"e{rng.random()}" if rng.random() < rng.choice((0, 0.01, 0.04)) else w for w in words]
            rows.append((len(rows), " ".join(edited)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("cluster", [3, 2048])
def test_components_against_all_pairs(spark, monkeypatch, cluster):
    from tablemart.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "CLUSTER_ROWS", cluster)
    frame = near_copies(spark)
    sets = {r["doc_id"]: shingles(r["text"]) for r in frame.collect()}
    low = {k: k for k in sets}
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]) and low[a] != low[b]:
            old, new = max(low[a], low[b]), min(low[a], low[b])
            low = {k: new if v == old else v for k, v in low.items()}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_components(frame).collect()}
    assert got == {k: (len(sets[k]), low[k]) for k in sets}
    assert len(set(low.values())) < len(low)


def test_components_survive_another_cut_of_the_input(spark, monkeypatch, tmp_path):
    """Both passes read the same blocks, also where the input is cut differently in between."""
    from tablemart.llm import jaccard_join

    near_copies(spark).repartition(12).write.parquet(str(tmp_path / "documents"))
    frame = spark.read.parquet(str(tmp_path / "documents"))
    want = sorted(map(tuple, ngram_components(frame).collect()))
    setting, cost = "spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes"
    before, first = spark.conf.get(cost), jaccard_join.answered

    def recut(*args):
        made = first(*args)
        spark.conf.set(setting, "12")
        spark.conf.set(cost, "1")
        return made

    monkeypatch.setattr(jaccard_join, "answered", recut)
    spark.conf.set(setting, "1")
    try:
        got = sorted(map(tuple, ngram_components(spark.read.parquet(str(tmp_path / "documents"))).collect()))
    finally:
        spark.conf.unset(setting)
        spark.conf.set(cost, before)
    assert got == want


def linked_by_all_pairs(sets):
    low = {k: k for k in sets}
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]) and low[a] != low[b]:
            old, new = max(low[a], low[b]), min(low[a], low[b])
            low = {k: new if v == old else v for k, v in low.items()}
    return low


@pytest.mark.parametrize("own", ["unique", "pooled"])
def test_no_bin_holds_a_group_below_the_threshold(spark, monkeypatch, own):
    """A template group whose members stay just under the threshold, and a few true copies in it."""
    from tablemart.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "CLUSTER_ROWS", 8)
    monkeypatch.setattr(jaccard_join, "PART_ROWS", 4, raising=False)
    held, links = [], jaccard_join._links

    def counted(sets, percent):
        held.append(sets.groupBy("bin", "cluster").count().agg({"count": "max"}).first()[0] or 0)
        return links(sets, percent)

    monkeypatch.setattr(jaccard_join, "_links", counted)
    rng, rows = random.Random(5), []
    for n in range(64):
        # Twelve phrases, three of them own ones: two members have at most 102 of 130 n-grams in common.
        tags = [f"p{k}v{n // 4**k % 4}" if own == "pooled" else f"u{n}s{k}" for k in range(3)]
        tags = [f"t{k}" for k in range(8)] + tags + ["t8"]
        rows.append((n, " ".join(f"{t}w{i}" for t in tags for i in range(10))))
    for n in range(6):
        words = rows[n * 9][1].split()
        words[rng.randint(0, 80)] = f"edit{n}"
        rows.append((100 + n, " ".join(words)))
    sets = {k: shingles(t) for k, t in rows}
    low = linked_by_all_pairs(sets)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r["doc_id"]: r["component_id"] for r in ngram_components(frame).collect()} == low
    assert len(set(low.values())) == 64
    # A cut with its pivots, or two parts; by chance a cut has a few rows more than CLUSTER_ROWS.
    assert max(held) <= 8 + 4 + 12, held


def test_prefix_tree_finds_exactly_the_linked_rows():
    rng = np.random.default_rng(1)
    for _ in range(100):
        base = rng.choice(10**6, size=rng.integers(3, 60), replace=False).astype(np.uint64)
        sets = {base[rng.random(len(base)) > rng.choice([0, 0.05, 0.2])].tobytes() for _ in range(8)} - {b""}
        sets = [np.unique(np.frombuffer(s, np.uint64)) for s in sorted(sets)]
        sets = list({s.tobytes(): s for s in sets}.values())
        tree = PrefixTree(sets)
        for row in range(len(sets)):
            own = set(tree.rows[row].tolist())
            want = {n for n in range(len(sets)) if n != row and 180 * len(own & set(tree.rows[n].tolist())) >= 80 * (len(own) + len(tree.rows[n]))}
            assert set(tree.links(row, 80, np.arange(len(sets)))) == want
