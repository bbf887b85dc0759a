"""Periodic runs against plain loops."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from tablemart.llm import runs as module
from tablemart.llm.arrays import RangeMin
from tablemart.llm.runs import common_prefixes, find_runs, periodic_documents, run_digest, runs_of, suffix_order


def by_loops(words, exponent=4, least=6):
    """(start, length, period) of every run, from every stretch of equal words q apart."""
    found, size = {}, len(words)
    for q in range(1, size // 2 + 1):
        low = 0
        while low + q < size:
            if words[low] != words[low + q]:
                low += 1
                continue
            high = low
            while high + q < size and words[high] == words[high + q]:
                high += 1
            # [low, high + q) has period q and nothing beside it keeps it.
            if high + q - low >= 2 * q:
                found.setdefault((low, high + q), q)
            low = high
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= max(least, exponent * q))


def bounds(docs):
    sizes = np.array([len(d) for d in docs])
    after = np.cumsum(sizes)
    return np.repeat(after - sizes, sizes), np.repeat(after, sizes)


letters = st.lists(st.integers(0, 2), max_size=40)
periodic = st.tuples(letters, st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 9), letters).map(
    lambda t: t[0][:8] + t[1] * t[2] + t[3][:8]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(letters, periodic), min_size=1, max_size=5), st.sampled_from([2, 3, 4]))
def test_runs_of_several_documents(docs, exponent):
    names = np.array([w for d in docs for w in d], dtype=np.int64)
    if not len(names):
        return
    lows, highs = bounds(docs)
    start, end, period = runs_of(names, lows, highs, exponent, 3)
    at = np.cumsum([0, *map(len, docs)])
    want = [(s + low, n, q) for low, d in zip(at, docs) for s, n, q in by_loops(d, exponent, 3)]
    assert sorted(zip(start.tolist(), (end - start).tolist(), period.tolist())) == sorted(want)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(letters, periodic), min_size=1, max_size=4))
def test_suffixes_are_in_order(docs):
    names = np.array([w for d in docs for w in d], dtype=np.int64)
    if not len(names):
        return
    lows, highs = bounds(docs)
    order, ranks = suffix_order(names, lows, highs)
    suffixes = [(int(lows[i]), names[i : highs[i]].tolist()) for i in range(len(names))]
    assert order.tolist() == sorted(range(len(names)), key=lambda i: suffixes[i])
    assert (order[ranks[-1]] == np.arange(len(names))).all()
    lcp = common_prefixes(order, ranks, highs)
    for slot in range(1, len(names)):
        (a, x), (b, y) = suffixes[order[slot - 1]], suffixes[order[slot]]
        same = next((n for n, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert lcp[slot] == (same if a == b else 0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=60), st.integers(1, 60))
def test_walks_over_minima(values, longest):
    made = RangeMin(np.array(values), longest)
    for start in range(len(values)):
        for bound in range(6):
            after = next((i for i in range(start, len(values)) if values[i] < bound), len(values))
            before = next((i for i in range(start, -1, -1) if values[i] <= bound), -1)
            assert made.next_below(np.array([start]), np.array([bound])).tolist() == [after]
            assert made.last_at_most(np.array([start]), np.array([bound])).tolist() == [before]
    lows, highs = np.array([0]), np.array([min(longest, len(values))])
    assert made.least(lows, highs).tolist() == [min(values[: highs[0]])]


def digest_by_loops(doc, text):
    words = (text or "").encode().split()
    found = by_loops(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    top = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    milli = 1000 * top[1] // top[2] if found else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc, len(found), top[0], top[1], top[2], milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def rebuilt(doc, text):
    words = (text or "").encode().split()
    if doc is None or not words or zlib.crc32(str(doc).encode()) % 10:
        return text
    g = zlib.crc32(str(doc).encode()) // 10
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return b" ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))).decode()


def test_digest_against_loops(spark, monkeypatch, odd_documents, no_documents):
    rng = random.Random(2)
    rows = []
    for n in range(150):
        words = [rng.choice("abcde") for _ in range(rng.randint(0, 60))]
        words[len(words) // 2 :] = words[len(words) // 2 :][: rng.randint(1, 5)] * rng.randint(1, 12)
        rows.append((n, rng.choice([" ", "\n", " \t\x0b"]).join(words)))
    rows += [(None, "x y " * 40), (7, "é  " * 30), (7, "é  " * 30), (200, None), (201, " "), (2**53 + 1, "a " * 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS runs", "2 AS n", "'q' AS words")
    for size in (50, 1 << 17):
        monkeypatch.setattr(module, "GROUP_WORDS", size)
        got = sorted((tuple(r) for r in run_digest(frame.repartition(3)).collect()), key=str)
        assert got == sorted((digest_by_loops(d, t) for d, t in rows), key=str)
    got = sorted((tuple(r) for r in run_digest(periodic_documents(frame)).collect()), key=str)
    assert got == sorted((digest_by_loops(d, rebuilt(d, t)) for d, t in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 50
    assert run_digest(odd_documents).count() == odd_documents.count()
    assert run_digest(periodic_documents(no_documents)).count() == 0


def test_long_periodic_text(spark):
    """One word 300,000 times, and a long period: time does not grow with the square."""
    text = "a " * 300_000 + " ".join(f"w{n % 7000}" for n in range(100_000))
    row = find_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(0, 300_000, 1), (300_000, 100_000, 7000)]
    assert len(bytes(row["collapsed"]).split()) == 7001
