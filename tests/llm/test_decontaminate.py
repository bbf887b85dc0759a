"""Multi-pattern search and benchmark decontamination against plain loops."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tablemart.llm import decontaminate as module, multi_pattern
from tablemart.llm.decontaminate import decontaminate, normalized
from tablemart.llm.multi_pattern import PAD, Patterns

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_loops(documents, benchmark, size=10):
    """{row: (id, words, hit, items, hash)} by comparing every window with every place."""
    windows = {}
    for item, text in benchmark:
        words = words_of(text)
        for low in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[low : low + size]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in documents:
        words, hit, items = words_of(text), set(), set()
        for window, owners in windows.items():
            for low in range(len(words) - len(window) + 1):
                if tuple(words[low : low + len(window)]) == window:
                    hit |= set(range(low, low + len(window)))
                    items |= owners
        name = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(items), name, bool(hit)))
    return sorted(out, key=str)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.binary(min_size=1, max_size=40).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=30, unique=True),
    st.binary(max_size=3000).map(lambda b: bytes(97 + x % 3 for x in b)),
)
def test_every_occurrence_is_found(patterns, text):
    data = np.frombuffer(text + bytes(PAD), dtype=np.uint8)
    got = sorted(zip(*[a.tolist() for a in Patterns(patterns).find(data)]))
    want = sorted(
        (at, len(p), n) for n, p in enumerate(patterns) for at in range(len(text) - len(p) + 1) if text[at : at + len(p)] == p
    )
    assert got == want


def test_shifts_skip_places(monkeypatch):
    rng = random.Random(1)
    patterns = [bytes(rng.choice(range(97, 123)) for _ in range(50)) for _ in range(20)]
    text = bytes(rng.choice(range(97, 123)) for _ in range(100_000)) + patterns[3]
    looked = []
    table = Patterns(patterns).tables[0]
    slot = table._slot
    monkeypatch.setattr(table, "_slot", lambda b: looked.append(len(b)) or slot(b))
    data = np.frombuffer(text + bytes(PAD), dtype=np.uint8)
    found = table.candidates(multi_pattern._words_at(data), len(text))
    assert 100_000 in found.tolist() and sum(looked) < len(text) / 10


def test_normalized_texts():
    data, words, owner = normalized(["Ab, c\x00d".encode(), b"", "ÄÖ x9".encode()])
    assert bytes(data)[:-PAD] == b" ab c d \0 \0" + " ÄÖ x9 ".encode() + b"\0"
    assert owner.tolist() == [0, 0, 0, 2, 2] and [chr(data[w]) for w in words[:3]] == ["a", "c", "d"]


def odd(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["A", "b", "Über", "x1", "long" * 9, "中文", "the"])
    items = [(n, " ".join(word() for _ in range(n % 17))) for n in range(1, 25)]
    items += [(None, "no id here at all"), (7, "second text of seven " * 4), (90, None), (91, " ,;"), (92, "the"), (92, "the"), (93, items[11][1])]
    docs = [(n, ", ".join(rng.choice(items)[1] or "" if rng.random() < 0.6 else word() for _ in range(rng.randint(0, 9)))) for n in range(60)]
    docs += [(None, items[15][1].upper()), (5, items[15][1]), (5, items[15][1]), (100, None), (101, ""), (102, "the " * 3000), (103, "q" * 200_000 + " the")]
    frame = spark.createDataFrame([(a, b, 1) for a, b in docs], "doc_id long, text string, n_items int").selectExpr("*", "n_items AS key", "'x' AS sets")
    bench = spark.createDataFrame([(a, b, "y") for a, b in items], "item_id long, text string, pattern string")
    return docs, items, frame.repartition(3), bench.repartition(2)


@pytest.mark.parametrize("block, batch", [(1 << 24, 1 << 23), (300, 2000)])
def test_hits_against_loops(spark, monkeypatch, block, batch):
    """One block of patterns, and many blocks, each searched for in a pass of its own."""
    docs, items, frame, bench = odd(spark)
    monkeypatch.setattr(module, "BATCH_BYTES", batch)
    if block == 300:
        items, bench = items[14:18], bench.filter("item_id BETWEEN 15 AND 18")
    monkeypatch.setattr(module, "BLOCK_BYTES", block)
    got = sorted((tuple(r) for r in decontaminate(frame, bench).collect()), key=str)
    assert got == by_loops(docs, items)
    assert any(r[5] for r in got) and not all(r[5] for r in got)


def test_nothing(spark):
    _, _, frame, bench = odd(spark)
    assert decontaminate(frame.limit(0), bench).count() == 0
    assert {tuple(r)[2:] for r in decontaminate(frame, bench.limit(0)).collect()} == {(0, 0, hashlib.sha256().hexdigest(), False)}
