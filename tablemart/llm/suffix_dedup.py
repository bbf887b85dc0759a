"""Repeated byte strings by hashes of windows behind difference-cover samples, in place of a suffix sort.

The strings at the places of a difference cover modulo 31 are named by a fixed three-level hash: names of
3, 9 and 27 bytes are hashes of three shorter names, and names of 27 bytes cover the tuple of a sample.
Nothing is ranked and no suffixes are merged. A sample whose name is unique is dropped; windows that hold
a repeated sample are named at their whole length and compared in buckets with their document: all but
the first of equal ones start earlier too.
"""

import numpy as np

from tablemart.llm.hashing import mix
from tablemart.llm.repeats import Units, without_repeats

#: A perfect difference set. Every difference modulo 31 is one of two members, so any
#: two equal windows hold samples at a common place among their first 31 bytes.
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)
SEGMENT = 1 << 17
#: Bytes of a block: a byte may be a window of its own, so blocks are smaller than those of words.
BLOCK_BYTES = 1 << 20
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _triple(names, step):
    count = len(names) - 2 * step
    return mix(names[:count] * _A + names[step : step + count] * _B + names[2 * step :] * _C)


def _names_27(data):
    """Names of all 27-byte strings: triples of triples of triples of bytes."""
    data = data.astype(np.uint64)
    three = mix(data[:-2] | data[1:-1] << np.uint64(8) | data[2:] << np.uint64(16))
    return _triple(_triple(three, 3), 9)


class Bytes(Units):
    """Byte windows of one block."""

    def __init__(self, block, window):
        if window < PERIOD + 26:
            raise ValueError(f"a window holds at least {PERIOD + 26} bytes")
        self.block, self.window, self.tuple = block, window, window - PERIOD + 1
        self.data = np.frombuffer(b"".join(block.texts), dtype=np.uint8)
        self.owner = np.repeat(np.arange(len(block.sizes), dtype=np.int32), block.sizes)
        self.ends = np.cumsum(block.sizes)
        cover = np.zeros(PERIOD, dtype=bool)
        cover[list(COVER)] = True
        pattern = np.tile(cover, int(block.sizes.max(initial=0)) // PERIOD + 1)
        chosen = [pattern[: max(0, s - self.tuple + 1)] for s in block.sizes.tolist()]
        lows = (self.ends - block.sizes).tolist()
        found = [np.flatnonzero(c) + low for c, low in zip(chosen, lows)]
        self.places = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def _at(self, places, width):
        """Names of the strings of `width` bytes at rising places, made segment by segment."""
        steps = [*range(0, width - 27, 27), width - 27]
        out = np.empty(len(places), dtype=np.uint64)
        for low in range(0, len(self.data), SEGMENT):
            a, b = np.searchsorted(places, [low, low + SEGMENT])
            if a == b:
                continue
            names, here = _names_27(self.data[low : low + SEGMENT + width]), places[a:b] - low
            made = names[here]
            for step in steps[1:]:
                made = mix(made * _A + names[here + step] * _B + np.uint64(step))
            out[a:b] = made
        return out

    def sampled(self):
        return self._at(self.places, self.tuple)

    def candidates(self, repeated):
        # A window starts at most PERIOD - 1 bytes before a repeated sample that it holds.
        near = np.zeros(len(self.data) + PERIOD + 1, dtype=np.int32)
        near[self.places[repeated] + 1] = 1
        near = np.cumsum(near, dtype=np.int32)
        starts = np.flatnonzero(near[PERIOD : PERIOD + len(self.data)] > near[: len(self.data)])
        return starts[starts + self.window <= self.ends[self.owner[starts]]]

    def named(self, starts):
        return self._at(starts, self.window)

    def whole(self, document):
        return self.block.texts[document]

    def kept(self, document, removed):
        return np.frombuffer(self.block.texts[document], dtype=np.uint8)[~removed].tobytes()


def remove_repeated_bytes(documents, window=100, with_text=False, size=None):
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and with with_text the
    remaining bytes as `kept`.

    Removed is each byte covered by a `window`-byte string that also starts earlier: in a document
    with a smaller doc_id, or earlier in the same one. Overlaps count, strings are judged on the input.
    n_spans counts maximal removed runs. Null texts are empty, texts shorter than the window stay.
    Null doc_ids come after all others; rows of a repeated doc_id are ordered by a hash of their text
    and are different documents. An empty table gives no rows; other columns are not looked at.
    """
    rows = without_repeats(
        documents, lambda block: Bytes(block, window), within=True, with_text=with_text, size=size or BLOCK_BYTES
    )
    return rows.withColumnRenamed("units", "n_bytes").drop("extra", *([] if with_text else ["kept"]))
