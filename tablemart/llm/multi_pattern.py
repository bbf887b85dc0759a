"""Wu-Manber search for many byte strings at once, over whole buffers of text.

A block is the last few bytes of a place where a pattern could end. A table of shifts, by hash of the
block, says how far the next such place is; where the shift is zero, the patterns of that suffix (and of
the hash of their first bytes) are compared with the text byte by byte. Many places of a buffer move on
together: each lane has its own stretch of it.
"""

import numpy as np

from tablemart.llm.arrays import spread

#: Lengths that share one table: short patterns would shorten the shifts of long ones.
CLASSES = (1, 4, 8, 16, 32)
LANE = 512
PAD = 8
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)


def _words_at(data):
    """The eight bytes at every place, as one number, without copying."""
    return np.ndarray(shape=(len(data) - PAD + 1,), dtype="<u8", buffer=data, strides=(1,))


def _mask(size):
    return np.uint64((1 << 8 * min(size, 8)) - 1)


class _Table:
    """Shifts and buckets of the patterns of one class."""

    def __init__(self, data, starts, sizes, numbers):
        self.least = int(sizes.min())
        # The rule of the method: as many bytes as tell apart twice all blocks, at three bits a byte.
        wanted = np.log2(2.0 * self.least * len(starts)) / 3
        self.block = int(min(self.least, 8, max(2, np.ceil(wanted))))
        self.bits = int(min(22, max(10, np.ceil(np.log2(4.0 * self.least * len(starts))))))
        self.mask, self.head = _mask(self.block), _mask(self.least)
        view = _words_at(data)
        self.shift = np.full(1 << self.bits, self.least - self.block + 1, dtype=np.int32)
        for end in range(self.block, self.least + 1):
            # Ends rise, so a smaller shift replaces a larger one.
            self.shift[self._slot(view[starts + end - self.block] & self.mask)] = self.least - end
        keys = self._key(view, starts)
        order = np.argsort(keys, kind="stable")
        self.keys, first = np.unique(keys[order], return_index=True)
        self.lows, self.counts = first, np.diff(first, append=len(order))
        self.starts, self.sizes, self.numbers = starts[order], sizes[order], numbers[order]

    def _slot(self, blocks):
        return (blocks * _SPREAD) >> np.uint64(64 - self.bits)

    def _key(self, view, starts):
        suffix = view[starts + self.least - self.block] & self.mask
        return suffix * _SPREAD ^ (view[starts] & self.head) * _OTHER

    def candidates(self, view, size):
        """Starts of all places where a suffix of the table ends, in no order."""
        low = np.arange(0, max(0, size - self.least + 1), LANE) + self.least
        high, found = np.minimum(low + LANE, size + 1), []
        while len(low):
            shift = self.shift[self._slot(view[low - self.block] & self.mask)]
            hit = shift == 0
            if hit.any():
                found.append(low[hit] - self.least)
                shift[hit] = 1
            low = low + shift
            live = low < high
            if not live.all():
                low, high = low[live], high[live]
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def matches(self, text, view, size, patterns):
        starts = self.candidates(view, size)
        keys = self._key(view, starts)
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[place] == keys
        starts, place = starts[known], place[known]
        which, member = spread(self.lows[place], self.counts[place])
        starts, own, sizes = starts[which], self.starts[member], self.sizes[member]
        numbers = self.numbers[member]
        fits = starts + sizes <= size
        starts, own, sizes, numbers = starts[fits], own[fits], sizes[fits], numbers[fits]
        done, at = [], 0
        while len(starts):
            # The last step goes back so far that it ends with the pattern.
            step = np.maximum(np.minimum(at, sizes - 8), 0)
            mask = np.where(sizes < 8, (np.uint64(1) << (8 * np.minimum(sizes, 7)).astype(np.uint64)) - np.uint64(1), _mask(8))
            same = (view[starts + step] ^ patterns[own + step]) & mask == 0
            starts, own, sizes, numbers = starts[same], own[same], sizes[same], numbers[same]
            at += 8
            over = sizes <= at
            done.append((starts[over], sizes[over], numbers[over]))
            starts, own, sizes, numbers = starts[~over], own[~over], sizes[~over], numbers[~over]
        return done


class Patterns:
    """Distinct patterns (bytes, none empty), to be searched for together."""

    def __init__(self, patterns):
        self.data = np.frombuffer(b"".join(patterns) + bytes(PAD), dtype=np.uint8)
        sizes = np.array([len(p) for p in patterns], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        group = np.searchsorted(CLASSES, sizes, side="right")
        self.tables = [
            _Table(self.data, starts[group == g], sizes[group == g], np.flatnonzero(group == g)) for g in np.unique(group)
        ]

    def find(self, text):
        """Start, size and pattern number of every occurrence in text (an array of bytes with PAD more
        behind them), overlapping ones too, in no order."""
        view, patterns, size = _words_at(text), _words_at(self.data), len(text) - PAD
        parts = [p for table in self.tables for p in table.matches(text, view, size, patterns)]
        if not parts:
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
        return tuple(np.concatenate(p) for p in zip(*parts))
