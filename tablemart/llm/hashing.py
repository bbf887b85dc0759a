"""64-bit names of words and of windows of words or bytes, for whole blocks of text at a time."""

import numpy as np

#: The six separators: space and the control signs 9 to 13.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_RANDOM = np.random.default_rng(20250202)
BYTE_NAME = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_LEFT, _RIGHT = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
SEGMENT = 1 << 20
_POWERS = {}


def mix(names):
    """Spread every bit of a name over all of it."""
    names = names ^ (names >> np.uint64(33))
    names = names * np.uint64(0xFF51AFD7ED558CCD)
    names ^= names >> np.uint64(33)
    names *= np.uint64(0xC4CEB9FE1A85EC53)
    names ^= names >> np.uint64(33)
    return names


def join_names(left, right):
    """Name of a string from the names of its two parts."""
    return mix(left * _LEFT + (right ^ (right >> np.uint64(29))) * _RIGHT)


def windows(names, size):
    """Name of each run of `size` names, by doubling: one pass per binary digit of size."""
    if len(names) < size:
        return names[:0]
    done, made, block, width = 0, None, names, 1
    while True:
        if size & width:
            if made is None:
                made, done = block, width
            else:
                count = len(names) - done - width + 1
                made, done = join_names(made[:count], block[done : done + count]), done + width
        if done == size:
            return made
        block = join_names(block[: len(block) - width], block[width:])
        width *= 2


def _powers(size):
    if "up" not in _POWERS or _POWERS["size"] < size:
        ones = np.ones(size + 1, dtype=np.uint64)
        up, down = ones.copy(), ones.copy()
        up[1:], down[1:] = _BASE, _BACK
        _POWERS.update(size=size, up=np.cumprod(up), down=np.cumprod(down))
    return _POWERS["up"], _POWERS["down"]


def _segment_words(data):
    solid = ~SEPARATOR[data]
    edge = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    up, down = _powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_NAME[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts, ends


def word_names(text):
    """Names of the words of one text (bytes), with the start and end of each; works through long
    texts by segments that end between words."""
    data, low, parts = np.frombuffer(text, dtype=np.uint8), 0, []
    while len(data) - low > 2 * SEGMENT:
        rest = np.flatnonzero(SEPARATOR[data[low + SEGMENT : low + 2 * SEGMENT]])
        width = SEGMENT + (int(rest[0]) if len(rest) else 0)
        if not len(rest):
            # One word longer than a segment: find its end.
            far = low + 2 * SEGMENT
            while far < len(data) and not SEPARATOR[data[far]]:
                far += 1
            width = far - low
        names, starts, ends = _segment_words(data[low : low + width])
        parts.append((names, starts + low, ends + low))
        low += width
    names, starts, ends = _segment_words(data[low:])
    parts.append((names, starts + low, ends + low))
    return tuple(np.concatenate(p) for p in zip(*parts)) if len(parts) > 1 else parts[0]
