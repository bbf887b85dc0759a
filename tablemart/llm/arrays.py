"""Ranges and range minima over whole numpy arrays at a time."""

import numpy as np


def spread(lows, counts):
    """For the ranges [low, low + count): the index of the range of each member, and the members."""
    which = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    return which, np.arange(len(which)) + np.repeat(lows - (ends - counts), counts)


class RangeMin:
    """Minima of stretches of 1, 2, 4, .. values, up to `longest`."""

    def __init__(self, values, longest=None):
        self.levels, width = [np.asarray(values)], 1
        while 2 * width <= min(len(values), longest or len(values)):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[: len(last) - width], last[width:]))
            width *= 2

    def least(self, lows, highs):
        """Smallest value of each [low, high), none of them empty and none longer than `longest`."""
        level = np.frexp(highs - lows)[1] - 1
        out = np.empty(len(lows), dtype=self.levels[0].dtype)
        for n in np.unique(level):
            rows = np.flatnonzero(level == n)
            values = self.levels[n]
            out[rows] = np.minimum(values[lows[rows]], values[highs[rows] - (1 << n)])
        return out

    def next_below(self, starts, bounds):
        """First place at or behind each start whose value is below the bound; the length if there is none."""
        return self._walk(starts, bounds, 1, False)

    def last_at_most(self, starts, bounds):
        """Last place at or before each start whose value is at most the bound; -1 if there is none."""
        return self._walk(starts, bounds, -1, True)

    def _walk(self, starts, bounds, sign, equal):
        at, size = np.array(starts), len(self.levels[0])
        out = np.full(len(at), size if sign > 0 else -1)
        rows = np.arange(len(at))
        while len(rows):
            # Down the levels; what is still on its way goes down them again.
            for n in reversed(range(len(self.levels))):
                width, values = 1 << n, self.levels[n]
                low = at if sign > 0 else at - width + 1
                inside = (low >= 0) & (low + width <= size)
                seen = values[np.where(inside, low, 0)]
                free = inside & (seen > bounds if equal else seen >= bounds)
                at = at + sign * width * free
            inside = (at >= 0) & (at < size)
            value = self.levels[0][np.where(inside, at, 0)]
            done = ~inside | (value <= bounds if equal else value < bounds)
            out[rows[done]] = np.clip(at[done], -1, size)
            rows, at, bounds = rows[~done], at[~done], bounds[~done]
        return out
