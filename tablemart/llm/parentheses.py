"""A trie as balanced parentheses in preorder: findclose over blocks of excess, rank of leaf pairs."""

import numpy as np

from tablemart.llm.arrays import RangeMin, spread

BLOCK = 64
ROWS = 1 << 14


def bits_of_paths(sizes, shared):
    """The parentheses (True opens) of the trie of sorted distinct paths: steps of each path, and how
    many of them it shares with the path before. The root opens first and closes last."""
    closes = np.append(sizes[:-1] - shared[1:], sizes[-1] + 1)
    turns = np.stack([sizes - shared, closes], axis=1).ravel()
    turns[0] += 1
    return np.repeat(np.tile([True, False], len(sizes)), turns)


class Parentheses:
    """Nodes are numbered in preorder; `opens` and `closes` are the places of their parentheses.

    Blocks of BLOCK signs know the smallest and largest excess (opened less closed) in them. As excess
    changes by one, a node closes in the first block behind it whose range reaches below its own.
    """

    def __init__(self, bits):
        self.bits = bits
        self.opens = np.flatnonzero(bits)
        self.excess = np.cumsum(np.where(bits, 1, -1))
        padded = np.append(self.excess, np.zeros(-len(bits) % BLOCK, dtype=np.int64))
        self.blocks = padded.reshape(-1, BLOCK)
        self.low, self.high = self.blocks.min(axis=1), self.blocks.max(axis=1)
        self.depth = self.excess[self.opens] - 1
        self.closes = self._find_closes()
        #: Nodes that open before a place: rank of opening signs.
        self.rank = np.concatenate([[0], np.cumsum(bits)])
        self.after = self.rank[self.closes]

    def _in_block(self, block, start, bound):
        """First place from `start` (within a block) on with an excess below the bound; BLOCK if none."""
        out = np.empty(len(block), dtype=np.int64)
        for low in range(0, len(block), ROWS):
            part = slice(low, low + ROWS)
            hit = (self.blocks[block[part]] < bound[part, None]) & (np.arange(BLOCK) >= start[part, None])
            out[part] = np.where(hit.any(axis=1), hit.argmax(axis=1), BLOCK)
        return out

    def _find_closes(self):
        bound, block, start = self.excess[self.opens], self.opens // BLOCK, self.opens % BLOCK + 1
        place = self._in_block(block, start, bound)
        far = np.flatnonzero(place == BLOCK)
        if len(far):
            block = block.copy()
            block[far] = RangeMin(self.low).next_below(block[far] + 1, bound[far])
            place[far] = self._in_block(block[far], np.zeros(len(far), dtype=np.int64), bound[far])
        return block * BLOCK + place

    def leaf_pairs(self):
        """For each node: does its parenthesis close at once."""
        return self.closes == self.opens + 1

    def subtree_sums(self, values):
        """Sum of a value per node over every subtree, its top included."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.after] - total[:-1]

    def subtree_least(self, values):
        nodes = np.arange(len(values))
        return RangeMin(values).least(nodes, self.after)

    def parents(self):
        """Parent of each node, -1 for the root: a first child stands behind its parent, and siblings
        find the first one by doubling their steps to the left."""
        size = len(self.opens)
        first = np.arange(size)
        behind = np.flatnonzero(~self.bits[self.opens[1:] - 1]) + 1
        owner = np.empty(len(self.bits), dtype=np.int64)
        owner[self.closes] = np.arange(size)
        first[behind] = owner[self.opens[behind] - 1]
        while True:
            further = first[first]
            if (further == first).all():
                return first - 1
            first = further

    def ancestors(self, node):
        """The node and those above it, from the root."""
        above = np.arange(node + 1)
        return above[self.closes[: node + 1] >= self.closes[node]]


def preorder_steps(sizes, shared):
    """For each new node of each path: the path's index and the step of it that the node stands for."""
    return spread(shared, sizes - shared)
