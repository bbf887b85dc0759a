"""Substring dedup by names of word windows behind a minimizer filter, in place of relative Lempel-Ziv.

Nothing is factored and no reference is indexed. Each block sends the names of its seeds; a seed that
occurs twice makes the windows around it candidates. Names of these windows are compared in buckets (a
residue of the window's own name), and a word goes if a window that covers it also starts in an earlier
document. Windows decide each for itself, so there are no boundaries to check.
"""

import numpy as np

from tablemart.llm.hashing import windows, word_names
from tablemart.llm.repeats import Units, with_kept_text, without_repeats


class Words(Units):
    """Windows of words of one block. The seed of a window is the smallest name among its runs of half
    as many words, so equal windows have equal seeds at equal places."""

    def __init__(self, block, window):
        self.block, self.window = block, window
        self.names, self.starts, self.ends = word_names(b"\n".join(block.texts))
        self.lows = np.cumsum(block.sizes + 1) - block.sizes - 1
        self.owner = (np.searchsorted(self.lows, self.starts, side="right") - 1).astype(np.int32)
        count = max(0, len(self.names) - window + 1)
        last = np.arange(count) + window - 1
        self.valid = np.flatnonzero(self.owner[:count] == self.owner[last]) if count else np.zeros(0, dtype=np.int64)
        half = window // 2
        runs = windows(self.names, max(1, half))
        self.seeds = np.zeros(0, dtype=np.int64)
        if len(self.valid):
            view = np.lib.stride_tricks.sliding_window_view(runs, window - max(1, half) + 1)
            self.seeds = self.valid + np.concatenate(
                [view[self.valid[a : a + 65536]].argmin(axis=1) for a in range(0, len(self.valid), 65536)]
            )
        self.places, self.seed_of = np.unique(self.seeds, return_inverse=True)
        self.seed_names = runs[self.places]
        self.all_windows = windows(self.names, window)

    def sampled(self):
        return self.seed_names

    def candidates(self, repeated):
        return self.valid[repeated[self.seed_of]]

    def named(self, starts):
        return self.all_windows[starts]

    def _joined(self, document, chosen):
        low, text = int(self.lows[document]), self.block.texts[document]
        starts, ends = (self.starts[chosen] - low).tolist(), (self.ends[chosen] - low).tolist()
        return b" ".join([text[a:b] for a, b in zip(starts, ends)])

    def whole(self, document):
        low, high = np.searchsorted(self.owner, [document, document + 1])
        return self._joined(document, slice(low, high))

    def kept(self, document, removed):
        return self._joined(document, np.searchsorted(self.owner, document) + np.flatnonzero(~removed))


def _removed(documents, window, keep=(), with_text=False):
    return without_repeats(documents, lambda block: Words(block, window), False, keep, with_text)


def remove_repeated_words(documents, window=50):
    """doc_id, n_words, n_removed, n_spans, kept_sha256 of every document.

    Words are runs without the six separators, unchanged. Removed is each word covered by a window of
    `window` words whose sequence also starts in a document with a smaller doc_id; windows are judged
    on the input. kept_sha256 is of the kept words joined by one space. Null texts have no words and
    texts shorter than the window stay whole. Null doc_ids come after all others; rows of a repeated
    doc_id are ordered by a hash of their text and are different documents. An empty table gives no
    rows; other columns are not looked at.
    """
    return _removed(documents, window).withColumnRenamed("units", "n_words").drop("kept", "extra")


def deduplicated_documents(documents, window=50):
    """The documents with the kept words, joined by one space, as text; all other columns as they are."""
    keep = [c for c in documents.columns if c not in ("doc_id", "text")]
    return with_kept_text(_removed(documents, window, keep, True), documents.schema)
