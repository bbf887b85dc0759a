"""Ids of texts as a tokenizer gives them, with repeated words encoded once and new ones by the batch."""

import json
import re

import numpy as np

LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: A space before one of these signs ends a piece: they are letters, digits or signs in every
#: Unicode table, never white space and never marks that join to what stands before them.
CUT = re.compile(" (?=[!-~À-ÖØ-öø-ÿ])")
OTHER_SPACE = re.compile(" (?![!-~À-ÖØ-öø-ÿ])")
#: Pieces of these signs alone mean the same to every regular expression engine and normalizer; most
#: hold no white space but line ends between words and are cut into words many at a time.
SIMPLE = re.compile(rf"[!-~{LETTERS}]+(?:\n[!-~{LETTERS}]+)*")
#: Stands between pieces: white space that no SIMPLE piece holds.
FEED = "\x0c"
#: SIMPLE pieces with feeds between them.
ALL_SIMPLE = re.compile(rf"[!-~{LETTERS}]+(?:[\n{FEED}][!-~{LETTERS}]+)*")
#: Fixed value: the word pattern of byte-level tokenizers.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED = 1_000_000
LONGEST = 48
JOINED = 512
NONE = np.iinfo(np.int32).max
NO_ID = 0xFFFFFFFF
LINE = np.array([NO_ID], dtype="<u4").tobytes()


def _signs():
    """The printable sign that stands for each byte: itself where it is one, else from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Merges:
    """The merge table of a BPE model, applied to many words at a time.

    Words of one length are one matrix. Each round joins, in every row, the leftmost pair of lowest
    rank, so all rows shrink together; rows without a mergeable pair are done. Pairs are found in a
    table by hash, a quarter full at most, where a pair stands at its slot or soon behind it.
    """

    def __init__(self, model):
        vocab, ending = model["vocab"], model.get("end_of_word_suffix") or ""
        self.first = np.array([vocab[s] for s in _signs()], dtype=np.int64)
        self.last = np.array([vocab[s + ending] for s in _signs()], dtype=np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.full((1 << self.bits) + len(keys) + 1, -1, dtype=np.int64)
        self.ranks = np.full(len(self.keys), NONE, dtype=np.int32)
        rest, slot = np.arange(len(keys)), self._slot(keys)
        while len(rest):
            # Of the pairs that want one free slot the first gets it, the others go one further.
            free = np.flatnonzero(self.keys[slot] < 0)
            taken, one = np.unique(slot[free], return_index=True)
            one = free[one]
            self.keys[taken], self.ranks[taken] = keys[rest[one]], rest[one]
            left = np.ones(len(rest), dtype=bool)
            left[one] = False
            rest, slot = rest[left], slot[left] + 1

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _rank(self, left, right):
        key = left << 32 | right
        slot = self._slot(key)
        seen, out = self.keys[slot], self.ranks[slot]
        other = np.nonzero((seen != key) & (seen >= 0))
        while len(other[0]):
            slot[other] += 1
            seen = self.keys[slot[other]]
            out[other] = self.ranks[slot[other]]
            on = (seen != key[other]) & (seen >= 0)
            seen, other = seen[on], tuple(o[on] for o in other)
        # Behind the last slot looked at stands the pair itself or nothing.
        return out

    def _same_length(self, rows):
        """Ids of words of one length, one matrix per number of ids: (rows, matrix)."""
        ids = self.first[rows]
        ids[:, -1] = self.last[rows[:, -1]]
        rank, at, out = self._rank(ids[:, :-1], ids[:, 1:]), np.arange(len(rows)), []
        while len(at):
            if not rank.shape[1]:
                out.append((at, ids))
                break
            best, every = rank.argmin(axis=1), np.arange(len(at))
            low = rank[every, best]
            done = low == NONE
            if done.any():
                out.append((at[done], ids[done]))
                ids, rank, at, best, low = ids[~done], rank[~done], at[~done], best[~done], low[~done]
                every = np.arange(len(at))
                if not len(at):
                    break
            columns = np.arange(ids.shape[1] - 1)
            ids[every, best] = self.made[low]
            ids = np.where(columns[None, :] <= best[:, None], ids[:, :-1], ids[:, 1:])
            if ids.shape[1] == 1:
                rank = rank[:, :0]
                continue
            columns = columns[:-1]
            rank = np.where(columns[None, :] < best[:, None], rank[:, :-1], rank[:, 1:])
            before, after = best > 0, best < ids.shape[1] - 1
            rows_, spots = every[before], best[before] - 1
            rank[rows_, spots] = self._rank(ids[rows_, spots], ids[rows_, spots + 1])
            rows_, spots = every[after], best[after]
            rank[rows_, spots] = self._rank(ids[rows_, spots], ids[rows_, spots + 1])
        return out

    def words(self, words):
        """Ids of each word (bytes, none empty), as little-endian unsigned 32-bit integers."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        data, starts = np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum(sizes) - sizes
        counts, made = np.zeros(len(words), dtype=np.int64), []
        order = np.argsort(sizes, kind="stable")
        bounds = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
        for low, high in zip(bounds, bounds[1:]):
            places = order[low:high]
            rows = data[starts[places][:, None] + np.arange(sizes[places[0]])]
            for at, ids in self._same_length(rows):
                counts[places[at]] = ids.shape[1]
                made.append((places[at], ids))
        ends = np.cumsum(counts)
        flat = np.empty(int(ends[-1]) if len(ends) else 0, dtype="<u4")
        for places, ids in made:
            flat[(ends - counts)[places][:, None] + np.arange(ids.shape[1])] = ids
        whole = flat.tobytes()
        return [whole[a:b] for a, b in zip((4 * (ends - counts)).tolist(), (4 * ends).tolist())]


class Words(dict):
    """Ids of words. A word asked for the first time gets an array that `fill` fills, so one look at
    each word of a text does, known or not. Words found in `older`, the memory before this one, are kept."""

    def __init__(self, older=()):
        super().__init__()
        self.older, self.fresh = dict(older), {}

    def __missing__(self, word):
        ids = self.older.get(word)
        if ids is None:
            ids = self.fresh[word] = bytearray()
        self[word] = ids
        return ids

    def fill(self, encode):
        fresh, self.fresh = self.fresh, {}
        known = encode(list(fresh))
        for word, ids in fresh.items():
            ids += known[word]
        self.update(known)


class Encoder:
    """The ids of whole texts, equal to Tokenizer.encode(text, add_special_tokens=False).

    For two kinds of tokenizers a text falls apart at CUT without changing an id: byte-level ones
    whose pattern takes one space to the word after it, and ones that lower-case and drop white
    space. There the pieces are encoded once and about REMEMBERED of them kept; SIMPLE pieces go through Merges, all others through the library. Texts that hold
    the start of a special token, and all texts of other tokenizers, go through the library whole.
    """

    def __init__(self, path):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            plan = json.load(file)
        pre, norm, model = plan.get("pre_tokenizer") or {}, plan.get("normalizer"), plan["model"]
        byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        steps = pre.get("pretokenizers") or [{}]
        dropping = (
            [s.get("type") for s in steps] == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]
            and [n["type"] for n in (norm or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        )
        usual = model["type"] == "BPE" and not any(
            model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        )
        added = plan.get("added_tokens", [])
        self.glue = None
        if usual and added and (dropping or byte_level and norm is None):
            self.glue = "" if dropping else " "
            pattern = steps[0]["pattern"]["Regex"] if dropping else BYTE_PATTERN
            pattern = re.sub(r"\[\\p\{[LN]\}\]", lambda m: m[0][1:-1], pattern)
            self.pattern = re.compile(
                re.sub(r"(?<!s)\\p\{L\}(?!\\)", f"[{LETTERS}]", pattern).replace(r"\p{L}", LETTERS)
                .replace(r"\s" + LETTERS + r"\p{N}", r"\s" + LETTERS + "0-9").replace(r"\p{N}", "[0-9]"),
            )
            self.lines = re.compile(self.pattern.pattern + "|" + FEED)
            self.merges = Merges(model)
            self.mark, self.mark_id = added[0]["content"], added[0]["id"]
        self.special = [t["content"][:2] for t in added]
        self.memory = Words()

    def _library(self, texts):
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in made]

    def _apart(self, pieces):
        """Ids of any pieces from few calls of the library: a special token keeps two pieces apart."""
        out = []
        for low in range(0, len(pieces), JOINED):
            joined = self.mark.join(pieces[low : low + JOINED])
            made = np.frombuffer(self._library([joined])[0], dtype="<u4")
            ends, start = [*np.flatnonzero(made == self.mark_id).tolist(), len(made)], 0
            for end in ends:
                out.append(made[start:end].tobytes())
                start = end + 1
        return out

    def _simple(self, words):
        """Ids of SIMPLE words from one text: the feeds between them stay words of their own."""
        if not words:
            return []
        text = self.glue + (FEED + self.glue).join(words)
        found = self.lines.findall(text if self.glue else text.lower())
        distinct = [w for w in dict.fromkeys(found) if w != FEED]
        ids = dict(zip(distinct, self.merges.words([w.encode() for w in distinct])))
        ids[FEED] = LINE
        data = b"".join(map(ids.__getitem__, found))
        ends = (4 * np.flatnonzero(np.frombuffer(data, dtype="<u4") == NO_ID)).tolist()
        starts = [0, *[e + 4 for e in ends]]
        return [data[a:b] for a, b in zip(starts, [*ends, len(data)])]

    def _by_word(self, words):
        simple = []
        for low in range(0, len(words), JOINED):
            block = words[low : low + JOINED]
            joined = FEED.join(block)
            # One look at the block tells that all its words are SIMPLE, as they are in most blocks.
            if max(map(len, block)) <= LONGEST and joined.count(FEED) == len(block) - 1 and ALL_SIMPLE.fullmatch(joined):
                simple += block
            else:
                simple += [w for w in block if len(w) <= LONGEST and SIMPLE.fullmatch(w)]
        known = dict(zip(simple, self._simple(simple), strict=True))
        if len(known) < len(words):
            rest = [w for w in words if w not in known]
            known.update(zip(rest, self._apart([self.glue + w for w in rest]), strict=True))
        return known

    def _ids_of(self, texts):
        """Ids of each word of these lists of words. Half of what is remembered is recent; when that
        half is full the other one goes, so frequent words stay."""
        memory, self.memory = self.memory, Words()
        made = [list(map(memory.__getitem__, words)) for words in texts]
        memory.fill(self._by_word)
        # Only a memory without empty arrays is kept: had a word failed, the next one would start anew.
        self.memory = Words(memory) if len(memory) > REMEMBERED // 2 else memory
        return made

    def encode(self, texts):
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self.glue is None:
            return self._library(texts)
        out = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if any(s in t for s in self.special)]
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = ids
        plain = [i for i in range(len(texts)) if out[i] is None]
        # Where every space ends a piece, splitting at spaces is the same and faster.
        cut = [CUT.split(texts[i]) if OTHER_SPACE.search(texts[i]) else texts[i].split(" ") for i in plain]
        heads = self._apart([words.pop(0) for words in cut])
        for i, head, words in zip(plain, heads, self._ids_of(cut)):
            out[i] = head + b"".join(words)
        return out


_LOADED = {}


def encoder(path):
    """One encoder per path and worker process."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
