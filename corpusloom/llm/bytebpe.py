"""Byte-level BPE over padded numpy matrices.

A vocabulary is a table of merges ``(left id, right id) -> new id`` whose order
is the rank.  Words are encoded many at once: words of similar length share one
matrix, and in each round every row merges its leftmost pair of minimum rank.
Since every active row loses exactly one column per round, dropping the merged
columns compacts the matrix without padding, and finished rows leave it.
"""

from __future__ import annotations

import json
import sys
from dataclasses import dataclass
from itertools import chain

import numpy as np

from corpusloom.session import ship

#: Fixed value: the public pattern that splits text before byte-level merges,
#: with the white space of the Unicode property written out.
_SPACE = r"\t-\r \u0085   -     　"
PRETOKEN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
NEVER = np.iinfo(np.int32).max
#: Rows longer than this take the path for long rows, which merges every
#: occurrence of the row's minimum pair in a round; the ids are the same, since
#: a merge never creates a pair of a lower rank.
LONG = 256
#: Words kept per Python worker; a full memo is emptied, which costs time only.
MEMO_WORDS = 200_000
#: Characters split into words at once; bounds the memory of a task.
SLICE_CHARS = 1_000_000


@dataclass(frozen=True)
class Merges:
    """The bounded part that is sent to executors: about 50,000 merges."""

    byte_ids: np.ndarray  # id of each of the 256 bytes
    left: np.ndarray
    right: np.ndarray
    new: np.ndarray


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_merges(path: str = DEFAULT_VOCABULARY) -> Merges:
    """Read the merges of a byte-level BPE vocabulary file."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids, letters = model["vocab"], _byte_letters()
    byte_ids = np.zeros(256, np.int32)
    for letter, byte in letters.items():
        byte_ids[byte] = ids[letter]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    take = lambda f: np.fromiter((ids[f(p)] for p in pairs), np.int32, len(pairs))
    return Merges(byte_ids, take(lambda p: p[0]), take(lambda p: p[1]), take(lambda p: p[0] + p[1]))


class PairTable:
    """Open-addressing hash table from a pair of ids to its rank and new id."""

    def __init__(self, merges: Merges):
        bits = max(4, int(2 * len(merges.left)).bit_length() + 1)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NEVER, np.int32)
        self.new = merges.new
        keys = merges.left.astype(np.int64) << 32 | merges.right.astype(np.int64)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[at] == -1
            slots, first = np.unique(at[free], return_index=True)
            chosen = np.flatnonzero(free)[first]
            self.keys[slots], self.ranks[slots] = keys[todo[chosen]], todo[chosen]
            rest = np.ones(len(todo), bool)
            rest[chosen] = False
            todo, at = todo[rest], at[rest] + 1 & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``NEVER`` where a pair doesn't merge or is padding."""
        out = np.full(left.shape, NEVER, np.int32)
        live = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        keys = left.ravel()[live].astype(np.int64) << 32 | right.ravel()[live].astype(np.int64)
        at, flat = self._slot(keys), out.ravel()
        while len(live):
            held = self.keys[at]
            hit = held == keys
            flat[live[hit]] = self.ranks[at[hit]]
            on = ~hit & (held != -1)
            live, keys, at = live[on], keys[on], at[on] + 1 & self.mask
        return flat.reshape(left.shape)


class Encoder:
    """Encodes words, and whole texts through a memo of words."""

    def __init__(self, merges: Merges, pattern: str = PRETOKEN):
        import regex

        self.byte_ids, self.table = merges.byte_ids, PairTable(merges)
        self.widths = np.ones(int(max(merges.byte_ids.max(), merges.new.max(initial=0))) + 1, np.int64)
        for left, right, new in zip(merges.left.tolist(), merges.right.tolist(), merges.new.tolist()):
            self.widths[new] = self.widths[left] + self.widths[right]
        self.split = regex.compile(pattern).findall
        self.memo: dict[str, tuple[int, ...]] = {}
        self.sizes: dict[str, int] = {}

    def words(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of each word, by buckets of similar byte length."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        out: list[tuple[int, ...]] = [()] * len(raw)
        edges = [0, 4, 8, 12, 16, 24, 32, 64, 128, LONG]
        for low, high in zip(edges, edges[1:]):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            for part in np.array_split(rows, max(1, len(rows) // 20_000)):
                if len(part):
                    self._matrix([raw[i] for i in part], sizes[part], part, out)
        for i in np.flatnonzero(sizes > LONG):
            out[i] = self._long(raw[i])
        return out

    def _matrix(self, raw: list[bytes], sizes: np.ndarray, rows: np.ndarray, out: list) -> None:
        width = int(sizes.max())
        ids = np.full((len(raw), width), -1, np.int32)
        ids[np.arange(width) < sizes[:, None]] = self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)]
        ranks = self.table.rank(ids[:, :-1], ids[:, 1:])
        while True:
            if ids.shape[1] > 1:
                at = ranks.argmin(1)
                best = ranks[np.arange(len(at)), at]
                done = best == NEVER
            else:
                done = np.ones(len(ids), bool)
            for row, i in zip(ids[done].tolist(), rows[done].tolist()):
                out[i] = tuple(x for x in row if x >= 0)
            if done.all():
                return
            ids, ranks, rows, at, best = ids[~done], ranks[~done], rows[~done], at[~done], best[~done]
            n, every = len(ids), np.arange(len(ids))
            ids[every, at] = self.table.new[best]
            keep = np.ones(ids.shape, bool)
            keep[every, at + 1] = False
            ids = ids[keep].reshape(n, -1)
            keep = np.ones(ranks.shape, bool)
            keep[every, at] = False
            ranks = ranks[keep].reshape(n, -1)
            if ranks.shape[1]:
                padded = np.pad(ids, ((0, 0), (1, 1)), constant_values=-1)
                here, before, after = padded[every, at + 1], padded[every, at], padded[every, at + 2]
                left, right = self.table.rank(before, here), self.table.rank(here, after)
                some = at > 0
                ranks[every[some], at[some] - 1] = left[some]
                some = at < ranks.shape[1]
                ranks[every[some], at[some]] = right[some]

    def _long(self, raw: bytes) -> tuple[int, ...]:
        ids = self.byte_ids[np.frombuffer(raw, np.uint8)].astype(np.int32)
        ranks = self.table.rank(ids[:-1], ids[1:])
        while len(ranks) and (best := ranks.min()) != NEVER:
            hits = np.flatnonzero(ranks == best)
            # of overlapping occurrences (a run of one id) every second one merges
            start = np.r_[True, np.diff(hits) > 1]
            run = hits - hits[np.maximum.accumulate(np.where(start, np.arange(len(hits)), 0))]
            hits = hits[run % 2 == 0]
            ids[hits] = self.table.new[best]
            ids, ranks = np.delete(ids, hits + 1), np.delete(ranks, hits)
            # only pairs beside a merged one have another rank now
            here = hits - np.arange(len(hits))
            near = np.unique(np.r_[here[here > 0] - 1, here[here < len(ranks)]])
            if len(near):
                ranks[near] = self.table.rank(ids[near], ids[near + 1])
        return tuple(ids.tolist())

    def slices(self, text: str):
        """Parts of a text, cut before white space that follows other text, where no word spans."""
        at = 0
        while len(text) - at > SLICE_CHARS:
            end = at + SLICE_CHARS
            while end < len(text) and not (text[end].isspace() and not text[end - 1].isspace()):
                end += 1
            yield text[at:end]
            at = end
        yield text[at:] if at else text

    def learn(self, words) -> None:
        """Put words into the memo."""
        words = set(words)
        new = [w for w in words if w not in self.memo]
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
            self.sizes.clear()
            new = list(words)
        for w, ids in zip(new, self.words(new)):
            self.memo[w], self.sizes[w] = ids, len(ids)

    def _learned(self, texts):
        """Words of the texts' parts by position, many parts at a time so that new words share matrices."""
        group, held = [], 0
        for i, text in enumerate(texts):
            for part in self.slices(text):
                group.append((i, self.split(part)))
                held += len(part)
                if held >= SLICE_CHARS:
                    self.learn(chain.from_iterable(w for _, w in group))
                    yield from group
                    group, held = [], 0
        self.learn(chain.from_iterable(w for _, w in group))
        yield from group

    def ids(self, texts: list[str]) -> list[list[int]]:
        """Token ids of each text."""
        out: list[list[int]] = [[] for _ in texts]
        for i, words in self._learned(texts):
            out[i].extend(chain.from_iterable(map(self.memo.__getitem__, words)))
        return out

    def counts(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text."""
        out = [0] * len(texts)
        for i, words in self._learned(texts):
            out[i] += sum(map(self.sizes.__getitem__, words))
        return out

    def inner_ends(self, word: str) -> tuple[list[int], list[int]]:
        """Character offsets in a word at which tokens end, and the tokens up to each."""
        raw = np.frombuffer(word.encode("utf-8", "surrogatepass"), np.uint8)
        begins = np.r_[(raw & 0xC0) != 0x80, True]
        ends = np.cumsum(self.widths[list(self.memo[word])])
        whole = np.flatnonzero(begins[ends])
        return (np.cumsum(begins)[ends[whole] - 1]).tolist(), (whole + 1).tolist()


def worker_encoder(shared) -> Encoder:
    """The encoder of this Python worker, built once from a broadcast of Merges."""
    kept = sys.modules[__name__].__dict__.setdefault("_kept", {})
    if shared.value_key not in kept:
        kept.clear()
        kept[shared.value_key] = Encoder(shared.broadcast.value)
    return kept[shared.value_key]


class Shared:
    """A broadcast of Merges (about 0.6 MB) with a key for the worker's cache."""

    def __init__(self, spark, path: str = DEFAULT_VOCABULARY):
        ship(spark)
        self.value_key = path
        self.broadcast = spark.sparkContext.broadcast(read_merges(path))
