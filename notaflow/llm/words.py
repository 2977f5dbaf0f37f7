"""Words of whole texts as stable 64-bit hashes, flat over a slice of documents."""

from __future__ import annotations

import numpy as np

from .common import gather

_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                                    0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93))


def split(text: str, lower: bool = False) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ in UTF-8; ``lower``: A-Z in lower case, nothing else."""
    raw = text.encode("utf-8", "surrogatepass")
    return (raw.lower() if lower else raw).split()  # bytes.lower() and .split() know ASCII only


_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def _place_keys(n: int) -> np.ndarray:
    """A fixed pseudo-random odd 64-bit number for each place in a word (splitmix)."""
    with np.errstate(over="ignore"):
        z = (np.arange(n, dtype=np.uint64) + np.uint64(1)) * _MIX[0]
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) | np.uint64(1)


_KEYS = _place_keys(256)


class Words:
    """The words of some texts, flat: bytes ``joined[start : start + size]``, hashes,
    words per text. A word's hash is the sum of its bytes times a key of their
    place, mixed with its length."""

    def __init__(self, texts: list, lower: bool = False):
        raws = [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in texts]
        joined = b" ".join(raws) + b" "
        self.joined = joined.lower() if lower else joined
        b = np.frombuffer(self.joined, np.uint8)
        space = _SPACES[b]
        edge = np.flatnonzero(np.diff(space, prepend=True))  # word begins and ends, in turn
        self.start, self.size = edge[::2], edge[1::2] - edge[::2]
        at = np.flatnonzero(~space)
        self._first = np.cumsum(self.size) - self.size
        self._place = np.arange(len(at)) - np.repeat(self._first, self.size)
        self._bytes = b[at].astype(np.uint64) + np.uint64(1)
        self.counts = np.diff(np.searchsorted(self.start, np.cumsum([0, *[len(r) + 1 for r in raws]])))

    def hash(self, seed: int = 0) -> np.ndarray:
        keys = _KEYS if self.size.max(initial=0) <= len(_KEYS) else _place_keys(int(self.size.max()))
        keys = mix(keys + np.uint64(seed) * _MIX[3]) | np.uint64(1) if seed else keys
        value = self._bytes * keys[self._place]
        h = np.add.reduceat(value, self._first) if len(self._first) else np.zeros(0, np.uint64)
        return mix(h + self.size.astype(np.uint64) * _MIX[4])


class HashedWords:
    """(hashes, byte lengths, words per text), flat over texts."""

    def __init__(self, lower: bool = False):
        self.lower = lower

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w = Words(texts, self.lower)
        return w.hash(), w.size, w.counts


class HashedTable:
    """A worker's bounded memory of word -> ids, keyed by two independent 64-bit hashes
    of the word (a word is taken for another only if both agree); a full table
    starts afresh, which changes speed only."""

    def __init__(self, encode, dtype, capacity: int = 3_000_000):
        self.encode, self.dtype, self.capacity = encode, dtype, capacity
        self._clear()

    def _clear(self) -> None:
        self.keys, self.checks, self.row = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.flat, self.at, self.len = np.zeros(0, self.dtype), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1)
        k = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[k] == keys) & (self.checks[k] == checks), self.row[k], -1)

    def ids(self, texts: list) -> list[np.ndarray]:
        """Ids of each text's words, one after another."""
        flat, lens = self.flat_ids(texts)
        return np.split(flat, np.cumsum(lens)[:-1]) if len(texts) else []

    def flat_ids(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts' words, ids per text)."""
        if len(self.keys) > self.capacity:
            self._clear()
        w = Words(texts)
        both = np.stack([w.hash(), w.hash(1)], axis=1)
        _, first, which = np.unique(both[:, 0], return_index=True, return_inverse=True)
        odd = np.flatnonzero(both[first[which], 1] != both[:, 1])  # one hash, two words
        first = np.concatenate([first, odd])
        which[odd] = len(first) - len(odd) + np.arange(len(odd))
        keys, checks = both[first].T
        row = self._find(keys, checks)
        new = np.flatnonzero(row < 0)
        if len(new):
            words = [w.joined[s:s + n] for s, n in zip(w.start[first[new]].tolist(), w.size[first[new]].tolist())]
            flat, lens = self.encode(words)
            row[new] = len(self.len) + np.arange(len(new))
            self.at = np.concatenate([self.at, (len(self.flat) + np.cumsum(lens) - lens).astype(np.int32)])
            self.len = np.concatenate([self.len, lens.astype(np.int32)])
            self.flat = np.concatenate([self.flat, flat.astype(self.dtype)])
            order = np.argsort(np.concatenate([self.keys, keys[new]]), kind="stable")
            self.keys, self.checks, self.row = (np.concatenate(x)[order] for x in (
                (self.keys, keys[new]), (self.checks, checks[new]), (self.row, row[new].astype(np.int32))))
        row = row[which]
        lens = self.len[row].astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lens)])[np.cumsum(w.counts)]
        return gather(self.flat, self.at[row].astype(np.int64), lens), np.diff(ends, prepend=0)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX[0]
    return h ^ (h >> np.uint64(32))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive entries (over borders of texts too)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    size = len(h) - n + 1
    out = np.full(size, n, np.uint64)
    for j in range(n):
        out = out * _MIX[1] + mix(h[j:j + size] + _MIX[2])
    return mix(out)
