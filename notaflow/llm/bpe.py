"""Byte-pair merges of many words at once, on flat numpy arrays.

A round takes, for every word, the smallest rank among its neighbouring pairs
(segmented minimum), merges the leftmost pair of that rank in all words
simultaneously and compacts the arrays; only pairs beside a merge are looked up
anew. Further non-overlapping occurrences of the pair in a word are merged in
the same round if no pair with the merged symbol ranks better, which is when the
sequential order would do the same. Words without a pair retire.
"""

from __future__ import annotations

import numpy as np

NONE = np.int64(1) << 40


class Merges:
    """Pairs (left, right) -> (rank, merged symbol) of a vocabulary of ``size`` symbols.
    Symbols below 0 never merge."""

    def __init__(self, size: int, pairs: list[tuple[int, int, int, int]]):
        self.size = size
        rows = np.array(sorted((a * size + b, rank, made) for a, b, rank, made in pairs), np.int64).reshape(-1, 3)
        self.key, self.rank, self.made = (np.ascontiguousarray(rows[:, i]) for i in range(3))
        #: The best rank that a pair holding this symbol can have.
        self.best = np.full(size, NONE)
        np.minimum.at(self.best, self.key // size, self.rank)
        np.minimum.at(self.best, self.key % size, self.rank)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair, or -1."""
        key = left * self.size + right
        k = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[k] == key) & (left >= 0) & (right >= 0), k, -1)

    def _ranks(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each position, NONE where there is none."""
        out = np.full(len(at), NONE)
        ok = np.flatnonzero((at >= 0) & (at + 1 < len(sym)))
        ok = ok[word[at[ok]] == word[at[ok] + 1]]
        k = self.find(sym[at[ok]], sym[at[ok] + 1])
        out[ok[k >= 0]] = self.rank[k[k >= 0]]
        return out

    def merge(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, word numbers) after all merges; word numbers ascend."""
        sym, word = sym.astype(np.int64), word.astype(np.int64)
        pair = self._ranks(sym, word, np.arange(len(sym)))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(sym):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[starts, len(sym)])
            least = np.minimum.reduceat(pair, starts)
            open_ = least < NONE
            if open_.mean() < 0.75:
                live = np.repeat(open_, size)
                done.append((sym[~live], word[~live]))
                sym, word, pair = sym[live], word[live], pair[live]
                if not open_.any():
                    break
                size, least, open_ = size[open_], least[open_], open_[open_]
            spot = np.flatnonzero((pair == np.repeat(least, size)) & (pair < NONE))
            # Occurrences that overlap (p, p+1, ...): every other one from the left.
            run = np.flatnonzero(np.r_[True, np.diff(spot) != 1])
            spot = spot[(np.arange(len(spot)) - np.repeat(run, np.diff(np.r_[run, len(spot)]))) % 2 == 0]
            k = self.find(sym[spot], sym[spot + 1])
            first = np.r_[True, word[spot[1:]] != word[spot[:-1]]]
            use = first | (self.best[self.made[k]] > self.rank[k])
            spot, k = spot[use], k[use]
            sym[spot] = self.made[k]
            keep = np.ones(len(sym), bool)
            keep[spot + 1] = False
            at = np.cumsum(keep)[spot] - 1
            sym, word, pair = sym[keep], word[keep], pair[keep]
            beside = np.concatenate([at, at[at > 0] - 1])
            pair[beside] = self._ranks(sym, word, beside)
        sym = np.concatenate([np.zeros(0, np.int64), *[s for s, _ in done]])
        word = np.concatenate([np.zeros(0, np.int64), *[w for _, w in done]])
        order = np.argsort(word, kind="stable")
        return sym[order], word[order]
