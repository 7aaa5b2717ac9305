"""Run-length grammar of an integer sequence by recompression, and longest common extensions on it.

Recompression replaces, in turns, every maximal block ``x x .. x`` by one
symbol and every pair ``x y`` with x in the left and y in the right half of
the alphabet by one symbol, until one symbol is left.  A level is two arrays,
so building one is a few vector operations, and lengths fall geometrically.

Where two stretches are equal, so are their symbols on every level, but for at
most one symbol at the near end of a pair level and one block at the near end
of a block level.  An extension therefore climbs while the symbols at hand are
equal, taking such an odd symbol or block along, and goes back down at the first
difference; both ways take a bounded number of steps a level, for all queries
at once.
"""

from __future__ import annotations

import numpy as np

_HALF = np.uint64(0x9E3779B97F4A7C15)


def _left(symbols: np.ndarray, round_: int) -> np.ndarray:
    """A pseudo-random half of the alphabet, another one each round."""
    h = (symbols.astype(np.uint64) + np.uint64(round_ * 7919 + 1)) * _HALF
    h ^= h >> np.uint64(29)
    return (h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63) == 1


def _named(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1].reshape(-1)


class Grammar:
    """``sequence`` holds integers from 0 on; its first and last must occur nowhere else (sentinels)."""

    def __init__(self, sequence: np.ndarray):
        self.symbols, self.parents, self.blocks = [_named(sequence)], [], []
        round_ = 0
        while len(s := self.symbols[-1]) > 1:
            same = s[1:] == s[:-1]
            if same.any():
                starts = np.flatnonzero(np.r_[True, ~same])
                lengths = np.diff(np.r_[starts, len(s)])
                self._add(np.r_[True, ~same], s[starts] * (int(lengths.max()) + 1) + lengths, block=True)
                s = self.symbols[-1]
                if len(s) == 1:
                    break
            round_ += 1
            left = _left(s, round_)
            pairs, others = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
            if others.sum() > pairs.sum():
                pairs = others
            if not pairs.any():
                continue
            starts = np.flatnonzero(np.r_[True, ~pairs])
            after = np.where(np.r_[pairs, False][starts], s[np.minimum(starts + 1, len(s) - 1)] + 1, 0)
            self._add(np.r_[True, ~pairs], s[starts] * (int(s.max()) + 2) + after, block=False)
        self._views = {1: self._view(1), -1: self._view(-1)}

    def _add(self, begins: np.ndarray, keys: np.ndarray, *, block: bool) -> None:
        self.parents.append(np.cumsum(begins) - 1)
        self.blocks.append(block)
        self.symbols.append(_named(keys))

    def _view(self, step: int) -> list[tuple]:
        """Per level: symbols, parent of each, whether it is its parent's first, first child of each parent and the end."""
        out = []
        for t, s in enumerate(self.symbols):
            if t == len(self.parents):
                out.append((s[::step], None, None, None))
                break
            p = self.parents[t]
            p = p if step > 0 else p[-1] - p[::-1]
            first = np.r_[True, p[1:] != p[:-1]]
            out.append((s[::step], p, first, np.r_[np.flatnonzero(first), len(p)]))
        return out

    def extend(self, i: np.ndarray, j: np.ndarray, step: int = 1) -> np.ndarray:
        """How many symbols from i on equal those from j on (i < j; step -1: leftwards, i and j included)."""
        view = self._views[step]
        n = len(self.symbols[0])
        a, b = (i.copy(), j.copy()) if step > 0 else (n - 1 - i, n - 1 - j)
        begin = a.copy()
        stop = np.zeros(len(a), np.int64)                  # the level where a and b differ
        live = np.arange(len(a))
        for t, block in enumerate(self.blocks):
            sym, par, first, child = view[t]
            eq = sym[a[live]] == sym[b[live]]
            stop[live[~eq]] = t
            live = live[eq]
            if not len(live):
                break
            x, y = a[live], b[live]
            inside = ~(first[x] & first[y])
            if block:
                rx, ry = child[par[x] + 1] - x, child[par[y] + 1] - y
                move = np.where(inside | (rx != ry), np.minimum(rx, ry), 0)
            else:
                move = inside.astype(np.int64)
            x, y = x + move, y + move
            a[live], b[live] = x, y
            eq = sym[x] == sym[y]
            stop[live[~eq]] = t
            live = live[eq]
            a[live], b[live] = par[a[live]], par[b[live]]
        for t in range(len(self.blocks) - 1, -1, -1):
            down = np.flatnonzero(stop > t)
            if not len(down):
                continue
            sym, par, _, child = view[t]
            x, y = child[a[down]], child[b[down]]
            eq = sym[x] == sym[y]
            if self.blocks[t]:
                move = np.where(eq, np.minimum(child[par[x] + 1] - x, child[par[y] + 1] - y), 0)
            else:
                move = eq.astype(np.int64)
            a[down], b[down] = x + move, y + move
        return a - begin
