"""A run-compressed Burrows-Wheeler index over short strings, and what it says about windows of a fixed length.

Rows of the transform are ordered by the first ``DEPTH`` bytes, and rows that agree on those by owner, largest first.
Runs of equal transform bytes are cut where that context changes, and only the end of a run is sampled: it holds the
smallest owner of the run, so the last run end of a match interval holds the smallest owner of the matched window.
Matching statistics are streamed from right to left for all strings at once: a match shorter than ``DEPTH`` is
extended by a byte, a full one first gives up its last byte (its interval widens to the context of ``DEPTH - 1``).
"""

from __future__ import annotations

import numpy as np

DEPTH = 50
SEPARATOR = 0xFF  # no byte of UTF-8


def _dense(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Ranks of pairs of ranks."""
    return np.unique(first.astype(np.int64) * (int(second.max()) + 1) + second, return_inverse=True)[1]


def _shifted(ranks: np.ndarray, by: int) -> np.ndarray:
    return np.roll(ranks, -by)


class RunIndex:
    def __init__(self, text: np.ndarray, owner: np.ndarray) -> None:
        """``text``: strings, each with a separator behind it; ``owner``: the owner of every position."""
        n = len(text)
        self.n = n
        word = np.zeros(n, np.uint64)
        for i in range(8):
            word = (word << np.uint64(8)) | np.roll(text, -i).astype(np.uint64)
        ranks = np.unique(word, return_inverse=True)[1]
        for step in (8, 16):
            ranks = _dense(ranks, _shifted(ranks, step))
        full = _dense(ranks, _shifted(ranks, DEPTH - 32))
        order = np.lexsort((-owner, full))
        context = full[order]
        tail = _shifted(ranks, DEPTH - 33)
        new_context = np.r_[True, context[1:] != context[:-1]]
        first, second = ranks[order], tail[order]
        new_wide = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        self.wide_start = np.r_[np.flatnonzero(new_wide), n]
        self.wide_of = np.cumsum(new_wide) - 1
        bwt = text[order - 1]
        heads = np.flatnonzero(np.r_[True, (bwt[1:] != bwt[:-1]) | new_context[1:]])
        self.run_byte = bwt[heads].astype(np.int64)
        lengths = np.diff(np.r_[heads, n])
        self.run_end_owner = owner[order[np.r_[heads[1:], n] - 1]]
        by_byte = np.argsort(self.run_byte, kind="stable")
        self.runs = len(heads)
        self.keys = self.run_byte[by_byte] * self.runs + by_byte
        # Runs are sorted by byte, so the lengths before a byte's runs are the bytes that are smaller.
        self.before = np.r_[0, np.cumsum(lengths[by_byte])]
        # The row behind the last one is a run of its own, of no byte.
        self.run_of = np.repeat(np.arange(self.runs + 1, dtype=np.int32), np.r_[lengths, 1])
        self.run_byte = np.r_[self.run_byte, 256]
        self.moved = np.zeros(self.runs + 1, np.int64)
        self.moved[by_byte] = self.before[:-1] - heads[by_byte]

    def _step(self, byte: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Where the rows before ``row`` that are preceded by ``byte`` end, in the order of the transform."""
        run = self.run_of[row]
        out = row + self.moved[run]
        # Only a row in a run of another byte needs a search: for the next run of its byte.
        other = np.flatnonzero(self.run_byte[run] != byte)
        out[other] = self.before[np.searchsorted(self.keys, byte[other] * self.runs + run[other])]
        return out

    def smallest_owners(self, text: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every window of every string: its smallest owner.  Returns (values, offset of each string's first).

        The strings are strings of the index, so every window is found.
        """
        windows = length - DEPTH + 1
        offset = np.r_[0, np.cumsum(windows)]
        values = np.empty(offset[-1], np.int64)
        by_length = np.argsort(-length, kind="stable")
        start, length, first = start[by_length], length[by_length], offset[:-1][by_length]
        low = np.zeros(len(start), np.int64)
        high = np.full(len(start), self.n, np.int64)
        for t in range(int(length[0]) if len(length) else 0):
            k = int(np.searchsorted(-length, -t, "left"))  # strings longer than t
            lo, hi = low[:k], high[:k]
            if t >= DEPTH:
                wide = self.wide_of[lo]
                lo, hi = self.wide_start[wide], self.wide_start[wide + 1]
            byte = text[start[:k] + length[:k] - 1 - t].astype(np.int64)
            lo, hi = self._step(byte, lo), self._step(byte, hi)
            low[:k], high[:k] = lo, hi
            if t >= DEPTH - 1:
                values[first[:k] + length[:k] - 1 - t] = self.run_end_owner[self.run_of[hi - 1]]
        return values, offset
