"""BPE merges of many words at once by a hierarchical-bitmap rank queue.

The symbols of all words stand in one array and are linked lists by position.
Every adjacent pair that has a merge rank is an entry, by the position of its
left symbol, in the bucket of that rank; buckets are linked lists of runs of entries.
Flags of two levels say which buckets hold anything: the first set flag of each
level gives the lowest rank, however many ranks or positions there are. A bucket
is taken whole: entries whose pair has changed since are stale and skipped, and
where pairs of the same rank overlap the leftmost goes first. Words don't touch
each other, so taking the lowest rank of all words takes that of each word; a very
long word costs no more per symbol than a short one.
"""

from __future__ import annotations

import numpy as np

BLOCK = 256  # flags of the lower level under one of the upper


class MergeTable:
    """Pairs of symbols by merge rank.

    ``left``, ``right``, ``rank`` are parallel arrays, one entry a pair; ``made`` has
    the new symbol of each rank. No pair may make, with a neighbour, a pair of
    lower rank than its own that its parts did not have: true of every
    vocabulary whose tokens encode to themselves (see tests).
    """

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, made: np.ndarray) -> None:
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.key_rank, self.made = keys[order], rank[order].astype(np.int32), made.astype(np.int32)
        self.ranks = len(made)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(left), -1, np.int32)
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == keys, self.key_rank[at], np.int32(-1))

    def merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge words whose initial symbols follow each other in ``symbols``; their symbols and lengths afterwards."""
        n = len(symbols)
        if not n:
            return symbols.astype(np.int32), lengths
        sym = symbols.astype(np.int32)
        ends = np.cumsum(lengths)
        filled = lengths > 0
        following, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        following[ends[filled] - 1] = -1
        before[(ends - lengths)[filled]] = -1
        current = np.full(n, -1, np.int32)  # rank of the pair that starts at a position
        entry_at = np.empty(3 * n + 1, np.int32)
        run_from, run_to, run_next = (np.empty(3 * n + 1, np.int32) for _ in range(3))  # entries of one rank pushed together
        head = np.full(self.ranks, -1, np.int32)
        blocks = self.ranks // BLOCK + 1
        flags, upper = np.zeros(blocks * BLOCK, bool), np.zeros(blocks, bool)
        from_view, to_view, next_view = map(memoryview, (run_from, run_to, run_next))
        used = runs = 0

        def push(at: np.ndarray) -> None:
            nonlocal used, runs
            at = at[following[at] >= 0]
            rank = self.rank_of(sym[at], sym[following[at]])
            current[at] = rank
            real = rank >= 0
            at, rank = at[real], rank[real]
            m = len(at)
            if not m:
                return
            order = rank.argsort(kind="stable")
            at, rank = at[order], rank[order]
            entry_at[used : used + m] = at
            first = np.r_[0, np.flatnonzero(rank[1:] != rank[:-1]) + 1]
            own = rank[first]
            k = len(first)
            run_from[runs : runs + k] = first + used
            run_to[runs : runs + k - 1] = first[1:] + used
            run_to[runs + k - 1] = used + m
            run_next[runs : runs + k] = head[own]
            head[own] = np.arange(runs, runs + k, dtype=np.int32)
            flags[own] = True
            upper[own // BLOCK] = True
            used += m
            runs += k

        push(np.arange(n, dtype=np.int32))
        while True:
            block = int(upper.argmax())
            if not upper[block]:
                break
            low = block * BLOCK
            rank = low + int(flags[low : low + BLOCK].argmax())
            run = int(head[rank])
            got = []
            while run >= 0:
                got.append(entry_at[from_view[run] : to_view[run]])
                run = next_view[run]
            head[rank] = -1
            flags[rank] = False
            if not flags[low : low + BLOCK].any():
                upper[block] = False
            at = got[0] if len(got) == 1 else np.concatenate(got)
            at = at[current[at] == rank]
            m = len(at)
            if not m:
                continue
            if m > 1:
                at = np.sort(at)
                meets = following[at[:-1]] == at[1:]
                again = at[1:] == at[:-1]
                if again.any():
                    at = at[np.r_[True, ~again]]
                    meets = following[at[:-1]] == at[1:]
                if meets.any():
                    index = np.arange(len(at))
                    started = np.maximum.accumulate(np.where(np.r_[True, ~meets], index, 0))
                    at = at[(index - started) % 2 == 0]
            right = following[at]
            after = following[right]
            sym[at] = self.made[rank]
            sym[right] = -1
            current[at] = -1
            current[right] = -1
            following[at] = after
            more = after >= 0
            before[after[more]] = at[more]
            left = before[at]
            push(np.concatenate([at, left[left >= 0]]))
        alive = sym >= 0
        kept = np.r_[0, np.cumsum(alive)]
        return sym[alive], kept[ends] - kept[ends - lengths]


def packed(symbols: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """Each word's symbols as little-endian 32-bit numbers."""
    whole = symbols.astype("<u4").tobytes()
    ends = (np.cumsum(lengths) * 4).tolist()
    return [whole[a:b] for a, b in zip([0, *ends], ends)]  # noqa: B905
