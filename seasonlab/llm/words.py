"""Words of whole text columns, found and hashed a batch at a time.

A word is a longest run of bytes other than ASCII white space (0x20, 0x09 to
0x0D), unchanged.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Bytes of text whose words are hashed together.
TOGETHER = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, TOGETHER)
        _powers["up"] = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, BASE)], dtype=np.uint64)
        _powers["down"] = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, INVERSE)], dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Words of a column in order: ``ends[i]`` is the number of words up to row i; bytes of word j are ``data[start[j]:stop[j]]``."""

    ends: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    data: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, the same in every batch and process."""
        n = len(self.data)
        up, down = _power_tables(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        return mix((sums[self.stop] - sums[self.start]) * down[self.start])


def words_of(column: pa.Array, apart: np.ndarray = SPACE, fold: np.ndarray | None = None) -> Words:
    """The words of a string column without nulls: longest runs of bytes that aren't ``apart``, each byte replaced as ``fold`` has it."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        nothing = np.zeros(0, np.int64)
        return Words(np.zeros(len(column), np.int64), nothing, nothing, np.zeros(0, np.uint8))
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]
    solid = ~apart[data]
    # a word starts after white space or at the start of a row, and stops likewise
    fresh = np.zeros(len(data) + 1, bool)
    fresh[bounds] = True
    before = np.r_[False, solid[:-1]]
    start = np.flatnonzero(solid & (~before | fresh[:-1]))
    after = np.r_[solid[1:], False]
    stop = np.flatnonzero(solid & (~after | fresh[1:])) + 1
    return Words(np.searchsorted(start, bounds[1:]), start, stop, data if fold is None else fold[data])


def runs_of(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every ``length`` consecutive words (windows that cross rows included), by doubling."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    out, done, power, span, rest = None, 0, hashes, 1, length
    while rest:
        if rest & 1:
            if out is None:
                out, done = power, span
            else:
                m = len(hashes) - (done + span) + 1
                out = mix(out[:m] * np.uint64(0xD6E8FEB86659FD93) + power[done : done + m])
                done += span
        rest >>= 1
        if rest:
            m = len(power) - span
            power = mix(power[:m] * np.uint64(0xA0761D6478BD642F) + power[span : span + m])
            span *= 2
    return out
