"""Sets of hashed word shingles in Python tasks, by whole-array operations."""

from __future__ import annotations

import numpy as np
import xxhash


def _fixed(name: str, n: int) -> np.ndarray:
    """Odd 64-bit numbers that look random and are the same in every process."""
    return np.array([xxhash.xxh3_64_intdigest(f"{name}{i}") | 1 for i in range(n)], np.uint64)


_VALUES = _fixed("byte", 256)  # of the bytes of a word
_VALUES[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PLACES = _fixed("place", 64)  # of the words of a shingle
_MIX = _fixed("mix", 3)
_BASE = int(_fixed("base", 1)[0])


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as texts need them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


_powers = _Powers()


def _word_hashes(data: np.ndarray) -> np.ndarray:
    """A polynomial hash of each word: a difference of running sums, moved to the start."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    bounds = np.flatnonzero(np.diff(inside))
    starts, ends = bounds[0::2], bounds[1::2]
    _powers.reach(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * _powers.up[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _powers.down[starts]
    return _mixed(hashes)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes ^= hashes >> np.uint64(32)
    hashes *= _MIX[0]
    hashes ^= hashes >> np.uint64(29)
    hashes *= _MIX[1]
    hashes ^= hashes >> np.uint64(32)
    return hashes


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles of `size` words.

    Words are split at white space (\\x20 and \\x09 to \\x0D), A-Z in lower case. Fewer
    words are one shingle; no words, none.
    """
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    hashes = _word_hashes(data) if len(data) else np.empty(0, np.uint64)
    if not len(hashes):
        return hashes
    n = min(size, len(hashes))
    count = len(hashes) - n + 1
    sums = np.full(count, n if n < size else 0, np.uint64)
    for i in range(n):
        sums += hashes[i : count + i] * _PLACES[i]
    return _distinct(_mixed(sums))


def _distinct(numbers: np.ndarray) -> np.ndarray:
    """Sorted and each once. Sorting is faster here than numpy's table of hashes."""
    numbers = np.sort(numbers)
    new = np.ones(len(numbers), bool)
    np.not_equal(numbers[1:], numbers[:-1], out=new[1:])
    return numbers[new]
