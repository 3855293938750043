"""Sets of hashed word shingles, and min-wise signatures of them."""

import numpy as np

from stillwell.llm.common import mixed

SEGMENT = 1 << 20
_rng = np.random.default_rng(20240229)
_BYTES = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACE = _rng.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_COUNT = np.uint64(0xD6E8FEB86659FD93)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SEGMENT + 4096)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each word of ``data``, bytes that end in white space."""
    starts, hashes, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        while end < len(data) and not _SPACE[data[end - 1]]:  # words are not cut
            further = np.flatnonzero(_SPACE[data[end:end + SEGMENT]])
            end = end + int(further[0]) + 1 if len(further) else min(len(data), end + SEGMENT)
        part = data[at:end]
        space = _SPACE[part]
        before = np.empty(len(part) + 1, bool)
        before[0], before[1:] = True, space
        first = np.flatnonzero(~space & before[:-1])
        last = np.flatnonzero(space & ~before[:-1])
        power, inverse = _power(len(part))
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTES[part] * power, out=sums[1:])
        starts.append(first + at)
        hashes.append(mixed((sums[last] - sums[first]) * inverse[first]))
        at = end
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``width`` words, with A-Z
    lower-cased; fewer words count as one run, none as an empty set."""
    data = np.frombuffer(b" ".join(t.lower() for t in texts) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    with np.errstate(over="ignore"):
        starts, words = word_hashes(data)
        cuts = np.r_[0, np.searchsorted(starts, ends)]
        full = len(words) - width + 1
        runs = np.zeros(max(0, full), np.uint64)
        for i in range(width):
            runs += words[i:i + full] * _PLACE[i] if full > 0 else 0
        runs = mixed(runs + np.uint64(width) * _COUNT)
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            n = b - a
            if n >= width:
                out.append(np.unique(runs[a:b - width + 1]))
            elif n:
                total = (words[a:b] * _PLACE[:n]).sum(dtype=np.uint64)
                out.append(mixed(np.array([total + np.uint64(n) * _COUNT])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


class Signatures:
    """``size`` min-wise values of a set: two sets agree in each with their similarity's chance."""

    def __init__(self, size: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.factor = rng.integers(0, 2**64, size, dtype=np.uint64)[:, None] | np.uint64(1)
        self.shift = rng.integers(0, 2**64, size, dtype=np.uint64)[:, None]

    def of(self, values: np.ndarray) -> np.ndarray:
        best = np.full(len(self.factor), 2**32 - 1, np.uint32)
        with np.errstate(over="ignore"):
            for at in range(0, len(values), 2048):
                part = (values[None, at:at + 2048] * self.factor + self.shift) >> np.uint64(32)
                np.minimum(best, part.min(axis=1).astype(np.uint32), out=best)
        return best
