"""Texts as numpy arrays: bytes, words, shingles and their 64-bit hashes, for many documents at once.

All arithmetic wraps at 64 bits. Hashes depend on the text alone, so every task and every run gives the same.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
#: Fixed odd constants of the splitmix64 generator.
GOLDEN, MIX_1, MIX_2 = U64(0x9E3779B97F4A7C15), U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit."""
    x = (x ^ (x >> U64(30))) * MIX_1
    x = (x ^ (x >> U64(27))) * MIX_2
    return x ^ (x >> U64(31))


BYTE_VALUE = mixed(np.arange(1, 257, dtype=U64) * GOLDEN)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
#: Everything in ASCII but letters and digits parts words too.
IS_BREAK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
BASE = U64(0xD6E8FEB86659FD93)
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_table(base: np.uint64, name: str, size: int) -> np.ndarray:
    """1, base, base**2, ... with at least ``size`` entries."""
    known = _powers.get(name)
    if known is None or len(known) < size:
        steps = np.full(max(size, 1 << 16), base, dtype=U64)
        steps[0] = 1
        known = _powers[name] = np.multiply.accumulate(steps)
    return known[:size]


class Block:
    """Documents laid end to end with one line feed after each."""

    def __init__(self, texts: list[bytes]):
        self.buffer = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
        sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        self.count = len(texts)

    def words(self, breaks: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end byte of every run of bytes that are no breaks, and its document."""
        edges = np.flatnonzero(np.diff(np.concatenate(([True], breaks[self.buffer])).astype(np.int8)))
        starts, ends = edges[0::2], edges[1::2]
        return starts, ends, np.searchsorted(self.ends, starts, side="right")

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
        """A hash of each span's bytes, the same wherever the span lies."""
        values = BYTE_VALUE[LOWER[self.buffer] if lower else self.buffer]
        sums = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(values * _power_table(BASE, "up", len(values)), out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * _power_table(BASE_INVERSE, "down", len(values) + 1)[starts]
        return mixed(hashes + (ends - starts).astype(U64) * GOLDEN)


def shingle_hashes(words: np.ndarray, docs: np.ndarray, count: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every run of ``width`` words; a shorter document is one run as a whole."""
    factors = mixed(np.arange(1, width + 1, dtype=U64) + GOLDEN) | U64(1)
    sizes = np.bincount(docs, minlength=count)
    firsts = np.cumsum(sizes) - sizes
    hashes, owners = np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    if len(words) >= width:
        runs = len(words) - width + 1
        hashes = np.zeros(runs, dtype=U64)
        for k in range(width):
            hashes += words[k : k + runs] * factors[k]
        inside = docs[:runs] == docs[width - 1 :]
        hashes, owners = hashes[inside], docs[:runs][inside]
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    if len(short):
        whole = np.zeros(len(short), dtype=U64)
        for k in range(width - 1):
            has = sizes[short] > k
            whole[has] += words[firsts[short[has]] + k] * factors[k]
        hashes, owners = np.concatenate((hashes, whole)), np.concatenate((owners, short))
    return mixed(hashes), owners


def distinct_per_doc(hashes: np.ndarray, docs: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in rising order document by document, and count + 1 bounds into them."""
    order = np.lexsort((hashes, docs))
    hashes, docs = hashes[order], docs[order]
    if len(hashes):
        fresh = np.ones(len(hashes), dtype=bool)
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
        hashes, docs = hashes[fresh], docs[fresh]
    return hashes, np.searchsorted(docs, np.arange(count + 1))
