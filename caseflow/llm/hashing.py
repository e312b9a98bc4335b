"""Vectorised hashes over the bytes of a batch of texts."""

from __future__ import annotations

import functools

import numpy as np

# Odd multipliers of the polynomial and of the mixers; any odd numbers do.
BASE = 0x9E3779B97F4A7C15
MIX_A = np.uint64(0xFF51AFD7ED558CCD)
MIX_B = np.uint64(0xC4CEB9FE1A85EC53)
WORD_MULTIPLIERS = np.random.default_rng(5).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) \
    + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * MIX_A
    x = x ^ (x >> np.uint64(33))
    x = x * MIX_B
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


@functools.lru_cache(maxsize=1)
def _tables(bits: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(BASE, 1 << bits), _powers(pow(BASE, -1, 1 << 64), 1 << bits)


def tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, at least, of the base and of its inverse mod 2^64."""
    return _tables(max(21, int(n).bit_length()))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, the empty one first."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * tables(len(data))[0][:len(data)],
              out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans, the same wherever the span stands (not yet mixed)."""
    return (prefix[ends] - prefix[starts]) * tables(len(prefix))[1][starts]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[32, *range(9, 14)]] = True


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``size``-word shingles,
    A-Z lower-cased; with fewer words the whole sequence is one shingle."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    data = LOWER[data]
    blank = np.concatenate([[True], IS_BLANK[data], [True]])
    edges = np.flatnonzero(np.diff(blank))
    starts, ends = edges[::2], edges[1::2]
    words = mix(span_hashes(prefix_hashes(data), starts, ends))
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(starts, bounds)
    c = WORD_MULTIPLIERS
    n = max(0, len(words) - size + 1)
    grams = np.zeros(n, np.uint64)
    for k in range(size):
        grams += words[k:k + n] * c[k]
    grams = mix(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(grams[a:b - size + 1]))
        elif b > a:
            short = (words[a:b] * c[:b - a]).sum(dtype=np.uint64, keepdims=True)
            out.append(mix(short + c[63:] * np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
