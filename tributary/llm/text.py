"""Vectorised work on the bytes of texts: words, their hashes, rolling hashes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Odd multiplier of the polynomial hashes and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse for 2**bits places."""
    out = []
    for factor in (BASE, INVERSE):
        table = np.ones(1 << bits, dtype=np.uint64)
        for b in range(bits):
            table[1 << b : 2 << b] = table[: 1 << b] * np.uint64(pow(factor, 1 << b, 1 << 64))
        out.append(table)
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(max(20, int(n).bit_length()))
    return up[: n + 1], down[: n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits over 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of the bytes: length n + 1, first 0."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end): equal bytes, equal hash."""
    _, down = powers(len(sums) - 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


# Bytes that end a term: what is neither an ASCII letter or digit nor beyond ASCII.
NO_TERM = np.zeros(256, dtype=bool)
NO_TERM[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def word_spans(data: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space (0x20, 0x09 to 0x0D), or without other `gaps`."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    gap = gaps[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    edges = np.concatenate(([0], edge, [len(data)]))
    first = int(gap[0])
    starts, ends = edges[first:-1:2], edges[first + 1 :: 2]
    return starts, ends[: len(starts)]


def batches_of_texts(texts: list[bytes], limit: int = 1 << 20):
    """Runs (from, to) of texts of about `limit` bytes together; a longer text is alone."""
    begin, total = 0, 0
    for i, text in enumerate(texts):
        if total and total + len(text) > limit:
            yield begin, i
            begin, total = i, 0
        total += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def hashed_words(texts: list[bytes], fold_case: bool, lengths: bool = False, gaps: np.ndarray = SPACE):
    """Word hashes of each text, in order: yields (index of the text, its hashes).

    With `lengths` the bytes of each word come as a third value.

    Texts are taken together in runs of about a megabyte, separated by white space.
    """
    for begin, end in batches_of_texts(texts):
        joined = np.frombuffer(b"\n".join(texts[begin:end]), dtype=np.uint8)
        if fold_case:
            joined = LOWER[joined]
        sums = prefix_hash(joined)
        starts, ends = word_spans(joined, gaps)
        hashes = span_hashes(sums, starts, ends)
        sizes = np.fromiter((len(t) for t in texts[begin:end]), np.int64, end - begin)
        offsets = np.concatenate(([0], np.cumsum(sizes + 1)))
        cut = np.searchsorted(starts, offsets)
        for i in range(end - begin):
            own = slice(cut[i], cut[i + 1])
            yield (begin + i, hashes[own], (ends - starts)[own]) if lengths else (begin + i, hashes[own])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per window of `size` words; a shorter text is one shingle, no words none."""
    if not len(words):
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    out = np.full(count, np.uint64(width), dtype=np.uint64)
    for i in range(width):
        out = mix(out * np.uint64(BASE) + words[i : i + count])
    return out
