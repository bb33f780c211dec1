"""Word and word-window hashes of many texts at once, in numpy.

Words are runs of bytes outside [\\x20\\x09-\\x0D].  A word's hash is a
polynomial of random byte values, taken as a difference of running sums over
the whole buffer, so the cost is a few array passes per byte and no Python
work per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

BLOCK_BYTES = 1 << 19           # text hashed at once
_BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(29))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base, inverse = _BASE % 2**64, pow(_BASE, -1, 2**64)
    return tuple(np.cumprod(np.concatenate([np.ones(1, _U), np.full(n - 1, b, _U)])) for b in (base, inverse))


@lru_cache(maxsize=2)
def _byte_values(fold_case: bool) -> np.ndarray:
    v = np.random.default_rng(2024).integers(1, 2**63, 256).astype(_U)
    if fold_case:
        v[ord("A"):ord("Z") + 1] = v[ord("a"):ord("z") + 1]
    return v


def segments(texts: Iterable[bytes], most: int = BLOCK_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """(text number, bytes) in lists of about ``most`` bytes; a longer text is
    cut between words."""
    held, size = [], 0
    for i, text in enumerate(texts):
        at = 0
        while True:
            end = at + most
            part = text[at:end]
            if len(text) > end:         # go back to white space; a longer word stays whole
                cut = max(part.rfind(c) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
                if cut < 0:
                    cut = min((p for p in (text.find(c, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if p >= 0),
                              default=len(text)) - at
                part = text[at:at + cut + 1]
            if held and size + len(part) > most:
                yield held
                held, size = [], 0
            held.append((i, part))
            size += len(part)
            at += len(part)
            if at >= len(text):
                break
    if held:
        yield held


def _hash_segments(held: list[tuple[int, bytes]], fold_case: bool) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every word of the segments, in order."""
    buf = np.frombuffer(b"\n".join(s for _, s in held) + b"\n", np.uint8)
    word = ~SPACE[buf]
    edges = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edges = np.concatenate([np.zeros(1, edges.dtype), edges])
    starts, ends = edges[::2], edges[1::2]
    size = 1 << max(BLOCK_BYTES + (BLOCK_BYTES >> 1), len(buf) + 1).bit_length()
    power, inverse = _powers(size)
    sums = np.empty(len(buf) + 1, _U)
    sums[0] = 0
    np.cumsum(_byte_values(fold_case)[buf] * power[:len(buf)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts])
    bounds = np.cumsum([len(s) + 1 for _, s in held])
    numbers = np.array([i for i, _ in held])
    return numbers[np.searchsorted(bounds, starts, side="right")], hashes


def word_hashes(texts: Iterable[bytes], fold_case: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text number, counts of words by text, hashes of the words) for
    consecutive groups of whole texts."""
    numbers, hashes, first, last = [], [], 0, -1

    def group(upto: int) -> tuple[int, np.ndarray, np.ndarray]:
        n = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        return first, np.bincount(n - first, minlength=upto - first + 1), np.concatenate(hashes) if hashes else np.zeros(0, _U)
    for held in segments(texts):
        if last >= 0 and held[0][0] > last:         # the texts so far are complete
            yield group(last)
            numbers, hashes, first = [], [], last + 1
        n, h = _hash_segments(held, fold_case)
        numbers.append(n)
        hashes.append(h)
        last = held[-1][0]
    if last >= 0:
        yield group(last)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` (a power of two) words from each position; the
    last ``size - 1`` positions are not whole windows."""
    step = 1
    while step < size:
        nxt = np.zeros_like(hashes)
        nxt[:-step] = hashes[step:]
        hashes = mix(hashes * _U(0xA0761D6478BD642F) + nxt * _U(0xE7037ED1A0B428DB) + _U(step))
        step *= 2
    return hashes
