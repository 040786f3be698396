"""Vectorised words of UTF-8 texts: boundaries and 64-bit hashes without a Python object per word."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BLOCK_BYTES = 1 << 21

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to ``size``."""
    global _powers, _inverses
    if len(_powers) < size:
        size = max(size, BLOCK_BYTES + 2)
        _powers = np.ones(size, dtype=np.uint64)
        _inverses = np.ones(size, dtype=np.uint64)
        _powers[1:] = BASE
        _inverses[1:] = BASE_INVERSE
        np.cumprod(_powers, out=_powers)
        np.cumprod(_inverses, out=_inverses)
    return _powers, _inverses


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def blocks(texts: list[bytes], most: int = BLOCK_BYTES):
    """(start, end) of runs of texts with about ``most`` bytes; one text is never cut."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > most:
            yield start, i
            start, held = i, 0
        held += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words per text, and the hashes of all words in order. A-Z count as a-z.

    A word's hash is that of its bytes as a polynomial modulo 2**64, with its length mixed in.
    Sums over a prefix give all of them in a few array operations per byte.
    """
    counts, hashes = [], []
    for start, end in blocks(texts):
        joined = np.frombuffer(b"\n".join(texts[start:end]).lower() + b"\n", dtype=np.uint8)
        gap = _SPACE[joined]
        begins = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        if not gap[0]:
            begins = np.concatenate(([0], begins))
        ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        powers, inverses = _tables(len(joined) + 1)
        sums = np.zeros(len(joined) + 1, dtype=np.uint64)
        np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * powers[: len(joined)], out=sums[1:])
        own = (sums[ends] - sums[begins]) * inverses[begins]
        hashes.append(mix(own ^ ((ends - begins).astype(np.uint64) << np.uint64(48))))
        sizes = np.fromiter(map(len, texts[start:end]), dtype=np.int64, count=end - start) + 1
        edges = np.concatenate(([0], np.cumsum(sizes)))
        counts.append(np.diff(np.searchsorted(begins, edges)))
    if not counts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    return np.concatenate(counts), np.concatenate(hashes)
