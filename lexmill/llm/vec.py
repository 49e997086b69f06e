"""Hashes of words and spans for whole batches of texts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Code points handled at once; one longer text is handled alone.
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(base: int, upto: int) -> np.ndarray:
    out = np.full(upto, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers 0..n-1 of the hash's base, or of its inverse modulo 2**64."""
    size = max(CHUNK + 1, 1 << (n - 1).bit_length())
    return _powers(int(_INVERSE if inverse else _BASE), size)[:n]


class Codes:
    """The code points of several texts side by side, with a prefix hash over all of them."""

    def __init__(self, texts: list[str]) -> None:
        raw = "".join(texts).encode("utf-32-le", "surrogatepass")
        self.codes = np.frombuffer(raw, dtype=np.uint32)
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        n = len(self.codes)
        terms = mix(self.codes.astype(np.uint64) + np.uint64(1)) * powers(n)
        self.prefix = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash for each span that depends on its code points only."""
        back = powers(len(self.codes) + 1, inverse=True)
        return mix((self.prefix[ends] - self.prefix[starts]) * back[starts] + (ends - starts).astype(np.uint64))

    def words(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, start, end and text number of each run of code points that ``table`` marks, in order."""
        mark = np.zeros(len(self.codes) + len(self.bounds), dtype=bool)
        owner = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        at = np.arange(len(self.codes)) + owner  # a gap after each text, so that runs end there
        mark[at] = table[self.codes]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8)))
        first, last = edge[0::2], edge[1::2]
        text = np.searchsorted(self.bounds + np.arange(len(self.bounds)), first, side="right") - 1
        starts, ends = first - text, last - text
        return self.spans(starts, ends), starts, ends, text


@lru_cache(maxsize=1)
def alnum_table() -> np.ndarray:
    """Which code points are letters or digits."""
    return np.array([chr(c).isalnum() for c in range(0x110000)], dtype=bool)


@lru_cache(maxsize=1)
def ascii_word_table() -> np.ndarray:
    """ASCII letters and digits, and all from U+0080 on."""
    out = np.ones(0x110000, dtype=bool)
    out[:128] = [chr(c).isalnum() for c in range(128)]
    return out


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Index ranges of about CHUNK code points each."""
    first, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield first, k
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def grams(words: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    """A hash for each position of the words that ``mask`` (offsets) picks from there; the last positions lack one."""
    n = len(words) - mask[-1]
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for offset in mask:
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[offset : offset + n]
    return mix(out)
