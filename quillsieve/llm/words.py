"""Words and word shingles of UTF-8 texts as numpy hashes, a batch at a time."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_RNG = np.random.default_rng(0x5EED)
_VALUE = _RNG.integers(1, 2**63, 256, np.uint64) | np.uint64(1)
for _c in range(65, 91):  # A-Z fold to a-z
    _VALUE[_c] = _VALUE[_c + 32]
_POWER = _RNG.integers(1, 2**63, 4096, np.uint64) | np.uint64(1)
_PLACE = _RNG.integers(1, 2**63, 64, np.uint64) | np.uint64(1)
_FAR = np.uint64(0x9E3779B97F4A7C15)  # a weight's factor for every further 4096 bytes of a word
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def weights(place: np.ndarray) -> np.ndarray:
    """Odd weights of byte places in a word; they differ beyond 4096 bytes too, so a hash depends on every byte's place."""
    near = _POWER[place & 4095]
    if not len(place) or int(place.max()) < 4096:
        return near
    far = np.full(int(place.max() >> 12) + 1, _FAR)
    far[0] = 1
    return near * np.cumprod(far)[place >> 12]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words ``[^\\x20\\x09-\\x0D]+``, A-Z lowered, and the number of words of each text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = _BLANK[data]
    before = np.empty_like(blank)
    before[0], before[1:] = True, blank[:-1]
    first = np.flatnonzero(before & ~blank)
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    last = np.flatnonzero(blank & ~before)
    size = last - first
    letters = data[~blank]
    start = np.cumsum(size) - size
    place = np.arange(len(letters)) - np.repeat(start, size)
    h = mix(np.add.reduceat(_VALUE[letters] * weights(place), start) + size.astype(np.uint64))
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    upto = np.searchsorted(first, ends)
    return h, np.diff(upto, prepend=0)


def shingle_sets(texts: list[bytes], words: int = 5) -> list[np.ndarray]:
    """The sorted distinct hashed shingles of each text; a text of fewer words is one shingle, one of none has none."""
    h, counts = word_hashes(texts)
    out, at = [], 0
    joined = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for k in range(words):
        joined += h[k : k + len(joined)] * _PLACE[k]
    joined = mix(joined)
    for n in counts.tolist():
        if n >= words:
            s = np.sort(joined[at : at + n - words + 1])
            keep = np.empty(len(s), bool)
            keep[0], keep[1:] = True, s[1:] != s[:-1]
            out.append(s[keep])
        elif n:
            out.append(mix((h[at : at + n] * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True) + _PLACE[32 + n : 33 + n]))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def text_key(text: Column) -> Column:
    """A hash that tells the texts of one id apart; null texts are empty."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def release() -> None:
    """Gives a worker's freed memory back to the system; workers outlive their tasks, and glibc keeps what they freed."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def blocks(texts: list[bytes], limit: int = 250_000, rows: int = 500):
    """Ranges of ``texts`` of about ``limit`` bytes and at most ``rows`` texts."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= limit or i + 1 - start >= rows:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
