"""Vectorised tokenising and hashing of whole texts, in bounded memory.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, after A-Z were lower-cased.
All functions work on numpy arrays and hold a few dozen bytes for each byte of one slice
(SLICE bytes, or one word if that is longer), however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE = 1 << 20
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_RADIX = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SPACES = b" \t\n\x0b\x0c\r"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, SLICE + 4096)
            for name, base in (("up", _RADIX), ("down", pow(_RADIX, -1, 1 << 64))):
                a = np.full(size, base, np.uint64)
                a[0] = 1
                setattr(cls, name, np.cumprod(a, dtype=np.uint64))
        return cls.up, cls.down


def lowered(text: str | None) -> bytes:
    """UTF-8 of a text (null: empty) with A-Z lower-cased; lone surrogates become '?'."""
    return (text or "").encode("utf-8", "replace").translate(_LOWER)


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end byte offsets of the words."""
    space = _IS_SPACE[np.frombuffer(raw, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    return edge[0::2], edge[1::2]


def _hash_slice(raw: bytes) -> np.ndarray:
    starts, ends = word_bounds(raw)
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _Powers.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[np.frombuffer(raw, np.uint8)] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _cut(raw: bytes) -> Iterator[bytes]:
    """Slices of about SLICE bytes that end before white space."""
    at, n = 0, len(raw)
    while n - at > SLICE:
        end = at + SLICE
        while end < n and raw[end] not in _SPACES:
            end += 1
        yield raw[at:end]
        at = end
    yield raw[at:]


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of these texts, in order, and each text's number of words."""
    hashes, counts, i = [], np.zeros(len(raws), np.int64), 0
    while i < len(raws):
        j, size = i, 0
        while j < len(raws) and (j == i or size + len(raws[j]) < SLICE):
            size += len(raws[j]) + 1
            j += 1
        if j == i + 1:
            parts = [_hash_slice(x) for x in _cut(raws[i])]
            counts[i] = sum(map(len, parts))
            hashes += parts
        else:
            joined = b" ".join(raws[i:j])
            part = _hash_slice(joined)
            ends = np.cumsum([len(x) + 1 for x in raws[i:j]])
            upto = np.searchsorted(word_bounds(joined)[0], ends)
            counts[i:j] = np.diff(upto, prepend=0)
            hashes.append(part)
        i = j
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), counts


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of `width` words; of the whole sequence if it is shorter."""
    n = len(words)
    if not n:
        return words
    k = min(width, n)
    h = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        h = mix(h + words[i : n - k + 1 + i] + np.uint64(0x9E3779B97F4A7C15 + i))
    return np.unique(h)
