"""Word shingles of whole texts as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np

# odd factors, one per place in a shingle; longer shingles go on from the last by squaring
FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63]
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
PLACES = 64
LETTERS = np.random.default_rng(20).integers(0, 1 << 64, PLACES * 256, np.uint64)  # a value per place and byte
PART = 1 << 20  # bytes hashed at a time


def words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, A-Z in lower case."""
    return (text or "").encode().lower().split()


def _hashed(b: np.ndarray) -> np.ndarray:
    """Sum over a word's bytes of a random value for place and byte, for every word of ``b``."""
    letter = ~SPACE[b]
    turn = np.flatnonzero(np.diff(letter, prepend=False, append=False))
    lengths = (turn[1::2] - turn[::2]).astype(np.int32)
    if not len(lengths):
        return np.empty(0, np.uint64)
    begin = np.cumsum(lengths, dtype=np.int32) - lengths
    chars = b[letter].astype(np.int32)
    place = np.arange(len(chars), dtype=np.int32) - np.repeat(begin, lengths)
    value = LETTERS[((place & (PLACES - 1)) << 8) | chars]
    if lengths.max() > PLACES:
        value *= (2 * (place // PLACES) + 1).astype(np.uint64)
    return mix(np.add.reduceat(value, begin) + lengths.astype(np.uint64))


def byte_word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words of UTF-8 text, in order."""
    if len(data) <= PART:
        return _hashed(np.frombuffer(data, np.uint8))
    out, start = [], 0
    whole = np.frombuffer(data, np.uint8)
    while start < len(whole):
        end = min(start + PART, len(whole))
        while end < len(whole):  # on to the next white space
            gap = np.flatnonzero(SPACE[whole[end:end + PART]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + PART, len(whole))
        out.append(_hashed(whole[start:end]))
        start = end
    return np.concatenate(out)


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of ``words(text)``."""
    return byte_word_hashes((text or "").encode().lower())


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every ``size`` words in a row, in text order; none for fewer words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += hashes[i:i + n] * np.uint64(FACTORS[i % len(FACTORS)] + 2 * (i // len(FACTORS)))
    return mix(total)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Distinct shingles, sorted. A shorter text is one shingle, an empty one has none."""
    hashes = word_hashes(text)
    if 0 < len(hashes) < size:
        return mix(shingle_hashes(hashes, len(hashes)) + np.uint64(len(hashes)))
    ordered = np.sort(shingle_hashes(hashes, size))
    return ordered[np.diff(ordered, prepend=~ordered[:1]) != 0]
