"""Hashed word shingles of texts, and their circulant MinHash signatures.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case. A text's set
holds the 64-bit hashes of its distinct runs of ``width`` words; a text with
fewer words has one shingle, its whole word sequence; a text without words has
none.

Circulant MinHash takes two permutations of a universe of ``UNIVERSE`` places.
The first (a hash of the shingle) gives each element a place and so breaks up
any structure; the second is one stored table. Signature coordinate k is the
least value that the second permutation, shifted circularly by k, gives to any
element. All coordinates of an element are one contiguous run of the table, so
a signature is the minimum over such runs.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np

UNIVERSE = 1 << 22
SEED = 20_240_901

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * _C
        return x ^ (x >> np.uint64(31))


# A-Z as a-z.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
# The scattered values of each byte at the first places of a word; those of later places are computed.
_PLACES = 64
_VALUES = mix(np.arange(1, _PLACES * 256 + 1, dtype=np.uint64) * _A)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, in order: the sum of a scattered value for each (place, byte), scattered again.

    Every place of a word has its own table of values, so no arrangement of
    letters cancels out by construction, as it does for polynomials modulo 2^64.
    """
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    space = _IS_SPACE[raw]
    letters = raw[~space]
    if not len(letters):
        return np.zeros(0, np.uint64)
    # A word starts at a letter in front of which is none.
    first = np.empty(len(raw), bool)
    first[0] = True
    first[1:] = space[:-1]
    starts = np.flatnonzero(first[~space])
    lengths = np.diff(np.append(starts, len(letters)))
    places = np.arange(len(letters)) - np.repeat(starts, lengths)
    at = (places << 8) + _LOWER[letters]
    with np.errstate(over="ignore"):
        if lengths.max() <= _PLACES:
            values = _VALUES[at]
        else:
            values = mix((at.astype(np.uint64) + np.uint64(1)) * _A)
        return mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64) * _A)


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = word_hashes(text)
    if not len(words):
        return words
    size = min(width, len(words))
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        total = np.full(n, np.uint64(size))
        for i in range(size):
            total = mix(total * _A + words[i : i + n])
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


@cache
def _runs(coordinates: int) -> np.ndarray:
    """The run of the second permutation at each place: one item of many bytes, overlapping its neighbours."""
    table = np.random.default_rng(SEED).permutation(UNIVERSE).astype(np.uint32)
    table = np.concatenate([table, table[:coordinates]])
    return np.ndarray(UNIVERSE, np.dtype((np.void, 4 * coordinates)), table, strides=(4,))


def signature(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """All signature coordinates of a set that is not empty."""
    runs = _runs(coordinates)
    places = (mix(shingles * _A) & np.uint64(UNIVERSE - 1)).astype(np.int64)
    best = np.full(coordinates, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(places), 512):
        block = runs[places[at : at + 512]].view(np.uint32).reshape(-1, coordinates)
        np.minimum(best, block.min(axis=0), out=best)
    return best


def band_keys(best: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of ``rows`` coordinates."""
    bands = best.reshape(-1, rows).astype(np.uint64)
    key = np.arange(1, len(bands) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in bands.T:
            key = mix(key * _A + column)
    return key.astype(np.int64)


def set_digest(shingles: np.ndarray) -> bytes:
    """16 bytes that stand for a whole set."""
    import hashlib

    return hashlib.blake2b(shingles.astype("<u8").tobytes(), digest_size=16).digest()


_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_TO_LOWER = {c: c + 32 for c in range(65, 91)}


def word_shingles(text: str, width: int) -> set[tuple[str, ...]]:
    """The shingle set in its own words."""
    words = _WORDS.findall(text.translate(_TO_LOWER))
    if len(words) <= width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width)), strict=False))


def linked(a: str, b: str, width: int, percent: int) -> bool:
    """Whether two texts link, by their words."""
    one, other = word_shingles(a, width), word_shingles(b, width)
    shared = len(one & other)
    return shared > 0 and 100 * shared >= percent * (len(one) + len(other) - shared)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
