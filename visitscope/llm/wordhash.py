"""Word boundaries and 64-bit hashes of words and word n-grams, a batch of texts at once.

Words are runs of bytes other than space and 0x09-0x0D. Hashes depend on the
bytes of a word alone and are mixed non-linearly, so n-gram hashes of equal
word sequences are equal wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_KEEP = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 8)] + [2**64 - 1], dtype=np.uint64)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, in place."""
    h ^= h >> np.uint64(30)
    h *= _B
    h ^= h >> np.uint64(27)
    h *= _C
    h ^= h >> np.uint64(31)
    return h


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the sequence a, b from the hashes of its parts."""
    return mix(a * _A + (b ^ (b >> np.uint64(29))) + np.uint64(1))


@dataclass
class Words:
    """Words of several texts that stand one after another in `data`."""

    data: bytes
    begins: np.ndarray  # first byte of each word
    ends: np.ndarray    # byte after each word
    first: np.ndarray   # first word of each text, and the number of words
    hashes: np.ndarray


def words_of(texts: list[bytes]) -> Words:
    data = b"\n".join(texts) + b"\n" + bytes(8)
    raw = np.frombuffer(data, dtype=np.uint8)[:-8]
    inside = np.empty(len(raw) + 1, dtype=bool)
    inside[0] = False
    np.logical_not(_SEPARATOR[raw], out=inside[1:])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[0::2], edges[1::2]
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    first = np.searchsorted(begins, np.concatenate([[0], np.cumsum(sizes)]))
    lanes = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    left = ends - begins
    h = mix(left.astype(np.uint64) * _A)
    at, which = begins, None
    while True:
        own = h if which is None else h[which]
        own = mix((own ^ (lanes[at] & _KEEP[np.minimum(left, 8)])) * _A)
        if which is None:
            h = own
        else:
            h[which] = own
        more = left > 8
        if not more.any():
            break
        which = np.flatnonzero(more) if which is None else which[more]
        at, left = at[more] + 8, left[more] - 8
    return Words(data, begins, ends, first, h)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; shorter by n - 1."""
    power, size, at, out = hashes, 1, 0, None
    while True:
        if n & size:
            out = power if out is None else joined(out[:len(power) - at], power[at:]) if len(power) > at else out[:0]
            at += size
        size *= 2
        if size > n:
            return out[:max(0, len(hashes) - n + 1)]
        half = size // 2
        power = joined(power[:-half], power[half:]) if len(power) > half else power[:0]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of the `width` values from each position on."""
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:]) if len(out) > size else out[:0]
        size *= 2
    rest = width - size
    return np.minimum(out[:-rest], out[rest:]) if rest and len(out) > rest else out[:0] if rest else out


def pieces(texts: list[bytes], most: int) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) in runs of at most `most` bytes; a longer text goes alone."""
    at, size, held = 0, 0, []
    for i, t in enumerate(texts):
        if held and size + len(t) > most:
            yield at, held
            at, size, held = i, 0, []
        held.append(t)
        size += len(t)
    if held:
        yield at, held
