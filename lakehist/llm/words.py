"""Words of a column of texts as arrays of 64-bit hashes, without a Python object per word.

Texts are read as UTF-8 bytes. A word is a maximal run of bytes that are not separators; ``A-Z`` count as
``a-z``. Bytes of characters beyond ASCII are never separators here, so byte classes and character classes agree.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Everything but white space: ``[^\x20\x09-\x0D]+``.
SPACED = np.isin(np.arange(256), [*range(9, 14), 32])
#: Digits, letters and all beyond ASCII, of lower-cased text: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
ALNUM = ~np.isin(LOWER, [*range(48, 58), *range(97, 123), *range(128, 256)])

#: Words of more bytes than this are hashed one by one.
LONG_WORD = 256

_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64); overwrites ``x``."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Hashes of all words in order; those of text ``i`` are ``hashes[bounds[i]:bounds[i + 1]]``."""

    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    raw: np.ndarray  # lower-cased bytes, 16 zeros behind

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of_word(self) -> np.ndarray:
        """For every word the number of its text."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def words(texts: pa.Array, separators: np.ndarray = SPACED) -> Words:
    """Split and hash a column of texts; null counts as empty."""
    texts = pa.concat_arrays([texts.cast(pa.large_string()).fill_null(""), pa.array([""], pa.large_string())])
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts), texts.offset * 8)
    first, last = int(offsets[0]), int(offsets[-1])
    size = last - first
    raw = np.zeros(size + 16, np.uint8)
    inside = np.zeros(size + 2, bool)  # one separator on either side
    if size:
        data = np.frombuffer(texts.buffers()[2], np.uint8, size, first)
        np.take(LOWER, data, out=raw[:size])
        np.take(~separators, data, out=inside[1:-1])
    offsets = offsets - first
    edges = offsets[(offsets > 0) & (offsets < size)]
    begins, stops = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    begins[edges] = inside[edges + 1]
    stops[edges] = inside[edges]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    return Words(_hashes(raw, starts, ends), np.searchsorted(starts, offsets), starts, ends, raw)


def _hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    eight = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))  # the 8 bytes from each position on
    left = ends - starts
    out = mixed((eight[starts] & _MASKS[np.minimum(left, 8)]) ^ (left.astype(np.uint64) << np.uint64(56)) ^ left.astype(np.uint64))
    at, more = 8, np.flatnonzero((left > 8) & (left <= LONG_WORD))
    while more.size:
        rest = left[more] - at
        out[more] = mixed((eight[starts[more] + at] & _MASKS[np.minimum(rest, 8)]) + out[more] * np.uint64(0x9E3779B97F4A7C15))
        at += 8
        more = more[rest > 8]
    for i in np.flatnonzero(left > LONG_WORD):
        digest = hashlib.blake2b(raw[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, "<u8")[0]
    return out
