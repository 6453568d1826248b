"""Words and word shingles of texts as 64-bit hashes, many texts at a time in numpy.

Runs inside tasks. Words are maximal runs of bytes other than space and tab to
return; A-Z count as a-z. A document's shingles are the distinct runs of five
words; a shorter text with a word is one shingle as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE = 5
#: Texts hashed together hold about so many bytes; one longer text is taken alone.
BLOCK_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` odd multipliers of a family of hash functions."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) * _ODD) | np.uint64(1)


#: A random word for each byte; A-Z as a-z.
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_BYTES[65:91] = _BYTES[97:123]
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0xA0761D6478BD642F)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = seeds(SHINGLE, 77)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, gaps: np.ndarray = _GAP, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """Hashes of all words of texts that lie one after the other, how many each text has, and hashes of the words' first bytes.

    ``data`` holds the bytes, ``starts`` the first byte of each text and the end
    of the last. The hash of a word is a polynomial in random words for its
    bytes, taken from running sums, so the work is linear in the bytes. ``gaps``
    says which bytes separate words; for each number in ``prefixes`` there is one
    more array, of the words cut to so many bytes.
    """
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.uint64)
        return (none, np.zeros(len(starts) - 1, np.int64), *[none for _ in prefixes])
    gap = gaps[data]
    edge = np.zeros(n + 1, bool)
    edge[starts[starts < n]] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, gap[:-1]
    begin = np.flatnonzero(~gap & (before | edge[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, gap[1:] | edge[1:n]
    end = np.flatnonzero(~gap & after) + 1
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data] * _powers(_BASE, n), out=sums[1:])
        back = _powers(_BASE_INVERSE, n)

        def hashed(stop: np.ndarray) -> np.ndarray:
            return mix((sums[stop] - sums[begin]) * back[begin] + (stop - begin).astype(np.uint64))

        return (hashed(end), np.diff(np.searchsorted(begin, starts)), *[hashed(np.minimum(end, begin + k)) for k in prefixes])


def shingle_hashes(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted within it, and how many each has."""
    firsts = np.concatenate([[0], np.cumsum(counts)])
    out, sizes = [], np.zeros(len(counts), np.int64)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
        for k in range(SHINGLE):
            rolled += words[k:k + len(rolled)] * _PLACE[k]
        rolled = mix(rolled)
        for d, n in enumerate(counts):
            if n >= SHINGLE:
                s = np.unique(rolled[firsts[d]:firsts[d] + n - SHINGLE + 1])
            elif n:
                s = mix((words[firsts[d]:firsts[d] + n] * _PLACE[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
            else:
                continue
            out.append(s)
            sizes[d] = len(s)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def text_blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first, end, bytes, starts`` of runs of texts of about ``most`` bytes; null is empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    if len(texts) == 0:
        return
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        starts = offsets[first:end + 1]
        yield first, end, data[starts[0]:starts[-1]], starts - starts[0]
        first = end


def shingle_sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``first, shingles, sizes`` for runs of texts, in order."""
    for first, _, data, starts in text_blocks(texts):
        shingles, sizes = shingle_hashes(*word_hashes(data, starts))
        yield first, shingles, sizes


def set_of(text: str) -> np.ndarray:
    """The sorted shingle set of one text."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    return shingle_hashes(*word_hashes(data, np.array([0, len(data)])))[0]


def segment_min(values: np.ndarray, sizes: np.ndarray, empty: int = 0) -> np.ndarray:
    """The least of each segment; ``empty`` for segments without values."""
    out = np.full(len(sizes), empty, values.dtype)
    full = sizes > 0
    if full.any():
        out[full] = np.minimum.reduceat(values, (np.cumsum(sizes) - sizes)[full])
    return out
