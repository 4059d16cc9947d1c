"""Word shingles of whole Arrow text columns as sorted sets of 64-bit hashes.

Words are runs of bytes other than space and \\t-\\r, A-Z lower-cased. A word's
hash is a polynomial over its bytes, taken from prefix sums over the whole
buffer; a shingle's mixes the hashes of its words in order. Sets are compared by
these hashes: two different shingles of one pair of documents share one with a
chance of about 1 in 2^64 per pair of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLAB = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C55)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit integers over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            size = max(n, SLAB)
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            self.up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, BASE)]))
            self.down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, inverse)]))
        return self.up, self.down


_POWERS = _Powers()


def _word_hashes(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a buffer, and how many words start before each bound."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    text = _LOWER[raw]
    ink = ~_WHITE[text]
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = ~ink[:-1]
    starts = np.flatnonzero(ink & (before | first[:n]))
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = ~ink[1:]
    ends = np.flatnonzero(ink & (after | first[1:])) + 1
    up, down = _POWERS.upto(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * BASE)
    return hashes, np.searchsorted(starts, bounds)


def text_words(raw: np.ndarray) -> np.ndarray:
    """Word hashes of one text of any length, in slabs cut at white space."""
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + SLAB)
        while end < len(raw):
            white = np.flatnonzero(_WHITE[raw[end : end + SLAB]])
            if len(white):
                end += int(white[0])
                break
            end = min(len(raw), end + SLAB)
        out.append(_word_hashes(raw[at:end], np.array([0]))[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _set_of(words: np.ndarray, size: int, salts: np.ndarray) -> np.ndarray:
    if not len(words):
        return words
    if len(words) < size:
        whole = np.uint64(len(words))
        for w in words:
            whole = mix(np.array([whole * BASE + w], np.uint64))[0]
        return np.array([whole], np.uint64)
    n = len(words) - size + 1
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += words[k : k + n] * salts[k]
    return np.unique(mix(total))


def shingle_sets(texts: pa.Array, size: int = 5) -> Iterator[np.ndarray]:
    """The sorted shingle set of every text (nulls are empty), in order."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    salts = mix(np.arange(1, size + 1, dtype=np.uint64) * BASE) | np.uint64(1)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(texts):
            to = int(np.searchsorted(offsets, offsets[at] + SLAB, side="right")) - 1
            if to <= at:
                yield _set_of(text_words(data[offsets[at] : offsets[at + 1]]), size, salts)
                at += 1
                continue
            bounds = offsets[at : to + 1] - offsets[at]
            words, cuts = _word_hashes(data[offsets[at] : offsets[to]], bounds)
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                yield _set_of(words[s:e], size, salts)
            at = to
