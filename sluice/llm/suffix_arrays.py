"""Suffix arrays of byte shards by induced sorting, and their permuted common prefixes.

The steps are the classic ones, each over whole arrays: classify suffixes as
smaller or larger than their right neighbour, sort the leftmost-smaller
substrings by one induction, name them, order the reduced string of names,
and induce the full array from it. An induction walks the buckets of the first
symbol in order; all suffixes that a bucket sends out are placed at once, in
waves where a bucket feeds itself, so the work is linear in the shard.

The reduced string is sorted by the same function while its alphabet is small;
with more symbols than ``WIDE`` its suffixes are ordered by doubled ranks, as a
walk over buckets would then cost more than the text. ``depth`` bounds how many
symbols of the text two suffixes are told apart by; equal prefixes of that length
stay next to each other, which is all that matching them needs.
"""

from __future__ import annotations

import numpy as np

WIDE = 512


def smaller_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next; the last symbol is the unique smallest."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1])  # > 0: smaller
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    nearest = np.minimum.accumulate(at[::-1])[::-1]  # the next place where neighbours differ
    out = np.ones(n, bool)
    out[:-1] = step[np.minimum(nearest, n - 2)] > 0 if n > 1 else True
    return out


def _send(order, pointer, text, sent, step):
    """Put ``sent`` suffixes at their buckets' pointers, in order; step 1 forward, -1 backward."""
    symbols = text[sent]
    by = np.argsort(symbols, kind="stable")
    symbols, sent = symbols[by], sent[by]
    firsts = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
    counts = np.diff(np.append(firsts, len(symbols)))
    heads = symbols[firsts]
    rank = np.arange(len(symbols)) - np.repeat(firsts, counts)
    order[pointer[symbols] + step * rank] = sent
    pointer[heads] += step * counts


def induce(text: np.ndarray, small: np.ndarray, starts: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from ``lms`` positions listed in their order."""
    n, k = len(text), len(starts) - 1
    order = np.full(n, -1, np.int64)
    present = np.flatnonzero(np.diff(starts))
    ends = starts[1:] - 1
    # the leftmost-smaller suffixes, bucket by bucket
    by = np.argsort(text[lms], kind="stable")
    seeds = lms[by]
    seed_at = np.searchsorted(text[seeds], np.arange(k + 1))
    # larger suffixes, first bucket to last
    front = starts[:-1].copy()
    for c in present:
        done = starts[c]
        while done < front[c]:
            part = order[done : front[c]]
            done = front[c]
            part = part[part > 0] - 1
            part = part[~small[part]]
            if len(part):
                _send(order, front, text, part, 1)
        part = seeds[seed_at[c] : seed_at[c + 1]]
        part = part[part > 0] - 1
        part = part[~small[part]]
        if len(part):
            _send(order, front, text, part, 1)
    # smaller suffixes, last bucket to first
    back = ends.copy()
    for c in present[::-1]:
        done = ends[c]
        while done > back[c]:
            part = order[back[c] + 1 : done + 1][::-1]
            done = back[c]
            part = part[part > 0] - 1
            part = part[small[part]]
            if len(part):
                _send(order, back, text, part, -1)
        part = order[starts[c] : front[c]][::-1]
        part = part[part > 0] - 1
        part = part[small[part]]
        if len(part):
            _send(order, back, text, part, -1)
    order[0] = n - 1
    return order


def _name(text: np.ndarray, sorted_lms: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the leftmost-smaller substrings (equal substrings share one), by text position."""
    n = len(text)
    following = np.full(n, n - 1, np.int64)
    following[lms[:-1]] = lms[1:]
    a, b = sorted_lms[:-1], sorted_lms[1:]
    length = following[a] - a
    same = length == following[b] - b
    alive = np.flatnonzero(same)
    t = 0
    while len(alive):
        keep = text[np.minimum(a[alive] + t, n - 1)] == text[np.minimum(b[alive] + t, n - 1)]
        same[alive[~keep]] = False
        alive = alive[keep]
        alive = alive[length[alive] > t]
        t += 1
    names = np.zeros(n, np.int64)
    names[sorted_lms] = np.concatenate([[0], np.cumsum(~same)])
    return names[lms], int((~same).sum()) + 1


def _doubled(names: np.ndarray, kinds: int, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names, to ``depth`` names, by doubled ranks."""
    n = len(names)
    bits = max(1, int(kinds + 1).bit_length())
    packed = max(1, 62 // bits)
    key = np.zeros(n, np.int64)
    for t in range(packed):
        key <<= bits
        key[: n - t] |= names[t:] + 1 if t < n else 0
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.append(True, key[order[1:]] != key[order[:-1]])
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = heads
    wide = packed
    while wide < depth:
        tied = ~new | np.append(~new[1:], False)  # places whose suffix shares its rank
        places = np.flatnonzero(tied)
        if not len(places):
            break
        part = order[places]
        second = np.where(part + wide < n, rank[np.minimum(part + wide, n - 1)] + 1, 0)
        both = rank[part] * (n + 1) + second
        by = np.argsort(both, kind="stable")
        order[places] = part[by]
        both = both[by]
        new[places] = np.append(True, both[1:] != both[:-1])
        heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[order[places]] = heads[places]
        wide *= 2
    return order


def suffix_array(text: np.ndarray, kinds: int, depth: int) -> np.ndarray:
    """Suffix order of ``text`` (symbols under ``kinds``; the last one unique and smallest)."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    small = smaller_types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=kinds))])
    order = induce(text, small, starts, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sorted_lms = order[is_lms[order]]
    names, found = _name(text, sorted_lms, lms)
    if found == len(lms):
        ranked = sorted_lms
    elif found <= WIDE:
        ranked = lms[suffix_array(names.astype(np.uint16), found, depth)]
    else:
        # a leftmost-smaller substring advances two symbols at least
        ranked = lms[_doubled(names, found, depth // 2 + 1)]
    return induce(text, small, starts, ranked)


def permuted_prefixes(
    text: np.ndarray, order: np.ndarray, most: int, cuts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(before, common): each suffix's predecessor in order and their common prefix, by text position.

    Common prefixes are counted up to ``most`` symbols, counted anew from each of
    ``cuts``: right up to there if cuts are no more than ``most`` apart. A position whose
    predecessor follows its left neighbour's, after equal symbols, has that
    neighbour's prefix less one; only the others are compared, eight bytes at a time.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    common = np.zeros(n, np.int64)
    own = np.ones(n, bool)
    own[1:] = (before[1:] != before[:-1] + 1) | (before[1:] < 1) | (text[:-1] != text[np.maximum(before[1:] - 1, 0)])
    own[cuts] = True
    own &= before >= 0
    padded = np.zeros(n + 16, np.uint8)
    padded[:n] = text
    words = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), shape=(n + 8,), strides=(1,))
    alive = np.flatnonzero(own)
    length = np.zeros(len(alive), np.int64)
    at, other = alive, before[alive]
    which = np.arange(len(alive))
    done = 0
    while len(which) and done < most:
        x = words[np.minimum(at + done, n)] ^ words[np.minimum(other + done, n)]
        differ = x != 0
        low = x[differ]
        bit = (low & (~low + np.uint64(1))).astype(np.float64)
        length[which[differ]] = done + (np.log2(bit).astype(np.int64) >> 3)
        done += 8
        length[which[~differ]] = done
        at, other, which = at[~differ], other[~differ], which[~differ]
    common[alive] = length
    source = np.maximum.accumulate(np.where(own, np.arange(n), 0))
    shifted = common[source] - (np.arange(n) - source)
    return before, np.where(own, common, np.where(before >= 0, shifted, 0))


def repeated_starts(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece (UTF-8 bytes), the offsets of its ``length``-byte strings that occur
    at any other place of any piece. Pieces are told apart by a symbol of their own."""
    sizes = np.array([len(p) for p in pieces])
    raw = np.frombuffer(b"\xf5".join(pieces) + b"\xf5\xf6", np.uint8)
    # No UTF-8 text has bytes from 0xf5 on: the two marks become the smallest symbols.
    text = raw + np.uint8(2)
    text[raw == 0xF5] = 1
    text[-1] = 0
    order = suffix_array(text, 256, 2 * length)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    before, common = permuted_prefixes(text, order, int(sizes.max()) + 1, begins)
    inside = np.zeros(len(text) + 1, np.int64)
    fits = sizes >= length
    np.add.at(inside, begins[fits], 1)
    np.add.at(inside, begins[fits] + sizes[fits] - length + 1, -1)
    inside = np.cumsum(inside)[:-1] > 0
    long = np.flatnonzero((common >= length) & inside)
    marked = np.zeros(len(text), bool)
    marked[long] = True
    marked[before[long]] = True
    marked &= inside
    return [np.flatnonzero(marked[b : b + s]) for b, s in zip(begins, sizes, strict=True)]
