"""Simple-8b word-aligned coding of unsigned integers in numpy.

Each little-endian 64-bit word holds a 4-bit selector (top bits) and 60 bits of payload: selector s packs COUNTS[s]
values of WIDTHS[s] bits each, the first value in the lowest bits.  Selector 15 is the escape: the next whole word is
one value that needs more than 60 bits.  The last word of a block may be padded with zeros; the block's length says how
many values count.
"""

from __future__ import annotations

import numpy as np

# Fixed values of the coding: how many values of how many bits a word holds, by selector.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
#: Selector 0 and 1 (runs of zeros) are used for nothing else; selector 1 marks an escaped value instead of 120 zeros.
ESCAPE = 1


def encode(values: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks of ``block`` values (the last may be shorter) one after another, and how many words each has.

    For every place, the selector that packs most is found first: a selector fits where the widest of the next so many
    values is narrow enough, and maxima over longer runs come from those over shorter ones.  Then all blocks are packed
    together, one word at a time, so the loop is as long as the longest block."""
    v = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(v)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts = np.arange(0, n, block, dtype=np.int64)
    ends = np.append(starts[1:], n)
    # bits of each value; those from 2**53 on may round up by one, which costs room but no value
    width = np.zeros((len(starts), block + int(COUNTS[0])), np.uint8)  # nothing follows a block's end, and nothing fits anywhere
    bits_of = np.frexp(v.astype(np.float64))[1].astype(np.uint8)
    whole = n // block
    width[:whole, :block] = bits_of[: whole * block].reshape(whole, block)
    if whole < len(starts):
        width[whole, : n - whole * block] = bits_of[whole * block :]
    best = np.full((len(starts), block), ESCAPE, np.uint8)
    widest, reach = width, 1  # widest[i, j]: of the reach values from j on
    for s in range(15, -1, -1):  # from the fewest values in a word to the most: the last that fits wins
        bits, count = int(WIDTHS[s]), int(COUNTS[s])
        if s == ESCAPE:
            continue
        while reach < count:
            more = min(reach, count - reach)
            widest = np.maximum(widest[:, : widest.shape[1] - more], widest[:, more:])
            reach += more
        good = widest[:, :block] <= bits
        if s < 15 and not good.any() and bits <= 2:
            break
        np.copyto(best, s, where=good)
    best = best.ravel()[:n]
    taken = np.minimum(np.where(best == ESCAPE, 1, COUNTS[best]), np.repeat(ends, ends - starts) - np.arange(n))
    # follow the chain of words in every block
    pos, live = starts.copy(), np.arange(len(starts))
    firsts: list[np.ndarray] = []
    while len(live):
        p = pos[live]
        firsts.append(p)
        pos[live] = p + taken[p]
        live = live[pos[live] < ends[live]]
    first = np.sort(np.concatenate(firsts)) if firsts else np.zeros(0, np.int64)
    sel, cnt = best[first], taken[first]
    escaped = sel == ESCAPE
    place = np.cumsum(1 + escaped) - (1 + escaped)
    words = np.zeros(int((1 + escaped).sum()), np.uint64)
    packed = sel.astype(np.uint64) << np.uint64(60)
    for s in np.unique(sel):
        mine = np.flatnonzero(sel == s)
        bits = int(WIDTHS[s])
        if s == ESCAPE or bits == 0:
            continue
        whole = mine[cnt[mine] == COUNTS[s]]
        word, begin = packed[whole], first[whole]
        for k in range(int(COUNTS[s])):
            word |= v[begin + k] << np.uint64(k * bits)
        packed[whole] = word
        short = mine[cnt[mine] < COUNTS[s]]  # at the ends of blocks
        for k in range(int(COUNTS[s])):
            has = short[cnt[short] > k]
            packed[has] |= v[first[has] + k] << np.uint64(k * bits)
    words[place] = packed
    words[place[escaped] + 1] = v[first[escaped]]
    return words, np.bincount(first // block, weights=1 + escaped, minlength=len(starts)).astype(np.int64)


def decode(words: np.ndarray, n: int) -> np.ndarray:
    """The n values of one block."""
    return decode_blocks(words, np.array([len(words)]), np.array([n]))


def decode_blocks(words: np.ndarray, n_words: np.ndarray, n_values: np.ndarray) -> np.ndarray:
    """The values of blocks that follow each other: block b has n_words[b] words and n_values[b] values."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)  # whole words behind an escape
    for m in np.flatnonzero(sel == ESCAPE).tolist():  # an escaped value may look like an escape itself
        if not raw[m]:
            raw[m + 1] = True
    n_words, n_values = np.asarray(n_words, np.int64), np.asarray(n_values, np.int64)
    block = np.repeat(np.arange(len(n_words)), n_words)[~raw]
    sel, body, extra = sel[~raw], words[~raw], words[raw]
    cnt = np.where(sel == ESCAPE, 1, COUNTS[sel])
    start = np.cumsum(cnt) - cnt
    out = np.zeros(int(cnt.sum()), np.uint64)
    for s in np.unique(sel):
        mine = np.flatnonzero(sel == s)
        width = int(WIDTHS[s])
        if s == ESCAPE:
            out[start[mine]] = extra
        elif width:
            mask, at, rest = np.uint64((1 << width) - 1), start[mine], body[mine]
            for k in range(int(COUNTS[s])):
                out[at + k] = (rest >> np.uint64(k * width)) & mask
    # the last word of a block may hold more than the block
    full = np.bincount(block, weights=cnt, minlength=len(n_words)).astype(np.int64)
    skip = np.repeat(np.cumsum(full) - full - (np.cumsum(n_values) - n_values), n_values)
    return out[np.arange(len(skip)) + skip]
