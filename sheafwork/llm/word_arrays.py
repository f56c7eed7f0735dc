"""Words of many texts as numpy arrays of byte positions, with hashed n-gram, affix and whole-word features.

Texts are lower-cased and joined; words are what white space separates.  Everything is computed over whole byte arrays, so
a word costs some tens of nanoseconds a byte and no Python call."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from sheafwork.llm.shared import SPACES

TRIGRAM_BITS, AFFIX_BITS, WORD_BITS = 16, 14, 18
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_POWERS = np.cumprod(np.full(64, 0x9E3779B1, np.uint64), dtype=np.uint64)


def hashed(x: np.ndarray, bits: int) -> np.ndarray:
    """Buckets 1 .. 2**bits - 1; bucket 0 is left for 'no feature'."""
    with np.errstate(over="ignore"):
        y = (x.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(32 - bits)
    return np.maximum(y, 1).astype(np.int32)


@dataclass
class Words:
    doc: np.ndarray  # of each word: the text it is in
    start: np.ndarray  # of each word: its first byte
    trigram: np.ndarray  # of each byte: bucket of it and its neighbours, 0 for white space
    prefix: np.ndarray
    suffix: np.ndarray
    whole: np.ndarray
    letters: np.ndarray  # of each word: whether it has a letter (or a byte beyond ASCII)

    def __len__(self) -> int:
        return len(self.start)


def words_of(texts: list[str]) -> Words:
    parts = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    b = np.frombuffer(b"    " + b" ".join(parts) + b"    ", np.uint8)
    begin = 4 + np.cumsum([0, *[len(p) + 1 for p in parts[:-1]]]) if parts else np.zeros(0, np.int64)
    ink = ~_SPACE[b]
    first = np.flatnonzero(ink[1:] & ~ink[:-1]) + 1
    last = np.flatnonzero(ink[:-1] & ~ink[1:])
    wide = b.astype(np.uint32)
    tri = np.zeros(len(b), np.int32)
    tri[1:-1] = hashed((wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:], TRIGRAM_BITS)
    tri[~ink] = 0
    size = last - first + 1
    pre, suf = np.zeros(len(first), np.uint32), np.zeros(len(first), np.uint32)
    for k in range(4):
        has = size > k
        pre |= np.where(has, wide[first + np.minimum(k, size - 1)], 0).astype(np.uint32) << np.uint32(8 * k)
        suf |= np.where(has, wide[last - np.minimum(k, size - 1)], 0).astype(np.uint32) << np.uint32(8 * k)
    if len(first):
        reach = np.diff(np.append(first, len(b)))
        place = (np.arange(first[0], len(b)) - np.repeat(first, reach)) & 63
        with np.errstate(over="ignore"):
            whole = np.add.reduceat(np.where(ink[first[0] :], b[first[0] :], 0).astype(np.uint64) * _POWERS[place], first - first[0])
        lettered = np.logical_or.reduceat(_LETTER[b], first)
    else:
        whole, lettered = np.zeros(0, np.uint64), np.zeros(0, bool)
    return Words(
        doc=np.searchsorted(begin, first, side="right") - 1, start=first, trigram=tri, prefix=hashed(pre, AFFIX_BITS),
        suffix=hashed(suf, AFFIX_BITS), whole=hashed((whole >> np.uint64(20)) ^ whole, WORD_BITS), letters=lettered,
    )


def chunks(texts: list[str], most: int = 1 << 21) -> Iterator[tuple[int, list[str]]]:
    """(position of the first, texts) in runs of about ``most`` characters; a longer text is a run of its own."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, texts[begin:]
