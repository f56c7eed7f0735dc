"""Counting quotient filters over 64-bit fingerprints, packed for shipping between tasks.

A fingerprint is cut into a quotient (its upper bits) and a remainder.  Remainders lie in the order of their quotients, sorted
within each run; ``occupied`` has a bit for each quotient that has a run, ``ends`` a bit for the last slot of each run, so the two
give the quotients back by rank.  ``repeated`` has a bit for each slot that counts more than one, and only those slots have a
counter.  Nothing is lost: items() gives back every fingerprint and its count, whatever the number of quotient bits, and filters
merge by merging their sorted remainders and adding up counters."""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

HEAD = struct.Struct("<BBQQ")


def packed(bits: np.ndarray) -> bytes:
    return np.packbits(bits, bitorder="little").tobytes()


def added_up(fps: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints and the sums of their counts."""
    if not len(fps):
        return fps, counts
    order = np.argsort(fps, kind="stable")
    fps, counts = fps[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], fps[1:] != fps[:-1]]))
    return fps[starts], np.add.reduceat(counts, starts)


@dataclass(frozen=True)
class QuotientFilter:
    """fps: sorted distinct unsigned fingerprints below 2**bits; counts: how often each was put in."""

    bits: int
    fps: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, fps: np.ndarray, bits: int = 64) -> QuotientFilter:
        return cls(bits, *added_up(fps.astype(np.uint64), np.ones(len(fps), np.int64)))

    @classmethod
    def merged(cls, filters: list[QuotientFilter], bits: int = 64) -> QuotientFilter:
        """One filter that holds what all of them hold."""
        none = cls(bits, np.zeros(0, np.uint64), np.zeros(0, np.int64))
        every = [none, *filters]
        return cls(bits, *added_up(np.concatenate([f.fps for f in every]), np.concatenate([f.counts for f in every])))

    def to_bytes(self) -> bytes:
        n = len(self.fps)
        q = min(self.bits, max(1, n.bit_length()))  # about one fingerprint for each quotient
        rest = self.bits - q
        width = -(-rest // 8)
        quotients = self.fps >> np.uint64(rest) if rest < 64 else np.zeros(n, np.uint64)
        remainders = self.fps & np.uint64((1 << rest) - 1)
        occupied = np.zeros(1 << q, bool)
        occupied[quotients.astype(np.int64)] = True
        ends = np.ones(n, bool)
        ends[:-1] = quotients[1:] != quotients[:-1]
        repeated = self.counts > 1
        slots = remainders.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
        return b"".join([HEAD.pack(self.bits, q, n, int(repeated.sum())), packed(occupied), packed(ends), packed(repeated), slots.tobytes(), self.counts[repeated].astype("<i8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        bits, q, n, more = HEAD.unpack_from(data)
        at = HEAD.size

        def flags(size: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(data, np.uint8, -(-size // 8), at)
            at += len(part)
            return np.unpackbits(part, count=size, bitorder="little").astype(bool)

        occupied, ends, repeated = flags(1 << q), flags(n), flags(n)
        rest = bits - q
        width = -(-rest // 8)
        slots = np.zeros((n, 8), np.uint8)
        slots[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
        counts = np.ones(n, np.int64)
        counts[repeated] = np.frombuffer(data, "<i8", more, at + n * width)
        runs = np.cumsum(ends) - ends  # the run that a slot belongs to
        quotients = np.flatnonzero(occupied).astype(np.uint64)[runs]
        return cls(bits, (quotients << np.uint64(rest)) | slots.reshape(-1).view("<u8") if rest < 64 else slots.reshape(-1).view("<u8"), counts)
