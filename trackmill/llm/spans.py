"""Words of many texts at once: byte positions and 64-bit hashes as numpy arrays.

Texts go in as UTF-8 bytes. All separators of the word rules used here are ASCII,
and no byte of a longer character is below 0x80, so words can be cut bytewise.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Odd, so that it has an inverse modulo 2**64 and powers never vanish.
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
MIX_1, MIX_2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)

_codes = np.arange(256)
#: Bytes of words `[^\x20\x09-\x0D]+`.
SPACED = ~((_codes == 0x20) | ((_codes >= 0x09) & (_codes <= 0x0D)))
#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after lower-casing A-Z).
LETTERS = (_codes >= 0x80) | ((_codes >= 0x30) & (_codes <= 0x39)) | ((_codes >= 0x61) & (_codes <= 0x7A))
#: A-Z to a-z, all else unchanged.
LOWER = np.where((_codes >= 0x41) & (_codes <= 0x5A), _codes + 32, _codes).astype(np.uint8)

#: Bytes whose sums and powers are held at a time.
PIECE = 1 << 18


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    grown = np.full(n, factor, np.uint64)
    grown[0] = 1
    return np.multiply.accumulate(grown)


POWERS, INVERSE_POWERS = _powers(BASE, PIECE), _powers(INVERSE, PIECE)


def span_hashes(joined: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, of ascending spans that don't overlap; none is empty.

    The sum of byte + 1 times a power of BASE that counts from the span's start. Sums are taken
    in pieces of PIECE bytes; a span over several pieces is the sum of its parts, each
    times the power for its distance from the start. So memory beyond the spans is fixed.
    """
    out = np.zeros(len(first), np.uint64)
    sums = np.zeros(PIECE + 1, np.uint64)
    for lo in range(0, len(joined), PIECE):
        piece = joined[lo : lo + PIECE].astype(np.uint64)
        piece += np.uint64(1)
        piece *= POWERS[: len(piece)]
        np.cumsum(piece, out=sums[1 : len(piece) + 1])
        own = slice(np.searchsorted(last, lo, "right"), np.searchsorted(first, lo + len(piece), "left"))
        start = np.maximum(first[own] - lo, 0)
        part = (sums[np.minimum(last[own] - lo, len(piece))] - sums[start]) * INVERSE_POWERS[start]
        if len(part) and first[own.start] < lo:
            part[:1] *= np.uint64(pow(int(BASE), int(lo - first[own.start]), 2**64))
        out[own] += part
    return mix(out)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole word."""
    x = x ^ (x >> np.uint64(33))
    x *= MIX_1
    x ^= x >> np.uint64(33)
    x *= MIX_2
    x ^= x >> np.uint64(33)
    return x


def chunks(texts: Iterable[bytes], size: int = 1 << 21) -> Iterator[list[bytes]]:
    """Lists of whole texts of about so many bytes, so that the arrays of a list stay small."""
    kept, n = [], 0
    for text in texts:
        kept.append(text)
        n += len(text) + 1
        if n >= size:
            yield kept
            kept, n = [], 0
    if kept:
        yield kept


class Words:
    """The words of some texts: `first` and `last` byte (exclusive), `hash`, and `bounds`,
    where text i has the words from bounds[i] to bounds[i + 1]. `offsets` are the texts' first bytes."""

    def __init__(self, texts: list[bytes], table: np.ndarray, lower: bool = True):
        joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            joined = LOWER[joined]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))
        # A separator stands behind every text, so each word ends before the bytes do.
        inside = np.zeros(len(joined) + 1, bool)
        inside[1:] = table[joined]
        self.first = np.flatnonzero(inside[1:] & ~inside[:-1])
        self.last = np.flatnonzero(inside[:-1] & ~inside[1:])
        del inside
        self.bounds = np.searchsorted(self.first, self.offsets)
        self.hash = span_hashes(joined, self.first, self.last)

    def __len__(self) -> int:
        return len(self.first)

    def runs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """A hash for every k consecutive words of a text, and the bounds of each text's hashes.

        A text with fewer words, but not none, has one hash, of all its words. Hash j of a
        text starts at its word j.
        """
        counts = np.diff(self.bounds)
        made = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
        bounds = np.concatenate(([0], np.cumsum(made)))
        start = np.repeat(self.bounds[:-1] - bounds[:-1], made) + np.arange(bounds[-1])
        padded = np.concatenate((self.hash, np.zeros(k, np.uint64)))
        out = np.zeros(len(start), np.uint64)
        for j in range(k):
            out = out * BASE + padded[start + j]
        short = np.flatnonzero((counts > 0) & (counts < k))
        for i in short.tolist():
            value = np.uint64(len(self.hash[self.bounds[i] : self.bounds[i + 1]]))
            with np.errstate(over="ignore"):
                for word in self.hash[self.bounds[i] : self.bounds[i + 1]]:
                    value = value * BASE + word
            out[bounds[i]] = value
        return mix(out), bounds


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text, ascending, and their bounds."""
    values, edges = values.copy(), bounds.tolist()
    for lo, hi in zip(edges, edges[1:], strict=False):
        values[lo:hi].sort()
    keep = np.ones(len(values) + 1, bool)
    keep[1:-1] = values[1:] != values[:-1]
    keep[bounds] = True
    keep = keep[:-1]
    return values[keep], np.concatenate(([0], np.cumsum(keep)))[bounds]
