"""Words of whole Arrow batches as numpy arrays: positions and 64-bit hashes.

A word is a maximal run of bytes of one class. Both word classes used here are closed under
UTF-8 (every byte of a non-ASCII character is a word byte), so runs of bytes are runs of
characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Bytes worked on at a time; documents above it form a block of their own.
BLOCK_BYTES = 1 << 20
# Words above this many bytes are hashed one by one.
LONG_WORD = 1 << 16

_BYTES = np.arange(256)
# Everything but the space and 0x09-0x0D.
SPACED = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
# Digits, a-z and all bytes of non-ASCII characters (for lower-cased text).
ALNUM = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_random = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODES = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int) -> np.ndarray:
    out = np.empty(BLOCK_BYTES + LONG_WORD + 1, dtype=np.uint64)
    out[0], out[1:] = 1, base
    return np.multiply.accumulate(out)


_POWERS, _INVERSES = _powers(_BASE), _powers(_INVERSE)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Words of consecutive documents: ``data[starts[i]:ends[i]]``; document ``d`` has the
    words ``first[d]`` up to ``first[d + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int, j: int) -> bytes:
        """Words ``i`` up to ``j`` joined by one space."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[i:j].tolist(), self.ends[i:j].tolist()))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        long = np.flatnonzero(self.ends - self.starts > LONG_WORD)
        i = 0
        for stop in [*long.tolist(), len(self.starts)]:
            while i < stop:
                j = min(stop, int(np.searchsorted(self.starts, self.starts[i] + BLOCK_BYTES)))
                base = int(self.starts[i])
                piece = _BYTE_CODES[self.data[base : self.ends[j - 1]]]
                piece *= _POWERS[: len(piece)]
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(piece)])
                s, e = self.starts[i:j] - base, self.ends[i:j] - base
                out[i:j] = mix((sums[e] - sums[s]) * _INVERSES[s] + (e - s).astype(np.uint64))
                i = j
            if stop < len(self.starts):
                out[stop] = xxhash.xxh64_intdigest(self.data[self.starts[stop] : self.ends[stop]].tobytes())
                i = stop + 1
        return out


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; entry ``i`` starts at word ``i``."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, dtype=np.uint64)
    for k in range(n):
        out *= np.uint64(_BASE)
        out += hashes[k : k + size]
    return mix(out)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a null text is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def word_blocks(column: pa.Array, word_bytes: np.ndarray, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    """Documents ``lo`` up to ``hi`` and their words, block by block."""
    if len(column) == 0:
        return
    data, offsets = utf8(column)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK_BYTES, side="right")) - 1)
        base = offsets[lo]
        piece = data[base : offsets[hi]]
        if lower:
            piece = LOWER[piece]
        bounds = offsets[lo : hi + 1] - base
        inside = word_bytes[piece]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cut = bounds[(bounds > 0) & (bounds < len(piece))]
        before[cut], after[cut - 1] = False, False
        starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        yield lo, hi, Words(piece, starts, ends, np.searchsorted(starts, bounds))
        lo = hi
