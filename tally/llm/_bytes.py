"""Vectorised text helpers over UTF-8 bytes, for use inside tasks.

A batch of texts is one byte array with offsets. Words are runs of bytes
other than ASCII white space (0x20, 0x09-0x0D). Hashes are 64 bits wide:
a polynomial over the bytes of a span, taken from prefix sums, then mixed
together with the span's length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_B = U(0x9E3779B97F4A7C15 | 1)
_B_INV = U(pow(int(_B), -1, 1 << 64))
_K = U(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def row_slices(offsets: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``max_bytes`` each; a longer row is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + max_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


class Spans:
    """Hashes of any byte spans of one buffer, in constant time each."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        power = np.empty(n + 1, dtype=U)
        power[0] = 1
        power[1:] = _B
        np.multiply.accumulate(power, out=power)
        inverse = np.empty(n + 1, dtype=U)
        inverse[0] = 1
        inverse[1:] = _B_INV
        np.multiply.accumulate(inverse, out=inverse)
        self.inverse = inverse
        self.prefix = np.zeros(n + 1, dtype=U)
        np.cumsum((buf.astype(U) + U(1)) * power[:n], out=self.prefix[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.prefix[end] - self.prefix[start]) * self.inverse[start]
        return mix(h + (end - start).astype(U) * _K)


class Words:
    """Words of a slice of texts: byte spans, hashes and each text's word range."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, spans: Spans | None = None):
        solid = ~SPACE[buf]
        before = np.empty_like(solid)
        after = np.empty_like(solid)
        if len(buf):
            before[0], after[-1] = False, False
            before[1:], after[:-1] = solid[:-1], solid[1:]
            inner = offsets[(offsets > 0) & (offsets < len(buf))]
            before[inner] = False
            after[inner - 1] = False
        self.solid = solid
        self.start = np.flatnonzero(solid & ~before)
        self.end = np.flatnonzero(solid & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)  # word index at which each text begins
        self.count = np.diff(self.first)
        self.hash = (spans or Spans(buf)).hash(self.start, self.end)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def shingles(self, k: int = 5, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, text number and first word of each k-word window.

        With ``short``, a text of 1 to k-1 words has one window of all its words.
        """
        n, h = len(self.hash), self.hash
        doc = self.doc()
        room = self.first[1:][doc] - np.arange(n)  # words from here to the text's end
        at = np.flatnonzero(room >= k)
        s = h[at].copy()
        for j in range(1, k):
            s = s * _K + h[at + j]
        out = mix(s)
        if not short:
            return out, doc[at], at
        few = np.flatnonzero((self.count > 0) & (self.count < k))
        extra = np.zeros(len(few), dtype=U)
        for j in range(k - 1):
            has = self.count[few] > j
            extra[has] = extra[has] * _K + h[self.first[few[has]] + j]
        return (
            np.concatenate([out, mix(extra + self.count[few].astype(U))]),
            np.concatenate([doc[at], few]),
            np.concatenate([at, self.first[few]]),
        )
