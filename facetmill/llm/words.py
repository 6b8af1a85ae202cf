"""Words and word windows of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow batch.

A word is a maximal run of bytes outside space and 0x09-0x0D. No Python loop runs per word: one pass of
prefix sums over the bytes gives a 64-bit hash of every word, a second one over the words gives the hash
of every window of k words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes handled at once. A single longer text is handled alone, whole.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xD6E8FEB86659FD93}
_powers: dict[tuple[str, bool], np.ndarray] = {}


def _power(kind: str, inverse: bool, n: int) -> np.ndarray:
    """base ** i (or its inverse) modulo 2 ** 64 for i < n; kept for the usual slice size only."""
    have = _powers.get((kind, inverse))
    if have is not None and len(have) >= n:
        return have[:n]
    base = _BASES[kind]
    base = pow(base, -1, 2**64) if inverse else base
    out = np.full(max(n, SLICE_BYTES), base, np.uint64)
    out[:1] = 1
    np.cumprod(out, out=out)
    if n <= SLICE_BYTES:
        _powers[kind, inverse] = out
    return out[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of consecutive texts. ``first[r]:first[r + 1]`` are the words of text r."""

    data: np.ndarray  # bytes of all texts
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        terms = _BYTE[self.data] * _power("byte", False, len(self.data))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        out = (sums[self.ends] - sums[self.starts]) * _power("byte", True, len(self.data))[self.starts]
        return mix(out + (self.ends - self.starts).astype(np.uint64))

    def spans(self, word_hashes: np.ndarray, start: np.ndarray, length) -> np.ndarray:
        """Hash of the ``length`` words from each of the words ``start`` on."""
        n = len(word_hashes)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(word_hashes * _power("word", False, n), out=sums[1:])
        length = np.broadcast_to(length, start.shape)
        return mix((sums[start + length] - sums[start]) * _power("word", True, n + 1)[start] + length.astype(np.uint64))

    def windows(self, word_hashes: np.ndarray, k: int) -> np.ndarray:
        """Hash of the k words from each word on. Windows that leave their text hold no meaning: see ``whole``."""
        return self.spans(word_hashes, np.arange(max(0, len(word_hashes) - k + 1)), k)

    def whole(self, k: int) -> np.ndarray:
        """Whether the window of k words from each word on lies in one text."""
        return self.row[: max(0, len(self.row) - k + 1)] == self.row[k - 1:]


def split(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    if lower:
        data = _LOWER[data]
    space = _SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(~space & (np.concatenate(([True], space[:-1])) | cut[:-1])) if len(data) else np.zeros(0, np.int64)
    ends = np.flatnonzero(~space & (np.concatenate((space[1:], [True])) | cut[1:])) + 1 if len(data) else starts
    row = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(row, np.arange(len(offsets)), "left")
    return Words(data, starts, ends, row, first)


def text_slices(texts: pa.Array, lower: bool = False, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(from row, to row, words) over a string column, a bounded number of bytes at a time. A null has no words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None and data_buffer.size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        high = min(high, n)
        yield low, high, split(data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low], lower)
        low = high
