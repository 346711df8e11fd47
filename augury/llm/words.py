"""Words of texts as 64-bit hashes, in numpy: no Python object for any word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], _U)
_END = _U(0x5851F42D4C957F2D)
#: Bytes whose words are hashed together, and the bytes that part words.
_GROUP, _SPACES = 1 << 18, b" \t\n\v\f\r"


def mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(_U) * _M[0]
    x ^= x >> _U(32)
    x *= _M[1]
    return x ^ (x >> _U(29))


def _byte_values() -> np.ndarray:
    """A number for each byte, the same for a capital and its small letter."""
    out = mixed(np.arange(1, 257))
    out[65:91] = out[97:123]
    return out


_VALUES = _byte_values()
_SPACE = np.isin(np.arange(256), np.frombuffer(_SPACES, np.uint8))
_POWERS = np.cumprod(np.full(1 << 16, _M[0], _U))


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, data[start:end]."""
    out = np.empty(len(starts), _U)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + _GROUP, "right")))
        a, n = starts[at:to], ends[at:to] - starts[at:to]
        first = np.cumsum(n) - n
        inside = np.arange(int(n.sum())) - np.repeat(first, n)
        values = _VALUES[data[np.repeat(a, n) + inside]] * _POWERS[inside & 0xFFFF]
        if n.max() > 1 << 16:  # the powers go on
            further = np.full(int(n.max() >> 16) + 1, _POWERS[-1], _U)
            further[0] = 1
            values *= np.cumprod(further)[inside >> 16]
        out[at:to] = np.add.reduceat(values, first)
        at = to
    return mixed(out)


class Tokens:
    """Tokens of some texts: the hash of each occurrence, text after text, and where the texts start."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        buffer = texts.buffers()[2] if len(texts) else None
        data = np.frombuffer(buffer, np.uint8)[edges[0] : edges[-1]] if buffer is not None and edges[-1] > edges[0] else np.empty(0, np.uint8)
        edges = edges - edges[0]
        full = np.concatenate([[False], ~_SPACE[data], [False]])
        begins, stops = full[1:-1] & ~full[:-2], full[1:-1] & ~full[2:]
        inner = edges[(edges > 0) & (edges < len(data))]  # a word ends where its text does
        begins[inner] = full[1:-1][inner]
        stops[inner - 1] = full[1:-1][inner - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        words = np.diff(np.searchsorted(starts, edges, "left"))
        self.lengths = words + 1
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.full(len(starts) + len(words), _END, _U)
        last = np.zeros(len(self.flat), bool)
        last[self.starts + words] = True
        self.flat[~last] = _hashes(data, starts, ends)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes in order, and the place of each occurrence among them."""
        order = np.argsort(self.flat)
        new = changes(self.flat[order])
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(new) - 1
        return self.flat[order][new], back


def changes(x: np.ndarray) -> np.ndarray:
    """Where a sorted array has a new value."""
    return np.concatenate([[True], x[1:] != x[:-1]])[: len(x)]
