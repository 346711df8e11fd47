"""Elias-Fano sequences in memory-mapped files, searched many queries at a time with numpy."""

from __future__ import annotations

import json
import os
import uuid

import numpy as np

_HEAD = 4096
_U = np.uint64
_BLOCK = 1 << 15  # queries searched at once, so that what is computed for them stays in the processor's cache
_ONES, _TOPS, _FULL = _U(0x0101010101010101), _U(0x8080808080808080), _U(0xFFFFFFFFFFFFFFFF)
#: Place of the k-th set bit of a byte, at k * 256 + byte.
_PLACES = np.array([([i for i in range(8) if b >> i & 1] + [8] * 8)[k] for k in range(8) for b in range(256)], np.uint8)


def save(path: str, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays into one file; a repeated attempt replaces it whole."""
    table, at = {}, _HEAD
    for name, x in arrays.items():
        table[name] = (x.dtype.str, at, len(x))
        at += -(-x.nbytes // 8) * 8
    head = json.dumps(table).encode()
    if len(head) > _HEAD:
        raise ValueError("too many arrays")
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        f.write(head.ljust(_HEAD))
        for x in arrays.values():
            f.write(x.tobytes())
            f.write(bytes(-x.nbytes % 8))
    os.replace(part, path)


def load(path: str) -> dict[str, np.ndarray]:
    """Views of the arrays in a file, read as they are used."""
    whole = np.asarray(np.memmap(path, np.uint8, "r"))
    table = json.loads(whole[:_HEAD].tobytes())
    return {name: whole[at : at + n * np.dtype(kind).itemsize].view(kind) for name, (kind, at, n) in table.items()}


def encode(name: str, values: np.ndarray, universe: int) -> dict[str, np.ndarray]:
    """Arrays of a non-decreasing sequence of values under universe: packed low bits, unary upper bits, and for each word
    of these the number of zeros before it."""
    x = values.astype(_U)
    n = len(x)
    bits = max(0, (int(universe) // max(1, n)).bit_length() - 1)
    place = np.arange(n, dtype=_U) * _U(bits)
    low = np.zeros((n * bits >> 6) + 2, _U)
    if bits:
        part = x & _U((1 << bits) - 1)
        word, shift = (place >> _U(6)).astype(np.int64), place & _U(63)
        np.bitwise_or.at(low, word, part << shift)
        over = shift + _U(bits) > _U(64)
        np.bitwise_or.at(low, word[over] + 1, part[over] >> (_U(64) - shift[over]))
    upper = (x >> _U(bits)).astype(np.int64)
    flags = np.zeros(-(-(n + (int(universe) >> bits) + 2) // 64) * 64, np.uint8)
    flags[upper + np.arange(n)] = 1
    high = np.packbits(flags, bitorder="little").view(_U)
    zeros = np.cumsum(64 - np.bitwise_count(high).astype(np.int64))
    kind = np.uint32 if len(flags) < 1 << 32 else np.int64
    return {f"{name}.low": low, f"{name}.high": high, f"{name}.zeros": np.concatenate([[0], zeros[:-1]]).astype(kind), f"{name}.shape": np.array([n, bits], np.int64)}


def _select(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th set bit (k from 0) of each word: bytes are counted side by side, then one is looked up."""
    s = words - ((words >> _U(1)) & _U(0x5555555555555555))
    s = (s & _U(0x3333333333333333)) + ((s >> _U(2)) & _U(0x3333333333333333))
    s = ((s + (s >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _ONES  # in each byte the ones up to and with it
    past = (((k * _ONES) | _TOPS) - s) & _TOPS  # bytes whose ones do not reach beyond k
    place = np.bitwise_count(past).astype(_U) << _U(3)
    left = k - (((s << _U(8)) >> place) & _U(255))
    return place + _PLACES[((left << _U(8)) | ((words >> place) & _U(255))).astype(np.int64)]


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray], name: str):
        self.low, self.high, self.zeros = (arrays[f"{name}.{x}"] for x in ("low", "high", "zeros"))
        self.n, self.bits = (int(v) for v in arrays[f"{name}.shape"])

    def _low(self, index: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(index), _U)
        place = index.astype(_U) * _U(self.bits)
        word, shift = (place >> _U(6)).astype(np.int64), place & _U(63)
        out = self.low[word] >> shift
        over = np.flatnonzero(shift + _U(self.bits) > _U(64))
        out[over] |= self.low[word[over] + 1] << (_U(64) - shift[over])
        return out & _U((1 << self.bits) - 1)

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero among the upper bits."""
        word = np.searchsorted(self.zeros, k.astype(self.zeros.dtype), "right") - 1
        return 64 * word + _select(~self.high[word], (k - self.zeros[word]).astype(_U)).astype(np.int64)

    def _next_zero(self, at: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero, the first one from place `at` on: mostly in the same word."""
        word, shift = at >> 6, (at & 63).astype(_U)
        rest = ~self.high[word] >> shift
        out = at + np.bitwise_count((rest & (~rest + _U(1))) - _U(1)).astype(np.int64)
        far = np.flatnonzero(rest == 0)
        if len(far):
            out[far] = self._zero(k[far])
        return out

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, or -1.

        The upper bits give the range of places that share them; in it the low bits are searched by interpolation,
        every other step by halving, so that a frequent context with many successors in one range stays cheap.
        """
        if not self.n or not len(values):
            return np.full(len(values), -1, np.int64)
        return np.concatenate([self._find(values[k : k + _BLOCK]) for k in range(0, len(values), _BLOCK)])

    def _find(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), -1, np.int64)
        upper = (values.astype(_U) >> _U(self.bits)).astype(np.int64)
        exact = values.astype(_U) & _U((1 << self.bits) - 1)
        wanted = exact.astype(np.float64)  # for guesses only
        start = np.where(upper > 0, self._zero(np.maximum(upper - 1, 0)) + 1, 0)
        lo, hi = start - upper, self._next_zero(start, upper) - upper
        least, most = np.zeros(len(values)), np.full(len(values), float(1 << self.bits))
        open_, step = np.flatnonzero(lo < hi), 0
        while len(open_):
            a, z, w = lo[open_], hi[open_], wanted[open_]
            if step & 1:
                guess = (a + z) >> 1
            else:
                share = (w - least[open_]) / np.maximum(most[open_] - least[open_], 1)
                guess = np.clip(a + (share * (z - a)).astype(np.int64), a, z - 1)
            here = self._low(guess)
            hit = here == exact[open_]
            out[open_[hit]] = guess[hit]
            under = here < exact[open_]
            lo[open_] = np.where(under, guess + 1, a)
            hi[open_] = np.where(under, z, guess)
            least[open_] = np.where(under, here.astype(np.float64) + 1, least[open_])
            most[open_] = np.where(under, most[open_], here.astype(np.float64))
            open_ = open_[~hit & (lo[open_] < hi[open_])]
            step += 1
        return out

    def at(self, index: np.ndarray) -> np.ndarray:
        """Values at the given places."""
        return self.ranges(index, False)[0]

    def ranges(self, index: np.ndarray, both: bool = True) -> tuple[np.ndarray, ...]:
        """Values at the given places and, with both, at the places after them."""
        parts = [self._at(index[k : k + _BLOCK], both) for k in range(0, len(index), _BLOCK)]
        return tuple(np.concatenate([np.empty(0, _U), *p]) for p in zip(*parts)) if parts else (np.empty(0, _U),) * (1 + both)

    def _at(self, index: np.ndarray, both: bool) -> list[np.ndarray]:
        # The word that holds the k-th one: ones before a word are what its zeros leave, found by halving.
        ones = lambda word: 64 * word - self.zeros[word].astype(np.int64)
        lo, hi = np.zeros(len(index), np.int64), np.full(len(index), len(self.zeros), np.int64)
        for _ in range(int(len(self.zeros)).bit_length()):
            middle = np.maximum((lo + hi) >> 1, lo)
            reached = ones(np.minimum(middle, len(self.zeros) - 1)) <= index
            lo, hi = np.where(reached, middle, lo), np.where(reached, hi, middle)
            hi = np.maximum(hi, lo + 1)
        place = 64 * lo + _select(self.high[lo], (index - ones(lo)).astype(_U)).astype(np.int64)
        value = lambda place, index: ((place - index).astype(_U) << _U(self.bits)) | self._low(index)
        out = [value(place, index)]
        if both:
            word, shift = (place + 1) >> 6, ((place + 1) & 63).astype(_U)
            rest = self.high[np.minimum(word, len(self.high) - 1)] >> shift
            after = place + 1 + np.bitwise_count((rest & (~rest + _U(1))) - _U(1)).astype(np.int64)
            far = np.flatnonzero((rest == 0) | (word >= len(self.high)))
            out.append(value(after, index + 1))
            if len(far):
                out[1][far] = self._at(index[far] + 1, False)[0]
        return out
