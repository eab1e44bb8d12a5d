"""Elias-Fano sequences over flat arrays of 64-bit words, so that they can be memory-mapped, with queries on whole numpy arrays."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_EACH, _TOPS = U64(0x0101010101010101), U64(0x8080808080808080)
_PAIRS, _FOURS, _EIGHTS = U64(0x5555555555555555), U64(0x3333333333333333), U64(0x0F0F0F0F0F0F0F0F)
#: Place of the k-th one in a byte, at 8 * byte + k.
_SELECT = np.array([([j for j in range(8) if b >> j & 1] + [0] * 8)[:8] for b in range(256)], np.int64).ravel()


def pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Values of so many bits, one after the other, in 64-bit words (and one word of padding)."""
    out = np.zeros(len(values) * bits // 64 + 2, U64)
    if bits and len(values):
        at = np.arange(len(values), dtype=U64) * U64(bits)
        word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
        np.bitwise_or.at(out, word, values << shift)
        over = shift + U64(bits) > U64(64)
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (U64(64) - shift[over]))
    return out


def unpack(words: np.ndarray, bits: int, at: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(at), U64)
    pos = at.astype(U64) * U64(bits)
    word, shift = (pos >> U64(6)).astype(np.int64), pos & U64(63)
    out = words[word] >> shift
    over = np.flatnonzero(shift > U64(64 - bits))  # the rest lies in the next word
    out[over] |= words[word[over] + 1] << (U64(64) - shift[over])
    return out & U64((1 << bits) - 1)


def encode(values: np.ndarray) -> np.ndarray:
    """Non-decreasing values below 2**63 as one array of words: a head of four, low bits, high bits, and the ones before each word of these."""
    n = len(values)
    values = values.astype(U64)
    top = int(values[-1]) if n else 0
    bits = max(0, (top // max(n, 1)).bit_length() - 1) if n else 0
    low = pack(values & U64((1 << bits) - 1), bits)
    ones = (values >> U64(bits)).astype(np.int64) + np.arange(n)
    high = np.zeros(((top >> bits) + n) // 64 + 2, U64)
    np.bitwise_or.at(high, ones >> 6, U64(1) << (ones & 63).astype(U64))
    before = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))]).astype(U64)
    return np.concatenate([np.array([n, bits, len(low), len(high)], U64), low, high, before])


class Sequence:
    """Queries on an encoded array."""

    def __init__(self, words: np.ndarray) -> None:
        self.n, self.bits, n_low, n_high = (int(x) for x in words[:4])
        self.low, self.high, self.before = words[4 : 4 + n_low], words[4 + n_low : 4 + n_low + n_high], words[4 + n_low + n_high : 5 + n_low + 2 * n_high]
        self.zeros = None

    def _place(self, word: np.ndarray, bits: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Place of the k-th (from 0) one of bits, which are a word of the high bits; any place where there are fewer."""
        k = k.astype(U64) & U64(63)
        ones = bits - ((bits >> U64(1)) & _PAIRS)
        ones = (ones & _FOURS) + ((ones >> U64(2)) & _FOURS)
        ones = ((ones + (ones >> U64(4))) & _EIGHTS) * _EACH  # in each byte: ones of it and of the bytes below
        byte = np.minimum(np.bitwise_count(((k * _EACH) | _TOPS) - ones & _TOPS), 7).astype(U64)
        shift = byte << U64(3)
        left = (k - (((ones << U64(8)) >> shift) & U64(255))) & U64(7)
        inside = _SELECT[((((bits >> shift) & U64(255)) << U64(3)) | left).astype(np.int64)]
        return word * 64 + shift.astype(np.int64) + inside

    def select(self, i: np.ndarray) -> np.ndarray:
        """Place of the i-th one among the high bits."""
        word = np.searchsorted(self.before, i.astype(U64), side="right") - 1
        return self._place(word, self.high[word], i - self.before[word].astype(np.int64))

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        return ((self.select(i) - i).astype(U64) << U64(self.bits)) | unpack(self.low, self.bits, i)

    def bucket(self, h: np.ndarray) -> np.ndarray:
        """How many values have high bits below h."""
        if self.zeros is None:
            self.zeros = np.arange(len(self.before), dtype=np.int64) * 64 - self.before.astype(np.int64)
        out = np.zeros(len(h), np.int64)
        some = np.flatnonzero(h > 0)
        if len(some):
            k = h[some] - 1
            word = np.minimum(np.searchsorted(self.zeros, k, side="right") - 1, len(self.high) - 1)
            beyond = k >= self.zeros[-1]
            place = self._place(word, ~self.high[word], k - self.zeros[word])
            out[some] = np.where(beyond, self.n, place - k)
        return out

    def find(self, target: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Index in [lo, hi) of each target among increasing values, by its successor there; -1 where it is another value or none."""
        h = (target >> U64(self.bits)).astype(np.int64)
        lo, hi = np.maximum(lo, self.bucket(h)), np.minimum(hi, self.bucket(h + 1))
        want = target & U64((1 << self.bits) - 1)
        out = np.full(len(target), -1)
        a = lo.copy()
        live = np.flatnonzero(a < hi)
        for _ in range(2):  # most have few values with their high bits
            low = unpack(self.low, self.bits, a[live])
            same = live[low == want[live]]
            out[same] = a[same]
            live = live[low < want[live]]
            a[live] += 1
            live = live[a[live] < hi[live]]
        left, b = live, hi.copy()
        while len(live):
            mid = (a[live] + b[live]) >> 1
            up = unpack(self.low, self.bits, mid) < want[live]
            a[live[up]], b[live[~up]] = mid[up] + 1, mid[~up]
            live = live[a[live] < b[live]]
        left = left[a[left] < hi[left]]
        same = left[unpack(self.low, self.bits, a[left]) == want[left]]
        out[same] = a[same]
        return out
