"""Elias-Fano coding of a non-decreasing sequence, with select.

``n`` values below a bound ``u`` take ``n * (2 + ceil(log2(u / n)))`` bits and
a sample for every ``SAMPLE`` values: the low bits are packed as they are, the high
parts as a unary bit vector, whose i-th set bit gives the i-th value.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QQBxxxI")           # values, first value, low bits, bytes of the bit vector
_U = np.uint64


class EliasFano:
    def __init__(self, n: int, first: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.first, self.width = n, first, width
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        """Of non-decreasing 64-bit values (signed ones too: steps count from the first)."""
        first = int(values[0]) if len(values) else 0
        v = values.astype(np.int64).view(_U) - _U(first % 2**64)
        n = len(v)
        width = max(0, (int(v[-1]) // n).bit_length() - 1) if n else 0
        places = (v >> _U(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        high[places] = 1
        bits = ((v[:, None] >> np.arange(width, dtype=_U)) & _U(1)).astype(np.uint8)
        return cls(n, first % 2**64, width, np.packbits(bits.ravel(), bitorder="little"), np.packbits(high, bitorder="little"),
                   places[::SAMPLE].astype("<u8"))

    def to_bytes(self) -> bytes:
        return (_HEAD.pack(self.n, self.first, self.width, len(self.high)) + self.low.tobytes() + self.high.tobytes()
                + self.samples.tobytes())

    @classmethod
    def from_bytes(cls, data: memoryview | bytes, at: int = 0) -> tuple["EliasFano", int]:
        """The sequence that stands at ``at``, and where it ends."""
        n, first, width, n_high = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        n_low, n_samples = (n * width + 7) // 8, -(-n // SAMPLE)
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        at += n_low + n_high
        samples = np.frombuffer(bytes(data[at:at + 8 * n_samples]), "<u8")
        return cls(n, first, width, low, high, samples), at + 8 * n_samples

    def __len__(self) -> int:
        return self.n

    def _low(self, i: np.ndarray) -> np.ndarray:
        out = np.zeros(len(i), _U)
        at = i.astype(np.int64) * self.width
        for b in range(self.width):
            bit = (self.low[(at + b) >> 3] >> ((at + b) & 7).astype(np.uint8)) & np.uint8(1)
            out |= bit.astype(_U) << _U(b)
        return out

    def _value(self, places: np.ndarray, i: np.ndarray) -> np.ndarray:
        steps = ((places - i).astype(_U) << _U(self.width)) | self._low(i)
        return (steps + _U(self.first)).view(np.int64)

    def __getitem__(self, i: int) -> int:
        """The i-th value: from the sample before it, only the bits up to it are read."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        block = i // SAMPLE
        start = int(self.samples[block])
        end = int(self.samples[block + 1]) if block + 1 < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(self.high[start >> 3:(end + 8) >> 3], bitorder="little")
        ones = np.flatnonzero(bits[start & 7:])
        place = start + int(ones[i % SAMPLE])
        return int(self._value(np.array([place]), np.array([i]))[0])

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        return self._value(places[:self.n], np.arange(self.n))

    def first_at_least(self, value: int) -> int:
        """The place of the first value that is not below ``value``."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (mid + 1, hi) if self[mid] < value else (lo, mid)
        return lo
