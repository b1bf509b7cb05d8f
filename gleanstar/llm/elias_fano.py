"""Elias-Fano coding of monotone sequences, searched without decoding them.

A value's low bits stand in a packed array; the high parts stand in a bit vector in unary:
each value is a one, each step of the high part a zero. The zeros (ones) before every 64-bit
word are counted, which finds the place of the k-th zero (one) by binary search and a
look into one word. All operations work on arrays of queries.
"""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)
_POPULATION = np.array([bin(i).count("1") for i in range(256)], np.uint8)
# position of the r-th one of a byte
_PLACE = np.zeros((256, 8), np.uint8)
for _byte in range(256):
    for _r, _bit in enumerate(b for b in range(8) if _byte >> b & 1):
        _PLACE[_byte, _r] = _bit


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """The low `width` bits of each value, one after another, in 64-bit words (and one spare)."""
    n = len(values)
    out = np.zeros((n * width + 63) // 64 + 1, np.uint64)
    if width and n:
        at = np.arange(n, dtype=np.uint64) * np.uint64(width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        low = values & np.uint64(2**width - 1)
        # values begin in the order of their words, so each word is one run
        edges = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[edges]] |= np.bitwise_or.reduceat(low << shift, edges)
        over = np.flatnonzero(shift + np.uint64(width) > 64)
        out[word[over] + 1] |= low[over] >> (np.uint64(64) - shift[over])
    return out


def unpack_bits(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Values of pack_bits at the places given."""
    if not width:
        return np.zeros(len(at), np.uint64)
    bit = at.astype(np.uint64) * np.uint64(width)
    word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
    # a shift by 64 is none in numpy's view, so it is made in two steps
    above = (words[word + 1] << (np.uint64(63) - shift)) << _ONE
    return ((words[word] >> shift) | above) & np.uint64(2**width - 1)


def encode(values: np.ndarray, prefix: str = "") -> dict[str, np.ndarray]:
    """Arrays of a sorted sequence of unsigned 64-bit values."""
    n = len(values)
    top = int(values[-1]) + 1 if n else 1
    width = max(0, (top // max(n, 1)).bit_length() - 1)
    high = (values >> np.uint64(width)).astype(np.int64)
    size = n + (int(high[-1]) if n else 0) + 2
    bits = np.zeros(-(-size // 64) * 64, np.uint8)
    bits[high + np.arange(n)] = 1
    words = np.packbits(bits, bitorder="little").view("<u8")
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
    return {
        f"{prefix}head": np.array([n, width], np.int64),
        f"{prefix}low": pack_bits(values, width),
        f"{prefix}high": np.append(words, np.uint64(0)),
        f"{prefix}ones": ones,
    }


class EliasFano:
    def __init__(self, arrays: dict[str, np.ndarray], prefix: str = ""):
        self.n, self.width = (int(x) for x in arrays[f"{prefix}head"])
        self.low, self.high, self.ones = (arrays[f"{prefix}{k}"] for k in ("low", "high", "ones"))
        self._words = len(self.ones) - 1
        self._zeros = None

    def _select(self, counts: np.ndarray, k: np.ndarray, zeros: bool = False) -> np.ndarray:
        """Place of the k-th one (or zero); counts: ones (or zeros) before each word."""
        word = np.searchsorted(counts, k, "right") - 1
        rest = (k - counts[word]).astype(np.int64)
        bits = ~self.high[word] if zeros else self.high[word]
        place = word * 64
        # halve the word: skip its lower half if the bit is not there
        for half in (32, 16, 8):
            lower = np.bitwise_count(bits & np.uint64(2**half - 1)).astype(np.int64)
            skip = rest >= lower
            rest -= np.where(skip, lower, 0)
            bits = np.where(skip, bits >> np.uint64(half), bits)
            place += np.where(skip, half, 0)
        return place + _PLACE[(bits & np.uint64(255)).astype(np.int64), rest]

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values by position."""
        at = self._select(self.ones, i)
        return ((at - i).astype(np.uint64) << np.uint64(self.width)) | unpack_bits(self.low, i, self.width)

    def _bucket(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first position, number) of the values with each high part."""
        if self._zeros is None:
            # counted from the ones on first use: one number per 64 bits
            self._zeros = np.arange(self._words + 1) * 64 - self.ones
        place = np.zeros(len(high), np.int64)
        later = np.flatnonzero(high > 0)
        place[later] = self._select(self._zeros, high[later] - 1, zeros=True) + 1
        first = place - high
        # ones that follow: trailing ones of the 64 bits from there
        count = np.zeros(len(high), np.int64)
        rows = np.arange(len(high))
        while len(rows):
            at = place[rows] + count[rows]
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            inside = word < self._words
            window = np.zeros(len(rows), np.uint64)
            window[inside] = self.high[word[inside]] >> shift[inside]
            run = np.bitwise_count(window & ~(window + _ONE)).astype(np.int64)
            count[rows] += run
            rows = rows[inside & (run == 64 - shift.astype(np.int64))]
        return first, count

    def find(self, values: np.ndarray) -> np.ndarray:
        """Position of each value, or -1: the successor within the bucket of its high part."""
        out = np.full(len(values), -1, np.int64)
        if not self.n:
            return out
        high = (values >> np.uint64(self.width)).astype(np.int64)
        rows = np.flatnonzero(high <= self._words * 64 - self.n - 1)
        rows = rows[high[rows] <= int(self.access(np.array([self.n - 1]))[0] >> np.uint64(self.width))]
        low, count = self._bucket(high[rows])
        end = low + count
        wanted = values[rows] & np.uint64(2**self.width - 1)
        # binary search for the successor among the low bits of the bucket
        first, last = low, end.copy()
        on = np.flatnonzero(first < last)
        while len(on):
            middle = (first[on] + last[on]) >> 1
            right = unpack_bits(self.low, middle, self.width) < wanted[on]
            first[on[right]] = middle[right] + 1
            last[on[~right]] = middle[~right]
            on = on[first[on] < last[on]]
        inside = np.flatnonzero(first < end)
        same = inside[unpack_bits(self.low, first[inside], self.width) == wanted[inside]]
        out[rows[same]] = first[same]
        return out

    def all(self) -> np.ndarray:
        """The whole sequence."""
        bits = np.unpackbits(np.ascontiguousarray(self.high[:-1]).view(np.uint8), bitorder="little")
        high = np.flatnonzero(bits)[: self.n] - np.arange(self.n)
        return (high.astype(np.uint64) << np.uint64(self.width)) | unpack_bits(self.low, np.arange(self.n), self.width)


def to_bytes(values: np.ndarray) -> bytes:
    """A sorted sequence for the wire, without what only searching needs."""
    a = encode(values)
    parts = [a["head"], np.array([len(a["low"]), len(a["high"])], np.int64), a["low"], a["high"]]
    return b"".join(p.tobytes() for p in parts)


def from_bytes(raw: bytes) -> np.ndarray:
    head = np.frombuffer(raw, np.int64, 4)
    low = np.frombuffer(raw, np.uint64, int(head[2]), 32)
    high = np.frombuffer(raw, np.uint64, int(head[3]), 32 + low.nbytes)
    return EliasFano({"head": head[:2], "low": low, "high": high, "ones": np.zeros(1, np.int64)}).all()
