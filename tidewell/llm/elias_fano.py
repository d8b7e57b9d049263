"""Monotone sequences in Elias-Fano code, and a trie level made of them."""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<qqB")  # values, bits of the high part, low bits of a value
_STRETCH = 512  # bytes of the high part between counts of its ones
PIECE = 1 << 16  # values unpacked at a time


class EliasFano:
    """A non-decreasing sequence of unsigned integers below ``universe``.

    The low bits of the values are packed side by side; the high parts stand in a bitmap in
    unary, a one for each value and a zero for each step up.  All arrays are views of one
    buffer, which may be a memory map.
    """

    def __init__(self, buffer):
        n, high_bits, self.low_bits = _HEAD.unpack_from(bytes(buffer[:_HEAD.size]))
        data = np.frombuffer(buffer, np.uint8) if not isinstance(buffer, np.ndarray) else buffer
        size = (n * self.low_bits + 7) // 8
        start = _HEAD.size
        self.low, self.high = data[start:start + size], data[start + size:start + size + (high_bits + 7) // 8]
        self.bytes = start + size + (high_bits + 7) // 8
        self.n, self.before = n, None

    @staticmethod
    def encode(values: np.ndarray, universe: int) -> bytes:
        values = values.astype(np.uint64)
        n = len(values)
        low_bits = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        high = (values >> np.uint64(low_bits)).astype(np.int64)
        bitmap = np.zeros(int(high[-1]) + n + 1 if n else 1, np.uint8)
        bitmap[high + np.arange(n)] = 1
        low = b""
        if low_bits and n:
            wide = values.astype(">u8").view(np.uint8).reshape(n, 8)
            low = np.packbits(np.unpackbits(wide, axis=1)[:, 64 - low_bits:]).tobytes()
        return _HEAD.pack(n, len(bitmap), low_bits) + low + np.packbits(bitmap).tobytes()

    def _ones(self) -> np.ndarray:
        """Ones of the high part before each of its stretches of ``_STRETCH`` bytes."""
        if self.before is None:
            counts = [int(np.bitwise_count(self.high[at:at + _STRETCH]).sum(dtype=np.int64))
                      for at in range(0, len(self.high), _STRETCH)]
            self.before = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        return self.before

    def segment(self, a: int, b: int) -> np.ndarray:
        """The values from place ``a`` to before ``b``; nothing else is unpacked."""
        if a >= b:
            return np.zeros(0, np.uint64)
        before = self._ones()
        first, last = np.searchsorted(before, [a, b - 1], "right") - 1
        bits = np.unpackbits(self.high[first * _STRETCH:(last + 1) * _STRETCH])
        ones = np.flatnonzero(bits)[a - before[first]:b - before[first]] + first * _STRETCH * 8
        values = (ones - np.arange(a, b)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            start, stop = a * self.low_bits, b * self.low_bits
            bits = np.unpackbits(self.low[start // 8:(stop + 7) // 8])[start % 8:][:stop - start]
            wide = np.zeros((b - a, 64), np.uint8)
            wide[:, 64 - self.low_bits:] = bits.reshape(b - a, self.low_bits)
            values |= np.packbits(wide, axis=1).view(">u8").ravel().astype(np.uint64)
        return values

    def decode(self) -> np.ndarray:
        out = np.empty(self.n, np.uint64)
        for a in range(0, self.n, PIECE):
            out[a:a + PIECE] = self.segment(a, min(self.n, a + PIECE))
        return out

    def find(self, values: np.ndarray) -> np.ndarray:
        """A place of each value, or -1, by pieces of the sequence."""
        out, order = np.full(len(values), -1, np.int64), np.argsort(values, kind="stable")
        ordered = values[order]
        for a in range(0, self.n, PIECE):
            piece = self.segment(a, min(self.n, a + PIECE))
            low, high = np.searchsorted(ordered, piece[0]), np.searchsorted(ordered, piece[-1], "right")
            at = np.searchsorted(piece, ordered[low:high])
            hit = piece[at] == ordered[low:high]
            out[order[low:high][hit]] = a + at[hit]
        return out


# Codes of counts: 0 is "none", 1 to 32 the count itself, and above the share of the context's tokens,
# evenly spaced in the logarithm from 10^-12 to 1.
EXACT = 32
LOWEST = -12.0
_STEP = -LOWEST / (254 - EXACT)


def code_counts(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Codes of counts out of ``totals``."""
    share = np.log10(np.maximum(counts, 1) / np.maximum(totals, 1))
    level = np.clip(np.rint((share - LOWEST) / _STEP), 0, 254 - EXACT)
    return np.where(counts > EXACT, EXACT + 1 + level, counts).astype(np.uint8)


def discounted(code: np.ndarray, totals: np.ndarray, discount: float) -> np.ndarray:
    """The discounted share of the total that each code stands for."""
    share = np.where(code > EXACT, 10.0 ** (LOWEST + (code.astype(float) - EXACT - 1) * _STEP), code / totals)
    return np.maximum(share - discount / totals, 0.0)


class Trie:
    """Two levels: contexts, and under each its successors with a quantised count.

    Successors are stored relative to their context: the sequence ``context place * words
    + successor`` is monotone over the level, and pointers say where each context begins, and so how many
    successors it has.
    """

    def __init__(self, buffer: np.ndarray):
        (self.words,) = struct.unpack("<q", bytes(buffer[:8]))
        at, parts = 8, []
        for _ in range(3):
            parts.append(EliasFano(buffer[at:]))
            at += parts[-1].bytes
        self.contexts, self.pointers, self.successors = parts
        self.codes = buffer[at:at + self.successors.n]

    @staticmethod
    def build(keys: np.ndarray, words: int, codes: np.ndarray) -> bytes:
        """``keys``: sorted ``context * words + successor``, with a code each."""
        context = keys // np.uint64(words)
        fresh = np.ones(len(keys), bool)
        fresh[1:] = context[1:] != context[:-1]
        context, place = context[fresh], np.cumsum(fresh) - 1
        pointers = np.append(np.flatnonzero(fresh), len(keys))
        relative = place.astype(np.uint64) * np.uint64(words) + keys % np.uint64(words)
        return b"".join([struct.pack("<q", words), EliasFano.encode(context, words),
                         EliasFano.encode(pointers, len(keys) + 1),
                         EliasFano.encode(relative, max(1, len(context)) * words), codes.tobytes()])

    def look_up(self, context: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the successors (0: none) and the number of successors that each context has.

        Queries are in order of context.  Each is searched between the pointers of its context; the successors are
        unpacked only where queried contexts point, some ``PIECE`` at a time.
        """
        code, many = np.zeros(len(context), np.uint8), np.zeros(len(context), np.int64)
        place = self.contexts.find(context)
        asked = np.flatnonzero(place >= 0)
        if not len(asked):
            return code, many
        pointers = self.pointers.decode().astype(np.int64)
        begin, end = pointers[place[asked]], pointers[place[asked] + 1]
        many[asked] = end - begin
        at = 0
        while at < len(asked):
            to = max(np.searchsorted(end, begin[at] + PIECE, "right"), np.searchsorted(begin, begin[at], "right"))
            own = self.successors.segment(int(begin[at]), int(end[to - 1])) % np.uint64(self.words)
            queries = asked[at:to]
            found = _search(own, begin[at:to] - begin[at], end[at:to] - begin[at], successor[queries])
            hit = found >= 0
            code[queries[hit]] = self.codes[begin[at] + found[hit]]
            at = int(to)
        return code, many


def _search(values: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted value in its own sorted range of ``values``, or -1."""
    low, stop = low.copy(), high
    high = high.copy()
    rows = np.flatnonzero(low < high)
    while len(rows):
        middle = (low[rows] + high[rows]) >> 1
        smaller = values[middle] < wanted[rows]
        low[rows[smaller]], high[rows[~smaller]] = middle[smaller] + 1, middle[~smaller]
        rows = rows[low[rows] < high[rows]]
    found = np.flatnonzero(low < stop)
    found = found[values[low[found]] == wanted[found]]
    out = np.full(len(wanted), -1, np.int64)
    out[found] = low[found]
    return out
