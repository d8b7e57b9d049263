"""CRC-32 of many byte spans at once, from a table of bytes by their distance to the end.

Without its constants a CRC is linear over XOR: the CRC of a span is the XOR of what each byte
contributes, which depends on the byte and on how many bytes follow it, and of a constant that depends
on the length alone.  So the contributions stand in a table, and one ``bitwise_xor.reduceat``
takes them together for all spans.  Spans beyond the reach of the table are cut into blocks from their
end; blocks are folded pairwise, the earlier one moved over the bytes of the later one.
"""

from __future__ import annotations

import zlib

import numpy as np

POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32 with reversed bits
REACH = 64  # bytes of a block
CHUNK_BYTES = 1 << 20  # bytes whose contributions are looked up at a time


def _after_byte() -> np.ndarray:
    """The register after each byte, from an empty register."""
    register = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        register = (register >> np.uint32(1)) ^ (register & np.uint32(1)) * np.uint32(POLYNOMIAL)
    return register


class PositionCrc:
    """Tables for spans of any length; ``reach`` bytes of distance are tabulated."""

    def __init__(self, reach: int = REACH):
        self.reach = reach
        self.last = _after_byte()
        rows = [self.last]
        for _ in range(reach - 1):
            rows.append(self._zero_byte(rows[-1]))
        self.table = np.concatenate(rows)  # contribution of byte b, d bytes before the end: d * 256 + b
        self.constants = np.array([zlib.crc32(bytes(n)) for n in range(reach + 1)], np.uint32)
        self.moves: list[np.ndarray] = []

    def _zero_byte(self, register: np.ndarray) -> np.ndarray:
        return (register >> np.uint32(8)) ^ self.last[register & np.uint32(255)]

    def _move(self, register: np.ndarray, k: int) -> np.ndarray:
        """Registers after ``reach * 2**k`` zero bytes."""
        while len(self.moves) <= k:
            single = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
            if self.moves:  # twice as far as the move before
                single = self._move(self.moves[-1].ravel(), len(self.moves) - 1).reshape(4, 256)
            else:
                for _ in range(self.reach):
                    single = self._zero_byte(single)
            self.moves.append(single)
        moved = self.moves[k]
        return (moved[0][register & np.uint32(255)] ^ moved[1][register >> np.uint32(8) & np.uint32(255)]
                ^ moved[2][register >> np.uint32(16) & np.uint32(255)] ^ moved[3][register >> np.uint32(24)])

    def crc(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Unsigned CRC-32 of ``data[begin:end]`` for each span; spans may overlap or be empty."""
        size = end - begin
        out = np.zeros(len(size), np.uint32)
        filled = np.flatnonzero(size > 0)
        if not len(filled):
            return out
        begin, end, size = begin[filled], end[filled], size[filled]
        blocks = -(-size // self.reach)
        span = np.repeat(np.arange(len(size)), blocks)
        later = np.repeat(np.cumsum(blocks), blocks) - 1 - np.arange(len(span))  # blocks after this one
        stop = end[span] - later * self.reach
        start = np.maximum(stop - self.reach, begin[span])
        part = self._blocks(data, start, stop)
        k = 0
        while len(part) > len(size):
            odd = later & 1 == 1
            part[odd] = self._move(part[odd], k)
            later >>= 1
            fresh = np.ones(len(part), bool)
            fresh[1:] = (span[1:] != span[:-1]) | (later[1:] != later[:-1])
            first = np.flatnonzero(fresh)
            part, span, later, k = np.bitwise_xor.reduceat(part, first), span[first], later[first], k + 1
        short = size <= self.reach
        part[short] ^= self.constants[size[short]]
        for n in np.unique(size[~short]):
            part[size == n] ^= np.uint32(zlib.crc32(bytes(int(n))))
        out[filled] = part
        return out

    def _blocks(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """XOR of the contributions of each block of at most ``reach`` bytes."""
        part = np.empty(len(start), np.uint32)
        total = np.concatenate([[0], np.cumsum(stop - start)])
        at = 0
        while at < len(start):
            to = max(at + 1, int(np.searchsorted(total, total[at] + CHUNK_BYTES, "right")) - 1)
            size = stop[at:to] - start[at:to]
            first = total[at:to] - total[at]
            place = np.arange(total[to] - total[at]) + np.repeat(start[at:to] - first, size)
            distance = np.repeat(stop[at:to], size) - 1 - place
            part[at:to] = np.bitwise_xor.reduceat(self.table[distance * 256 + data[place]], first)
            at = to
        return part
