"""A unigram vocabulary from a SentencePiece model file, as a double-array trie."""

from __future__ import annotations

import math
import re
import struct

import numpy as np

SPACE = "▁"
# Fixed values of the model file's format: piece types and the kind of model.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
# The tokenizer's penalty of an unknown character, below the lowest score.
UNKNOWN_PENALTY = 10.0


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes):
    """(number, value) of the fields of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        if key & 7 == 0:
            value, at = _varint(data, at)
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            if size is None:
                size, at = _varint(data, at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class DoubleArray:
    """Byte transitions in two arrays: ``check[base[s] + c]`` is s where s goes on with c."""

    def __init__(self, words: list[bytes]):
        children: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        for place, word in enumerate(words):
            node = 0
            for c in word:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                node = children[node][c]
            ends.setdefault(node, place)
        size = 2 * len(children) + 1024
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        self.depth = np.zeros(size, np.int32)
        used = bytearray(size)
        used[0] = 1
        state = {0: 0}
        free, queue = 1, [0]
        for node in queue:
            s, own = state[node], sorted(children[node])
            if node in ends:
                self.value[s] = ends[node]
            if not own:
                continue
            while used[free]:
                free += 1
            at, tries = free, 0
            while at < own[0] + 1 or any(used[at - own[0] + c] for c in own):
                at, tries = at + 1, tries + 1
            if tries > 200:
                free += 16  # a crowded stretch is left behind
            self.base[s] = at - own[0]
            for c in own:
                t = at - own[0] + c
                used[t] = 1
                self.check[t], self.depth[t] = s, self.depth[s] + 1
                state[children[node][c]] = t
                queue.append(children[node][c])

    def step(self, states: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and which of them there are."""
        to = np.minimum(self.base[states] + c, len(self.check) - 1)
        return to, self.check[to] == states


class Vocabulary:
    """Pieces with log scores, the trie of those that match text, and the byte pieces.

    A file of kind BPE has merge ranks in place of scores; the piece of rank r then gets the
    Zipf log score ``-ln(r + 1)``.
    """

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        pieces, kind = [], UNIGRAM
        self.dummy_prefix, self.escape, self.byte_fallback = True, True, False
        for number, value in _fields(data):
            if number == 1:
                held = dict(_fields(value))
                score = struct.unpack("<f", held[2])[0] if 2 in held else 0.0
                pieces.append((held.get(1, b"").decode(), score, held.get(3, NORMAL)))
            elif number == 2:
                held = dict(_fields(value))
                kind, self.byte_fallback = held.get(3, UNIGRAM), bool(held.get(35, 0))
            elif number == 3:
                held = dict(_fields(value))
                self.dummy_prefix, self.escape = bool(held.get(3, 1)), bool(held.get(5, 1))
                if held.get(2) or held.get(4, 1):
                    raise ValueError("only models without character normalisation are supported")
        self.types = np.array([t for _, _, t in pieces], np.int32)
        self.scores = np.array([s for _, s, _ in pieces], float)
        normal = self.types == NORMAL
        if kind == BPE:
            rank = np.cumsum(normal)
            self.scores[normal] = [float(np.float32(-math.log(r + 1))) for r in rank[normal]]
        self.unknown = int(np.flatnonzero(self.types == UNKNOWN)[0])
        self.unknown_score = float(self.scores[normal].min()) - UNKNOWN_PENALTY
        self.byte_id = np.full(256, self.unknown, np.int32)
        self.bytes_of: list[bytes] = []
        for i, (text, _, t) in enumerate(pieces):
            if t == BYTE:
                self.byte_id[int(text[3:5], 16)] = i
                self.bytes_of.append(bytes([int(text[3:5], 16)]))
            elif t == UNKNOWN:
                self.bytes_of.append(" ⁇ ".encode())
            else:
                self.bytes_of.append(b"" if t == CONTROL else text.replace(SPACE, " ").encode())
        matched = [i for i, t in enumerate(self.types) if t in (NORMAL, USER_DEFINED)]
        self.trie = DoubleArray([pieces[i][0].encode() for i in matched])
        ids = np.array(matched, np.int32)
        self.trie.value = np.where(self.trie.value >= 0, ids[self.trie.value], -1).astype(np.int32)
        # No piece goes over a place where a run of markers begins, or holds a line break.
        texts = [pieces[i][0] for i in matched]
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", t) for t in texts):
            raise ValueError("pieces that go over word ends are not supported")

    def segments(self, text: str | None) -> list[str]:
        """The text with white-space markers, cut where no piece goes over."""
        if not text:
            return []
        marked = (SPACE if self.dummy_prefix else "") + (text.replace(" ", SPACE) if self.escape else text)
        return _SEGMENT.findall(marked)


_SEGMENT = re.compile(f"(?:{SPACE}+|\n)[^{SPACE}\n]*|[^{SPACE}\n]+")


def in_matrices(segments: list[str]):
    """Groups of segments of similar length: (places, bytes padded with 0, lengths)."""
    data = [s.encode("utf-8", "replace") for s in segments]
    sizes = np.array([len(d) for d in data], np.int64)
    order = np.argsort(sizes, kind="stable")
    start = 0
    while start < len(order):
        longest = max(8, int(sizes[order[start]]) * 3 // 2)
        stop = int(np.searchsorted(sizes[order], longest, side="right"))
        stop = min(stop, start + max(1, (1 << 22) // longest))
        part = order[start:stop]
        width = int(sizes[part].max())
        rows = b"".join(data[i].ljust(width, b"\0") for i in part)
        yield part, np.frombuffer(rows, np.uint8).reshape(len(part), width), sizes[part]
        start = stop


def char_lengths(matrix: np.ndarray) -> np.ndarray:
    """Bytes of the character that begins at each byte; 0 inside a character."""
    return np.select([matrix < 0x80, matrix < 0xC0, matrix < 0xE0, matrix < 0xF0], [1, 0, 2, 3], 4)


def distinct_segments(vocabulary: Vocabulary, texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct segments of some texts, the segment at each place, and segments of each text."""
    place: dict[str, int] = {}
    at, counts = [], np.zeros(len(texts), np.int64)
    for n, text in enumerate(texts):
        found = vocabulary.segments(text)
        counts[n] = len(found)
        at += [place.setdefault(s, len(place)) for s in found]
    return list(place), np.array(at, np.int64), counts
