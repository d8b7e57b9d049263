"""SentencePiece encoding and decoding with a unigram vocabulary.

Encoding marks white space, walks a double-array trie of the pieces from every character, and
keeps for each position the best sum of log scores and the piece that ends there (Viterbi);
of equal sums the piece that begins first wins, as in the tokenizer.  Characters
without a piece become byte pieces if the vocabulary has them, and the unknown piece
otherwise.  No piece goes over the beginning of a run of white-space markers, so the text
is cut there, and each distinct segment of a batch is solved once, many side by side.  Sums are in
double precision within a segment, so they do not lose digits in long texts.

Decoding joins the pieces' bytes, turns markers to spaces and takes the leading one away; bytes
that are not UTF-8 become U+FFFD.

Null and empty texts give no token and decode to the empty text.  A marker character in the
text comes back as a space.  Repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.llm.unigram import Vocabulary, char_lengths, distinct_segments, in_matrices

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
BATCH_ROWS = 1000


def best_paths(v: Vocabulary, matrix: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every position of every row, where its best last piece begins, and its id
    (-1: a character without a piece)."""
    n, width = matrix.shape
    best = np.full((width + 1, n), -np.inf)
    best[0] = 0
    back = np.zeros((width + 1, n), np.int32)
    last = np.full((width + 1, n), -1, np.int32)
    chars = char_lengths(matrix)
    codes = np.ascontiguousarray(matrix.T).astype(np.int64)

    def offer(rows, start, stop, score, piece):
        better = score > best[stop, rows]
        rows = rows[better]
        at = stop[better] if isinstance(stop, np.ndarray) else stop
        best[at, rows], back[at, rows] = score[better], start
        last[at, rows] = piece[better]

    for i in range(width):
        rows = np.flatnonzero((sizes > i) & (chars[:, i] > 0))
        if len(rows) == 0:
            continue
        everyone, states = rows, np.zeros(len(rows), np.int64)
        single = np.zeros(n, bool)
        for stop in range(i + 1, width + 1):
            states, there = v.trie.step(states, codes[stop - 1, rows])
            there &= sizes[rows] >= stop
            rows, states = rows[there], states[there]
            if len(rows) == 0:
                break
            piece = v.trie.value[states]
            ends = piece >= 0
            if ends.any():
                who, piece = rows[ends], piece[ends]
                single[who[chars[who, i] == stop - i]] = True
                offer(who, i, stop, best[i, who] + v.scores[piece], piece)
        lone = everyone[~single[everyone]]
        if len(lone):
            stop = np.minimum(i + chars[lone, i], sizes[lone])
            offer(lone, i, stop, best[i, lone] + v.unknown_score, np.full(len(lone), -1, np.int32))
    return back, last


def encode_segments(v: Vocabulary, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all segments one after the other, and how many each has."""
    keys, ids = [], []  # sort key: segment, then position
    for part, matrix, sizes in in_matrices(segments):
        back, last = best_paths(v, matrix, sizes)
        at, rows = sizes.copy(), np.arange(len(part))
        while len(rows):
            start, piece = back[at[rows], rows], last[at[rows], rows]
            known = piece >= 0
            keys.append(part[rows[known]] << 32 | start[known])
            ids.append(piece[known])
            for r, s in zip(rows[~known], start[~known]):
                if v.byte_fallback:
                    lone = matrix[r, s:at[r]]
                    keys.append((part[r] << 32) + s + np.arange(len(lone)))
                    ids.append(v.byte_id[lone])
                else:
                    keys.append(np.array([part[r] << 32 | int(s)]))
                    ids.append(np.array([v.unknown], np.int32))
            at[rows] = start
            rows = rows[at[rows] > 0]
    if not keys:
        return np.zeros(0, np.int32), np.zeros(len(segments), np.int64)
    key = np.concatenate(keys)
    flat = np.concatenate(ids)[np.argsort(key, kind="stable")]
    return flat.astype(np.int32), np.bincount(key >> 32, minlength=len(segments))


def encode(v: Vocabulary, texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the offsets of the texts."""
    segments, at, counts = distinct_segments(v, texts)
    flat, sizes = encode_segments(v, segments)
    first = np.cumsum(sizes) - sizes
    size = sizes[at]
    ends = np.cumsum(size)
    index = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size - first[at], size)
    offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    return flat[index], offsets


def decode(v: Vocabulary, ids) -> str:
    """The text of some ids."""
    data = b"".join([v.bytes_of[i] for i in ids])
    if v.dummy_prefix and data[:1] == b" ":
        data = data[1:]
    return data.decode("utf-8", "replace")


def encode_documents(docs: DataFrame, path: str = MODEL_PATH, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id``, ``tokens`` (ids), ``n_tokens`` and ``decoded``, the text of the tokens, and the columns
    ``keep`` of ``docs``."""
    kept = docs.select(*keep).schema.fields if keep else []
    schema = StructType.fromDDL("doc_id bigint, tokens array<int>, n_tokens bigint, decoded string")
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches):
        v = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                flat, offsets = encode(v, part.column(1).to_pylist())
                rows = flat.tolist()
                decoded = [decode(v, rows[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())),
                     pa.array(np.diff(offsets), pa.int64()), pa.array(decoded, pa.string()),
                     *part.columns[2:]],
                    names=["doc_id", "tokens", "n_tokens", "decoded", *keep])

    return docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(f"_kept{i}") for i, c in enumerate(keep)]).mapInArrow(
        run, StructType([*schema.fields, *kept]))
