"""Token counts by a Viterbi pass that keeps no path.

An Aho-Corasick automaton over the pieces reports, at every byte, all pieces that end there,
the longest first.  For every position the pass carries the best score and the number of
pieces of the best path; a shorter piece replaces a longer one only if its sum is greater, which
is the tokenizer's rule for ties.  Characters without a piece count as their bytes if
the vocabulary has byte pieces, and as one otherwise.  The result is the length of
the tokenizer's own encoding.

Null and empty texts count 0.  Repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tidewell.llm.common import map_documents
from tidewell.llm.sentencepiece import MODEL_PATH
from tidewell.llm.unigram import Vocabulary, char_lengths, distinct_segments, in_matrices


class Automaton:
    """Failure and output links over the trie of a vocabulary."""

    def __init__(self, v: Vocabulary):
        trie = self.trie = v.trie
        self.fail = np.zeros(len(trie.base), np.int64)
        self.output = np.zeros(len(trie.base), np.int64)  # next shorter piece that ends here; 0: none
        states = np.flatnonzero(trie.check >= 0)
        for depth in range(2, int(trie.depth.max()) + 1):
            level = states[trie.depth[states] == depth]
            parent = trie.check[level].astype(np.int64)
            c = level - trie.base[parent]
            self.fail[level] = self.follow(self.fail[parent], c)
        for depth in range(1, int(trie.depth.max()) + 1):
            level = states[trie.depth[states] == depth]
            shorter = self.fail[level]
            self.output[level] = np.where(trie.value[shorter] >= 0, shorter, self.output[shorter])

    def follow(self, states: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The states after one more byte, over failure links where there is no transition."""
        out = np.zeros(len(states), np.int64)
        rows, states = np.arange(len(states)), states.astype(np.int64)
        while len(rows):
            to, there = self.trie.step(states, c[rows])
            out[rows[there]] = to[there]
            stuck = ~there & (states != 0)
            rows, states = rows[stuck], self.fail[states[stuck]]
        return out


def count_segments(v: Vocabulary, automaton: Automaton, segments: list[str]) -> np.ndarray:
    """Pieces of the best path of each segment."""
    found = np.zeros(len(segments), np.int64)
    trie = v.trie
    for part, matrix, sizes in in_matrices(segments):
        n, width = matrix.shape
        best, count = np.full((width + 1, n), -np.inf), np.zeros((width + 1, n), np.int64)
        best[0] = 0
        chars = char_lengths(matrix)
        codes = np.ascontiguousarray(matrix.T).astype(np.int64)
        states, begun = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for stop in range(1, width + 1):
            live = np.flatnonzero(sizes >= stop)
            starts = chars[live, stop - 1] > 0
            begun[live[starts]] = stop - 1
            states[live] = automaton.follow(states[live], codes[stop - 1, live])
            # only whole characters end a piece
            last = live[begun[live] + chars[live, begun[live]] == stop]
            single = np.zeros(n, bool)
            here = states[last]
            here = np.where(trie.value[here] >= 0, here, automaton.output[here])
            rows = last
            while True:
                rows, here = rows[here > 0], here[here > 0]
                if len(rows) == 0:
                    break
                start = stop - trie.depth[here]
                single[rows[start == begun[rows]]] = True
                score = best[start, rows] + v.scores[trie.value[here]]
                better = score > best[stop, rows]
                best[stop, rows[better]] = score[better]
                count[stop, rows[better]] = count[start[better], rows[better]] + 1
                here = automaton.output[here]
            lone = last[~single[last]]
            if len(lone):
                start = begun[lone]
                score = best[start, lone] + v.unknown_score
                better = score > best[stop, lone]
                pieces = stop - start if v.byte_fallback else 1
                best[stop, lone[better]] = score[better]
                count[stop, lone[better]] = (count[start, lone] + pieces)[better]
        found[part] = count[sizes, np.arange(n)]
    return found


def count_tokens(docs: DataFrame, path: str = MODEL_PATH) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def make():
        v = shared.value
        automaton = Automaton(v)

        def work(ids, texts):
            segments, at, counts = distinct_segments(v, texts)
            sums = np.concatenate([[0], np.cumsum(count_segments(v, automaton, segments)[at])])
            ends = np.cumsum(counts)
            return zip(ids, (sums[ends] - sums[ends - counts]).tolist())
        return work

    return map_documents(docs, ["doc_id", "text"], "doc_id bigint, n_tokens bigint", make)
