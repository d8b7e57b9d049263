"""The unigram tokenizer against the installed library on the same vocabulary."""

import random
import struct

import numpy as np
import pytest
import sentencepiece

from tidewell.llm.sentencepiece import MODEL_PATH, decode, encode, encode_documents
from tidewell.llm.token_counts import Automaton, count_segments, count_tokens
from tidewell.llm.unigram import Vocabulary, _fields, distinct_segments


def _wire(number, kind, payload):
    def varint(x):
        out = b""
        while x > 127:
            out, x = out + bytes([x & 127 | 128]), x >> 7
        return out + bytes([x])
    if kind == 0:
        return varint(number << 3) + varint(payload)
    if kind == 5:
        return varint(number << 3 | 5) + payload
    return varint(number << 3 | 2) + varint(len(payload)) + payload


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(MODEL_PATH)


@pytest.fixture(scope="module")
def library(vocabulary):
    """The library with a unigram model of the same pieces and scores."""
    out, place = b"", 0
    with open(MODEL_PATH, "rb") as file:
        data = file.read()
    for number, value in _fields(data):
        if number == 1:
            held = dict(_fields(value))
            piece = _wire(1, 2, held[1]) + _wire(2, 5, struct.pack("<f", vocabulary.scores[place]))
            out += _wire(1, 2, piece + _wire(3, 0, held.get(3, 1)))
            place += 1
        elif number == 2:
            out += _wire(2, 2, _wire(3, 0, 1) + _wire(4, 0, place) + _wire(35, 0, 1))
        else:
            out += _wire(number, 2, value)
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def _texts():
    r = random.Random(5)
    alphabet = "etaoin  shrdlu\nÉßñ語😀.,0123'\t"
    return ["", " ", "  a  b ", "Hello world", "x\ny\n\n z", "naïve 😀😀 語", "aaaa" * 30, "a" * 3000,
            *["".join(r.choice(alphabet) for _ in range(r.randint(1, 60))) for _ in range(400)]]


def test_ids_are_those_of_the_library(vocabulary, library):
    texts = _texts()
    flat, offsets = encode(vocabulary, texts)
    for n, text in enumerate(texts):
        assert flat[offsets[n]:offsets[n + 1]].tolist() == library.encode(text), text


def test_decode_gives_the_text_and_what_the_library_gives(vocabulary, library):
    texts = _texts()
    flat, offsets = encode(vocabulary, texts)
    for n, text in enumerate(texts):
        ids = flat[offsets[n]:offsets[n + 1]].tolist()
        assert decode(vocabulary, ids) == text == library.decode(ids)


def test_counts_are_the_lengths(vocabulary):
    texts = _texts()
    _, offsets = encode(vocabulary, texts)
    segments, at, counts = distinct_segments(vocabulary, texts)
    sizes = count_segments(vocabulary, Automaton(vocabulary), segments)
    totals = [int(x.sum()) for x in np.split(sizes[at], np.cumsum(counts)[:-1])]
    assert totals == np.diff(offsets).tolist()


def test_rows_with_nulls_and_repeats(spark):
    docs = spark.createDataFrame(
        [(1, None, 0), (2, "", 0), (3, "ab c", 0), (3, "ab c", 0), (None, "z" * 5000, 0)],
        "doc_id bigint, text string, tokens int")
    rows = encode_documents(docs).collect()
    assert sorted(r["n_tokens"] for r in rows)[:2] == [0, 0] and len(rows) == 5
    assert sorted(r["decoded"] for r in rows) == ["", "", "ab c", "ab c", "z" * 5000]
    counts = sorted((r[0] or 0, r[1]) for r in count_tokens(docs).collect())
    assert counts == sorted((r["doc_id"] or 0, r["n_tokens"]) for r in rows)
    assert count_tokens(docs.limit(0)).count() == 0
