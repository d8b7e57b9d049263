"""Benchmark decontamination: a BM25 index of test items searched by block-max WAND.

The index holds the test items and, as segments of their own, their question and answer parts
where these are telling: a question from ``NGRAM`` words on, an answer from ``TELLING``.  What is
longer than ``STRIDE`` words is cut into segments of that length, evenly spread, that overlap by
half or more.  Every training document is cut into passages, windows of ``2 * STRIDE`` words that
start every ``STRIDE`` words, so that any segment copied into a document lies whole in one of its
passages.

Each passage of every document is a query.  Postings of a term are in blocks of ``BLOCK``
neighbouring segments that keep their largest impact; the parts of an item are neighbours.  A
block whose largest impacts, added over the terms of the passage, stay below ``min_score`` is
passed over; the postings of the others give the exact scores, and every segment that reaches
``min_score`` of its score for itself is retrieved.  ``CHUNK`` passages of one or more texts are searched
at once, or as many as have ``ENTRIES`` blocks, so memory does not grow with the text.  A retrieved segment is then verified on word
n-grams: the share of its n-grams that stand in the passage must reach ``min_overlap``, and must be
all of them for an item or a question of less than ``TELLING`` words.  So an item is found by its
whole, by its question alone or by its answer alone.  ``min_score`` is below ``min_overlap``
because the half of a segment that is copied may hold its commoner words.

Terms are lower-case runs of letters and digits.  Impacts are divided by the segment's own
score, so one threshold serves all segments.  An item that is null or has no term is never
found; one of fewer than ``NGRAM`` words ("Paris") is found only in a text of just these words.
A null, empty or wordless text holds no item.  Equal items are all found.  Without an
``answer`` column, the first half of an item's words is its question, the rest its answer.
Rows may repeat; other columns are ignored.  Of several passages or segments that show an item,
the one with the highest score (to 9 digits) is returned, of equal ones the first passage.

The index is built in tasks, in parts of about ``PART_BYTES`` of text; all rows of an item id are in
one part.  Document frequencies and the mean length are those of the whole benchmark, so
scores do not depend on the parts.  Built parts are measured and searched in passes of at most
``INDEX_BYTES`` (a larger part is a pass of its own).  The driver holds one pass at a time and
broadcasts it; each pass reads the documents once.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import map_documents, mix64, text_pieces
from tidewell.session import materialize

TERM = re.compile(r"[^\W_]+")
STRIDE = 64
TELLING = 10
MIN_SCORE = 0.3
MIN_OVERLAP = 0.5
BLOCK = 4
CHUNK = 256
ENTRIES = 1 << 20
K1, B = 1.2, 0.75
NGRAM = 5
PART_BYTES = 1024 * 1024
INDEX_BYTES = 64 * 1024 * 1024
FOUND = ("doc_id bigint, item_id bigint, passage int, score double, "
         "question_overlap double, answer_overlap double")
_SLACK = 1e-9


def terms_of(text: str | None) -> list[str]:
    return TERM.findall(text.lower()) if text else []


def grams(words, n: int = NGRAM) -> set[tuple]:
    """Word n-grams; all words as one if they are fewer than n."""
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if len(words) else set()


def pieces(first: int, end: int) -> list[tuple[int, int]]:
    """The segments of a run of words: the run, or windows of ``STRIDE`` that overlap by half."""
    size = end - first
    more = -(-max(0, size - STRIDE) // (STRIDE // 2))
    starts = [first + i * (size - STRIDE) // more for i in range(more + 1)] if more else [first]
    return [(s, min(end, s + STRIDE)) for s in starts] if size > 0 else []


def segments_of(size: int, asked: int) -> list[tuple]:
    """The segments of an item of ``size`` words, the first ``asked`` of which are its question: ends
    of the segment, of the question and of the answer to report, and the share of n-grams needed
    (None: the caller's)."""
    found = []
    for s, e in pieces(0, size):
        cut = min(max(asked, s), e)
        found.append((s, e, s, cut, cut, e, 1.0 if size < TELLING else None))
    if NGRAM <= asked < size:
        found += [(s, e, s, e, asked, size, 1.0 if asked < TELLING else None) for s, e in pieces(0, asked)]
    if 0 < asked <= size - TELLING:
        found += [(s, e, 0, asked, s, e, None) for s, e in pieces(asked, size)]
    return found


def item_words(text: str | None, answer: str | None) -> tuple[list[str], int]:
    """The words of an item, and how many of them are its question."""
    asked, answered = terms_of(text), terms_of(answer)
    return asked + answered, len(asked) if answer is not None else (len(asked) + 1) // 2


def item_counts(words: list[str], asked: int) -> tuple[Counter, int, int]:
    """Of an item: the segments that hold each term, all its segments, and their words."""
    found = segments_of(len(words), asked)
    return (Counter(t for s, e, *_ in found for t in set(words[s:e])), len(found),
            sum(e - s for s, e, *_ in found))


def _expand(first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places ``first[r]`` to ``first[r + 1]`` of each row r, and where r stands in ``rows``."""
    size = first[rows + 1] - first[rows]
    owner = np.repeat(np.arange(len(rows)), size)
    return np.arange(len(owner)) + np.repeat(first[rows] - (np.cumsum(size) - size), size), owner


def _distinct(keys: np.ndarray, size: int) -> np.ndarray:
    """The distinct keys below ``size``, sorted."""
    if size > 64 * len(keys):
        return np.unique(keys)
    seen = np.zeros(size, bool)
    seen[keys] = True
    return np.flatnonzero(seen)


def _sums(keys: np.ndarray, values: np.ndarray, size: int) -> tuple:
    """Keys below ``size`` (None: all), the sums of their values, and the place of each key's sum."""
    if size > 8 * len(keys):
        names, group = np.unique(keys, return_inverse=True)
        return names, np.bincount(group, values, len(names)), group
    return None, np.bincount(keys, values, size), keys


def _enough(keys: np.ndarray, values: np.ndarray, size: int, least: float) -> np.ndarray:
    """Which entries have a key whose values add up to at least ``least``."""
    _, total, group = _sums(keys, values, size)
    return (total >= least - _SLACK)[group]


def _reaching(keys: np.ndarray, values: np.ndarray, size: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The keys, sorted, whose values add up to at least ``least``, and the sums."""
    names, total, _ = _sums(keys, values, size)
    at = np.flatnonzero(total >= least - _SLACK)
    return (at if names is None else names[at]), total[at]


def _places(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each value stands in the sorted ``keys``; -1 if it does not."""
    if len(keys) == 0:
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return np.where(keys[at] == values, at, -1)


def _gram_hashes(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """A hash of the ``n`` word numbers from each of the places ``at`` on."""
    out = np.full(len(at), n, np.uint64)
    for i in range(n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + ids[at + i].astype(np.uint64))
    return out


def _bounds(sorted_keys: np.ndarray, n: int) -> np.ndarray:
    """The first place of each of the keys 0 to n."""
    return np.searchsorted(sorted_keys, np.arange(n + 1))


class Index:
    """Postings of the segments in blocks, and what is needed to verify a segment."""

    def __init__(self, items: list[tuple[int, list[str], int]], held: dict | None = None,
                 segments: int = 0, length: int = 0):
        """``items``: (item id, words, number of words of the question).  ``held`` (segments that hold
        a term), ``segments`` and ``length`` (their number and words) are those of the whole
        benchmark, and without ``held`` those of ``items``."""
        if held is None:
            counts = [item_counts(words, asked) for _, words, asked in items]
            held = sum((c[0] for c in counts), Counter())
            segments, length = sum(c[1] for c in counts), sum(c[2] for c in counts)
        idf = {t: log(1 + (segments - d + 0.5) / (d + 0.5)) for t, d in held.items()}
        mean = length / max(1, segments)
        self.number: dict[str, int] = {}
        self.words, self.item, self.span, self.needed = [], [], [], []
        term, segment, impact = [], [], []
        for item, words, asked in items:
            ids = np.array([self.number.setdefault(t, len(self.number)) for t in words], np.int32)
            for s, e, *parts, needed in segments_of(len(words), asked):
                size = K1 * (1 - B + B * (e - s) / mean)
                mine = {t: idf[t] * c * (K1 + 1) / (c + size) for t, c in Counter(words[s:e]).items()}
                own = sum(mine.values())
                term += [self.number[t] for t in mine]
                segment += [len(self.item)] * len(mine)
                impact += [x / own for x in mine.values()]
                self.item.append(item)
                self.span.append((len(self.words), s, e, *parts))
                self.needed.append(np.nan if needed is None else needed)
            self.words.append(ids)
        self.needed = np.array(self.needed, float)
        self._post(np.array(term, np.int64), np.array(segment, np.int32), np.array(impact, float))
        self._post_grams()

    def _post(self, term: np.ndarray, segment: np.ndarray, impact: np.ndarray) -> None:
        order = np.lexsort((segment, term))
        term, self.segment, self.impact = term[order], segment[order], impact[order]
        self.blocks = len(self.item) // BLOCK + 1
        key = term * self.blocks + self.segment // BLOCK
        start = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
        self.block = key[start] % self.blocks
        self.block_max = np.maximum.reduceat(self.impact, start) if len(start) else np.zeros(0)
        self.postings_of_block = np.append(start, len(key))
        self.blocks_of_term = _bounds(key[start] // self.blocks, len(self.number))

    def _post_grams(self) -> None:
        """Hashes of the n-grams of each segment, with the segments of each hash."""
        keys, owner = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        self.gram_words = []
        for place, (item, s, e, *_) in enumerate(self.span):
            n = min(NGRAM, e - s)
            mine = np.unique(_gram_hashes(self.words[item], np.arange(s, e - n + 1), n))
            self.gram_words.append(n)
            keys.append(mine)
            owner.append(np.full(len(mine), place))
        self.gram_words = np.array(self.gram_words, np.int64)
        self.gram_count = np.array([len(k) for k in keys[1:]], float)
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        order = np.lexsort((owner, keys))
        self.gram_keys, group = np.unique(keys[order], return_inverse=True)
        self.gram_segment = owner[order].astype(np.int32)
        self.segments_of_gram = _bounds(group, len(self.gram_keys))

    def retrieve(self, ids: np.ndarray, real: np.ndarray, least: float) -> tuple[np.ndarray, ...]:
        """Passage, segment and score of every segment that reaches ``least`` in a passage, by passage
        and segment.  ``ids`` are numbers of words (-1: in no item), a passage begins at every
        ``STRIDE`` of them, and ``real`` tells which of these passages to search."""
        v, n, blocks = max(1, len(self.number)), max(1, len(self.item)), self.blocks
        at = np.flatnonzero(ids >= 0)
        here, word = at // STRIDE, ids[at]
        inside = real[here]
        behind = np.flatnonzero((here > 0) & real[here - 1])
        pairs = _distinct(np.concatenate([here[inside] * v + word[inside],
                                          (here[behind] - 1) * v + word[behind]]), len(real) * v)
        passage, term = pairs // v, pairs % v
        cost = np.cumsum(self.blocks_of_term[term + 1] - self.blocks_of_term[term])
        found, scores, cut = [np.zeros(0, np.int64)], [np.zeros(0)], 0
        while cut < len(pairs):  # whole passages, as many as their blocks allow
            end = int(np.searchsorted(cost, (cost[cut - 1] if cut else 0) + ENTRIES, "right"))
            if end < len(pairs):
                end = max(int(np.searchsorted(passage, passage[end])),
                          int(np.searchsorted(passage, passage[cut], "right")))
            first, many = passage[cut], passage[end - 1] - passage[cut] + 1
            entry, row = _expand(self.blocks_of_term, term[cut:end])
            row = passage[cut:end][row] - first
            kept = _enough(row * blocks + self.block[entry], self.block_max[entry], many * blocks, least)
            posting, at = _expand(self.postings_of_block, entry[kept])
            key, score = _reaching(row[kept][at] * n + self.segment[posting], self.impact[posting],
                                   many * n, least)
            found.append(key + first * n)
            scores.append(score)
            cut = end
        found = np.concatenate(found)
        return found // n, found % n, np.concatenate(scores)

    def verify(self, ids: np.ndarray, words: np.ndarray, passage: np.ndarray, segment: np.ndarray,
               min_overlap: float) -> np.ndarray:
        """Which of the retrieved segments may have enough n-grams in their passage: counts are by
        hash and of n-grams that begin in it, so none is missed.  ``words``: of the whole text of
        each passage."""
        short = self.gram_words[segment] < NGRAM
        fits = ~short | (self.gram_words[segment] == words[passage])
        known = np.cumsum(np.concatenate([[0], ids >= 0]))
        n, found = max(1, len(self.item)), []
        wanted = passage * n + segment
        for size in np.unique(self.gram_words[segment[fits]]):
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            gram = _places(_gram_hashes(ids, at, size), self.gram_keys)
            at, gram = at[gram >= 0], gram[gram >= 0]
            place, row = _expand(self.segments_of_gram, gram)
            for back in (0, 1):
                key = (at[row] // STRIDE - back) * n + self.gram_segment[place]
                slot = _places(key, wanted)
                hit = (slot >= 0) & (self.gram_words[self.gram_segment[place]] == size)
                found.append(_distinct(slot[hit] * len(self.gram_keys) + gram[row][hit],
                                       len(wanted) * len(self.gram_keys)) // len(self.gram_keys))
        count = np.bincount(np.concatenate(found), minlength=len(wanted)) if found else np.zeros(len(wanted))
        least = np.where(np.isnan(self.needed[segment]), min_overlap, self.needed[segment])
        return fits & (count >= least * self.gram_count[segment] - _SLACK)

    def overlaps(self, seen: dict, segment: int) -> list[float]:
        """The shares of n-grams of the segment, its question and its answer that stand in ``seen``,
        the n-grams of a passage by their length."""
        item, *ends = self.span[segment]
        out = []
        for s, e in zip(ends[::2], ends[1::2]):
            part = grams(self.words[item][s:e].tolist())
            here = seen[min(NGRAM, e - s)] if part else ()
            out.append(sum(g in here for g in part) / len(part) if part else 1.0)
        return out


def _runs(texts: list[list[str]]) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of about ``CHUNK`` passages: text, its first passage here, and how many of them."""
    group, held = [], 0
    for n, words in enumerate(texts):
        last = (len(words) - STRIDE - 1) // STRIDE if len(words) > STRIDE else 0
        for start in range(0, last + 1 if words else 0, CHUNK):
            group.append((n, start, min(CHUNK, last + 1 - start)))
            held += group[-1][2]
            if held >= CHUNK:
                yield group
                group, held = [], 0
    if group:
        yield group


def find_items(texts: list[list[str]], index: Index, min_score: float, min_overlap: float) -> list[list[tuple]]:
    """For each text, given by its words, (item id, passage, score, question overlap, answer overlap)
    of each item in it."""
    best: list[dict[int, tuple]] = [{} for _ in texts]
    for group in _runs(texts) if index.item else ():
        # each run ends in a stride that belongs to its last passage and is none itself
        first = np.cumsum([0] + [many + 1 for _, _, many in group])
        ids = np.full(first[-1] * STRIDE, -1, np.int64)
        real, words = np.ones(first[-1], bool), np.zeros(first[-1], np.int64)
        real[first[1:] - 1] = False
        for place, (n, start, many) in zip(first.tolist(), group):
            part = texts[n][start * STRIDE:(start + many + 1) * STRIDE]
            ids[place * STRIDE:place * STRIDE + len(part)] = np.fromiter(
                map(index.number.get, part, repeat(-1)), np.int64, len(part))
            words[place:place + many] = len(texts[n])
        passage, segment, score = index.retrieve(ids, real, min_score)
        if len(passage) == 0:
            continue
        kept = index.verify(ids, words, passage, segment, min_overlap)
        seen, shown = {}, -1
        run = np.searchsorted(first, passage[kept], "right") - 1
        for p, place, x, r in zip(passage[kept].tolist(), segment[kept].tolist(), score[kept].tolist(),
                                  run.tolist()):
            if p != shown:
                here, shown = ids[p * STRIDE:(p + 2) * STRIDE].tolist(), p
                seen = {n: {tuple(here[i:i + n]) for i in range(len(here) - n + 1)}
                        for n in range(1, NGRAM + 1)}
            whole, question, answer = index.overlaps(seen, place)
            needed = index.needed[place]
            if whole >= (min_overlap if np.isnan(needed) else needed):
                n, start, _ = group[r]
                row = (index.item[place], start + p - int(first[r]), x, question, answer)
                old = best[n].get(row[0])
                if old is None or (round(x, 9), -row[1]) > (round(old[2], 9), -old[1]):
                    best[n][row[0]] = row
    return [[found[i] for i in sorted(found)] for found in best]


def build_parts(items: DataFrame, id_column: str, text: str, answer: str | None,
                part_bytes: int = PART_BYTES) -> DataFrame:
    """``part`` and ``built``, a pickled ``Index`` of about ``part_bytes`` of text, built in tasks."""
    kept = materialize(items.select(
        F.col(id_column).cast("bigint").alias("item"), F.col(text).alias("text"),
        (F.col(answer) if answer else F.lit(None)).cast("string").alias("answer"))
        .filter("item is not null").distinct(), "benchmark")
    size = kept.agg(F.sum(F.octet_length(F.concat_ws(" ", "text", "answer")))).first()[0] or 0
    rows = kept.withColumn("part", F.pmod(F.xxhash64("item"), F.lit(size // part_bytes + 1)))

    def counted(parts, texts, answers):
        for part, item, said in zip(parts, texts, answers):
            held, segments, length = item_counts(*item_words(item, said))
            yield part, None, segments, length  # an item's totals
            yield from ((part, t, n, 0) for t, n in held.items())

    counts = materialize(map_documents(rows, ["part", "text", "answer"],
                                       "part bigint, term string, held bigint, length bigint",
                                       lambda: counted), "terms")
    totals = counts.filter("term is null").agg(F.sum("held"), F.sum("length")).first()
    segments, length = totals[0] or 0, totals[1] or 0
    held = counts.filter("term is not null").groupBy("term").agg(F.sum("held").alias("held"))
    terms = (counts.filter("term is not null").select("part", "term").distinct()
             .join(held, "term").select("part", "term", "held"))

    def build(items: pa.Table, terms: pa.Table) -> pa.Table:
        found = sorted(items.select(["part", "item", "text", "answer"]).to_pylist(),
                       key=lambda r: (r["item"], r["text"] or "", r["answer"] or ""))
        index = Index([(r["item"], *item_words(r["text"], r["answer"])) for r in found],
                      dict(zip(terms["term"].to_pylist(), terms["held"].to_pylist())),
                      segments, length)
        return pa.table({"part": pa.array([r["part"] for r in found[:1]], pa.int64()),
                         "built": pa.array([pickle.dumps(index)] * len(found[:1]), pa.binary())})

    return materialize(rows.groupBy("part").cogroup(terms.groupBy("part"))
                       .applyInArrow(build, "part bigint, built binary"), "index")


def passes_of(built: DataFrame, index_bytes: int = INDEX_BYTES) -> list[list[int]]:
    """The parts to search together: measured, and first to last as many as fit ``index_bytes``."""
    passes, room = [], 0
    for part, size in built.select("part", F.length("built")).orderBy("part").collect():
        if not passes or size > room:
            passes.append([])
            room = index_bytes
        passes[-1].append(part)
        room -= size
    return passes


def _loaded(docs: DataFrame, items: DataFrame, item_id: str, item_text: str, item_answer: str | None,
            part_bytes: int, index_bytes: int) -> Iterator[tuple]:
    """For each pass, a function that gives a task the pass's indexes, and whether it is the last.  When
    the next one is asked for, the former must have been used: its broadcast is removed."""
    built = build_parts(items, item_id, item_text, item_answer, part_bytes)
    passes = passes_of(built, index_bytes)
    for place, parts in enumerate(passes):
        shared = docs.sparkSession.sparkContext.broadcast(
            [bytes(r["built"]) for r in built.filter(F.col("part").between(parts[0], parts[-1]))
             .orderBy("part").collect()])
        yield (lambda shared=shared: [pickle.loads(b) for b in shared.value]), place == len(passes) - 1
        shared.unpersist()


def find_contamination(docs: DataFrame, items: DataFrame, *, item_id: str = "item_id",
                       item_text: str = "text", item_answer: str | None = None,
                       min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP,
                       part_bytes: int = PART_BYTES, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``doc_id``, ``item_id``, ``passage``, ``score``, ``question_overlap`` and
    ``answer_overlap`` for every test item found in a document."""
    found = None
    for load, last in _loaded(docs, items, item_id, item_text, item_answer, part_bytes, index_bytes):
        def make(load=load):
            indexes = load()

            def work(ids, texts):
                words = list(map(terms_of, texts))
                for index in indexes:
                    for i, rows in zip(ids, find_items(words, index, min_score, min_overlap)):
                        yield from ((i, *row) for row in rows)

            return work

        part = map_documents(docs, ["doc_id", "text"], FOUND, make)
        part = part if last else materialize(part, "found")
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], FOUND) if found is None else found


def drop_contaminated(docs: DataFrame, items: DataFrame, *, item_id: str = "item_id",
                      item_text: str = "text", item_answer: str | None = None,
                      min_score: float = MIN_SCORE, min_overlap: float = MIN_OVERLAP,
                      part_bytes: int = PART_BYTES, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows, with all columns, whose text holds no test item."""
    for load, last in _loaded(docs, items, item_id, item_text, item_answer, part_bytes, index_bytes):
        def run(batches, load=load):
            indexes = load()
            for part in (p for batch in batches for p in text_pieces(batch, "text")):
                words = list(map(terms_of, part["text"].to_pylist()))
                clean = np.ones(len(words), bool)
                for index in indexes:
                    clean &= [not rows for rows in find_items(words, index, min_score, min_overlap)]
                yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
        docs = docs if last else materialize(docs, "clean")
    return docs
