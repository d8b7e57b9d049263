"""Personal data: high-recall candidates, boosted trees, calibrated thresholds.

*Base spans* follow fixed rules per kind (email, ip, card, phone) and always stay.
*Candidates* come from wide patterns that overlap each other and the base spans.  Boosted
regression trees score each candidate of a kind from its format (digits, separators, group
lengths, checksum) and its context (words and characters around it); no feature is the
outcome of a base rule.  The trees learn from the candidates of all documents that no base
span touches.  Positive are base spans rewritten, where they stand, into formats
that no base rule knows ('[at]', dots, no plus).  Negative are digit runs that fail the checks
of their kind, or pass them without a word of its context before; card numbers and addresses
that pass are neither.  A hash of id and text puts a document into one of three parts: the trees
learn from two, and on the third the scores are calibrated in bins, and each kind's threshold is
the lowest at which at least ``PRECISION`` of such candidates are positive.  Candidates that reach
it are added, best first, unless they overlap a span that is already there; of equal scores, which
are rounded down to thousandths, the earlier start goes first, then the kind in the order above.

Equal candidates are counted once with their number, and stay in blocks on the executors.  The
driver gets sums over blocks whose size does not grow with the input: a node's gradients by
feature and cut, and candidates by score.  These are whole numbers, so the model depends neither
on how the rows are dealt nor on the order in which tasks finish.

Offsets are code points, the end exclusive.  A null text is an empty one: no span.  Spans at
one place come once for each kind.  Repeated rows each give a row; other columns are ignored.
All patterns run in linear time on texts of any length, and overlaps are looked up in sorted spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import map_documents
from tidewell.session import materialize

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH, RATE = 40, 3, 0.2
CUTS = 32
# A node of fewer candidates is not cut.
LEAST_ROWS = 20
PRECISION = 0.98
BINS = 10
# Gradients are whole multiples of 1 / UNIT: their sums over 5e11 candidates fit 64 bits.
UNIT = 1 << 24

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# The wide patterns of the candidate generators.
_WIDE = {
    "email": re.compile(r"[\w.%+-]{1,64}(?:@| ?[\[(]at[\])] ?)[\w-]{1,63}(?:(?:\.| ?[\[(]dot[\])] ?)[\w-]{1,63}){1,8}"),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}(?:[.,-][0-9]{1,3}){3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])[0-9]{2,6}(?:[ ./-]{0,2}[0-9]{2,6}){2,6}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])[+(]?[0-9]{1,4}(?:[ ().-]{1,3}[0-9]{2,5}){2,4}(?![0-9])"),
}
_CONTEXT = {
    "email": re.compile(r"mail|contact|write", re.I),
    "ip": re.compile(r"\bip\b|host|server|address", re.I),
    "card": re.compile(r"card|visa|credit|pay|account", re.I),
    "phone": re.compile(r"phone|tel|call|fax|mobile|contact", re.I),
}


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        value = int(d) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """As the one pattern of local part, at sign and domain, looked for at each at sign."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((start, match.end()))
        done = match.end() if match else at + 1
        at = text.find("@", done)
    return found


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """The spans of the fixed rules, by kind and then start."""
    if not text:
        return []
    found = [("email", s, e) for s, e in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text)
              if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return found


def candidates(text: str | None) -> list[tuple[str, int, int]]:
    """Spans that may be personal data; they may overlap."""
    if not text:
        return []
    found = []
    for kind in KINDS:
        if kind == "email" and "@" not in text and "at]" not in text and "at)" not in text:
            continue
        found += [(kind, *m.span()) for m in _WIDE[kind].finditer(text)]
    return found


def overlap_test(spans: list[tuple[str, int, int]]):
    """A function that tells whether a start and end overlap one of the spans."""
    held = sorted((s, e) for _, s, e in spans)
    starts, reach = [s for s, _ in held], list(accumulate((e for _, e in held), max))

    def overlaps(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return before > 0 and reach[before - 1] > start

    return overlaps


def disjoint(spans) -> list[tuple[str, int, int]]:
    """The spans, in the order given, that overlap none taken before them."""
    taken, held = [], []  # held: by start; since none overlap, by end too
    for kind, s, e in spans:
        before = bisect_left(held, (e,))
        if before == 0 or held[before - 1][1] <= s:
            insort(held, (s, e))
            taken.append((kind, s, e))
    return taken


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    span = text[start:end]
    digits = "".join(c for c in span if c in "0123456789")
    groups = re.findall(r"[0-9]+", span)
    before, after = text[max(0, start - 24):start], text[end:end + 12]
    edge = lambda c: 0.0 if not c or c.isspace() else 1.0 if c in ".,;:!?)\"'" else 2.0
    return [
        float(KINDS.index(kind)), float(len(span)), float(len(digits)), float(len(groups)),
        float(len(groups[0]) if groups else 0), float(len(groups[-1]) if groups else 0),
        float(max(map(len, groups), default=0)), float(min(map(len, groups), default=0)),
        float(max((int(g[:9]) for g in groups), default=0)), float(span.count(".")),
        float(span.count("-")), float(span.count(" ")), float(span.count("(")),
        float(span[:1] == "+" or before[-1:] == "+"), float("@" in span), float(len(set(digits))),
        float(luhn(digits)) if digits else 0.0, edge(before[-1:]), edge(after[:1]),
        float(bool(_CONTEXT[kind].search(before))), float(before[-1:] in ":#="),
    ]


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, left, right = tree
    return np.where(x[:, f] <= cut, _apply(left, x), _apply(right, x))


def raw_scores(trees: list, x: np.ndarray) -> np.ndarray:
    """Sums of the trees, rounded down to thousandths and held within 30."""
    return np.floor(np.clip(_sums(trees, x), -30, 30) * 1000) / 1000


def _sums(trees: list, x: np.ndarray) -> np.ndarray:
    return sum((RATE * _apply(t, x) for t in trees), np.zeros(len(x)))


def rewrite(kind: str, span: str, turn: int) -> str:
    """A base span in a format that no base rule knows; ``turn`` chooses among several."""
    digits = "".join(c for c in span if c in "0123456789")
    if kind == "email":
        at, dot = ((" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "."))[turn % 3]
        local, _, host = span.partition("@")
        return local + at + host.replace(".", dot)
    if kind == "ip":
        return span.replace(".", "-,"[turn % 2])
    if kind == "card":
        return "./"[turn % 2].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    if turn % 3 == 0:
        return span.lstrip("+")
    return ".-"[turn % 2].join([digits[:3], digits[3:6], digits[6:10], *filter(None, [digits[10:]])])


def rewritten(text: str, turn: int) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its base spans rewritten, and where they stand now."""
    out, spans, done, size = [], [], 0, 0
    for kind, s, e in sorted(base_spans(text), key=lambda r: (r[1], r[2])):
        if s < done:
            continue
        new = rewrite(kind, text[s:e], turn + len(spans))
        size += s - done
        out += [text[done:s], new]
        spans.append((kind, size, size + len(new)))
        size, done = size + len(new), e
    return "".join([*out, text[done:]]), spans


def fails(text: str, kind: str, start: int, end: int) -> bool:
    """Whether a candidate that no base span touches counts as no personal data."""
    span = text[start:end]
    digits = "".join(c for c in span if c in "0123456789")
    if kind == "email":
        return False
    if kind == "card":
        return not (16 <= len(digits) <= 19 and luhn(digits))
    fits = (all(int(g) <= 255 for g in re.findall(r"[0-9]+", span)) if kind == "ip"
            else 8 <= len(digits) <= 15)
    return not (fits and _CONTEXT[kind].search(text[max(0, start - 24):start]))


def examples(text: str, turn: int) -> Iterator[tuple[list[float], float]]:
    """Features of the candidates that the trees learn from, and whether each is positive."""
    text, planted = rewritten(text, turn)
    touched = overlap_test(base_spans(text) if planted else [])
    starts, ends = [p[1] for p in planted], [p[2] for p in planted]
    for kind, s, e in candidates(text):
        if touched(s, e):
            continue
        near = planted[bisect_right(ends, s):bisect_left(starts, e)]
        covers = any(k == kind and s <= ps and pe <= e for k, ps, pe in near)
        if covers or not near and fails(text, kind, s, e):
            yield features(text, kind, s, e), float(covers)


# A block is (features, labels, numbers, whether it is for calibration) of distinct examples.

def _values(block: tuple) -> Counter:
    """Training examples by label, and by each feature's value to three digits."""
    x, y, n, side = block
    x, y, n = x[~side], y[~side], n[~side]
    step = 10.0 ** np.maximum(0, np.floor(np.log10(np.maximum(x, 1))) - 2)
    x, found = np.floor(x / step) * step, Counter()
    for f, column in enumerate([*x.T, y]):
        values, place = np.unique(column, return_inverse=True)
        counts = np.zeros(len(values), np.int64)
        np.add.at(counts, place, n)
        found.update({(f, float(v)): int(c) for v, c in zip(values, counts)})
    return found


def _quantiles(counts: dict[float, int], parts: int, ends: bool = True) -> np.ndarray:
    """The distinct values between so many parts of like size, and the least and largest if
    ``ends``, as ``np.quantile`` of all the values."""
    values = np.array(sorted(counts))
    upto = list(accumulate(counts[v] for v in values))
    found = []
    for i in range(parts + 1) if ends else range(1, parts):
        place, rest = divmod(i * (upto[-1] - 1), parts)
        a, b = (float(values[bisect_right(upto, min(k, upto[-1] - 1))]) for k in (place, place + 1))
        found.append(a + (b - a) * rest / parts)
    return np.unique(found)


def _node_sums(block: tuple, trees: list, splits: dict, nodes: list[int], cuts: list) -> np.ndarray:
    """Gradients, their derivatives and examples of each open node, by feature and cut."""
    x, y, n, side = block
    x, y, n = x[~side], y[~side], n[~side]
    p = 1 / (1 + np.exp(-_sums(trees, x)))
    parts = [np.rint(v * UNIT).astype(np.int64) * n for v in (p - y, np.maximum(p * (1 - p), 1e-6))] + [n]
    at = np.ones(len(x), np.int64)
    for node in sorted(splits):  # a node's children are 2 * node and 2 * node + 1
        f, cut = splits[node]
        here = at == node
        at[here] = 2 * node + (x[here, f] > cut)
    out = np.zeros((len(nodes), len(cuts), CUTS, 3), np.int64)
    for slot, node in enumerate(nodes):
        here = at == node
        for f, marks in enumerate(cuts):
            place = np.searchsorted(marks, x[here, f], side="left")
            for part, values in enumerate(parts):
                np.add.at(out[slot, f, :, part], place, values[here])
    return out


def _cut(sums: np.ndarray, cuts: list) -> tuple | None:
    """The feature and cut of a node that gain most, and the sums on both sides."""
    left = np.cumsum(sums, axis=1)
    whole = left[0, -1]
    if whole[2] < LEAST_ROWS:
        return None
    strength = lambda part: (part[..., 0] / UNIT) ** 2 / (part[..., 1] / UNIT + 1)
    best = (1e-3, None)
    for f, marks in enumerate(cuts):
        if len(marks):
            gain = (strength(left[f]) + strength(whole - left[f]) - strength(whole))[:len(marks)]
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (float(gain[i]), (f, float(marks[i]), left[f, i], whole - left[f, i]))
    return best[1]


def _tree(splits: dict, whole: dict, node: int = 1):
    """A leaf value, or (feature, cut, left, right)."""
    if node in splits:
        return (*splits[node], _tree(splits, whole, 2 * node), _tree(splits, whole, 2 * node + 1))
    return float(-(whole[node][0] / UNIT) / (whole[node][1] / UNIT + 1))


def boost(total: Callable, cuts: list) -> list:
    """Trees boosted on the logistic loss; ``total`` sums a function over all blocks."""
    trees: list = []
    for _ in range(TREES):
        splits, whole, nodes = {}, {}, [1]
        for _ in range(DEPTH):
            sums = total(lambda block: _node_sums(block, trees, splits, nodes, cuts))
            below = []
            for node, found in zip(nodes, sums):
                whole[node] = found[0].sum(axis=0)
                best = _cut(found, cuts)
                if best:
                    splits[node] = best[:2]
                    whole[2 * node], whole[2 * node + 1] = best[2:]
                    below += [2 * node, 2 * node + 1]
            nodes = [node for node in below if whole[node][2] >= LEAST_ROWS]
            if not nodes:
                break
        trees.append(_tree(splits, whole))
    return trees


def _scored(block: tuple, trees: list) -> Counter:
    """Calibration examples by kind, score and label."""
    x, y, n, side = block
    x, y, n, found = x[side], y[side], n[side], Counter()
    for place, z, label, number in zip(x[:, 0], raw_scores(trees, x), y, n):
        found[int(place), float(z), label > 0] += int(number)
    return found


def learn(total: Callable) -> dict:
    """Trees, and for each kind the least raw score that is added."""
    counts: dict[int, dict] = {}
    for (f, value), n in total(_values).items():
        counts.setdefault(f, {})[value] = n
    none = {"trees": [], "least": {k: float("inf") for k in KINDS}}
    if not counts or len(counts.pop(max(counts))) < 2:  # the labels
        return none
    cuts = [_quantiles(counts[f], CUTS, ends=False) for f in sorted(counts)]
    trees = boost(total, cuts)
    found, least = total(lambda block: _scored(block, trees)), {}
    for place, kind in enumerate(KINDS):
        good = {z: found[place, z, True] for k, z, _ in found if k == place}
        all_ = {z: n + found[place, z, False] for z, n in good.items()}
        least[kind] = float("inf")
        for cut in _quantiles(all_, BINS) if all_ else ():
            # the lowest threshold whose rows are positive often enough
            rows = sum(n for z, n in all_.items() if z >= cut)
            if sum(n for z, n in good.items() if z >= cut) >= PRECISION * rows:
                least[kind] = float(cut)
                break
    return {"trees": trees, "least": least}


def fit_texts(texts: list[str], turns: list[int] | None = None) -> dict:
    """As ``fit_pii``, of texts at hand; a text's turn stands for the hash."""
    found = Counter((n % 3 == 0, y, tuple(x)) for n, text in zip(turns or range(len(texts)), texts)
                    for x, y in examples(text, n))
    side, y, x = zip(*found) if found else ((), (), ())
    block = (np.array(x).reshape(len(x), -1), np.array(y), np.array([*found.values()], np.int64),
             np.array(side, bool))
    return learn(lambda work: work(block)) if found else learn(lambda work: Counter())


def example_rows(docs: DataFrame) -> DataFrame:
    """The examples of all documents: ``side``, ``y``, ``x`` and their number ``n``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        made = lambda: pa.RecordBatch.from_arrays(
            [*(pa.array(c, t) for c, t in zip(zip(*held), (pa.bool_(), pa.float64(), pa.list_(pa.float64())))),
             pa.array(held.values(), pa.int64())], ["side", "y", "x", "n"])
        for batch in batches:
            for turn, text in zip(batch["turn"].to_pylist(), batch["text"].to_pylist()):
                for x, y in examples(text or "", turn):
                    held[turn % 3 == 0, y, tuple(x)] += 1
                    if len(held) == 5000:
                        yield made()
                        held.clear()
        if held:
            yield made()

    turns = docs.select("text", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)).alias("turn"))
    return (turns.mapInArrow(run, "side boolean, y double, x array<double>, n bigint")
            .groupBy("side", "y", "x").agg(F.sum("n").alias("n")))


def _blocks(examples: DataFrame) -> RDD:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = b["x"].flatten().to_numpy().astype(np.float64)
                yield pa.RecordBatch.from_pydict({
                    "x": pa.array([x.tobytes()], pa.binary()),
                    **{c: pa.array([b[c].to_pylist()]) for c in ("side", "y", "n")}})

    def block(row) -> tuple:
        side = np.array(row["side"], bool)
        return (np.frombuffer(row["x"]).reshape(len(side), -1), np.array(row["y"]),
                np.array(row["n"], np.int64), side)

    packed = examples.mapInArrow(run, "x binary, side array<boolean>, y array<double>, n array<bigint>")
    return packed.rdd.map(block)


def fit_pii(docs: DataFrame) -> dict:
    """Learn from the candidates of all documents."""
    found = materialize(example_rows(docs), "pii_examples")
    blocks = _blocks(found).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if blocks.isEmpty():
            return learn(lambda work: Counter())
        # the sums meet on the executors first if there are many
        depth = 1 if blocks.getNumPartitions() <= 64 else 2
        return learn(lambda work: blocks.map(work).treeReduce(add, depth))
    finally:
        blocks.unpersist()


def finder(model: dict):
    """A function from a list of texts to [(base spans, all spans)]."""
    trees, least = model["trees"], model["least"]

    def find(texts: list):
        base = [base_spans(t) for t in texts]
        rows, owner = [], []
        for n, text in enumerate(texts):
            touched = overlap_test(base[n])
            for kind, s, e in candidates(text) if trees else ():
                if least[kind] < float("inf") and not touched(s, e):
                    rows.append((features(text, kind, s, e), kind, s, e))
                    owner.append(n)
        good: list[list] = [[] for _ in texts]
        if rows:
            z = raw_scores(trees, np.array([r[0] for r in rows]))
            for n, (_, kind, s, e), score in sorted(
                    zip(owner, rows, z), key=lambda r: (r[0], -r[2], r[1][2], KINDS.index(r[1][1]))):
                if score >= least[kind]:
                    good[n].append((kind, s, e))
        extra = [disjoint(spans) for spans in good]
        order = lambda spans: sorted(spans, key=lambda r: (KINDS.index(r[0]), r[1]))
        return [(b, order(b + x)) for b, x in zip(base, extra)]

    return find


def find_pii(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``base`` and ``spans``, both arrays of kind, start and end."""
    def make():
        find = finder(model)
        return lambda ids, texts: ((i, b, s) for i, (b, s) in zip(ids, find(texts)))

    span = "array<struct<kind:string,start:int,end:int>>"
    return map_documents(docs, ["doc_id", "text"], f"doc_id bigint, base {span}, spans {span}", make)


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each run of overlapping spans replaced by the kinds it holds."""
    if not text or not spans:
        return text
    out, done, held = [], 0, None
    for kind, s, e in sorted(spans, key=lambda r: (r[1], r[2])):
        if held and s < held[1]:
            held = (held[0], max(held[1], e), held[2] if kind in held[2] else held[2] + [kind])
            continue
        if held:
            out += [text[done:held[0]], f"[{'|'.join(held[2])}]"]
            done = held[1]
        held = (s, e, [kind])
    out += [text[done:held[0]], f"[{'|'.join(held[2])}]", text[held[1]:]]
    return "".join(out)


def redact_documents(docs: DataFrame, model: dict, length: str | None = "n_chars") -> DataFrame:
    """The rows with the spans in ``text`` replaced; ``length``, if there, is counted anew."""
    def run(batches):
        find = finder(model)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            new = [redact(t, spans) for t, (_, spans) in zip(texts, find(texts))]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            size = batch.schema.get_field_index(length) if length else -1
            if size >= 0:
                field = batch.schema.field(size)
                batch = batch.set_column(size, field, pa.array(
                    [None if t is None else len(t) for t in new], field.type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
