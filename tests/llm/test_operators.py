"""Text operators on edge rows, and against plain versions of what they compute."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from tests.conftest import SF_DIR
from tidewell.llm import common, decontaminate, elias_fano, language, near_duplicates, nearest, pii, quality, toxicity
from tidewell.llm.common import hash_words, read_table, words_of
from tidewell.llm.components import connected_components
from tidewell.llm.elias_fano import EliasFano, Trie
from tidewell.llm.language_model import score_texts
from tidewell.llm.queries import QUERIES, SQL

EDGE = [(1, None, 9), (2, "", 9), (3, "x", 9), (4, "Plain words stand here. No more.\n", 9),
        (4, "Plain words stand here. No more.\n", 9), (None, "no id at all in this row", 9),
        (5, "w" * 50_000, 9), (6, " \n\t ", 9), (7, "é 語 😀 ... 123", 9)]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and long texts, repeats, and a column with a name of the results."""
    return spark.createDataFrame(EDGE, "doc_id bigint, text string, score int")


@pytest.fixture(scope="module")
def documents():
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([], "doc_id bigint, toxic int, quality int")


def test_word_hashes_tell_words_apart(documents):
    texts = [t for _, t in documents] + [None, "", "A a\x0ba\fb"]
    hashes, sizes = hash_words(texts)
    words = [w for t in texts for w in words_of(t)]
    assert sizes.tolist() == [len(words_of(t)) for t in texts]
    assert len(set(zip(words, hashes.tolist()))) == len(set(words)) == len(set(hashes.tolist()))


# near duplicates

def _plain_components(rows, n):
    sets, parent = {}, {}
    for i, text in rows:
        words = words_of(text)
        sets[i] = ({tuple(words[k:k + n]) for k in range(len(words) - n + 1)} if len(words) >= n
                   else {tuple(words)} if words else set())
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_components_are_those_of_all_pairs(spark, documents):
    expected = _plain_components(documents, 4)
    found = QUERIES["op10_minhash_near_dedup"](spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    assert sorted(con.execute(SQL["op10_minhash_near_dedup"]).fetchall()) == sorted(tuple(r) for r in found)


def test_a_large_key_is_taken_apart_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    rng = np.random.default_rng(1)
    rows, base = [], [f"w{i}" for i in range(60)]
    for i in range(60):
        words = list(base)
        for at in rng.choice(60, rng.integers(0, 4), replace=False):
            words[at] = f"v{rng.integers(1000)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = near_duplicates.near_duplicates(docs, 4, 80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == _plain_components(rows, 4)


def test_near_duplicates_edge_rows(edge):
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
             for r in near_duplicates.near_duplicates(edge).collect()}
    assert found == {(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 2, 4, True),
                     (None, 3, None, True), (5, 1, 5, True), (6, 0, 6, True), (7, 1, 7, True)}
    assert near_duplicates.near_duplicates(edge.limit(0)).count() == 0
    kept = near_duplicates.drop_near_duplicates(edge)
    assert kept.columns == edge.columns and kept.count() == len(EDGE) - 1


def test_sketch_estimates_and_bounds():
    rng = np.random.default_rng(2)
    sets = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    a, b = np.unique(sets[:900]), np.unique(sets[100:])
    bits = [np.unpackbits((x ^ y).view(np.uint8)).sum() for x, y in (
        (near_duplicates.odd_sketch(near_duplicates.min_hashes(a)),
         near_duplicates.odd_sketch(near_duplicates.min_hashes(b))),
        (near_duplicates.parity_bitmap(a), near_duplicates.parity_bitmap(b)))]
    assert abs(near_duplicates.estimate(int(bits[0])) - 0.8) < 0.15
    assert bits[1] <= 200


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(10, 40)] + [(2, 3), (3, 3)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert found == {**{i: 10 for i in range(10, 41)}, 2: 2, 3: 2}


# language model

def test_base_scores_and_counts(spark, documents):
    split = lambda t: words_of(t) + [b"\n"]
    counts = Counter()
    for i, text in documents:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(split(text))
    n, v = sum(counts.values()), len(counts)
    better = 0
    for r in QUERIES["op6_language_model"](spark, SF_DIR).collect():
        words = split(dict(documents)[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            len(words), sum(counts[w] > 0 for w in words), n)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        better += r["score"] > r["base_score"] if r["held_out"] else 0
    assert better > 100


def test_language_model_edge_rows(edge):
    rows = score_texts(edge).collect()
    assert sorted(r["n_tokens"] for r in rows) == sorted(
        len(words_of(t)) + 1 for _, t, _ in EDGE)
    assert all(r["score"] <= 0 for r in rows) and score_texts(edge.limit(0)).count() == 0


def test_elias_fano_finds_and_restores():
    rng = np.random.default_rng(3)
    values = np.unique(rng.integers(0, 1 << 40, 5000, dtype=np.uint64))
    coded = EliasFano(EliasFano.encode(values, 1 << 40))
    assert (coded.decode() == values).all()
    assert (coded.find(values) == np.arange(len(values))).all()
    others = np.setdiff1d(rng.integers(0, 1 << 41, 500, dtype=np.uint64), values)
    assert (coded.find(others) == -1).all()
    empty = EliasFano(EliasFano.encode(values[:0], 10))
    assert len(empty.decode()) == 0 and empty.find(values[:3]).tolist() == [-1] * 3


def test_segments_are_unpacked_alone(monkeypatch):
    monkeypatch.setattr(elias_fano, "_STRETCH", 16)
    rng = np.random.default_rng(4)
    values = np.sort(rng.integers(0, 1 << 20, 3000, dtype=np.uint64))
    coded = EliasFano(EliasFano.encode(values, 1 << 20))
    for a, b in ((0, 0), (0, 3000), (17, 18), (1000, 2500), (2999, 3000)):
        assert (coded.segment(a, b) == values[a:b]).all()


@pytest.mark.parametrize("piece", [2, 1 << 16])
def test_trie_gives_what_was_put_in(monkeypatch, piece):
    monkeypatch.setattr(elias_fano, "PIECE", piece)
    keys = np.array([3 * 10 + 1, 3 * 10 + 7, 3 * 10 + 8, 5 * 10 + 1, 7 * 10 + 9], np.uint64)
    trie = Trie(np.frombuffer(Trie.build(keys, 10, np.array([11, 12, 14, 13, 15], np.uint8)), np.uint8))
    code, many = trie.look_up(np.array([3, 3, 3, 4, 5, 7, 7], np.uint64), np.array([0, 2, 7, 1, 1, 8, 9], np.uint64))
    assert code.tolist() == [0, 0, 12, 0, 13, 0, 15] and many.tolist() == [3, 3, 3, 0, 1, 1, 1]


def test_codes_of_counts():
    counts, totals = np.array([0, 1, 32, 33, 10 ** 6, 7 * 10 ** 11]), np.array([5, 9, 40, 50, 10 ** 9, 10 ** 12])
    shares = elias_fano.discounted(elias_fano.code_counts(counts, totals), totals, 0.5)
    exact = np.maximum(counts - 0.5, 0) / totals
    assert np.allclose(shares[:3], exact[:3], rtol=1e-12)
    assert (np.abs(np.log10(shares[3:] / exact[3:])) <= elias_fano._STEP / 2 * 1.02).all()


# decontamination

def test_items_are_found_where_they_stand(spark, documents):
    items = duckdb.connect().execute(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
    plain = lambda t: " ".join(decontaminate.terms_of(t))
    expected = {(d, i) for d, t in documents for i, x in items if plain(x) in plain(t)}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op9_decontaminate"](spark, SF_DIR).collect()}
    assert found == expected and expected


def _plain_bm25(items):
    """Of whole items of at most 64 words without telling parts: score of a passage for each."""
    held = Counter(t for words in items for t in set(words))
    mean = sum(map(len, items)) / len(items)

    def impacts(words):
        return {t: np.log(1 + (len(items) - held[t] + 0.5) / (held[t] + 0.5)) * c * 2.2
                / (c + 1.2 * (0.25 + 0.75 * len(words) / mean)) for t, c in Counter(words).items()}

    found = [impacts(words) for words in items]
    return lambda passage: [sum(x for t, x in f.items() if t in passage) / sum(f.values()) for f in found]


def test_wand_finds_all_above_the_threshold():
    rng = np.random.default_rng(4)
    items = [[f"t{x}" for x in rng.zipf(1.3, 9) % 200] for i in range(120)]
    index = decontaminate.Index([(i, words, 4) for i, words in enumerate(items)])
    plain, some = _plain_bm25(items), 0
    assert index.item == list(range(120))
    for size in (3, 64, 129, 700, 10_000):
        words = [f"t{x}" for x in rng.zipf(1.3, size) % 300]
        words[size // 2:size // 2 + 5] = items[size % 120][:5]
        ids = np.array([index.number.get(w, -1) for w in words], np.int64)
        last = max(0, (len(words) - 65) // 64)
        for least in (0.3, 0.6):
            expected = {(p, s) for p in range(last + 1)
                        for s, x in enumerate(plain(set(words[p * 64:p * 64 + 128]))) if x >= least - 1e-9}
            padded = np.full((last + 2) * 64, -1)  # at most 128 words after the last start
            padded[:len(ids)] = ids
            passage, segment, score = index.retrieve(padded, np.arange(last + 2) <= last, least)
            assert set(zip(passage.tolist(), segment.tolist())) == expected
            assert np.all(score >= least - 1e-9)
            some += len(expected)
    assert some > 100


def _plain_items(text, items, min_score, min_overlap):
    """Item ids found in a text by reading the rules of the module one after the other."""
    words = decontaminate.terms_of(text)
    split = [(i, *decontaminate.item_words(t, a)) for i, t, a in items]
    pieces = [(i, w, seg) for i, w, asked in split for seg in decontaminate.segments_of(len(w), asked)]
    plain = _plain_bm25([w[seg[0]:seg[1]] for _, w, seg in pieces])
    found = set()
    for p in range(max(0, (len(words) - 65) // 64) + 1 if words else 0):
        passage = words[p * 64:p * 64 + 128]
        for (i, w, (s, e, *_, needed)), score in zip(pieces, plain(set(passage))):
            n = min(5, e - s)
            seen = {tuple(passage[j:j + n]) for j in range(len(passage) - n + 1)}
            share = np.mean([g in seen for g in {tuple(w[j:j + n]) for j in range(s, e - n + 1)}])
            if score >= min_score - 1e-9 and share >= (min_overlap if needed is None else needed) \
                    and (n == 5 or words == w):
                found.add(i)
    return found


def test_contamination_equals_the_plain_rules(spark):
    rng = np.random.default_rng(8)
    word = lambda: f"w{int(rng.zipf(1.4)) % 120}"
    run = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(run(int(rng.integers(1, 14)))) if i % 3 else " ".join(run(int(rng.integers(20, 160)))),
              None if i % 2 else " ".join(run(int(rng.integers(0, 30))))) for i in range(40)]
    items += [(40, "Paris", None), (41, None, "w1 w2"), (42, None, None), (3, items[3][1], items[3][2])]
    docs = []
    for i in range(250):
        text = run(int(rng.integers(0, 300)))
        held = decontaminate.item_words(*items[int(rng.integers(40))][1:])[0]
        at, size = int(rng.integers(0, len(held))), int(rng.integers(1, 80))
        docs.append((i, " ".join(text + held[at:at + size] + run(int(rng.integers(0, 90))))))
    docs += [(250, "I went to Paris last spring"), (251, "paris."), (252, None), (253, ""), (254, "w1 w2")]
    table = spark.createDataFrame(items, "item_id bigint, text string, answer string")
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    unique = sorted(set(items), key=str)
    expected = {(d, i) for d, t in docs for i in _plain_items(t, unique, 0.3, 0.5)}
    assert (251, 40) in expected and (250, 40) not in expected and len(expected) > 60
    seen = []
    for sizes in ({}, {"part_bytes": 700, "index_bytes": 60_000}):
        found = decontaminate.find_contamination(rows, table, item_answer="answer", **sizes).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == expected and len(found) == len(expected)
        kept = decontaminate.drop_contaminated(rows, table, item_answer="answer", **sizes)
        assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in expected}
        seen.append(sorted((r["doc_id"], r["item_id"], r["passage"], round(r["score"], 9),
                            r["question_overlap"], r["answer_overlap"]) for r in found))
    assert seen[0] == seen[1]
    parts = decontaminate.build_parts(table, "item_id", "text", "answer", 700)
    assert len(decontaminate.passes_of(parts, 60_000)) > 1 and parts.count() > 3


def test_a_very_long_text_is_searched_in_pieces():
    items = [(i, [f"t{i}_{j}" for j in range(30)], 15) for i in range(50)]
    index = decontaminate.Index(items)
    words = ["so", "on"] * 400_000 + items[7][1] + ["so"] * 100_001 + items[9][1][:15]
    found = decontaminate.find_items([words, [], items[3][1], words[:90]], index, 0.3, 0.5)
    assert [[r[0] for r in rows] for rows in found] == [[7, 9], [], [3], []]


def test_a_small_bound_of_blocks_changes_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    items = [(i, [f"t{x}" for x in rng.zipf(1.3, 30) % 200], 15) for i in range(60)]
    texts = [[f"t{x}" for x in rng.zipf(1.3, 700) % 300] + items[i][1] for i in range(9)]
    index = decontaminate.Index(items)
    whole = decontaminate.find_items(texts, index, 0.2, 0.3)
    monkeypatch.setattr(decontaminate, "ENTRIES", 50)
    monkeypatch.setattr(decontaminate, "CHUNK", 3)
    assert decontaminate.find_items(texts, index, 0.2, 0.3) == whole and all(whole)


def test_contamination_edge_rows(spark, edge):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "Plain words, stand here; no more")],
                                  "item_id bigint, text string")
    rows = decontaminate.find_contamination(edge, items).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(4, 3), (4, 3)]
    kept = decontaminate.drop_contaminated(edge, items)
    assert kept.count() == len(EDGE) - 2 and kept.columns == edge.columns
    assert decontaminate.find_contamination(edge, items.limit(0)).count() == 0


def test_a_long_item_leaves_no_short_segment(spark):
    words = [f"w{i}" for i in range(64)] + ["the", "end"]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    docs = spark.createDataFrame(
        [(1, "this is the end of a clean text"), (2, "so " * 70 + " ".join(words) + " so on"),
         (3, "again " * 31 + " ".join(words[33:]))], "doc_id bigint, text string")
    found = {r["doc_id"] for r in decontaminate.find_contamination(docs, items).collect()}
    assert found == {2, 3}
    assert decontaminate.drop_contaminated(docs, items).count() == 1


# personal data

_BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
         "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _plain_spans(text):
    def fits(kind, span):
        digits = re.sub("[^0-9]", "", span)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in span.split(".")),
                "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
    return [(k, *m.span()) for k, p in _BASE.items() for m in re.finditer(p, text) if fits(k, m[0])]


def test_base_spans_are_those_of_the_patterns(documents):
    rng = np.random.default_rng(6)
    made = ["".join(rng.choice(list("a1@.-+ (0259_x"), rng.integers(0, 40))) for _ in range(20_000)]
    for text in made + [t for _, t in documents]:
        assert pii.base_spans(text) == _plain_spans(text)


def test_redaction_and_edge_rows(spark, edge):
    model = pii.fit_pii(edge)
    rows = pii.find_pii(edge, model).collect()
    assert len(rows) == len(EDGE) and not any(r["spans"] for r in rows)
    text = "to a.b@c.de and 10.0.0.1"
    docs = spark.createDataFrame([(1, text, 24), (2, None, None)], "doc_id bigint, text string, n_chars bigint")
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.redact_documents(docs, model).collect()}
    assert out == {1: ("to [email] and [ip]", 19), 2: (None, None)}
    assert pii.redact("abcdef", [("ip", 1, 3), ("card", 2, 5)]) == "a[ip|card]f"


# classifiers

@pytest.mark.parametrize("name, column, part, side, least", [
    ("op7_toxicity", "toxic", 4, 2, 0.95), ("op2_quality", "quality", 5, 0, 0.95)])
def test_held_out_labels(spark, name, column, part, side, least):
    labels = {r["doc_id"]: r[column] for r in read_table(spark, SF_DIR, "labels").collect()}
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % part == side) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) >= least


def test_held_out_languages(spark):
    lang = {r["doc_id"]: r["lang"] for r in read_table(spark, SF_DIR, "documents").collect()}
    rows = [r for r in QUERIES["op1_language_id"](spark, SF_DIR).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in rows]) >= 0.97


def test_classifiers_without_labels(edge, labels):
    toxic = toxicity.score_toxicity(edge, toxicity.fit_toxicity(edge, labels)).collect()
    assert len(toxic) == len(EDGE) and all(r["score"] < 1e-6 and not r["offending"] for r in toxic)
    good = quality.score_quality(edge, quality.fit_quality(edge, labels)).collect()
    assert len(good) == len(EDGE) and {r["score"] for r in good} == {0.5}
    from pyspark.sql import functions as F
    model = language.fit_language(edge.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language.identify_language(edge, model).collect()} == {"und"}
    one = language.fit_language(edge.withColumn("lang", F.lit("xx")))
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify_language(edge, one).collect()}
    assert found[1] == found[2] == found[6] == "und" and found[4] == found[7] == "xx"


def test_an_id_with_many_rows_stays_within_the_sample(spark):
    from pyspark.sql import functions as F
    docs = spark.range(3000).select(F.lit(1).cast("bigint").alias("doc_id"), F.col("id").cast("string").alias("text"))
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, toxic int")
    sample = common.labelled_sample(docs, labels, "toxic", 10, 4, 2)
    assert 0 < sample.count() <= 2 * common.most_rows(10)


def test_noisy_or_and_offending_sentences():
    model = toxicity.fit_bags(["good day. you fool. fine"] * 20 + ["good day. fine"] * 30, [1] * 20 + [0] * 30)
    score, found = toxicity.sentence_scorer(model)("Fine. You FOOL! good day")
    assert score > 0.5 and [(s, e) for s, e, _ in found] == [(5, 14)]


def test_chain_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(8)
    emission, turn, sizes = rng.normal(size=7), rng.normal(size=3), np.array([3, 1, 3])
    p, log_z, _ = quality.marginals(emission, sizes, turn)
    at = 0
    for size, z in zip(sizes, log_z):
        total, bad = 0.0, np.zeros(size)
        for path in np.ndindex(*[2] * size):
            score = sum(emission[at + t] for t in range(size) if path[t])
            score += sum({(0, 1): turn[0], (1, 0): turn[1], (1, 1): turn[2]}.get(pair, 0.0)
                         for pair in zip(path, path[1:]))
            total += math.exp(score)
            bad += np.array(path) * math.exp(score)
        assert z == pytest.approx(math.log(total)) and p[at:at + size] == pytest.approx(bad / total)
        at += size


def test_codewords_are_apart():
    for k in (2, 4, 7, 12):
        code = language.codewords(k)
        assert code.shape[0] == k and len({tuple(r) for r in code}) == k


# nearest neighbours

def test_recall_and_exact_scores(spark):
    vectors = {r["vec_id"]: np.array(r["embedding"], float)
               for r in read_table(spark, SF_DIR, "embeddings").collect()}
    ids, x = np.array(sorted(vectors)), np.array([vectors[i] for i in sorted(vectors)])
    found = {}
    for r in QUERIES["op3_nearest_neighbours"](spark, SF_DIR).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(found) == [i for i in ids.tolist() if i % 20 == 0]
    hits = 0
    for q, ranks in found.items():
        scores = x @ vectors[q]
        assert sorted(ranks) == list(range(1, 21))
        assert all(abs(s - scores[np.searchsorted(ids, v)]) < 1e-12 for v, s in ranks.values())
        scores[np.searchsorted(ids, q)] = -np.inf
        hits += len({v for v, _ in ranks.values()} & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert hits / (20 * len(found)) >= 0.9


def test_equal_and_unfit_vectors(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 60)] + [
        (100, None), (101, [0.0, 0.0]), (102, [None, 1.0]), (103, [float("nan"), 1.0]), (104, [1.0]), (105, [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = {}
    for r in nearest.nearest_neighbours(vectors, every=20, k=20).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == [0, 20, 40]
    for q, got in found.items():
        others = [i for i in range(60) if i != q][:20]
        assert sorted(got) == [(n + 1, i, 1.0) for n, i in enumerate(others)]
    assert nearest.nearest_neighbours(vectors.limit(0)).count() == 0


# pipeline

def test_pipeline_stages_keep_rows_and_columns(spark):
    docs = read_table(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count(), name
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name


def test_pipeline_result(spark):
    kept = {r["doc_id"]: r["decoded"] for r in corpus_pipeline.run(spark, SF_DIR).select("doc_id", "decoded").collect()}
    assert kept and not any(pii.base_spans(t) for t in kept.values())


def test_last_stage_keeps_all_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "en", 7), (2, None, None, None)],
                                 "doc_id bigint, text string, lang string, n_tokens int")
    out = corpus_pipeline.tokenize(spark, docs, SF_DIR)
    assert out.columns == ["doc_id", "tokens", "n_tokens", "decoded", "text", "lang"]
    assert {(r["doc_id"], r["text"], r["lang"]) for r in out.collect()} == {(1, "a b", "en"), (2, None, None)}
