"""The registered queries of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm.common import fold, read_table
from tidewell.llm.decontaminate import find_contamination
from tidewell.llm.filter_audit import audit_filters
from tidewell.llm.language import fit_language, identify_language
from tidewell.llm.language_model import score_texts
from tidewell.llm.line_runs import drop_frequent_lines
from tidewell.llm.near_duplicates import near_duplicates
from tidewell.llm.nearest import nearest_neighbours
from tidewell.llm.pii import KINDS, find_pii, fit_pii
from tidewell.llm.quality import fit_quality, score_quality
from tidewell.llm.resampling import resample
from tidewell.llm.sentencepiece import encode_documents
from tidewell.llm.token_counts import count_tokens
from tidewell.llm.toxicity import fit_toxicity, score_toxicity


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
        F.get(F.sort_array(F.transform(
            "offending", lambda s: F.struct((-s["score"]).alias("p"), s["start"], s["end"]))),
            0).alias("worst")).select(
        "doc_id", "held_out", "score", "predicted", "n_offending",
        F.col("worst.start").alias("worst_start"), F.col("worst.end").alias("worst_end"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose 4-word shingle sets reach a similarity of 0.8."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, by BM25 search of all passages."""
    return find_contamination(read_table(spark, sf_dir, "documents"),
                              read_table(spark, sf_dir, "benchmark"))


def _joined(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans counted and hashed, and all spans."""
    docs = read_table(spark, sf_dir, "documents")
    found = find_pii(docs, fit_pii(docs))

    def count(kind: str):
        return (F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
                .alias(f"n_{kind}"))

    return found.select("doc_id", *[count(k) for k in KINDS],
                        F.sha2(_joined("base"), 256).alias("base_sha256"),
                        _joined("spans").alias("spans"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they decode to the text (null: empty)."""
    docs = read_table(spark, sf_dir, "documents")
    same = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    encoded = encode_documents(same)
    return encoded.select("doc_id", "n_tokens", "tokens",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens of every document."""
    return count_tokens(read_table(spark, sf_dir, "documents"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    return identify_language(docs, fit_language(docs)).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned outside the held-out fold."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("bad").alias("n_lines"),
        F.size(F.filter("bad", lambda p: p >= 0.5)).alias("n_bad_lines"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth vector."""
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), every=20, k=20)


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document, learned outside the held-out fold."""
    return score_texts(read_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and noisy score of every document, and the rank of those drawn towards the benchmark."""
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that at least ten documents hold."""
    return drop_frequent_lines(read_table(spark, sf_dir, "documents"), limit=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes, in all 120 orders, for each language."""
    return audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES = {fn.__name__: fn for fn in (
    op1_language_id, op2_quality, op3_nearest_neighbours, op4_sentencepiece, op5_pii, op6_language_model,
    op7_toxicity, op8_token_counts, op9_decontaminate, op10_minhash_near_dedup,
    op11_importance_resampling, op12_line_dedup, op13_filter_audit)}

# Shingle sets, all linked pairs and the smallest id reachable.
SQL = {"op10_minhash_near_dedup": r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    places AS (
        SELECT doc_id, len(w) AS n_words, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
    runs AS (
        SELECT doc_id, i, n_words, concat_ws(' ', word, lead(word, 1) OVER p, lead(word, 2) OVER p,
            lead(word, 3) OVER p) AS shingle
        FROM places WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
    shingles AS (SELECT DISTINCT doc_id, shingle FROM runs WHERE i <= greatest(1, n_words - 3)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    members AS (SELECT doc_id, shingle, n FROM shingles JOIN sizes USING (doc_id)),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
            AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (
        SELECT a AS doc_id, b AS other FROM both_ways
        UNION
        SELECT r.doc_id, l.b FROM reached r JOIN both_ways l ON r.other = l.a),
    least_reached AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id),
    placed AS (
        SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id
        FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached USING (doc_id))
    SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM placed
""",
# CRC-32 byte by byte over the distinct words' bytes, by a table built in SQL.
"op11_importance_resampling": r"""
    WITH crc_table AS (
        SELECT list(list_reduce(list_prepend(b::BIGINT, range(8)),
            lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY b) AS t
        FROM range(256) r(b)),
    texts AS (
        SELECT 'd' AS kind, doc_id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
    split AS (
        SELECT kind, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM texts),
    features AS (SELECT kind, doc_id, unnest(w) AS word FROM split),
    words AS (
        SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(word) + 1),
            lambda i: ('0x' || substr(hex(word), (2 * i - 1)::INT, 2))::BIGINT)),
            lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
        FROM (SELECT DISTINCT word FROM features), crc_table),
    placed AS (SELECT kind, doc_id, bucket FROM features JOIN words USING (word)),
    counts AS (
        SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM placed GROUP BY bucket),
    totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM counts),
    gains AS (
        SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000)
            / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain FROM counts, totals),
    weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM placed JOIN gains USING (bucket)
        WHERE kind = 'd' GROUP BY doc_id),
    scored AS (
        SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
            coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
                (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
        FROM split LEFT JOIN weights USING (doc_id) WHERE kind = 'd'),
    drawn AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
        FROM scored WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
    FROM scored LEFT JOIN drawn USING (doc_id)
""",
"op12_line_dedup": r"""
    WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
    lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM split),
    keyed AS (
        SELECT doc_id, line, i, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM lines),
    frequent AS (
        SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
    marked AS (SELECT doc_id, line, i, frequent.key IS NOT NULL AS gone FROM keyed LEFT JOIN frequent USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
""",
# Each row's failed filters as a string, then every order of the letters.
"op13_filter_audit": r"""
    WITH words AS (
        SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    firsts AS (SELECT text, min(doc_id) AS first FROM words GROUP BY text),
    marks AS (SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good,
        max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY doc_id),
    failed AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, concat(
            CASE WHEN len(w) < 100 THEN 'A' END,
            CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
            CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) THEN 'C' END,
            CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
            CASE WHEN doc_id > first THEN 'E' END) AS f
        FROM words JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
    kinds AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, f),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x)
            AND e.x NOT IN (a.x, b.x, c.x, d.x)),
    steps AS (
        SELECT filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS own,
            substr(filter_order, 1, step::INT - 1) AS earlier
        FROM orders, range(1, 6) r(step)),
    met AS (
        SELECT *, contains(f, own) AS fails, translate(f, earlier, '') <> f AS gone FROM kinds, steps)
    SELECT part, filter_order, step,
        coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
        coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
        coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
        coalesce(sum(n) FILTER (f = own), 0)::BIGINT AS unique_fails,
        coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
        coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost,
        sum(coalesce(sum(n) FILTER (fails AND NOT gone), 0)) OVER (PARTITION BY part, own)::BIGINT AS shapley
    FROM met GROUP BY part, filter_order, step, own
"""}
