"""Near duplicates where ids and rows repeat; vectors of doubles."""

from tidewell.llm import near_duplicates
from tidewell.llm.nearest import nearest_neighbours

A = " ".join(f"a{i}" for i in range(80))
B = " ".join(f"b{i}" for i in range(80))


def test_each_row_of_an_id_is_placed_by_its_own_text(spark):
    rows = [(9, A), (9, B), (3, A + " more"), (12, B), (9, B), (20, ""), (20, " "), (None, A)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, kept string")
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
             for r in near_duplicates.near_duplicates(docs).collect()}
    assert found == {(9, 76, 3, False), (9, 76, 9, True), (3, 77, 3, True), (12, 76, 9, False),
                     (20, 0, 20, True), (None, 76, None, True)}
    kept = near_duplicates.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(
        [(9, B), (3, A + " more"), (20, ""), (20, " "), (None, A)], key=str)


def test_repeated_rows_are_verified_once(spark, monkeypatch):
    pairs = []
    real = near_duplicates.verified

    def counting(tried, texts, shingle, percent):
        joined = (tried.select("a", "b").join(texts.selectExpr("rep AS a"), "a")
                  .join(texts.selectExpr("rep AS b"), "b"))
        pairs.append(joined.count())
        return real(tried, texts, shingle, percent)

    monkeypatch.setattr(near_duplicates, "verified", counting)
    rows = [(1, A)] * 300 + [(2, A + " more")] * 300
    found = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {(r["doc_id"], r["component_id"]) for r in found.collect()} == {(1, 1), (2, 1)}
    assert pairs == [1]


def test_doubles_are_not_rounded(spark):
    rows = [(i, [1.0, 1.0 + (59 - abs(59 - i)) * 1e-9]) for i in range(100)] + [(200, [1e60, 1e60]), (201, [1e60, None])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    near = sorted((r["rank"], r["vec_id"], r["score"]) for r in nearest_neighbours(
        vectors, every=100, k=3).collect() if r["query_id"] == 0)
    assert [v for _, v, _ in near] == [200, 59, 58]
    assert near[1][2] == 1.0 * 1.0 + 1.0 * (1.0 + 59e-9)
