"""Benchmark items of which a document holds only a part."""

from tidewell.llm import decontaminate


def _found(spark, items, docs, **options):
    items = spark.createDataFrame(items, "item_id bigint, text string, answer string")
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = decontaminate.find_contamination(docs, items, **options).collect()
    kept = decontaminate.drop_contaminated(docs, items, **options)
    assert {r["doc_id"] for r in kept.collect()} == {d[0] for d in docs.collect()} - {r["doc_id"] for r in found}
    return {(r["doc_id"], r["item_id"]): (r["question_overlap"], r["answer_overlap"]) for r in found}


def test_a_question_or_a_telling_answer_is_enough(spark):
    question, answer = [" ".join(f"{c}{i}" for i in range(20)) for c in "qa"]
    docs = [(1, f"so {question} on"), (2, f"so {answer} on"), (3, f"so {question} {answer} on"), (4, "q1 q2 a1")]
    for options in ({"item_answer": "answer"}, {}):
        text = question if options else f"{question} {answer}"
        found = _found(spark, [(7, text, answer)], docs, **options)
        assert found == {(1, 7): (1.0, 0.0), (2, 7): (0.0, 1.0), (3, 7): (1.0, 1.0)}


def test_short_parts_are_found_whole_or_not_at_all(spark):
    item = (7, "what is the largest of all moons", "it is titan")
    docs = [(1, "ask what is the largest of all moons then"), (2, "ask what is the largest of it"),
            (3, "I said it is titan")]
    assert set(_found(spark, [item], docs, item_answer="answer")) == {(1, 7)}


def test_a_run_across_the_cut_of_a_long_item(spark):
    words = [f"w{i}" for i in range(120)]
    docs = [(s, "so on " * 40 + " ".join(words[s:s + 56]) + " so on" * 40) for s in range(0, 65, 8)]
    assert {d for d, _ in _found(spark, [(7, " ".join(words), None)], docs)} == {d for d, _ in docs}
