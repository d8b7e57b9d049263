import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql import Observation

from tidewell.operators import (
    CLASSIFIERS, accuracy, assemble, compare_classifiers, index_strings, majority_accuracy,
    score, with_label,
)
from tidewell.operators.models import bins_needed, fit


@pytest.fixture(scope="module")
def points(spark):
    """Two groups that a line separates."""
    rows = [(float(i >= 100), Vectors.dense([float(i), float(i % 7)])) for i in range(200)]
    return spark.createDataFrame(rows, ["label", "features"]).repartition(4).cache()


def test_every_classifier_beats_the_majority(points):
    result = {r["model"]: r for r in compare_classifiers(points, points).collect()}
    assert set(result) == set(CLASSIFIERS) and len(result) == 6
    for row in result.values():
        assert row["test_error"] == pytest.approx(1 - row["accuracy"])
        assert row["majority_accuracy"] == 0.5
        assert row["accuracy"] >= 0.5
    for name in ("decision_tree", "random_forest", "gradient_boosted_trees"):
        assert result[name]["accuracy"] > 0.98


def test_the_forest_is_a_forest(points):
    model = fit("random_forest", points)
    assert len(model.trees) == 20
    assert len(fit("gradient_boosted_trees", points).trees) == 10


def test_same_seed_same_forest(points):
    first, second = (fit("random_forest", points).toDebugString.split("\n", 1)[1]
                     for _ in range(2))
    assert first == second


def test_scores_after_metrics_were_observed(spark, points):
    seen = Observation()
    points.observe(seen, F.count("*").alias("n")).count()
    assert seen.get["n"] == 200
    scored = score(fit("logistic_regression", points), points)
    assert scored.columns == ["prediction", "label", "features"]
    assert accuracy(scored) > 0.9


def test_accuracy_is_the_share_of_matches(spark):
    df = spark.createDataFrame([(1.0, 1.0), (0.0, 1.0), (0.0, 0.0), (1.0, 1.0)],
                               "prediction double, label double")
    assert accuracy(df) == 0.75
    assert majority_accuracy(df) == 0.75


def test_boolean_label(spark):
    df = with_label(spark.createDataFrame([(True,), (False,)], "label boolean"), "label")
    assert sorted(r[0] for r in df.collect()) == [0.0, 1.0]


def test_trees_get_a_bin_for_every_label(spark):
    df = spark.range(200).select(
        F.concat(F.lit("s"), (F.col("id") % 50).cast("string")).alias("s"),
        (F.col("id") % 50 < 25).cast("double").alias("label"))
    ready = assemble(index_strings(df, ["s"]), ["s_index"])
    assert bins_needed(ready) == 50
    assert accuracy(score(fit("decision_tree", ready), ready)) == 1.0


def test_naive_bayes_rejects_negative_features(spark):
    df = spark.createDataFrame([(0.0, Vectors.dense([-1.0])), (1.0, Vectors.dense([1.0]))],
                               ["label", "features"])
    with pytest.raises(Exception, match="(?i)negative"):
        fit("naive_bayes", df)
