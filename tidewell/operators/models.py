"""Classifiers and their evaluation."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Model
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import scratch_dir
from tidewell.sources.local import rows_from_list

SEED = 11

CLASSIFIERS: dict[str, Callable] = {
    "logistic_regression": lambda bins, **c: LogisticRegression(**c),
    "decision_tree": lambda bins, **c: DecisionTreeClassifier(seed=SEED, maxBins=bins, **c),
    "random_forest": lambda bins, **c: RandomForestClassifier(seed=SEED, maxBins=bins, **c),
    "gradient_boosted_trees":
        lambda bins, **c: GBTClassifier(**{"maxIter": 10} | c, seed=SEED, maxBins=bins),
    # Multinomial: all features must be zero or more, MLlib checks that.
    "naive_bayes": lambda bins, **c: NaiveBayes(**c),
    "linear_svc": lambda bins, **c: LinearSVC(**c),
}

DEFAULT_BINS = 32


def bins_needed(df: DataFrame, features: str = "features") -> int:
    """Trees need a bin for every label of an indexed column."""
    groups = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    labels = [len(attr.get("vals", ())) for attr in groups.get("nominal", ())]
    return max([DEFAULT_BINS, *labels])


def with_label(df: DataFrame, label: str) -> DataFrame:
    """Label as double; MLlib takes no boolean."""
    return df.withColumn(label, F.col(label).cast("double"))


def fit(name: str, train: DataFrame, label: str = "label",
        features: str = "features", bins: int | None = None, **params) -> Model:
    """Train, store the model in the shared folder and return the stored one.

    The stored model carries no training summary.  The summary of a fresh one refers
    to the session, which cannot be shipped to executors once the session has been
    used to observe metrics.  Trees cut each feature into ``bins``, by default as many as
    the indexed column with most labels needs; MLlib refuses fewer.  ``params`` go to the
    classifier.
    """
    model = CLASSIFIERS[name](bins or bins_needed(train, features), labelCol=label,
                              featuresCol=features, **params).fit(train)
    path = scratch_dir(train.sparkSession, f"model-{name}")
    model.save(path)
    return type(model).load(path)


def score(model: Model, df: DataFrame, label: str = "label", features: str = "features",
          keep: Sequence[str] = ()) -> DataFrame:
    """Predictions next to the label and the features."""
    return model.transform(df).select(*keep, "prediction", label, features)


def accuracy(predictions: DataFrame, label: str = "label",
             prediction: str = "prediction") -> float:
    evaluator = MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=prediction, metricName="accuracy")
    return evaluator.evaluate(predictions)


def majority_accuracy(df: DataFrame, label: str = "label") -> float:
    """What always answering with the most frequent label would reach."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg((F.max("n") / F.sum("n")).alias("share")).first()
    return row["share"]


def compare_classifiers(train: DataFrame, test: DataFrame, label: str = "label",
                        features: str = "features",
                        names: Sequence[str] = tuple(CLASSIFIERS),
                        parallelism: int = 3) -> DataFrame:
    """Fit and judge the classifiers; one row of quality figures for each.

    A fit is a long row of small jobs with pauses in between, so a few of them run
    side by side over the same cached training rows.
    """
    spark = train.sparkSession
    train = train.select(label, features).persist()
    test = test.select(label, features).persist()

    def judge(name: str) -> tuple:
        model = fit(name, train, label, features)
        reached = accuracy(score(model, test, label, features), label)
        return name, reached, 1.0 - reached, baseline

    try:
        baseline = majority_accuracy(test, label)
        train.count()
        with ThreadPoolExecutor(parallelism) as pool:
            # The last ones in the list take longest, so they start first.
            rows = list(pool.map(inheritable_thread_target(spark)(judge), names[::-1]))[::-1]
    finally:
        train.unpersist()
        test.unpersist()
    return rows_from_list(
        spark, rows, "model string, accuracy double, test_error double, majority_accuracy double")
