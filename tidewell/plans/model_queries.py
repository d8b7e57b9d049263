"""Classifiers on labelled documents."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewell.operators import (
    accuracy, assemble, compare_classifiers, hash_split, index_strings, score,
)
from tidewell.operators.models import fit, with_label
from tidewell.plans.registry import query, table
from tidewell.session import materialize
from tidewell.sources import rows_from_list


def _labelled_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    return table(spark, sf_dir, "labels").join(documents, "doc_id")


def _train_and_test(spark, sf_dir):
    rows = materialize(_labelled_documents(spark, sf_dir), "labelled")
    rows = index_strings(rows, ["lang", "source"])
    rows = assemble(rows, ["n_chars", "toxic", "lang_index", "source_index"])
    rows = with_label(rows, "quality").withColumnRenamed("quality", "label")
    rows = hash_split(rows.select("doc_id", "label", "features"), ["doc_id"])
    rows = materialize(rows, "vectors")
    return rows.where("is_train").drop("is_train"), rows.where("NOT is_train").drop("is_train")


@query()
def classifier_accuracy(spark, sf_dir):
    """Six classifiers, one row each; iterative, so there is no SQL twin."""
    return compare_classifiers(*_train_and_test(spark, sf_dir))


@query()
def score_predictions(spark, sf_dir):
    """Predictions of the logistic regression for the test documents."""
    train, test = _train_and_test(spark, sf_dir)
    model = fit("logistic_regression", train)
    return score(model, test, keep=["doc_id"]).drop("features")


def _label_index_sql(column):
    return f"""(SELECT {column}, CAST(row_number() OVER (
        ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE) AS {column}_index
      FROM labelled GROUP BY {column})"""


_VECTORS_SQL = f"""
    WITH labelled AS (SELECT * FROM labels JOIN documents USING (doc_id)),
    vectors AS (
      SELECT doc_id, CAST(quality AS DOUBLE) AS label, CAST(n_chars AS DOUBLE) AS x1,
             CAST(toxic AS DOUBLE) AS x2, lang_index AS x3, source_index AS x4,
             CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
               AS is_train
      FROM labelled JOIN {_label_index_sql('lang')} USING (lang)
        JOIN {_label_index_sql('source')} USING (source))"""

_BAYES_SQL = _VECTORS_SQL + """,
    sums AS (
      SELECT label, count(*) AS n, sum(x1) AS s1, sum(x2) AS s2, sum(x3) AS s3, sum(x4) AS s4,
             sum(x1 + x2 + x3 + x4) AS s
      FROM vectors WHERE is_train GROUP BY label),
    weights AS (
      SELECT label AS prediction, ln((n + 1) / (sum(n) OVER () + count(*) OVER ())) AS prior,
             ln((s1 + 1) / (s + 4)) AS w1, ln((s2 + 1) / (s + 4)) AS w2,
             ln((s3 + 1) / (s + 4)) AS w3, ln((s4 + 1) / (s + 4)) AS w4
      FROM sums),
    scores AS (
      SELECT doc_id, label, prediction,
             prior + x1 * w1 + x2 * w2 + x3 * w3 + x4 * w4 AS score
      FROM vectors CROSS JOIN weights WHERE NOT is_train)"""


@query(_BAYES_SQL + """
    SELECT doc_id, label, arg_max(prediction, score) AS prediction,
           round(max(score) FILTER (WHERE prediction = 0), 4) AS score_0,
           round(max(score) FILTER (WHERE prediction = 1), 4) AS score_1
    FROM scores GROUP BY doc_id, label""")
def naive_bayes_predictions(spark, sf_dir):
    """Naive Bayes has a closed form, so its scores per class have a SQL twin."""
    train, test = _train_and_test(spark, sf_dir)
    scored = score(fit("naive_bayes", train), test, keep=["doc_id", "rawPrediction"])
    raw = vector_to_array("rawPrediction")
    return scored.select("doc_id", "label", "prediction", F.round(raw[0], 4).alias("score_0"),
                         F.round(raw[1], 4).alias("score_1"))


@query(_BAYES_SQL + """,
    answers AS (
      SELECT label, arg_max(prediction, score) AS prediction FROM scores GROUP BY doc_id, label),
    shares AS (SELECT count(*) AS n FROM vectors WHERE NOT is_train GROUP BY label)
    SELECT 'naive_bayes' AS model, round(avg(CAST(label = prediction AS INTEGER)), 6) AS accuracy,
           round(1 - avg(CAST(label = prediction AS INTEGER)), 6) AS test_error,
           (SELECT round(max(n) / sum(n), 6) FROM shares) AS majority_accuracy
    FROM answers""")
def closed_form_accuracy(spark, sf_dir):
    """The comparison of classifiers, for the one whose answers have a closed form."""
    compared = compare_classifiers(*_train_and_test(spark, sf_dir), names=["naive_bayes"])
    return compared.select("model", *[F.round(c, 6).alias(c) for c in compared.columns[1:]])


@query(_VECTORS_SQL + """,
    sums AS (
      SELECT sum(label) AS one, sum(label * x1) AS n_chars, sum(label * x2) AS toxic,
             sum(label * x3) AS lang_index, sum(label * x4) AS source_index
      FROM vectors WHERE is_train)
    SELECT feature, total, 1 AS balanced
    FROM (UNPIVOT sums ON one, n_chars, toxic, lang_index, source_index INTO NAME feature VALUE total)""")
def logistic_balance(spark, sf_dir):
    """At its optimum a logistic regression expects of every feature what the good documents hold of it.

    ``total`` is what they hold in the training rows; ``balanced`` says that the probabilities of all training rows
    give the same, within a hundredth of what all rows hold.
    """
    train, _ = _train_and_test(spark, sf_dir)
    scored = score(fit("logistic_regression", train), train, keep=["probability"])
    names = ["one", "n_chars", "toxic", "lang_index", "source_index"]
    values = F.concat(F.array(F.lit(1.0)), vector_to_array("features"))
    rows = scored.select("label", vector_to_array("probability")[1].alias("p"),
                         F.posexplode(values).alias("place", "x"))
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("place") + 1)
    return rows.groupBy(name.alias("feature")).agg(
        F.sum(F.col("label") * F.col("x")).alias("total"),
        (F.abs(F.sum((F.col("p") - F.col("label")) * F.col("x"))) <= F.sum("x") / 100).cast("int").alias("balanced"))


@query("""
    SELECT round(avg(CASE WHEN (n_chars >= 200) = (quality = 1) THEN 1.0 ELSE 0.0 END), 6)
        AS accuracy,
      round(1 - avg(CASE WHEN (n_chars >= 200) = (quality = 1) THEN 1.0 ELSE 0.0 END), 6)
        AS test_error
    FROM labels JOIN documents USING (doc_id)""")
def accuracy_from_predictions(spark, sf_dir):
    """Accuracy of a rule: documents of 200 characters or more are good."""
    answers = _labelled_documents(spark, sf_dir).select(
        (F.col("n_chars") >= 200).cast("double").alias("prediction"),
        F.col("quality").cast("double").alias("label"))
    reached = accuracy(answers)
    result = rows_from_list(spark, [(reached, 1.0 - reached)],
                            "accuracy double, test_error double")
    return result.select(F.round("accuracy", 6).alias("accuracy"),
                         F.round("test_error", 6).alias("test_error"))


# Models that a closed form describes, over all labelled documents: the word variety of a
# text (twentieths of its words that are distinct), toxicity and a band of its length.
_TRAITS_SQL = """
    WITH traits AS (
      SELECT doc_id, CAST(quality AS DOUBLE) AS label, lang, toxic,
             len(list_distinct(string_split(text, ' '))) * 20 // len(string_split(text, ' '))
               AS variety,
             least(n_chars // 200, 12) AS band
      FROM labels JOIN documents USING (doc_id) WHERE text IS NOT NULL)"""

# The cut of one feature that leaves the least impurity; a cut lies between two values.
_STUMP_SQL = _TRAITS_SQL + """,
    cells AS (
      SELECT feature, value, count(*) AS n, sum(label) AS good
      FROM (SELECT 1 AS feature, variety AS value, label FROM traits
            UNION ALL SELECT 2, toxic, label FROM traits
            UNION ALL SELECT 3, band, label FROM traits)
      GROUP BY feature, value),
    sides AS (
      SELECT feature, value, sum(n) OVER upto AS n, sum(good) OVER upto AS good,
             sum(n) OVER (PARTITION BY feature) AS total,
             sum(good) OVER (PARTITION BY feature) AS total_good
      FROM cells WINDOW upto AS (PARTITION BY feature ORDER BY value)),
    cut AS (
      SELECT *, good / n AS below, (total_good - good) / (total - n) AS above
      FROM sides WHERE n < total
      ORDER BY good * (1 - good / n)
        + (total_good - good) * (1 - (total_good - good) / (total - n)), feature, value LIMIT 1),
    leaves AS (
      SELECT doc_id, label, CASE WHEN CASE feature WHEN 1 THEN variety WHEN 2 THEN toxic
        ELSE band END <= value THEN below ELSE above END AS share
      FROM traits CROSS JOIN cut)"""

_TREE_SQL = _STUMP_SQL + """
    SELECT doc_id, label, CASE WHEN share > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
             AS prediction, round(share, 6) AS probability FROM leaves"""


def _traits(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    words = F.split("text", " ", -1)
    variety = F.floor(F.size(F.array_distinct(words)) * 20 / F.size(words))
    documents = documents.select(
        "doc_id", "lang", variety.alias("variety"),
        F.least(F.floor(F.col("n_chars") / 200), F.lit(12)).alias("band"))
    rows = table(spark, sf_dir, "labels").join(documents, "doc_id")
    rows = with_label(rows, "quality").withColumnRenamed("quality", "label")
    return materialize(rows, "traits")


def _fitted(rows, inputs, name, keep=("doc_id",), **params):
    rows = assemble(rows, inputs)
    return score(fit(name, rows, **params), rows, keep=keep).drop("features")


def _with_probability(spark, sf_dir, name, **params):
    scored = _fitted(_traits(spark, sf_dir), ["variety", "toxic", "band"], name,
                     keep=["doc_id", "probability"], **params)
    return scored.withColumn("probability", F.round(vector_to_array("probability")[1], 6))


@query(_TREE_SQL)
def decision_tree_stump(spark, sf_dir):
    """A tree of one cut: the best one by Gini impurity."""
    return _with_probability(spark, sf_dir, "decision_tree", maxDepth=1)


@query(_TREE_SQL)
def random_forest_stump(spark, sf_dir):
    """A forest of one such tree over all rows and features."""
    return _with_probability(spark, sf_dir, "random_forest", maxDepth=1, numTrees=1,
                             bootstrap=False, featureSubsetStrategy="all")


@query(_STUMP_SQL + """
    SELECT doc_id, label, CASE WHEN share > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
             AS prediction, round(1 / (1 + exp(-2 * (2 * share - 1))), 6) AS probability
    FROM leaves""")
def boosted_stump(spark, sf_dir):
    """One round of boosting: the same cut by variance, with a logistic link."""
    return _with_probability(spark, sf_dir, "gradient_boosted_trees", maxDepth=1, maxIter=1)


def _flags(rows, conditions):
    return rows.withColumns({name: F.when(condition, 1).otherwise(0)
                             for name, condition in conditions.items()})


@query(_TRAITS_SQL + """
    SELECT doc_id, label, CASE WHEN share > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
             AS prediction, round(share, 4) AS probability
    FROM (SELECT doc_id, label, avg(label) OVER (PARTITION BY CASE WHEN lang IN
            ('de', 'en', 'es') THEN lang ELSE '' END) AS share FROM traits)""")
def logistic_groups(spark, sf_dir):
    """With a flag for each group but one, the fitted probability is the group's mean."""
    rows = _flags(_traits(spark, sf_dir),
                  {f"is_{lang}": F.col("lang") == lang for lang in ("de", "en", "es")})
    scored = _fitted(rows, ["is_de", "is_en", "is_es"], "logistic_regression",
                     keep=["doc_id", "probability"], maxIter=200, tol=1e-12)
    return scored.withColumn("probability", F.round(vector_to_array("probability")[1], 4))


@query(_TRAITS_SQL + """
    SELECT doc_id, label, CASE WHEN avg(label) OVER (PARTITION BY CASE WHEN variety < 6
             THEN 0 WHEN variety < 11 THEN 1 ELSE 2 END) > 0.5
             THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM traits""")
def linear_svc_groups(spark, sf_dir):
    """With a flag for each group but one, the least hinge loss answers with the majority."""
    variety = F.col("variety")
    rows = _flags(_traits(spark, sf_dir),
                  {"is_poor": variety < 6, "is_plain": (variety >= 6) & (variety < 11)})
    return _fitted(rows, ["is_poor", "is_plain"], "linear_svc", maxIter=10, tol=1e-6)
