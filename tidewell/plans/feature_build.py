"""From a raw table to feature vectors, in one call."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import TITLE_REMAP
from tidewell.operators.features import (
    add_family, add_title, assemble, fill_by_group, fill_mode, impute_group_mean,
    index_strings, modes, value_counts,
)
from tidewell.operators.joins import sized_for_broadcast
from tidewell.operators.models import with_label
from tidewell.session import materialize


@dataclass(frozen=True)
class FeatureSpec:
    """Which column of the input plays which part."""

    key: str
    label: str
    text: str                           # holds the title
    impute: str                         # filled from the title group
    family: Sequence[str]               # summed into the family size
    numeric: Sequence[str]              # used as they are
    indexed: Sequence[str]              # text columns to index, next to the title
    fill: Sequence[str] = ()            # filled with their most frequent value
    title: str = "title"
    remap: Mapping[str, str] = field(default_factory=lambda: dict(TITLE_REMAP))
    # Fixed values per title group; without them the rounded group means are used.
    impute_values: Mapping[str, float] | None = None
    # Feature columns in vector order, if another than the one below is wanted.
    order: Sequence[str] = ()

    @property
    def inputs(self) -> list[str]:
        """Feature columns in vector order."""
        if self.order:
            return list(self.order)
        return [*self.numeric, self.impute, *self.family, "family_size", "alone",
                *[f"{c}_index" for c in (*self.indexed, self.title)]]


def build_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Title, imputation, family features, indexes and the vector.

    Result: key, label, the feature columns and ``features``.  Several steps need a
    pass of their own over a few columns, so the columns in use are written to the
    shared folder first and whatever made ``df`` runs only once.  The text is left
    behind there, only its title goes on.  The steps that count labels come before
    the join with the group means, which they do not need.
    """
    used = list(dict.fromkeys([spec.key, spec.label, spec.title, spec.impute, *spec.family,
                               *spec.numeric, *spec.indexed, *spec.fill]))
    titled = add_title(df, spec.text, spec.title, spec.remap)
    rows = materialize(titled.select(*used), "features")
    rows = fill_mode(rows, spec.fill, now=True) if spec.fill else rows
    rows = index_strings(rows, [*spec.indexed, spec.title])
    if spec.impute_values is None:
        rows = impute_group_mean(rows, spec.title, spec.impute)
    else:
        rows = fill_by_group(rows, spec.title, spec.impute, spec.impute_values)
    rows = assemble(add_family(rows, spec.family), spec.inputs)
    return with_label(rows, spec.label).select(spec.key, spec.label, *spec.inputs, "features")


class FittedFeatures:
    """What a feature build learned from some rows, to be applied to others.

    ``facts`` is a table of (kind, column_name, value, number): the most frequent value of
    each filled column (``mode``), the mean of each title group (``mean``), and the labels
    of each indexed column with their counts (``label``).
    """

    def __init__(self, spec: FeatureSpec, facts: DataFrame):
        self.spec, self.facts = spec, facts

    def save(self, path: str) -> None:
        self.facts.write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, spec: FeatureSpec) -> FittedFeatures:
        return cls(spec, spark.read.parquet(path))

    def transform(self, df: DataFrame, unknown: str = "error") -> DataFrame:
        """Key, label if ``df`` has it, the feature columns and ``features``.

        A label that the fit has not seen is an error, gets the index after the last with
        ``unknown="keep"``, and takes its row out with ``"skip"``.  A missing value in
        a title group without a mean is an error.
        """
        spec = self.spec
        used = _used(spec, df.columns)
        rows = add_title(df, spec.text, spec.title, spec.remap).select(*used)
        labels: dict[str, list[str]] = {c: [] for c in (*spec.indexed, spec.title)}
        kinds = dict(rows.dtypes)
        # labels of categorical columns, which MLlib keeps on the driver in any case
        for fact in (self.facts.where("kind <> 'mean'")
                     .orderBy("kind", "column_name", F.desc("number"), "value").collect()):
            name, value = fact["column_name"], fact["value"]
            if fact["kind"] == "label":
                labels[name].append(value)
            else:
                rows = rows.withColumn(name, F.coalesce(name, F.lit(value).cast(kinds[name])))
        rows = PipelineModel(stages=[
            StringIndexerModel.from_labels(found, c, f"{c}_index", unknown)
            for c, found in labels.items()]).transform(rows)
        if spec.impute_values is None:
            means = sized_for_broadcast(self.facts.where("kind = 'mean'").select(
                F.col("value").alias("_group"), F.col("number").alias("_mean")))
            rows = (rows.join(means, F.col(spec.title).eqNullSafe(F.col("_group")), "left")
                    .withColumn(spec.impute, F.coalesce(spec.impute, "_mean")))
        else:
            rows = fill_by_group(rows, spec.title, spec.impute, spec.impute_values)
        rows = assemble(add_family(rows, spec.family), spec.inputs)
        if spec.label in used:
            return with_label(rows, spec.label).select(spec.key, spec.label, *spec.inputs, "features")
        return rows.select(spec.key, *spec.inputs, "features")


def _used(spec: FeatureSpec, columns: Sequence[str]) -> list[str]:
    used = [spec.key, spec.label, spec.title, spec.impute, *spec.family, *spec.numeric,
            *spec.indexed, *spec.fill]
    return [c for c in dict.fromkeys(used) if c != spec.label or c in columns]


def fit_features(df: DataFrame, spec: FeatureSpec) -> FittedFeatures:
    """Learn modes, group means and label counts from ``df``; its label may be missing."""
    titled = add_title(df, spec.text, spec.title, spec.remap)
    rows = materialize(titled.select(*_used(spec, df.columns)), "features")
    spark = df.sparkSession
    tops = modes(rows, list(spec.fill)).first().asDict() if spec.fill else {}
    tops = {c: top for c, top in tops.items() if top is not None}
    facts = spark.createDataFrame(
        [("mode", c, str(value), None) for c, value in tops.items()],
        "kind string, column_name string, value string, number double")
    counts = value_counts(rows.na.fill(tops) if tops else rows, [*spec.indexed, spec.title])
    facts = facts.unionByName(counts.select(
        F.lit("label").alias("kind"), "column_name", "value", F.col("n").cast("double").alias("number")))
    if spec.impute_values is None:
        means = rows.where(F.col(spec.impute).isNotNull()).groupBy(spec.title).agg(
            F.round(F.avg(spec.impute), 0).cast("double").alias("number"))
        facts = facts.unionByName(means.select(
            F.lit("mean").alias("kind"), F.lit(spec.impute).alias("column_name"),
            F.col(spec.title).alias("value"), "number"))
    return FittedFeatures(spec, materialize(facts, "facts"))
