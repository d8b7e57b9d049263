"""Cleaning, imputation and feature operators.  All take their columns by name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidewell.functions import TITLE_REMAP, first_title, hash_bucket
from tidewell.operators.joins import BROADCAST_BYTES, sized_for_broadcast
from tidewell.session import materialize


def remap_values(df: DataFrame, mapping: Mapping[str, str],
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Replace cells that equal a key of ``mapping``; by default in all text columns."""
    return df.replace(dict(mapping), subset=list(columns) if columns else None)


def remap_from_table(df: DataFrame, mapping: DataFrame, column: str, old: str = "old",
                     new: str = "new", max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Replace cells of ``column`` that equal ``old`` of a row of ``mapping`` by its ``new``.

    For mappings too long for an expression, of any size: the join broadcasts the mapping if it was
    measured to be small.  Of an ``old`` with several rows the smallest ``new`` counts, a null ``old`` is ignored; a
    ``new`` of null makes the cell null.
    """
    pairs = (mapping.where(F.col(old).isNotNull()).groupBy(F.col(old).alias("_old"))
             .agg(F.min(new).alias("_new")).withColumn("_found", F.lit(True)))
    joined = df.join(sized_for_broadcast(pairs, max_broadcast_bytes), F.col(f"`{column}`") == F.col("_old"), "left")
    return joined.withColumn(column, F.when(F.col("_found"), F.col("_new")).otherwise(F.col(f"`{column}`"))).drop(
        "_old", "_new", "_found")


def add_title(df: DataFrame, text: str, title: str,
              remap: Mapping[str, str] = TITLE_REMAP) -> DataFrame:
    """Column with the normalised title found in ``text``, empty if there is none."""
    return remap_values(df.withColumn(title, first_title(F.col(text))), remap, [title])


def fill_by_group(df: DataFrame, group: str, column: str,
                  values: Mapping[str, float]) -> DataFrame:
    """Fill nulls of ``column`` with a given constant per group."""
    filled = F.col(column)
    for key, value in values.items():
        missing = (F.col(group) == key) & F.col(column).isNull()
        filled = F.when(missing, F.lit(value)).otherwise(filled)
    return df.withColumn(column, filled)


def impute_group_mean(df: DataFrame, group: str, column: str, digits: int = 0,
                      max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Fill nulls of ``column`` with the rounded mean of the row's group.

    Two passes: the means, aggregated before the shuffle, then a join with them.
    While the means fit a broadcast the second pass needs no shuffle.  A window over
    the group would instead bring all rows of a group into one task.
    """
    means = (df.where(F.col(column).isNotNull())
             .groupBy(F.col(group).alias("_group"))
             .agg(F.round(F.avg(column), digits).alias("_mean")))
    means = sized_for_broadcast(means, max_broadcast_bytes)
    joined = df.join(means, F.col(group).eqNullSafe(F.col("_group")), "left")
    return (joined.withColumn(column, F.coalesce(F.col(column), F.col("_mean")))
            .select(*df.columns))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the most frequent value of each column, the smallest among equals; null
    if all values are null.

    One scan for all columns: grouping sets count the values of each column side by side, reduced in the
    tasks, and an ordered aggregate takes the top one of each, in the column's own type.
    """
    own = [F.col(f"`{c}`") for c in columns]
    cells = df.select(*[c.alias(f"_v{i}") for i, c in enumerate(own)])
    names = cells.columns
    counts = cells.groupingSets([[name] for name in names], *names).agg(
        F.count(F.lit(1)).alias("_n"), *[F.grouping(name).alias(f"{name}_out") for name in names])
    tops = [F.min(F.when((F.col(f"{name}_out") == 0) & F.col(name).isNotNull(),
                         F.struct((-F.col("_n")).alias("order"), F.col(name).alias("value"))))["value"].alias(c)
            for name, c in zip(names, columns)]
    return counts.agg(*tops)


def fill_mode(df: DataFrame, columns: Sequence[str], now: bool = False) -> DataFrame:
    """Fill nulls with the most frequent value of the column, found in one pass for all columns.

    By default the values are a stored row that the result looks up.  With ``now`` they are put in
    as constants, which saves the lookup when the result is read often.
    """
    columns = list(columns)
    if not columns:
        return df
    if now:
        tops = modes(df, columns).first().asDict()
        return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(top).cast(df.schema[c].dataType))
                               for c, top in tops.items() if top is not None})
    tops = materialize(modes(df, columns).toDF(*[f"_v{i}" for i in range(len(columns))]), "modes")
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), tops.select(f"_v{i}").scalar())
                           for i, c in enumerate(columns)})


def add_family(df: DataFrame, parts: Sequence[str], size: str = "family_size",
               alone: str = "alone") -> DataFrame:
    """Sum of the given columns, null if one is null, and a 0/1 flag for a sum of 0."""
    total = F.col(parts[0])
    for name in parts[1:]:
        total = total + F.col(name)
    return (df.withColumn(size, total)
            .withColumn(alone, F.when(F.col(size) == 0, F.lit(1)).otherwise(F.lit(0))))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n) of the non-null values of text columns, in one pass."""
    return (df.unpivot([], list(columns), "column_name", "value")
            .where(F.col("value").isNotNull())
            .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))


def rank_by_count(counts: DataFrame, value: str, n: str, index: str) -> DataFrame:
    """(value, index) with index 0 for the greatest count, ties by value.

    For any number of values: they are range-sorted in parallel, and each range is
    then numbered from its offset.  The offsets are one row per shuffle partition,
    which bounds the only single-task step and the broadcast.
    """
    ordered = (counts.orderBy(F.desc(n), F.asc(value))
               .withColumn("_id", F.monotonically_increasing_id())
               # Upper bits: the range; lower 33 bits: the place within it.
               .select(value, F.shiftright("_id", 33).alias("_range"),
                       F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")))
    ordered = materialize(ordered, "ranked")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ordered.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
               .select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
                       .alias("_offset")))
    return (ordered.join(F.broadcast(offsets), "_range")
            .select(value, (F.col("_offset") + F.col("_place")).cast("double").alias(index)))


def frequency_index(df: DataFrame, column: str, index: str = "index") -> DataFrame:
    """(value, index) of a column, index 0 for the most frequent value."""
    counts = (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("_n")))
    return rank_by_count(counts, column, "_n", index)


def index_strings(df: DataFrame, columns: Sequence[str], suffix: str = "_index",
                  continuous: Sequence[str] = ()) -> DataFrame:
    """Add a frequency index for each text column; a null label is an error.

    One counting pass serves all columns.  The caller says which are ``continuous``: these
    are indexed by a join with the ranked labels, for any number of labels, and carry no
    label metadata, so trees cut their index as a number.  The others are categorical:
    an MLlib model keeps their labels on the driver and in the metadata of the result.  The
    number of labels never changes which of the two a column is.
    """
    counts = materialize(value_counts(df, columns), "labels")
    few = [c for c in columns if c not in continuous]
    out = df
    if few:
        labels: dict[str, list[str]] = {c: [] for c in few}
        for row in (counts.where(F.col("column_name").isin(few))
                    .orderBy("column_name", F.desc("n"), "value").collect()):
            labels[row["column_name"]].append(row["value"])
        indexers = [StringIndexerModel.from_labels(labels[c], c, c + suffix, "error")
                    for c in few]
        out = PipelineModel(stages=indexers).transform(out)
    for name in columns:
        if name in few:
            continue
        own = counts.where(F.col("column_name") == name)
        codes = sized_for_broadcast(rank_by_count(own, "value", "n", name + suffix))
        found = F.coalesce(F.col(name + suffix),
                           F.raise_error(F.lit(f"null label in column {name}")))
        out = (out.join(codes, F.col(name) == F.col("value"), "left")
               .withColumn(name + suffix, found).drop("value"))
    return out


def feature_stages(columns: Sequence[str], numeric: Sequence[str],
                   output: str = "features", suffix: str = "_index",
                   unknown: str = "error") -> Pipeline:
    """Indexing and vector assembly as MLlib stages, for when the fitted model is to be
    stored and applied to other data later.  For columns with few labels.

    A label that the fit has not seen is an error, gets the index after the last with
    ``unknown="keep"``, and takes its row out with ``"skip"``.
    """
    indexed = [c + suffix for c in columns]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(columns), outputCols=indexed,
                      stringOrderType="frequencyDesc", handleInvalid=unknown),
        VectorAssembler(inputCols=[*numeric, *indexed], outputCol=output,
                        handleInvalid="error")])


def assemble(df: DataFrame, inputs: Sequence[str], output: str = "features") -> DataFrame:
    """Vector column from numeric columns; a null is an error."""
    assembler = VectorAssembler(inputCols=list(inputs), outputCol=output,
                                handleInvalid="error")
    return assembler.transform(df)


def random_split(df: DataFrame, train_share: float = 0.8,
                 seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """Random split.  Which rows go where depends on the partition layout."""
    train, test = df.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, test


def hash_split(df: DataFrame, keys: Sequence[str], train_percent: int = 80,
               flag: str = "is_train") -> DataFrame:
    """Mark the rows of the training part by a hash of their key.

    The same key always falls on the same side, whatever the layout or retries.
    """
    bucket = hash_bucket(*[F.col(k) for k in keys])
    return df.withColumn(flag, bucket < train_percent)
