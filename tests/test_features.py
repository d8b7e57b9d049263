from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell.functions import TITLE_MEAN_AGES, TITLE_REMAP
from tidewell.operators import (
    add_family, add_title, assemble, feature_stages, fill_by_group, fill_mode, modes,
    frequency_index, hash_split, impute_group_mean, index_strings, random_split, remap_from_table, remap_values,
    sized_for_broadcast,
)
from tidewell.plans.feature_build import FeatureSpec, FittedFeatures, build_features, fit_features
from tidewell.plans.jdbc_queries import DERBY_DRIVER
from tidewell.session import with_conf
from tidewell.sources import read_table, write_table

PEOPLE = [
    (1, True, 3, "Hill, Mr. Tom", "male", 22.0, 1, 0, 7.25, "S"),
    (2, True, 1, "Moor, the Countess. of (Ann)", "female", None, 0, 0, 86.5, "S"),
    (3, False, 3, "Vale, Mlle. Eva", "female", 20.0, 0, 0, 9.0, None),
    (4, False, 2, "Ford, Mr. Jim", "male", None, 0, 0, 13.0, "C"),
    (5, True, 2, "Lake, Master. Bob", "male", 4.0, 1, 2, 27.0, "C"),
    (6, False, 3, "Wood, Rev. Sam", "male", None, 0, 0, 8.0, "S"),
    (7, True, 1, "Dale, Mrs. Joe (Amy)", "female", 35.5, 1, 1, 60.0, "Q"),
    (8, False, 3, "Beck, Dr. Lea", "female", 40.0, 0, 0, 50.0, "S"),
]
COLUMNS = ("id int, survived boolean, class int, name string, sex string, age double, "
           "siblings int, parents int, fare double, port string")


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, COLUMNS)


def test_remap_is_whole_cell_and_covers_all_text_columns(spark):
    df = spark.createDataFrame([("Dr", "Dr. Ms"), ("x", "Ms")], "a string, b string")
    assert rows(remap_values(df, TITLE_REMAP)) == [("Mr", "Dr. Ms"), ("x", "Miss")]
    assert rows(remap_values(df, TITLE_REMAP, ["a"])) == [("Mr", "Dr. Ms"), ("x", "Ms")]


def test_titles(people):
    titles = dict(rows(add_title(people, "name", "title"), "id", "title"))
    assert titles == {1: "Mr", 2: "Mrs", 3: "Miss", 4: "Mr", 5: "Master", 6: "Other",
                      7: "Mrs", 8: "Mr"}


def test_fill_by_group_uses_the_given_values(people):
    titled = add_title(people, "name", "title")
    ages = dict(rows(fill_by_group(titled, "title", "age", TITLE_MEAN_AGES), "id", "age"))
    assert (ages[2], ages[4], ages[6], ages[1]) == (36.0, 33.0, 46.0, 22.0)


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_impute_group_mean(people, plan_of, limit):
    titled = add_title(people, "name", "title")
    filled = impute_group_mean(titled, "title", "age", max_broadcast_bytes=limit)
    ages = dict(rows(filled, "id", "age"))
    assert ages[4] == 31.0                      # mean of 22 and 40
    assert ages[2] == 36.0                      # 35.5 rounds up
    assert ages[6] is None                      # no known age in the group
    assert ages[3] == 20.0
    assert filled.columns == titled.columns


def test_the_null_group_has_a_mean_too(spark):
    df = spark.createDataFrame([(None, 2.0), (None, None), ("a", 1.0)], "g string, v double")
    assert rows(impute_group_mean(df, "g", "v")) == [(None, 2.0), (None, 2.0), ("a", 1.0)]


def test_broadcast_only_when_small(spark):
    df = spark.range(1000)
    hinted = sized_for_broadcast(df)._jdf.queryExecution().logical().toString()
    assert "Hint broadcast" in hinted
    plain = sized_for_broadcast(df, max_bytes=10)._jdf.queryExecution().logical().toString()
    assert "Hint" not in plain


def test_impute_of_a_hot_group_without_broadcast_splits_it(spark, plan_of):
    """Beyond the broadcast bound the join is a shuffle join; a group with most of the
    rows is split over several tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 300_000, numPartitions=8).select(
            F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 50).alias("g"),
            F.when(F.col("id") % 7 > 0, F.rand(1)).alias("v"), F.rand(2).alias("pad"))
        out = impute_group_mean(df, "g", "v", max_broadcast_bytes=0)
        placed = out.withColumn("p", F.spark_partition_id())
        result = placed.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(placed)
        assert len({r["p"] for r in result if r["g"] == 0}) > 2
        assert len(result) == 300_000 and all(r["v"] is not None for r in result)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("now", [False, True])
def test_fill_mode(spark, now):
    df = spark.createDataFrame(
        [(1, "b", 5), (2, "a", None), (3, None, None), (4, "b", 7), (5, "a", 7)],
        "id int, s string, n int")
    assert rows(fill_mode(df, ["s", "n"], now)) == [
        (1, "b", 5), (2, "a", 7), (3, "a", 7), (4, "b", 7), (5, "a", 7)]


def test_fill_mode_of_an_empty_column_leaves_nulls(spark):
    df = spark.createDataFrame([(1, None)], "id int, s string")
    assert rows(fill_mode(df, ["s"])) == [(1, None)]
    assert rows(fill_mode(df, ["s"], now=True)) == [(1, None)]


def test_family(people):
    result = add_family(people, ["siblings", "parents"])
    assert dict(rows(result.groupBy("family_size").count())) == {0: 5, 1: 1, 2: 1, 3: 1}
    assert result.where("alone = 1").count() == 5


def test_family_of_unknown_size_is_not_alone(spark):
    df = spark.createDataFrame([(None, 0), (0, 0)], "a int, b int")
    assert rows(add_family(df, ["a", "b"])) == [(0, 0, 0, 1), (None, 0, None, 0)]


LETTERS = [("b",), ("a",), ("c",), ("c",)]


@pytest.mark.parametrize("continuous", [[], ["s"]])
def test_index_order(spark, continuous):
    """The most frequent first, equals by value; the same on both ways."""
    df = spark.createDataFrame(LETTERS, "s string")
    result = index_strings(df, ["s"], continuous=continuous).distinct()
    assert rows(result) == [("a", 1.0), ("b", 2.0), ("c", 0.0)]


@pytest.mark.parametrize("continuous", [[], ["s"]])
def test_index_of_null_is_an_error(spark, continuous):
    df = spark.createDataFrame([*LETTERS, (None,)], "s string")
    with pytest.raises(Exception, match="(?i)null"):
        index_strings(df, ["s"], continuous=continuous).collect()


def test_columns_with_different_numbers_of_labels(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "s string, t string")
    result = index_strings(df, ["s", "t"])
    assert rows(result, "s", "s_index", "t", "t_index") == [
        ("a", 0.0, "x", 0.0), ("b", 1.0, "x", 0.0), ("c", 2.0, "y", 1.0)]
    assert result.schema["t_index"].metadata["ml_attr"]["vals"] == ["x", "y"]


def test_frequency_index_over_many_ranges(spark):
    df = spark.range(0, 20_000, numPartitions=16).select(
        F.floor(F.sqrt("id")).cast("string").alias("v"))
    with with_conf(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        index = frequency_index(df, "v").cache()
        assert len({r[0] >> 33 for r in df.groupBy("v").count().orderBy("count").select(
            F.monotonically_increasing_id()).collect()}) > 3
    counts = df.groupBy("v").count().collect()
    expected = sorted(counts, key=lambda r: (-r["count"], r["v"]))
    assert {r["v"]: r["index"] for r in index.collect()} == {
        r["v"]: float(i) for i, r in enumerate(expected)}


def test_stored_stages_apply_to_other_data(spark, people, tmp_path):
    known = people.where("port IS NOT NULL")
    model = feature_stages(["sex", "port"], ["fare"]).fit(known)
    model.save(str(tmp_path / "stages"))
    again = PipelineModel.load(str(tmp_path / "stages")).transform(known.where("id = 7"))
    vector = again.select(vector_to_array("features")).first()[0]
    assert vector == [60.0, 0.0, 2.0] or vector == [60.0, 1.0, 2.0]


def test_assemble_rejects_nulls(people):
    assert assemble(people, ["class", "fare"]).select("features").first()[0].tolist() == [3, 7.25]
    with pytest.raises(Exception, match="(?i)null"):
        assemble(people, ["age"]).collect()


def test_splits(spark):
    df = spark.range(5000)
    train, test = random_split(df)
    assert train.count() + test.count() == 5000
    assert train.join(test, "id").count() == 0
    marked = hash_split(df, ["id"])
    assert rows(marked.repartition(3)) == rows(marked)


SPEC = FeatureSpec(key="id", label="survived", text="name", impute="age",
                   family=["siblings", "parents"], numeric=["class", "fare"],
                   indexed=["sex", "port"], fill=["port"], impute_values=TITLE_MEAN_AGES)


@pytest.mark.parametrize("values", [TITLE_MEAN_AGES, None])
def test_build_features_from_a_database(spark, people, values):
    """Database types: bit label, decimal age and fare."""
    url, properties = "jdbc:derby:memory:people;create=true", {"driver": DERBY_DRIVER}
    typed = people.withColumns({"age": F.col("age").cast("decimal(4,2)"),
                                "fare": F.col("fare").cast("decimal(8,4)"),
                                # This database takes no null text from Spark.
                                "port": F.coalesce("port", F.lit("-"))})
    write_table(typed, url, "people", properties,
                "name VARCHAR(82), sex VARCHAR(6), port VARCHAR(1)")
    stored = read_table(spark, url, "people", properties)
    assert dict(stored.dtypes)["survived"] == "boolean"
    assert dict(stored.dtypes)["age"] == "decimal(4,2)"
    # The one in group Other has no known age to take a mean of.
    stored = stored.where("id <> 6").replace({"-": None}, subset=["port"])
    spec = replace(SPEC, impute_values=values)
    vectors = {r["id"]: r["features"].toArray().tolist()
               for r in build_features(stored, spec).collect()}
    plain = {r["id"]: r["features"].toArray().tolist()
             for r in build_features(people.where("id <> 6"), spec).collect()}
    assert vectors == plain


def test_build_features(people):
    built = build_features(people, SPEC)
    assert built.columns == ["id", "survived", *SPEC.inputs, "features"]
    by_id = {r["id"]: r for r in built.collect()}
    assert len(by_id) == 8
    # class, fare, age, siblings, parents, family size, alone, sex, port, title
    assert by_id[2]["features"].toArray().tolist() == [1, 86.5, 36, 0, 0, 0, 1, 0, 0, 1]
    assert by_id[3]["features"].toArray().tolist() == [3, 9, 20, 0, 0, 0, 1, 0, 0, 3]
    assert by_id[5]["features"].toArray().tolist() == [2, 27, 4, 1, 2, 3, 0, 1, 1, 2]
    assert by_id[2]["survived"] == 1.0


def test_fitted_features_stored_and_applied(spark, people, tmp_path):
    vectors = lambda df: {r["id"]: r["features"].toArray().tolist() for r in df.collect()}
    fit_features(people, SPEC).save(str(tmp_path / "facts"))
    fitted = FittedFeatures.load(spark, str(tmp_path / "facts"), SPEC)
    assert vectors(fitted.transform(people)) == vectors(build_features(people, SPEC))
    # One row without a label: title, port and age come from the fitted rows.
    new = spark.createDataFrame([(9, 3, "Hill, Mr. Tim", "male", None, 0, 0, 7.0, None)],
                                COLUMNS.replace("survived boolean, ", ""))
    row = fitted.transform(new).first()
    whole = vectors(build_features(people, SPEC))
    assert "survived" not in row.asDict()
    assert row["port_index"] == 0 and row["title_index"] == whole[1][SPEC.inputs.index("title_index")]
    assert row["age"] is not None


def test_fitted_features_meet_an_unknown_label(spark, people):
    fitted = fit_features(people, SPEC)
    odd = people.where("id = 1").withColumn("sex", F.lit("other"))
    assert fitted.transform(odd, unknown="keep").first()["sex_index"] == 2
    assert fitted.transform(odd, unknown="skip").count() == 0
    with pytest.raises(Exception, match="[Uu]nseen"):
        fitted.transform(odd).collect()


def test_modes_of_many_columns_in_one_scan(spark, tmp_path, plan_of):
    data = [(1, "b", 5, True, None), (2, "a", 30, None, None), (3, None, 30, False, None), (4, "b", 5, True, None),
            (5, "a", None, True, None)]
    spark.createDataFrame(data, "id int, `s.t` string, n int, f boolean, v string").write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d"))
    found = modes(df, ["s.t", "n", "f", "v"])
    assert tuple(found.first()) == ("a", 5, True, None)  # 5 before 30: numbers, not text
    assert plan_of(modes(df, ["s.t", "n", "f"])).count("FileScan") == 1
    for now in (False, True):
        filled = fill_mode(df, ["s.t", "n", "f", "v"], now)
        assert dict(filled.dtypes) == dict(df.dtypes)
        assert rows(filled) == [(1, "b", 5, True, None), (2, "a", 30, True, None), (3, "a", 30, False, None),
                                (4, "b", 5, True, None), (5, "a", 5, True, None)]
    assert fill_mode(df, []) is df


def test_fills_of_a_feature_build_read_the_rows_once(spark, monkeypatch):
    from tidewell.plans import feature_build
    calls = []
    real = feature_build.modes
    monkeypatch.setattr(feature_build, "modes", lambda df, columns: calls.append(list(columns)) or real(df, columns))
    people = spark.createDataFrame(
        [(i, i % 2, "Mr. X" if i % 3 else "Miss. Y", float(i) if i % 4 else None, 0, 1, "q" if i % 5 else None,
          "r" if i % 3 else None) for i in range(1, 40)],
        "id int, label int, name string, age double, a int, b int, s string, t string")
    spec = feature_build.FeatureSpec("id", "label", "name", "age", ["a", "b"], [], ["s", "t"], ["s", "t"])
    fitted = feature_build.fit_features(people, spec)
    assert calls == [["s", "t"]]
    assert fitted.transform(people).count() == 39


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_remap_from_a_table(spark, most):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz"), (5, "a")], "id int, `v.w` string")
    mapping = spark.createDataFrame([("a", "A"), ("a", "B"), (None, "none"), ("b", None), ("q", "Q")],
                                    "old string, new string")
    found = remap_from_table(df, mapping, "v.w", max_broadcast_bytes=most)
    assert found.columns == df.columns
    assert rows(found) == [(1, "A"), (2, None), (3, None), (4, "zz"), (5, "A")]
