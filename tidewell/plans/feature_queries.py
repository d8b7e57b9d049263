"""Feature operators and the complete feature build."""

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewell.functions import TITLE_REMAP, first_title, hash_bucket
from tidewell.operators import (
    add_family, add_title, assemble, feature_stages, fill_mode, frequency_index, hash_split,
    impute_group_mean, index_strings, random_split,
)
from tidewell.plans.feature_build import FeatureSpec, build_features, fit_features
from tidewell.plans.registry import query, table
from tidewell.session import materialize, scratch_dir

# Titles as they appear in names, one for each nation.
NATION_TITLES = [
    "Mr", "Mrs", "Miss", "Master", "Don", "Rev", "Dr", "Mme", "Ms", "Major", "Lady", "Sir",
    "Mlle", "Col", "Capt", "Countess", "Jonkheer", "Mr", "Mrs", "Miss", "Master", "Mr", "Mrs",
    "Miss", "Mr",
]


def titled_customers(spark, sf_dir):
    """Customers with a name in the form "surname, title. given names"."""
    titles = F.array(*[F.lit(t) for t in NATION_TITLES])
    return table(spark, sf_dir, "customer").withColumn(
        "full_name", F.concat("c_name", F.lit(", "), F.get(titles, F.col("c_nationkey")),
                              F.lit(". "), "c_mktsegment"))


def passengers(spark, sf_dir):
    """One row per order in the shape of a passenger list.

    Balances below zero count as unknown, and orders without lines have no return
    flag, so there are nulls to impute and to fill.
    """
    lines = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        # One-letter flags, compared as numbers: Spark aggregates those by hashing,
        # text it would have to sort.
        F.char(F.min(F.ascii("l_returnflag"))).alias("port")))
    orders = table(spark, sf_dir, "orders")
    people = titled_customers(spark, sf_dir)
    return (orders.join(people, orders.o_custkey == people.c_custkey)
            .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
            .select(
                F.col("o_orderkey").alias("passenger_id"),
                (F.col("o_orderstatus") == "F").alias("survived"),
                F.substring("o_orderpriority", 1, 1).cast("int").alias("class"),
                F.col("full_name").alias("name"),
                F.col("c_mktsegment").alias("segment"),
                F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("age"),
                F.coalesce("n_lines", F.lit(0)).alias("relatives"),
                F.coalesce("n_returned", F.lit(0)).alias("children"),
                F.col("o_totalprice").alias("fare"),
                "port"))


SPEC = FeatureSpec(
    key="passenger_id", label="survived", text="name", impute="age",
    family=["relatives", "children"], numeric=["class", "fare"], indexed=["segment", "port"],
    fill=["port"])

_TITLED = f"""
    titled AS (
      SELECT *, c_name || ', ' || ({NATION_TITLES})[c_nationkey + 1] || '. ' || c_mktsegment
        AS full_name
      FROM customer)"""

_REMAP_CASE = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TITLE_REMAP.items())


@query(r"""
    SELECT doc_id, regexp_extract(text, '([A-Za-z]+)\.', 1) AS title FROM documents""")
def title_extract(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", first_title(F.col("text")).alias("title"))


@query(rf"""
    WITH {_TITLED},
    raw AS (SELECT c_custkey, regexp_extract(full_name, '([A-Za-z]+)\.', 1) AS t FROM titled)
    SELECT c_custkey, CASE t {_REMAP_CASE} ELSE t END AS title FROM raw""")
def title_normalize(spark, sf_dir):
    people = titled_customers(spark, sf_dir)
    return add_title(people, "full_name", "title").select("c_custkey", "title")


@query("""
    SELECT d.doc_id, coalesce(l.quality, (
        SELECT quality FROM labels JOIN documents USING (doc_id)
        GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1)) AS quality
    FROM documents d LEFT JOIN labels l USING (doc_id)""", name="fill_mode")
def fill_mode_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return fill_mode(documents.join(labels, "doc_id", "left"), ["quality"])


@query("""
    WITH known AS (
      SELECT o_orderkey, o_orderpriority,
             CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price
      FROM orders)
    SELECT o_orderkey, o_orderpriority,
           coalesce(price, round(avg(price) OVER (PARTITION BY o_orderpriority), 0)) AS price
    FROM known""")
def group_mean_impute(spark, sf_dir):
    """Pending orders have no final price; they get the mean of their priority."""
    known = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"))
    return impute_group_mean(known, "o_orderpriority", "price")


@query("""
    SELECT doc_id, quality + toxic AS family_size,
           CASE WHEN quality + toxic = 0 THEN 1 ELSE 0 END AS alone
    FROM documents LEFT JOIN labels USING (doc_id)""")
def family_features(spark, sf_dir):
    """Sum of two columns, null if one is null, and a flag for a sum of zero."""
    rows = table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels"), "doc_id", "left")
    return add_family(rows, ["quality", "toxic"]).select("doc_id", "family_size", "alone")


@query("""
    WITH coded AS (
      SELECT o_orderpriority, CAST(row_number() OVER (
        ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS o_orderpriority_index
      FROM orders GROUP BY o_orderpriority)
    SELECT o_orderkey, o_orderpriority_index FROM orders JOIN coded USING (o_orderpriority)""")
def string_index(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return index_strings(orders, ["o_orderpriority"]).drop("o_orderpriority")


@query("""
    WITH coded AS (
      SELECT CAST(l_partkey AS VARCHAR) AS part, CAST(row_number() OVER (
        ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS DOUBLE) AS part_index
      FROM lineitem GROUP BY 1)
    SELECT l_orderkey, l_linenumber, part_index
    FROM lineitem JOIN coded ON CAST(l_partkey AS VARCHAR) = part""")
def string_index_many(spark, sf_dir):
    """A column whose labels grow with the table, indexed without the driver."""
    parts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return index_strings(parts, ["part"], continuous=["part"]).drop("part")


@query("""
    SELECT l_partkey, CAST(row_number() OVER (ORDER BY count(*) DESC, l_partkey) - 1 AS DOUBLE)
      AS index
    FROM lineitem GROUP BY l_partkey""")
def frequency_index_many(spark, sf_dir):
    """The same order for a column with too many values for the driver."""
    return frequency_index(table(spark, sf_dir, "lineitem"), "l_partkey")


_ASSEMBLED = ["o_custkey", "o_totalprice"]


@query(" UNION ALL ".join(
    f"SELECT o_orderkey, {i} AS pos, CAST({c} AS DOUBLE) AS value FROM orders"
    for i, c in enumerate(_ASSEMBLED)))
def assemble_features(spark, sf_dir):
    vectors = assemble(table(spark, sf_dir, "orders").select("o_orderkey", *_ASSEMBLED),
                       _ASSEMBLED)
    return vectors.select("o_orderkey", F.posexplode(vector_to_array("features"))
                          .alias("pos", "value"))


@query("""
    SELECT o_orderkey, CAST(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)
      AS BIGINT) % 100 < 80 AS INTEGER) AS is_train
    FROM orders""", name="hash_split")
def hash_split_orders(spark, sf_dir):
    """Every order with the side it falls on."""
    marked = hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return marked.withColumn("is_train", F.col("is_train").cast("int"))


@query("""
    SELECT o_orderstatus, count(*) AS n_orders, count(DISTINCT o_orderkey) AS n_keys,
           CAST(0 AS BIGINT) AS n_in_both, CAST(1 AS INTEGER) AS near_80_percent
    FROM orders GROUP BY o_orderstatus""", name="random_split")
def random_split_orders(spark, sf_dir):
    """Of each status, both parts together hold every order, none is in both, and the share is right
    within ten points."""
    train, test = random_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"))
    both = (train.withColumn("is_train", F.lit(1))
            .unionByName(test.withColumn("is_train", F.lit(0))))
    keys = both.groupBy("o_orderstatus", "o_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_train").alias("n_train"))
    return keys.groupBy("o_orderstatus").agg(
        F.sum("n").alias("n_orders"), F.count(F.lit(1)).alias("n_keys"),
        F.count_if((F.col("n_train") > 0) & (F.col("n_train") < F.col("n"))).alias("n_in_both"),
        (F.sum("n_train") / F.sum("n")).between(0.7, 0.9).cast("int").alias("near_80_percent"))


def _index_sql(name):
    return f"""(SELECT {name}, CAST(row_number() OVER (ORDER BY count(*) DESC, {name}) - 1
        AS DOUBLE) AS {name}_index FROM full_rows GROUP BY {name})"""


_NAMED = rf"""lines AS (
      SELECT l_orderkey, count(*) AS n_lines,
             count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
             min(l_returnflag) AS port
      FROM lineitem GROUP BY l_orderkey),
    raw AS (
      SELECT o_orderkey AS passenger_id, CAST(o_orderstatus = 'F' AS DOUBLE) AS survived,
             CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS class,
             regexp_extract(full_name, '([A-Za-z]+)\.', 1) AS t,
             c_mktsegment AS segment, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS age,
             coalesce(n_lines, 0) AS relatives, coalesce(n_returned, 0) AS children,
             o_totalprice AS fare, port
      FROM orders JOIN titled ON o_custkey = c_custkey
      LEFT JOIN lines ON o_orderkey = l_orderkey),
    named AS (SELECT *, CASE t {_REMAP_CASE} ELSE t END AS title FROM raw)"""


@query(rf"""
    WITH {_TITLED},
    {_NAMED},
    full_rows AS (
      SELECT * REPLACE (
        coalesce(age, round(avg(age) OVER (PARTITION BY title), 0)) AS age,
        coalesce(port, (SELECT port FROM raw WHERE port IS NOT NULL
                        GROUP BY port ORDER BY count(*) DESC, port LIMIT 1)) AS port)
      FROM named)
    SELECT passenger_id, survived, CAST(class AS DOUBLE) AS class, fare, age,
           CAST(relatives AS DOUBLE) AS relatives, CAST(children AS DOUBLE) AS children,
           CAST(relatives + children AS DOUBLE) AS family_size,
           CAST(relatives + children = 0 AS DOUBLE) AS alone,
           segment_index, port_index, title_index
    FROM full_rows JOIN {_index_sql('segment')} USING (segment)
      JOIN {_index_sql('port')} USING (port) JOIN {_index_sql('title')} USING (title)""")
def feature_build(spark, sf_dir):
    """The whole feature build; the vector is laid out as one column per element."""
    built = build_features(passengers(spark, sf_dir), SPEC)
    element = vector_to_array("features")
    return built.select("passenger_id", "survived",
                        *[element[i].alias(c) for i, c in enumerate(SPEC.inputs)])


def _fitted_index_sql(name):
    return f"""(SELECT {name}, CAST(row_number() OVER (ORDER BY count(*) DESC, {name}) - 1
        AS DOUBLE) AS {name}_index FROM full_rows WHERE is_train GROUP BY {name})"""


@query(rf"""
    WITH {_TITLED},
    {_NAMED},
    marked AS (
      SELECT *, CAST('0x' || substr(md5(CAST(passenger_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
        AS is_train FROM named),
    means AS (SELECT title, round(avg(age), 0) AS mean_age FROM marked WHERE is_train GROUP BY title),
    full_rows AS (
      SELECT * REPLACE (
        coalesce(age, mean_age) AS age,
        coalesce(port, (SELECT port FROM marked WHERE is_train AND port IS NOT NULL
                        GROUP BY port ORDER BY count(*) DESC, port LIMIT 1)) AS port)
      FROM marked LEFT JOIN means USING (title))
    SELECT passenger_id, survived, CAST(class AS DOUBLE) AS class, fare, age,
           CAST(relatives AS DOUBLE) AS relatives, CAST(children AS DOUBLE) AS children,
           CAST(relatives + children AS DOUBLE) AS family_size,
           CAST(relatives + children = 0 AS DOUBLE) AS alone,
           segment_index, port_index, title_index
    FROM full_rows JOIN {_fitted_index_sql('segment')} USING (segment)
      JOIN {_fitted_index_sql('port')} USING (port) JOIN {_fitted_index_sql('title')} USING (title)
    WHERE NOT is_train""")
def feature_build_fitted(spark, sf_dir):
    """The feature build learned on the training side, applied to the other."""
    marked = hash_split(passengers(spark, sf_dir), ["passenger_id"])
    built = fit_features(marked.where("is_train"), SPEC).transform(marked.where("not is_train"))
    element = vector_to_array("features")
    return built.select("passenger_id", "survived",
                        *[element[i].alias(c) for i, c in enumerate(SPEC.inputs)])


@query("""
    WITH kinds AS (
      SELECT o_orderkey, o_totalprice, o_orderpriority, bucket < 80 AS is_train,
             CASE WHEN bucket >= 95 THEN 'late' ELSE o_orderstatus END AS kind
      FROM (SELECT *, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS bucket
            FROM orders)),
    kind_index AS (
      SELECT kind, row_number() OVER (ORDER BY count(*) DESC, kind) - 1 AS i FROM kinds WHERE is_train GROUP BY kind),
    priority_index AS (
      SELECT o_orderpriority, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS i
      FROM kinds WHERE is_train GROUP BY o_orderpriority)
    SELECT o_orderkey, kind, o_totalprice AS f0, CAST(coalesce(k.i, (SELECT count(*) FROM kind_index)) AS DOUBLE) AS f1,
           CAST(coalesce(p.i, (SELECT count(*) FROM priority_index)) AS DOUBLE) AS f2
    FROM kinds LEFT JOIN kind_index k USING (kind) LEFT JOIN priority_index p USING (o_orderpriority)
    WHERE NOT is_train""")
def stored_pipeline(spark, sf_dir):
    """Indexing and assembly fitted on the training orders, saved, loaded, and applied to the others, a
    quarter of which have a label that the fit has not seen."""
    orders = hash_split(table(spark, sf_dir, "orders"), ["o_orderkey"])
    late = hash_bucket(F.col("o_orderkey")) >= 95
    kinds = materialize(orders.select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "is_train",
        F.when(late, "late").otherwise(F.col("o_orderstatus")).alias("kind")), "kinds")
    path = scratch_dir(spark, "stages")
    feature_stages(["kind", "o_orderpriority"], ["o_totalprice"], unknown="keep").fit(
        kinds.where("is_train")).save(path)
    scored = PipelineModel.load(path).transform(kinds.where("NOT is_train"))
    features = vector_to_array("features")
    return scored.select("o_orderkey", "kind", *[features[i].alias(f"f{i}") for i in range(3)])
