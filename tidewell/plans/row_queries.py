"""Projections, filters, aggregates and profiles."""

from pyspark.sql import functions as F

from tidewell.catalog import cache_table, cached_table, clear_cache, register_view
from tidewell.functions import epoch_seconds
from tidewell.operators import (
    column_summary, exact_summary, global_mean as mean_of, group_count, group_mean, mean_between, null_profile,
    remap_from_table, remap_values, row_count, text_summary, top_rows,
)
from tidewell.plans.history import daily_counts_of_raw
from tidewell.plans.registry import query, table
from tidewell.session import materialize


@query("""
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, count(event_type) AS action_count
    FROM events GROUP BY 1, 2 ORDER BY 2, 1""")
def daily_action_counts(spark, sf_dir):
    """Events per type and day, in that order (the flagship)."""
    events = table(spark, sf_dir, "events")
    return daily_counts_of_raw(events, "event_type", epoch_seconds(F.col("ts")))


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def project_columns(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def drop_columns(spark, sf_dir):
    """Names that do not exist, or no longer exist, are ignored."""
    return (table(spark, sf_dir, "part").drop("p_brand", "p_type", "p_container")
            .drop("p_brand"))


@query("SELECT p_brand FROM part WHERE p_size = 46")
def filter_equality(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.filter(part.p_size == 46).select("p_brand")


@query("SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderpriority").distinct()


@query("""
    SELECT p_partkey, p_name,
           CASE p_type WHEN 'ECONOMY' THEN 'OTHER' WHEN 'SMALL' THEN 'OTHER' ELSE p_type END
             AS p_type
    FROM part""")
def value_remap(spark, sf_dir):
    """Whole-cell replacement in every text column."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return remap_values(part, {"ECONOMY": "OTHER", "SMALL": "OTHER"})


@query("SELECT o_orderstatus, count(*) AS n_orders FROM orders GROUP BY o_orderstatus")
def group_count_one_key(spark, sf_dir):
    return group_count(table(spark, sf_dir, "orders"), ["o_orderstatus"], "n_orders")


@query("""
    SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders
    FROM orders GROUP BY o_orderstatus, o_orderpriority""")
def group_count_two_keys(spark, sf_dir):
    return group_count(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"],
                       "n_orders")


@query("SELECT round(avg(value), 4) AS mean_value FROM events")
def global_mean(spark, sf_dir):
    mean = mean_of(table(spark, sf_dir, "events"), "value")
    return spark.range(1).select(F.round(F.lit(mean), 4).alias("mean_value"))


@query("""
    SELECT event_type, round(avg(value), 4) AS mean_value FROM events GROUP BY event_type""")
def avg_by_group(spark, sf_dir):
    means = group_mean(table(spark, sf_dir, "events"), ["event_type"], "value", "mean_value")
    return means.withColumn("mean_value", F.round("mean_value", 4))


@query("""
    SELECT round(mean_price, 4) AS mean_price, year FROM (
      SELECT avg(o_totalprice) AS mean_price, CAST(year(o_orderdate) AS INTEGER) AS year
      FROM orders GROUP BY 2)
    WHERE year > 1995 AND year < 2000""")
def avg_by_year(spark, sf_dir):
    # The range of the raw column reaches the scan; the years of the groups do not.
    orders = (table(spark, sf_dir, "orders")
              .where("o_orderdate >= timestamp_ntz'1996-01-01' and o_orderdate < timestamp_ntz'2000-01-01'")
              .withColumn("year", F.year("o_orderdate")))
    means = mean_between(orders, "year", "o_totalprice", 1995, 2000, "mean_price")
    return means.withColumn("mean_price", F.round("mean_price", 4))


def _summary_sql(source, columns):
    return " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean,
           round(stddev({c}), 4) AS stddev, CAST(min({c}) AS DOUBLE) AS min,
           CAST(max({c}) AS DOUBLE) AS max
    FROM {source}""" for c in columns)


SUMMARISED = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(_summary_sql("lineitem", SUMMARISED), name="column_summary")
def column_summary_numeric(spark, sf_dir):
    return column_summary(table(spark, sf_dir, "lineitem"), SUMMARISED, digits=4)


@query(_summary_sql("orders", ["o_totalprice"]))
def column_summary_one(spark, sf_dir):
    return column_summary(table(spark, sf_dir, "orders"), ["o_totalprice"], digits=4)


_TEXTS = ["o_orderstatus", "o_orderpriority"]


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, min({c}) AS min, max({c}) AS max "
    "FROM orders" for c in _TEXTS))
def column_summary_text(spark, sf_dir):
    return text_summary(table(spark, sf_dir, "orders"), _TEXTS)


@query("""
    SELECT column_name, null_count FROM (
      SELECT 'quality' AS column_name, count(*) - count(l.quality) AS null_count
      FROM documents d LEFT JOIN labels l USING (doc_id)
      UNION ALL
      SELECT 'toxic', count(*) - count(l.toxic)
      FROM documents d LEFT JOIN labels l USING (doc_id)
      UNION ALL
      SELECT 'text', count(*) - count(d.text) FROM documents d
      UNION ALL
      SELECT 'lang', count(*) - count(d.lang) FROM documents d)
    WHERE null_count > 0""", name="null_profile")
def null_profile_labels(spark, sf_dir):
    """Documents without a label have null label columns after the join."""
    documents = table(spark, sf_dir, "documents")
    labelled = documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return null_profile(labelled)


@query("SELECT count(*) AS n_orders FROM orders")
def view_sql_count(spark, sf_dir):
    register_view(table(spark, sf_dir, "orders"), "orders_view")
    return spark.sql("SELECT count(*) AS n_orders FROM orders_view")


@query("SELECT count(*) AS n_lines FROM lineitem")
def row_count_dataframe(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"), "n_lines")


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 15""")
def cached_view_limit(spark, sf_dir):
    """First rows by key of a view that is cached meanwhile."""
    columns = ["o_orderkey", "o_custkey", "o_totalprice"]
    register_view(table(spark, sf_dir, "orders").select(*columns), "orders_cached_view")
    with cached_table(spark, "orders_cached_view", lazy=True) as view:
        return materialize(top_rows(view, 15, ["o_orderkey"]), "top")


_EXACT_SQL = {"big_key": "o_orderkey + 9007199254740992", "price": "CAST(o_totalprice AS DECIMAL(38, 10))",
              "day": "CAST(o_orderdate AS DATE)", "o_orderpriority": "o_orderpriority"}


@query(" UNION ALL ".join(f"""
    SELECT '{name}' AS column_name, '{kind}' AS data_type, count({sql}) AS count,
           CAST(min({sql}) AS VARCHAR) AS min, CAST(max({sql}) AS VARCHAR) AS max FROM orders"""
    for (name, sql), kind in zip(_EXACT_SQL.items(), ("bigint", "decimal(38,10)", "date", "string"))),
    name="exact_summary")
def exact_summary_orders(spark, sf_dir):
    """Keys beyond what a double holds, long decimals, dates and text, all in one pass."""
    return exact_summary(table(spark, sf_dir, "orders").select(
        *[F.expr(sql).alias(name) for name, sql in _EXACT_SQL.items()]))


@query("""
    SELECT l_orderkey, l_linenumber, coalesce(p_name, CAST(l_partkey AS VARCHAR)) AS part
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 3 <> 0) ON l_partkey = p_partkey""",
    name="remap_from_table")
def remap_parts(spark, sf_dir):
    """Part numbers replaced by names from a table that knows two of three."""
    names = table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(
        F.col("p_partkey").cast("string").alias("old"), F.col("p_name").alias("new"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return remap_from_table(lines, names, "part")


@query("""
    SELECT o_orderstatus, count(*) AS n_orders, (SELECT round(avg(o_totalprice), 4) FROM orders) AS mean_price,
           CAST(1 AS INTEGER) AS from_memory, CAST(1 AS INTEGER) AS released
    FROM orders GROUP BY o_orderstatus""")
def cached_view_reads(spark, sf_dir):
    """Two reads of one cached view, both from memory by their plans, and the cache cleared after."""
    register_view(table(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice"), "orders_read_twice")
    cache_table(spark, "orders_read_twice")
    reads = [group_count(spark.table("orders_read_twice"), ["o_orderstatus"], "n_orders"),
             spark.sql("SELECT round(avg(o_totalprice), 4) AS mean_price FROM orders_read_twice")]
    cached = [int("InMemoryRelation" in r._jdf.queryExecution().executedPlan().toString()) for r in reads]
    counts, mean = materialize(reads[0], "counts"), reads[1].first()[0]
    clear_cache(spark)
    return counts.withColumns({
        "mean_price": F.lit(mean), "from_memory": F.lit(min(cached)),
        "released": F.lit(int(not spark.catalog.isCached("orders_read_twice")))})
