"""File sources and sinks, table housekeeping, catalog."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell import catalog
from tidewell.functions import epoch_seconds
from tidewell.operators import row_count
from tidewell.plans.history import backfill_batch, daily_counts, dated, write_with_history
from tidewell.plans.registry import query, table
from tidewell.session import materialize, scratch_dir
from tidewell.sinks import (
    WriteLedger, compact, compact_table, export_csv, file_detail, partition_detail,
    table_detail, upsert_partitions, write_clustered, write_lake,
)
from tidewell.sources import (
    file_rows, list_files, read_csv, read_header, read_json, read_projected, read_typed_text,
    rows_from_list, rows_read, split_rejects,
)


def _timed_events(spark, sf_dir):
    """Events with their time as epoch seconds, as an event log has it."""
    return table(spark, sf_dir, "events").select(
        "event_id", epoch_seconds(F.col("ts")).alias("time"), "user_id", "event_type", "value", "props")


@query("""
    SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size,
           p_retailprice
    FROM part""")
def csv_scan(spark, sf_dir):
    """Types are inferred, so a key that fits one becomes an int."""
    path = export_csv(table(spark, sf_dir, "part"), scratch_dir(spark, "csv"))
    return read_csv(spark, path)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_export(spark, sf_dir):
    """Export, read back with the declared schema: no inference pass."""
    customer = table(spark, sf_dir, "customer")
    path = export_csv(customer, scratch_dir(spark, "csv"))
    return read_csv(spark, path, schema=customer.schema)


@query("""
    SELECT event_id, epoch_us(ts) AS time_us, user_id, event_type, value, props FROM events""")
def json_scan(spark, sf_dir):
    """Every column; the types are inferred, but JSON has none for times."""
    path, events = scratch_dir(spark, "json"), table(spark, sf_dir, "events")
    events.withColumn("ts", F.col("ts").cast("string")).write.json(path)
    return read_json(spark, path).select(
        "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"), "user_id",
        "event_type", "value", "props")


HEADER = [("event_id", "int"), ("ts", "string"), ("user_id", "int"), ("value", "double"),
          ("event_type", "string"), ("props", "string")]


@query("""
    SELECT CAST(event_id AS INTEGER) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
           CAST(CASE WHEN event_type = 'error' THEN -1 ELSE user_id END AS INTEGER) AS user_id,
           value, event_type, props
    FROM events""")
def typed_text_parse(spark, sf_dir):
    """Tab-separated lines of all columns with a header file; errors have no user, written as --."""
    path = scratch_dir(spark, "text")
    user = F.when(F.col("event_type") == "error", "--").otherwise(
        F.col("user_id").cast("string"))
    lines = table(spark, sf_dir, "events").select(F.concat_ws(
        "\t", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), user, "value", "event_type", "props"))
    lines.write.text(f"{path}/data")
    rows_from_list(spark, [("\n".join(f"{n}:{t}" for n, t in HEADER),)],
                   "value string").write.text(f"{path}/header")
    header = read_header(spark, f"{path}/header")
    return read_typed_text(spark, f"{path}/data/part-*", header)


_REJECTED = """
    SELECT event_type, count(*) FILTER (NOT bad) AS n_events, count(*) FILTER (bad) AS n_rejected,
           CAST(coalesce(sum(event_id) FILTER (NOT bad), 0) AS BIGINT) AS sum_ids,
           CAST((SELECT count(*) FROM events WHERE {bad}) AS BIGINT) AS observed
    FROM (SELECT *, {bad} AS bad FROM events) GROUP BY event_type"""


def _both_outputs(df, pattern):
    """Good rows and rejects by type, which of a reject is found in its text."""
    good, rejects, counts = split_rejects(df, "_broken")
    both = good.select("event_type", "event_id", F.lit(0).alias("bad")).unionByName(rejects.select(
        F.regexp_extract("_broken", pattern, 1).alias("event_type"), F.lit(0).cast("bigint").alias("event_id"),
        F.lit(1).alias("bad")))
    return both.groupBy("event_type").agg(
        F.count_if(F.col("bad") == 0).alias("n_events"), F.count_if(F.col("bad") == 1).alias("n_rejected"),
        F.sum("event_id").alias("sum_ids"), F.lit(counts["rejected"]).cast("bigint").alias("observed"))


@query(_REJECTED.format(bad="(event_id % 9 = 2 OR event_id % 10 = 3)"))
def csv_rejects(spark, sf_dir):
    """CSV lines with an unreadable key or without the last column are kept as they are, apart."""
    path, event = scratch_dir(spark, "csv"), F.col("event_id")
    key = F.when(event % 9 == 2, F.concat(F.lit("x"), event)).otherwise(event.cast("string"))
    table(spark, sf_dir, "events").select(F.concat_ws(
        ",", "event_type", key, F.when(event % 10 != 3, F.col("value").cast("string")))).write.text(path)
    return _both_outputs(read_csv(spark, path, "event_type string, event_id bigint, value double",
                                  corrupt_column="_broken", header=False), "^([^,]*),")


@query(_REJECTED.format(bad="(event_id % 9 = 2 OR event_id % 10 = 3)"))
def json_rejects(spark, sf_dir):
    """JSON lines that are cut off, or whose key is no number."""
    path, event = scratch_dir(spark, "json"), F.col("event_id")
    line = F.to_json(F.struct("event_type", "event_id", "value"))
    line = F.when(event % 9 == 2, F.regexp_replace(line, '"event_id":', '"event_id":"x",":":')).otherwise(line)
    line = F.when(event % 10 == 3, F.regexp_replace(line, "}$", "")).otherwise(line)
    table(spark, sf_dir, "events").select(line).write.text(path)
    return _both_outputs(read_json(spark, path, "event_type string, event_id bigint, value double",
                                   corrupt_column="_broken"), '"event_type":"([^"]*)"')


@query("""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
    FROM orders WHERE o_orderstatus = 'F'""")
def source_projection_filter(spark, sf_dir):
    return read_projected(
        spark, f"{sf_dir}/orders.parquet",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"],
        "o_orderstatus = 'F'")


@query("""
    WITH asked AS (
      SELECT 'customers' AS asked, * FROM orders WHERE o_custkey BETWEEN 101 AND 110
      UNION ALL SELECT 'order', * FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders))
    SELECT * REPLACE (epoch_us(o_orderdate) AS o_orderdate), 1 AS skipped FROM asked""")
def clustered_lookup(spark, sf_dir):
    """All orders laid out by customer, with a Bloom filter on the order's key, and two selective reads.

    ``skipped``: the scan handed on fewer rows than the table holds.
    """
    orders = table(spark, sf_dir, "orders")
    n_orders, last = orders.agg(F.count(F.lit(1)), F.max("o_orderkey")).first()
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    clustered = write_clustered(orders, scratch_dir(spark, "clustered"), ["o_custkey"],
                                {"o_orderkey": n_orders // files + 1}, files)
    reads = []
    for asked, found in (("customers", clustered.where("o_custkey BETWEEN 101 AND 110")),
                         ("order", clustered.where(F.col("o_orderkey") == last))):
        skipped = int(rows_read(found) < n_orders)
        reads.append(found.select(F.lit(asked).alias("asked"), "*", F.lit(skipped).alias("skipped"))
                     .withColumn("o_orderdate", F.unix_micros(F.col("o_orderdate").cast("timestamp"))))
    return reads[0].unionByName(reads[1])


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _plain_path(path):
    """Listings and scans write the slashes after the scheme in different numbers."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


@query(" UNION ALL ".join(
    f"SELECT '{name}.parquet' AS file_name, 1 AS has_bytes, count(*) AS n_rows FROM {name}"
    for name in TABLES))
def file_listing(spark, sf_dir):
    """The files of all tables, with the rows that their footers name.

    A table may be one file or a folder of them.
    """
    counts = file_rows(spark, sf_dir).select(_plain_path("path").alias("path"), "n_rows")
    files = list_files(spark, sf_dir, "*.parquet", recursive=True)
    return (files.withColumn("path", _plain_path("path")).join(counts, "path")
            .groupBy(F.regexp_extract("path", "([^/]+[.]parquet)(/[^/]+)?$", 1).alias("file_name"))
            .agg(F.min((F.col("length") > 0).cast("int")).alias("has_bytes"), F.sum("n_rows").alias("n_rows")))


@query("""
    SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n_events FROM events GROUP BY 1""")
def partitioned_overwrite(spark, sf_dir):
    """A second overwrite replaces what the first one wrote."""
    events = dated(_timed_events(spark, sf_dir))
    path = scratch_dir(spark, "lake")
    write_lake(events, path, ["date"], "overwrite")
    lake = write_lake(events, path, ["date"], "overwrite")
    return lake.groupBy("date").agg(F.count(F.lit(1)).alias("n_events"))


_WITH_HISTORY = """
    WITH both_parts AS (
      SELECT event_type, ts FROM events
      UNION ALL SELECT event_type, ts - INTERVAL 2 DAY FROM events)"""


@query(_WITH_HISTORY + """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, count(event_type) AS action_count
    FROM both_parts GROUP BY 1, 2 ORDER BY 2, 1""")
def historical_backfill(spark, sf_dir):
    lake = write_with_history(_timed_events(spark, sf_dir), scratch_dir(spark, "lake"))
    return daily_counts(lake, "event_type")


@query(_WITH_HISTORY + """
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS date, count(event_type) AS action_count,
           CAST(3 AS BIGINT) AS n_runs
    FROM both_parts GROUP BY 1, 2""")
def backfill_rerun(spark, sf_dir):
    """The backfill run twice, first onto wrong days: the table holds what the second run wrote, the ledger all three."""
    events, path = _timed_events(spark, sf_dir), scratch_dir(spark, "lake")
    ledger = WriteLedger(spark, scratch_dir(spark, "ledger"))
    backfill_batch(events, path, "events", ledger=ledger)
    for days in (5, 2):
        lake = backfill_batch(events, path, "history", shift=f"-{days * 86400}", ledger=ledger)
    runs = ledger.read().where("operation LIKE 'BATCH %'").count()
    return daily_counts(lake, "event_type").withColumn("n_runs", F.lit(runs).cast("bigint"))


@query(_WITH_HISTORY + """
    SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n_events,
           CAST(1 AS BIGINT) AS num_files
    FROM both_parts GROUP BY 1""")
def compact_partitions(spark, sf_dir):
    """Backfill makes several files per date; afterwards one file each is enough here."""
    lake = write_with_history(_timed_events(spark, sf_dir), scratch_dir(spark, "lake"))
    target = scratch_dir(spark, "compacted")
    compacted = compact(lake, target, ["date"])
    rows = compacted.groupBy("date").agg(F.count(F.lit(1)).alias("n_events"))
    files = partition_detail(spark, target, ["date"]).select("date", "num_files")
    return rows.join(files, "date")


@query(_WITH_HISTORY + """
    SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n_events,
           CAST(1 AS BIGINT) AS num_files
    FROM both_parts GROUP BY 1""")
def compact_fragmented(spark, sf_dir):
    """Only the partitions with too many files are rewritten."""
    path = scratch_dir(spark, "lake")
    lake = write_with_history(_timed_events(spark, sf_dir), path)
    catalog.create_external_table(spark, "events_fragmented", path, lake.schema, ["date"])
    table_now = compact_table(spark, "events_fragmented")
    return (file_detail(table_now, ["date"]).groupBy("date")
            .agg(F.sum("num_rows").alias("n_events"), F.count(F.lit(1)).alias("num_files")))


@query("""
    SELECT strftime(ts, '%Y-%m-%d') AS date, event_type, count(*) * 2 AS n_events,
           CAST(1 AS INTEGER) AS fewer_files, CAST(1 AS INTEGER) AS packed
    FROM events GROUP BY 1, 2""")
def compact_two_columns(spark, sf_dir):
    """A table partitioned by date and type, every partition in two files or more, after packing.

    ``packed``: at most one file of the partition is under half of the wanted size.
    """
    path, wanted = scratch_dir(spark, "lake"), 1 << 20
    events = dated(_timed_events(spark, sf_dir)).withColumn("tags", F.create_map("event_type", "value"))
    for mode in ("overwrite", "append"):
        lake = write_lake(events, path, ["date", "event_type"], mode)
    parts = ["date", "event_type"]
    before = catalog.create_external_table(spark, "events_two_columns", path, lake.schema, parts)
    files = file_detail(before, parts).groupBy(*parts).agg(F.count(F.lit(1)).alias("n_before"))
    after = file_detail(compact_table(spark, "events_two_columns", wanted), parts)
    return (after.groupBy(*parts).agg(
        F.sum("num_rows").alias("n_events"), F.count(F.lit(1)).alias("n_files"),
        F.count_if(F.col("size_in_bytes") < wanted / 2).alias("n_small")).join(files, parts)
        .select(*parts, "n_events", (F.col("n_files") < F.col("n_before")).cast("int").alias("fewer_files"),
                (F.col("n_small") <= 1).cast("int").alias("packed")))


@query("""
    SELECT 'parquet' AS format, 'date' AS partition_columns,
           count(DISTINCT strftime(ts, '%Y-%m-%d')) AS num_partitions,
           count(DISTINCT strftime(ts, '%Y-%m-%d')) AS num_files, 1 AS has_bytes
    FROM events""", name="table_detail")
def table_detail_report(spark, sf_dir):
    """From the directory listing alone.  The size itself depends on the machine."""
    path = scratch_dir(spark, "lake")
    write_lake(dated(_timed_events(spark, sf_dir)), path, ["date"])
    return (table_detail(spark, path, ["date"])
            .withColumn("has_bytes", (F.col("size_in_bytes") > 0).cast("int"))
            .drop("size_in_bytes"))


@query("""
    SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, 'overwrite' AS mode,
           'date' AS partition_by, count(*) AS num_rows FROM events
    UNION ALL
    SELECT CAST(1 AS BIGINT), 'WRITE', 'append', 'date', count(*) FROM events""")
def write_ledger(spark, sf_dir):
    ledger = WriteLedger(spark, scratch_dir(spark, "ledger"))
    write_with_history(_timed_events(spark, sf_dir), scratch_dir(spark, "lake"), ledger=ledger)
    return ledger.read().drop("written_at", "written_by")


def _events_table(spark, sf_dir, name):
    path = scratch_dir(spark, "lake")
    lake = write_lake(dated(_timed_events(spark, sf_dir)), path, ["date"])
    return catalog.create_external_table(spark, name, path, lake.schema, ["date"])


@query("SELECT count(*) AS n_events FROM events")
def external_table_count(spark, sf_dir):
    _events_table(spark, sf_dir, "events_external")
    return spark.sql("SELECT count(*) AS n_events FROM events_external")


def _described_sql(name):
    return f"""
    SELECT column_name AS col_name,
           CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string'
             WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS data_type
    FROM (DESCRIBE {name})"""


@query(_described_sql("events") + """
    UNION ALL SELECT 'Type', 'EXTERNAL' UNION ALL SELECT 'Provider', 'parquet'
    UNION ALL SELECT 'Table', 'events_described'""")
def describe_table(spark, sf_dir):
    """Formatted description, without the lines that name folders, times and versions."""
    schema = table(spark, sf_dir, "events").schema
    catalog.create_external_table(spark, "events_described", f"{sf_dir}/events.parquet", schema)
    return (catalog.describe_table(spark, "events_described")
            .where(F.col("col_name").isin(*schema.names, "Type", "Provider", "Table"))
            .select("col_name", "data_type"))


@query(f"""
    WITH counts AS (SELECT count(COLUMNS(*)) FROM orders)
    SELECT col_name, data_type, n_values
    FROM ({_described_sql("orders")}) JOIN (
      UNPIVOT counts ON COLUMNS(*) INTO NAME col_name VALUE n_values) USING (col_name)""")
def describe_columns(spark, sf_dir):
    """The description of a table next to the non-null values of each column."""
    orders = table(spark, sf_dir, "orders")
    catalog.create_external_table(spark, "orders_described", f"{sf_dir}/orders.parquet",
                                  orders.schema)
    counts = spark.table("orders_described").agg(
        *[F.count(c).alias(c) for c in orders.columns]).unpivot(
        [], orders.columns, "col_name", "n_values")
    return (catalog.describe_table(spark, "orders_described", formatted=False)
            .join(counts, "col_name").select("col_name", "data_type", "n_values"))


@query("""
    SELECT 'tidewell_listing' AS database_name, 'events_listed' AS table_name,
           count(*) AS n_rows FROM events
    UNION ALL SELECT 'tidewell_listing', 'orders_listed', count(*) FROM orders""")
def catalog_listing(spark, sf_dir):
    """Whatever tables the selected database has, one dropped again, with their rows."""
    database = "tidewell_listing"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} "
              f"LOCATION '{scratch_dir(spark, 'database')}'")
    for name in ("events", "orders", "labels"):
        catalog.create_external_table(spark, f"{database}.{name}_listed",
                                      f"{sf_dir}/{name}.parquet",
                                      table(spark, sf_dir, name).schema)
    catalog.drop_table(spark, f"{database}.labels_listed")
    before = spark.catalog.currentDatabase()
    catalog.use_database(spark, database)
    try:
        names = [r["tableName"] for r in catalog.list_tables(spark).where("NOT isTemporary").collect()]
        counts = [row_count(spark.table(name), "n_rows").select(
            F.lit(spark.catalog.currentDatabase()).alias("database_name"), F.lit(name).alias("table_name"), "n_rows")
            for name in names]
    finally:
        catalog.use_database(spark, before)
    listed = catalog.list_databases(spark).select(F.col("namespace").alias("database_name"))
    return reduce(DataFrame.unionByName, counts).join(listed, "database_name", "left_semi")


_NEW_KEYS = 1_000_000_000_000  # added to the keys of the feed's new orders


@query(f"""
    WITH target AS (
      SELECT o_orderkey AS order_key, o_orderstatus AS status, o_totalprice AS amount,
             strftime(o_orderdate, '%Y-%m') AS month FROM orders),
    feed AS (
      SELECT CASE WHEN l_orderkey % 10 = 0 THEN l_orderkey + {_NEW_KEYS} ELSE l_orderkey END
               AS order_key,
             l_linestatus AS status, l_extendedprice AS amount, strftime(l_shipdate, '%Y-%m') AS month,
             l_shipdate, l_linenumber FROM lineitem),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY order_key ORDER BY l_shipdate DESC,
               l_linenumber DESC, status DESC, amount DESC) AS place FROM feed)
    SELECT * FROM target WHERE order_key NOT IN (SELECT order_key FROM ranked)
    UNION ALL
    SELECT order_key, status, amount, month FROM ranked WHERE place = 1""", name="keyed_upsert")
def keyed_upsert_orders(spark, sf_dir):
    """The book of all orders brought up to date by the feed of all order lines.

    Each order takes status, amount and month of its last line, and so moves to the
    partition of that month.  A tenth of the feed are new orders, whose keys are shifted
    beyond those of the book; orders without a line stay as they are.
    """
    _order_book(spark, sf_dir, "order_book")
    line = F.col("l_orderkey")
    feed = table(spark, sf_dir, "lineitem").select(
        F.when(line % 10 == 0, line + _NEW_KEYS).otherwise(line).alias("order_key"),
        F.col("l_linestatus").alias("status"), F.col("l_extendedprice").alias("amount"),
        F.date_format("l_shipdate", "yyyy-MM").alias("month"), "l_shipdate", "l_linenumber")
    return upsert_partitions(spark, "order_book", feed, ["order_key"],
                             ["l_shipdate", "l_linenumber"])


def _order_book(spark, sf_dir, name):
    """A table of all orders, partitioned by the month of their date."""
    book = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("amount"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    path = scratch_dir(spark, "book")
    write_lake(book, path, ["month"])
    return catalog.create_external_table(spark, name, path, book.schema, ["month"])


@query("""
    WITH target AS (
      SELECT o_orderkey AS order_key, CAST(floor(o_totalprice) AS BIGINT) AS amount,
             strftime(o_orderdate, '%Y-%m') AS month, o_orderdate AS day FROM orders),
    feed AS (
      SELECT order_key, amount + 1 AS amount,
             CASE WHEN month = '2001-05' THEN '2001-07' ELSE month END AS month
      FROM target WHERE day >= TIMESTAMP '2001-05-01' OR strftime(day, '%m-%d') = '02-28'),
    after AS (
      SELECT order_key, amount, month FROM target WHERE order_key NOT IN (SELECT order_key FROM feed)
      UNION ALL SELECT order_key, amount, month FROM feed),
    changed AS (
      SELECT month FROM feed UNION SELECT month FROM target
      WHERE order_key IN (SELECT order_key FROM feed))
    SELECT month, count(*) AS n_orders, CAST(sum(amount) AS BIGINT) AS amount,
           CAST(month IN (SELECT month FROM changed) AS INTEGER) AS rewritten
    FROM after GROUP BY month""")
def upsert_touched(spark, sf_dir):
    """Each month of the order book after an upsert, and whether its files are new.

    The feed corrects the orders of the last months and those of each 28th of February; May of 2001
    is moved to July, and its partition goes.
    """
    _order_book(spark, sf_dir, "order_book_touched")
    old = materialize(file_detail(spark.table("order_book_touched"), ["month"]).select("path"), "files")
    day = F.col("o_orderdate")
    month = F.date_format(day, "yyyy-MM")
    feed = (table(spark, sf_dir, "orders")
            .where((day >= F.lit("2001-05-01").cast("timestamp_ntz")) | (F.date_format(day, "MM-dd") == "02-28"))
            .select(F.col("o_orderkey").alias("order_key"), F.col("o_orderstatus").alias("status"),
                    (F.floor("o_totalprice") + 1).cast("double").alias("amount"),
                    F.when(month == "2001-05", "2001-07").otherwise(month).alias("month")))
    after = upsert_partitions(spark, "order_book_touched", feed, ["order_key"], ["amount"])
    fresh = (file_detail(after, ["month"]).join(old, "path", "left_anti")
             .select("month").distinct().withColumn("rewritten", F.lit(1)))
    return (after.groupBy("month").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum(F.floor("amount")).cast("bigint").alias("amount"))
        .join(fresh, "month", "left").withColumn("rewritten", F.coalesce("rewritten", F.lit(0))))
