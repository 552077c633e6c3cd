"""Structured Streaming operators, each run available-now over files Spark lands
from the driver tables, with results read back from the sink."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewell.functions.scalar import day_bucket, epoch_ms_to_ts, from_json_typed, year_month
from tidewell.operators.merge import merge_insert_only
from tidewell.plans.batch_queries import TUMBLING_SQL
from tidewell.plans.common import CUSTOMER_FEED_CTE, CUSTOMERS_CTE, with_ctes
from tidewell.plans.merge_queries import ORDER_SUM_SQL
from tidewell.plans.registry import query
from tidewell.plans.version_queries import FC, FEED_SQL, V15, customer_change_feed
from tidewell.session import scratch_path
from tidewell.sources import shapes
from tidewell.sources.tables import read_table
from tidewell.streaming import joins as SJ
from tidewell.streaming.deletes import delete_downstream, delete_requests, mark_deleted
from tidewell.streaming.expectations import ExpectationLog, observed
from tidewell.streaming.runner import land_files, run_available_now
from tidewell.streaming.stateful import stream_dedup, tumbling_stats
from tidewell.streaming.store import EpochTable, VersionedTable

JSON_TS = {"timestampFormat": shapes.JSON_TS_FORMAT}
ORDER_ROW_DDL = "order_id BIGINT, order_timestamp TIMESTAMP, customer_id BIGINT, quantity BIGINT, total BIGINT"


def _events(spark, d):
    # watermarks need TIMESTAMP (the driver tables hold TIMESTAMP_NTZ)
    return read_table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _events_stream(spark, d, max_files=None):
    e = _events(spark, d)
    path = land_files(e, "parquet", "landing-events")
    r = spark.readStream.schema(e.schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def _read(spark, path):
    return spark.read.parquet(path)


EVENTS_SQL = ("SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value, props FROM events")


# ---------------------------------------------------------------------------- sources


@query("stream_table", EVENTS_SQL)
def q_stream_table(spark, d):
    name = "events_" + uuid.uuid4().hex[:10]
    _events(spark, d).write.option("path", scratch_path(spark, "table-events")).saveAsTable(name)
    out = run_available_now(spark.readStream.table(name), "stream_table")
    return _read(spark, out)


def _feed_json(spark, d) -> str:
    return land_files(shapes.customer_feed(spark, d), "json", "landing-customers", **JSON_TS)


FEED_SQL_ROWS = with_ctes(CUSTOMER_FEED_CTE) + f"SELECT {FC} FROM cf"


@query("ingest_files", FEED_SQL_ROWS)
def q_ingest_files(spark, d):
    src = spark.readStream.schema(shapes.CUSTOMER_DDL).options(**JSON_TS).json(_feed_json(spark, d))
    return _read(spark, run_available_now(src, "ingest_files"))


def inferred_schema(spark, landing: str, schema_location: str):
    """Infer once from the files present, persist the schema JSON, reuse it afterwards."""
    from pyspark.sql.types import StructType
    import json
    from tidewell.session import path_exists
    if path_exists(spark, schema_location):
        text = spark.read.text(schema_location).first()[0]
        return StructType.fromJson(json.loads(text))
    schema = spark.read.json(landing).schema
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite").text(schema_location)
    return schema


@query("ingest_files_inferred", with_ctes(CUSTOMER_FEED_CTE) + """
SELECT customer_id, email, first_name, city, CAST(country_code AS BIGINT) AS country_code, balance, row_status,
       strftime(row_time, '%Y-%m-%dT%H:%M:%S.%f') AS row_time FROM cf
""")
def q_ingest_files_inferred(spark, d):
    landing = _feed_json(spark, d)
    schema = inferred_schema(spark, landing, scratch_path(spark, "schema-customers"))
    src = spark.readStream.schema(schema).json(landing)
    out = _read(spark, run_available_now(src, "ingest_inferred"))
    return out.select("customer_id", "email", "first_name", "city", "country_code", "balance",
                      "row_status", "row_time")


# ---------------------------------------------------------------------------- sinks / modes


@query("stream_append", "SELECT event_id, user_id, event_type, value FROM events WHERE value > 0")
def q_stream_append(spark, d):
    s = _events_stream(spark, d).filter("value > 0").select("event_id", "user_id", "event_type", "value")
    return _read(spark, run_available_now(s, "stream_append", output_mode="append"))


def _complete(spark, sdf, name):
    table = EpochTable(spark, scratch_path(spark, name))
    run_available_now(sdf, name, output_mode="complete", foreach_batch=table.write)
    return table.read()


@query("stream_complete", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def q_stream_complete(spark, d):
    s = _events_stream(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return _complete(spark, s, "stream_complete")


@query("stream_daily_gold", """
SELECT date_trunc('day', CAST(ts AS TIMESTAMP)) AS day, event_type, count(*) AS n, round(sum(value), 2) AS total_value
FROM events GROUP BY 1, 2
""")
def q_stream_daily_gold(spark, d):
    s = (_events_stream(spark, d).groupBy(day_bucket("ts").alias("day"), "event_type")
         .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total_value")))
    return _complete(spark, s, "stream_daily_gold")


@query("stream_sql_view", """
SELECT event_id, user_id, value * 2 AS double_value FROM events WHERE event_type = 'purchase'
""")
def q_stream_sql_view(spark, d):
    _events_stream(spark, d).createOrReplaceTempView("events_stream_v")
    s = spark.sql("SELECT event_id, user_id, value * 2 AS double_value FROM events_stream_v "
                  "WHERE event_type = 'purchase'")
    return _read(spark, run_available_now(s, "stream_sql_view"))


# ---------------------------------------------------------------------------- dedup / windows


def _orders_json(spark, d, twice=True, chunks=None) -> str:
    o = shapes.book_orders(spark, d).drop("books")
    path = land_files(o, "json", "landing-orders", chunks=chunks, **JSON_TS)
    if twice:  # the same orders delivered again
        land_files(o, "json", "landing-orders", chunks=chunks, path=path, **JSON_TS)
    return path


@query("stream_dedup", ORDER_SUM_SQL)
def q_stream_dedup(spark, d):
    src = spark.readStream.schema(ORDER_ROW_DDL).options(**JSON_TS).json(_orders_json(spark, d))
    s = stream_dedup(src, ["order_id", "order_timestamp"], "order_timestamp", "30 seconds")
    return _read(spark, run_available_now(s, "stream_dedup"))


@query("dedup_parity", "SELECT count(*) AS batch_rows, count(*) AS stream_rows FROM orders")
def q_dedup_parity(spark, d):
    from tidewell.operators.aggregate import dedup_batch
    path = _orders_json(spark, d)
    batch = dedup_batch(spark.read.schema(ORDER_ROW_DDL).options(**JSON_TS).json(path),
                        ["order_id", "order_timestamp"])
    src = spark.readStream.schema(ORDER_ROW_DDL).options(**JSON_TS).json(path)
    streamed = _read(spark, run_available_now(
        stream_dedup(src, ["order_id", "order_timestamp"], "order_timestamp", "30 seconds"), "dedup_parity"))
    b = batch.agg(F.count(F.lit(1)).alias("batch_rows"))
    s = streamed.agg(F.count(F.lit(1)).alias("stream_rows"))
    # two one-row aggregates side by side
    return b.withColumn("_k", F.lit(1)).join(s.withColumn("_k", F.lit(1)), "_k").drop("_k")


TUMBLING_STREAM_SQL = TUMBLING_SQL.replace(
    "{having}", "HAVING time_bucket(INTERVAL 5 MINUTE, CAST(ts AS TIMESTAMP)) + INTERVAL 5 MINUTE <= "
    "(SELECT max(CAST(ts AS TIMESTAMP)) FROM events) - INTERVAL 10 MINUTE")


@query("tumbling_stats_stream", TUMBLING_STREAM_SQL)
def q_tumbling_stats_stream(spark, d):
    s = tumbling_stats(_events_stream(spark, d), "ts", ["event_type"], "event_id", "value",
                       watermark="10 minutes")
    return _read(spark, run_available_now(s, "tumbling_stats_stream", output_mode="append"))


@query("late_rows", TUMBLING_STREAM_SQL)
def q_late_rows(spark, d):
    """Events land in time order in three drops, each processed by an available-now
    run on the same checkpoint; between the second and third drop a late copy of
    the first five days lands.  Its rows are behind the watermark and ignored."""
    e = _events(spark, d)
    ts = F.col("ts")
    day = lambda n: F.lit(f"2024-01-{n:02d}").cast("timestamp")
    drops = [e.filter(ts < day(11)), e.filter((ts >= day(11)) & (ts < day(21))),
             e.filter(ts < day(6)),  # late copy
             e.filter(ts >= day(21))]
    landing, out = scratch_path(spark, "landing-late"), scratch_path(spark, "late_rows")
    ckpt = scratch_path(spark, "checkpoint-late_rows")
    for drop in drops:
        land_files(drop, "parquet", "landing-late", path=landing)
        src = spark.readStream.schema(e.schema).parquet(landing)
        s = tumbling_stats(src, "ts", ["event_type"], "event_id", "value", watermark="10 minutes")
        run_available_now(s, "late_rows", path=out, checkpoint=ckpt, output_mode="append")
    return _read(spark, out)


# ---------------------------------------------------------------------------- joins


def _orders_stream(spark, d, nested=True):
    o = shapes.book_orders(spark, d)
    if not nested:
        o = o.drop("books")
    path = land_files(o, "parquet", "landing-orders-pq")
    return spark.readStream.schema(o.schema).parquet(path)


@query("stream_static_join", """
SELECT l_orderkey AS order_id, l_partkey AS book_id, p_name AS title, p_brand AS author,
       CAST(l_quantity AS BIGINT) AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def q_stream_static_join(spark, d):
    items = _orders_stream(spark, d).select("order_id", F.explode("books").alias("b")).select(
        "order_id", "b.book_id", "b.quantity")
    out = scratch_path(spark, "books_sales")

    def sink(df, epoch):
        df.select("order_id", "book_id", "title", "author", "quantity").write.mode("overwrite").parquet(
            f"{out}/epoch={epoch}")

    fb = SJ.fresh_static_join(lambda: shapes.books(spark, d), "book_id", "inner", sink)
    run_available_now(items, "stream_static_join", foreach_batch=fb)
    return spark.read.parquet(out).drop("epoch")


@query("stream_left_join", with_ctes(CUSTOMERS_CTE) + """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, cu.email, cu.segment
FROM orders LEFT JOIN (SELECT * FROM cu WHERE email IS NOT NULL) cu ON o_custkey = cu.customer_id
""")
def q_stream_left_join(spark, d):
    o = _orders_stream(spark, d, nested=False).select("order_id", "customer_id")
    c = shapes.customers(spark, d).filter(F.col("email").isNotNull()).select("customer_id", "email", "segment")
    s = SJ.stream_static_join(o, c, "customer_id", "left")
    return _read(spark, run_available_now(s, "stream_left_join"))


@query("stream_stream_join", with_ctes(CUSTOMERS_CTE) + """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, cu.email, cu.country_code
FROM orders JOIN cu ON o_custkey = cu.customer_id
""")
def q_stream_stream_join(spark, d):
    o = _orders_stream(spark, d, nested=False).select("order_id", "customer_id")
    c = shapes.customers(spark, d).select("customer_id", "email", "country_code")
    cpath = land_files(c, "parquet", "landing-customers-pq")
    cs = spark.readStream.schema(c.schema).parquet(cpath)
    s = SJ.stream_stream_join(o, cs, ["customer_id"], "inner")
    return _read(spark, run_available_now(s, "stream_stream_join"))


# ---------------------------------------------------------------------------- multiplex bronze


# The envelope carries each value as Base64 in JSON text, several times its size: it lands compressed.  Tasks cannot
# share a compressed file, so its rows are bounded.
LANDED = {"compression": "gzip", "maxRecordsPerFile": 200_000}
BRONZE = {"partition_by": ["topic", "year_month"], "compression": "zstd"}


def land_envelope(spark, d, path: str | None = None, where: str | None = None) -> str:
    feed = shapes.bronze_envelope(spark, d)
    return land_files(feed.filter(where) if where else feed, "json", "landing-kafka", path=path, **LANDED)


def bronze_stream(spark, landing: str):
    """Envelope JSON → bronze rows with an event timestamp and a month partition."""
    src = spark.readStream.schema(shapes.ENVELOPE_DDL).json(landing)
    ts = epoch_ms_to_ts("timestamp")
    return src.withColumn("timestamp", ts).withColumn("year_month", year_month("timestamp"))


def build_bronze(spark, d) -> str:
    out = scratch_path(spark, "bronze")
    run_available_now(bronze_stream(spark, land_envelope(spark, d)), "bronze", path=out, **BRONZE)
    return out


BRONZE_SQL = """
SELECT 'orders' AS topic, strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m') AS year_month,
       CAST(o_orderkey AS VARCHAR) AS key, o_orderkey AS "offset", CAST(o_orderdate AS TIMESTAMP) AS "timestamp"
FROM orders
UNION ALL
SELECT 'customers', strftime(CAST(ts AS TIMESTAMP), '%Y-%m'), CAST(user_id AS VARCHAR), epoch_us(CAST(ts AS TIMESTAMP)),
       make_timestamp((epoch_us(CAST(ts AS TIMESTAMP)) // 1000) * 1000)
FROM events
UNION ALL
SELECT 'books', strftime(CAST(ts AS TIMESTAMP), '%Y-%m'), CAST(user_id AS VARCHAR), epoch_us(CAST(ts AS TIMESTAMP)),
       make_timestamp((epoch_us(CAST(ts AS TIMESTAMP)) // 1000) * 1000)
FROM events
"""


@query("bronze_multiplex", BRONZE_SQL)
def q_bronze_multiplex(spark, d):
    b = spark.read.parquet(build_bronze(spark, d))
    return b.select("topic", "year_month", F.col("key").cast("string").alias("key"), "offset", "timestamp")


ORDER_VALUE_DDL = (ORDER_ROW_DDL + f", books ARRAY<{shapes.ITEM_DDL}>")


def demux(bronze_stream_df, topic: str, ddl: str):
    """Silver rows of one topic: filter (partition-pruned) → parse → expand."""
    return (bronze_stream_df.filter(F.col("topic") == topic)
            .select(from_json_typed("value", ddl, JSON_TS).alias("v")).select("v.*"))


@query("demux_topic", ORDER_SUM_SQL)
def q_demux_topic(spark, d):
    bronze = build_bronze(spark, d)
    schema = spark.read.parquet(bronze).schema
    s = demux(spark.readStream.schema(schema).parquet(bronze), "orders", ORDER_VALUE_DDL).drop("books")
    return _read(spark, run_available_now(s, "demux_orders"))


# ---------------------------------------------------------------------------- upserts / deletes


@query("upsert_stream", ORDER_SUM_SQL)
def q_upsert_stream(spark, d):
    """Orders arrive in three time-ordered drops, each delivered twice; after each drop
    an available-now run deduplicates within the watermark and insert-merges every
    micro-batch into the versioned table (same checkpoint across runs)."""
    o = shapes.book_orders(spark, d).drop("books")
    ts = F.col("order_timestamp")
    y = lambda n: F.lit(f"{n}-01-01").cast("timestamp")
    drops = [o.filter(ts < y(1997)), o.filter((ts >= y(1997)) & (ts < y(1999))), o.filter(ts >= y(1999))]
    landing = scratch_path(spark, "landing-orders-drops")
    ckpt = scratch_path(spark, "checkpoint-upsert_stream")
    keys = ["order_id", "order_timestamp"]
    # months as buckets: a drop is local in time, so a batch rewrites its own months only
    table = VersionedTable(spark, scratch_path(spark, "orders_silver"), keys,
                           bucket_by="year(order_timestamp) * 12 + month(order_timestamp)")
    table.create(spark.createDataFrame([], o.schema))

    def upsert(batch, epoch):
        table.commit(epoch + 1, batch, lambda cur, src: merge_insert_only(cur, src, keys),
                     commit_ts=F.lit(None).cast("timestamp"))

    for drop in drops:
        for _ in range(2):
            land_files(drop, "json", "landing-orders", path=landing, **JSON_TS)
        src = spark.readStream.schema(ORDER_ROW_DDL).options(**JSON_TS).json(landing)
        s = stream_dedup(src, keys, "order_timestamp", "30 seconds")
        run_available_now(s, "upsert_stream", output_mode="update", foreach_batch=upsert, checkpoint=ckpt)
    return table.read()


@query("delete_requests", with_ctes(CUSTOMER_FEED_CTE) + """
SELECT customer_id, row_time AS request_timestamp, CAST(row_time AS DATE) + 30 AS deadline, 'requested' AS status
FROM cf WHERE row_status = 'delete'
""")
def q_delete_requests(spark, d):
    src = spark.readStream.schema(shapes.CUSTOMER_DDL).options(**JSON_TS).json(_feed_json(spark, d))
    return _read(spark, run_available_now(delete_requests(src), "delete_requests"))


def _propagate_deletes(spark, d):
    """Delete rows from the change feed of customers remove that customer's orders
    downstream and mark the delete requests done, one micro-batch at a time.  Returns
    both tables."""
    feed = customer_change_feed(spark, d)
    feed_path = scratch_path(spark, "customers-changes")
    feed.hint("rebalance", "_commit_version").write.partitionBy("_commit_version").parquet(feed_path)
    orders = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"),
                                                   F.col("o_custkey").alias("customer_id"))
    down = VersionedTable(spark, scratch_path(spark, "customers_orders"), ["customer_id"])
    down.create(orders)
    reqs = VersionedTable(spark, scratch_path(spark, "delete_requests"), ["customer_id"])
    reqs.create(delete_requests(shapes.customer_feed(spark, d)))
    schema = spark.read.parquet(feed_path).schema
    deletes = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(feed_path)
               .filter(F.col("_change_type") == "delete").select("customer_id"))

    def propagate(batch, epoch):
        keys = batch.select("customer_id").distinct()
        ts = F.lit(None).cast("timestamp")
        down.commit(epoch + 1, keys, lambda cur, k: delete_downstream(k, cur, ["customer_id"]), commit_ts=ts)
        reqs.commit(epoch + 1, keys, lambda cur, k: mark_deleted(k, cur, ["customer_id"]), commit_ts=ts)

    run_available_now(deletes, "propagate_deletes", foreach_batch=propagate)
    return down.read(), reqs.read()


@query("propagate_deletes", FEED_SQL + """
SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders
WHERE o_custkey NOT IN (SELECT customer_id FROM feed WHERE _change_type = 'delete')
""")
def q_propagate_deletes(spark, d):
    return _propagate_deletes(spark, d)[0]


@query("propagate_deletes_requests", FEED_SQL + """
SELECT customer_id, row_time AS request_timestamp, CAST(row_time AS DATE) + 30 AS deadline,
       CASE WHEN customer_id IN (SELECT customer_id FROM feed WHERE _change_type = 'delete')
            THEN 'deleted' ELSE 'requested' END AS status
FROM cf WHERE row_status = 'delete'
""")
def q_propagate_deletes_requests(spark, d):
    return _propagate_deletes(spark, d)[1]


@query("stream_changes", FEED_SQL + f"SELECT * FROM feed WHERE _commit_version >= {V15}")
def q_stream_changes(spark, d):
    path = scratch_path(spark, "customers-changes")
    customer_change_feed(spark, d).hint("rebalance", "_commit_version").write.partitionBy("_commit_version").parquet(path)
    schema = spark.read.parquet(path).schema
    s = spark.readStream.schema(schema).parquet(path).filter(F.col("_commit_version") >= V15)
    return _read(spark, run_available_now(s, "stream_changes"))


@query("arrival_stamp", with_ctes(CUSTOMER_FEED_CTE) + """
SELECT customer_id, row_time, true AS stamped, true AS from_json_file FROM cf
""")
def q_arrival_stamp(spark, d):
    src = spark.readStream.schema(shapes.CUSTOMER_DDL).options(**JSON_TS).json(_feed_json(spark, d))
    s = (src.withColumn("arrival_time", F.current_timestamp())
         .withColumn("source_file", F.col("_metadata.file_path")))
    out = _read(spark, run_available_now(s, "arrival_stamp"))
    return out.select("customer_id", "row_time", F.col("arrival_time").isNotNull().alias("stamped"),
                      F.col("source_file").endswith(".json").alias("from_json_file"))


@query("clean_positive", "SELECT event_id, value, true AS stamped FROM events WHERE value > 10")
def q_clean_positive(spark, d):
    s = (_events_stream(spark, d).filter(F.col("value") > 10)
         .withColumn("processed_time", F.current_timestamp()).select("event_id", "value", "processed_time"))
    out = _read(spark, run_available_now(s, "clean_positive"))
    return out.select("event_id", "value", F.col("processed_time").isNotNull().alias("stamped"))


@query("stream_expectations", """
WITH e AS (SELECT value, user_id, event_type FROM events)
SELECT 'values' AS name, 'valid_value' AS rule, count(*) AS input_rows, count(*) FILTER (WHERE NOT coalesce(value >= 1, false)) AS failed_rows,
       count(*) FILTER (WHERE NOT coalesce(value >= 1 AND user_id IS NOT NULL, false)) AS dropped_rows FROM e
UNION ALL SELECT 'values', 'has_user', count(*), count(*) FILTER (WHERE user_id IS NULL),
       count(*) FILTER (WHERE NOT coalesce(value >= 1 AND user_id IS NOT NULL, false)) FROM e
UNION ALL SELECT 'types', 'no_error', count(*), count(*) FILTER (WHERE NOT coalesce(event_type <> 'error', false)), 0
FROM e WHERE value >= 1 AND user_id IS NOT NULL
UNION ALL SELECT 'passed', 'rows', count(*), 0, 0 FROM e WHERE value >= 1 AND user_id IS NOT NULL
""")
def q_stream_expectations(spark, d):
    """Rules that drop and a rule that warns behind them, over several deliveries; counts summed over micro-batches."""
    e = read_table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    landing = land_files(e, "parquet", "landing-expect", [F.col("event_type") == "click", ~F.col("event_type").eqNullSafe("click")])
    log = ExpectationLog(spark, scratch_path(spark, "expectations"))
    spark.streams.addListener(log)
    try:
        feed = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 4).parquet(landing)
        kept = observed(feed, "values", {"valid_value": "value >= 1", "has_user": "user_id IS NOT NULL"}, drop=True)
        out = run_available_now(observed(kept, "types", {"no_error": "event_type <> 'error'"}), "expect")
        log.wait()
    finally:
        spark.streams.removeListener(log)
    counts = log.table().groupBy("name", "rule").agg(*[F.sum(c).alias(c) for c in ("input_rows", "failed_rows", "dropped_rows")])
    passed = spark.read.schema(e.schema).parquet(out).agg(F.count(F.lit(1)).alias("input_rows")).select(
        F.lit("passed").alias("name"), F.lit("rows").alias("rule"), "input_rows", F.lit(0).cast("long").alias("failed_rows"),
        F.lit(0).cast("long").alias("dropped_rows"))
    return counts.unionByName(passed)
