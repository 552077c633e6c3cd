"""Reference-shaped datasets derived by Spark from the driver tables.

The workloads this library serves (bookstore orders with nested items, a
Kafka-shaped multiplex bronze feed, customer change-data-capture rows, price
history) are built here from the TPC-H-like tables, so every query's work grows
with the input.  All derivations are built-in column expressions, joins and
aggregates: no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.joins import broadcast_lookup
from tidewell.sources.tables import read_table

# Customer change statuses by event type, and the JSON time format
# used in the envelope so that microseconds survive a round trip.
STATUS_BY_EVENT = {"signup": "insert", "error": "delete"}  # every other type is "update"
DOMAIN_SUFFIXES = ["com", "org", "edu", "net", "io"]
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
JSON_OPTS = {"timestampFormat": JSON_TS_FORMAT}

ITEM_DDL = "STRUCT<book_id: BIGINT, quantity: BIGINT, subtotal: BIGINT>"
ORDER_DDL = ("order_id BIGINT, order_timestamp TIMESTAMP, customer_id BIGINT, quantity BIGINT, "
             f"total BIGINT, books ARRAY<{ITEM_DDL}>")
CUSTOMER_DDL = ("customer_id BIGINT, email STRING, first_name STRING, city STRING, "
                "country_code INT, balance DOUBLE, row_status STRING, row_time TIMESTAMP")
BOOK_DDL = "book_id BIGINT, title STRING, author STRING, price DOUBLE, updated TIMESTAMP"
ENVELOPE_DDL = ("key BINARY, value BINARY, topic STRING, partition BIGINT, offset BIGINT, "
                "timestamp BIGINT")


def order_items(lineitem: DataFrame) -> DataFrame:
    """Per-order item array and totals; one partial+final aggregate keyed by order."""
    item = F.struct(
        F.col("l_partkey").alias("book_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.floor("l_extendedprice").cast("bigint").alias("subtotal"),
    )
    return (lineitem
            .select(F.col("l_orderkey").alias("order_id"), item.alias("item"))
            .groupBy("order_id")
            .agg(F.array_sort(F.collect_list("item")).alias("books"),
                 F.sum("item.quantity").alias("quantity"),
                 F.sum("item.subtotal").alias("total")))


def book_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``books ARRAY<STRUCT<book_id, quantity, subtotal>>``.

    Orders without line items keep NULL ``books``/``quantity``/``total``.
    The item array of one order is bounded by that order's own lines.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_timestamp"),
        F.col("o_custkey").alias("customer_id"))
    items = order_items(read_table(spark, sf_dir, "lineitem"))
    return (orders.join(items, "order_id", "left")
            .select("order_id", "order_timestamp", "customer_id", "quantity", "total", "books"))


def customer_email(custkey: Column, segment: Column, nationkey: Column, balance: Column) -> Column:
    domain = F.concat(F.lower(segment), F.lit("."),
                      F.element_at(F.array(*[F.lit(s) for s in DOMAIN_SUFFIXES]),
                                   (F.pmod(nationkey, F.lit(len(DOMAIN_SUFFIXES))) + 1).cast("int")))
    return F.when(balance >= 0, F.concat(F.lit("c"), custkey.cast("string"), F.lit("@"), domain))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension: ``customer_id, email (NULL when balance < 0), name, country_code, …``."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        customer_email(F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey"),
                       F.col("c_acctbal")).alias("email"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("country_code"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"))


def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a nested JSON ``profile`` string (name and address)."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    profile = F.to_json(F.struct(
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.struct(F.concat(F.lit("street "), F.col("c_custkey").cast("string")).alias("street"),
                 F.concat(F.lit("city "), F.col("c_nationkey").cast("string")).alias("city"),
                 F.col("n_name").alias("country")).alias("address")))
    return (broadcast_lookup(c, n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    customer_email(F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_nationkey"),
                                   F.col("c_acctbal")).alias("email"),
                    profile.alias("profile")))


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``code INT, country STRING`` (25 rows; size-bounded, safe to broadcast)."""
    return read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("code"), F.col("n_name").alias("country"))


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book catalogue from ``part``."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("book_id"), F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"))


def row_status(event_type: Column) -> Column:
    expr = F.lit("update")
    for ev, status in reversed(list(STATUS_BY_EVENT.items())):
        expr = F.when(event_type == ev, F.lit(status)).otherwise(expr)
    return expr


def customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer change rows from ``events``: one row per event, keyed by user.

    ``signup`` → insert, ``error`` → delete, anything else → update; ``row_time``
    is the event time, so ``(customer_id, row_time)`` orders each key's history.
    """
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("customer_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@"), F.col("event_type"),
                 F.lit(".com")).alias("email"),
        F.concat(F.lit("First"), F.col("user_id").cast("string")).alias("first_name"),
        F.concat(F.lit("City"), F.get_json_object("props", "$.k")).alias("city"),
        F.pmod(F.col("user_id"), F.lit(25)).cast("int").alias("country_code"),
        F.col("value").alias("balance"),
        row_status(F.col("event_type")).alias("row_status"),
        F.col("ts").cast("timestamp").alias("row_time"))


def price_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book price updates from ``events``: ``book_id`` = user, ``price`` = value."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("book_id"),
        F.concat(F.lit("Book "), F.col("user_id").cast("string")).alias("title"),
        F.concat(F.lit("Author "), F.pmod(F.col("user_id"), F.lit(10)).cast("string")).alias("author"),
        F.col("value").alias("price"),
        F.col("ts").cast("timestamp").alias("updated"))


BOOK_STATUS_BY_EVENT = {"signup": "INSERT", "error": "DELETE"}  # every other type is "UPDATE"
BOOK_CDC_DDL = ("book_id BIGINT, title STRING, author STRING, price DOUBLE, row_status STRING, "
                "row_time TIMESTAMP")


def books_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book change rows (``row_status`` INSERT/UPDATE/DELETE, ``row_time``) from ``events``."""
    e = read_table(spark, sf_dir, "events")
    status = F.lit("UPDATE")
    for ev, st in reversed(list(BOOK_STATUS_BY_EVENT.items())):
        status = F.when(F.col("event_type") == ev, F.lit(st)).otherwise(status)
    return e.select(
        F.col("user_id").alias("book_id"),
        F.concat(F.lit("Book "), F.col("user_id").cast("string")).alias("title"),
        F.concat(F.lit("Author "), F.pmod(F.col("user_id"), F.lit(10)).cast("string")).alias("author"),
        F.col("value").alias("price"), status.alias("row_status"),
        F.col("ts").cast("timestamp").alias("row_time"))


def _envelope(df: DataFrame, topic: str, key: str, offset: Column, ts: Column) -> DataFrame:
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), JSON_OPTS)
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(4)).cast("bigint").alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.unix_millis(ts).alias("timestamp"))


def bronze_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped multiplex feed: topics ``orders``, ``customers``, ``books``."""
    o = book_orders(spark, sf_dir)
    c = customer_feed(spark, sf_dir)
    b = price_feed(spark, sf_dir)
    # offsets: order key for orders; event time in microseconds for the event-derived topics
    return (_envelope(o, "orders", "order_id", F.col("order_id"), F.col("order_timestamp"))
            .unionByName(_envelope(c, "customers", "customer_id",
                                   F.unix_micros(F.col("row_time")), F.col("row_time")))
            .unionByName(_envelope(b, "books", "book_id",
                                   F.unix_micros(F.col("updated")), F.col("updated"))))
