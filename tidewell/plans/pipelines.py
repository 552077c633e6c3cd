"""Multi-hop pipelines assembled from the library's functions.

Each step is a Structured Streaming query run available-now or a batch aggregate
over the step before.  Tables and checkpoints live under one pipeline folder
(``root``; a new one in the shared checkpoint folder if none is given), and steps hand
over only through those tables.  Run again with the same ``root``, a pipeline lands
the rows it is given, and every step processes only what is new: tables are made
where there are none, and the checkpoints say how far each step has come.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.scalar import day_bucket, json_path, unix_seconds_to_ts
from tidewell.operators import quality as Q
from tidewell.operators.cdc import scd1_upsert
from tidewell.operators.joins import broadcast_lookup
from tidewell.operators.layout import input_bytes
from tidewell.operators.merge import MergeResult, merge_insert_only
from tidewell.operators.scd2 import scd2_apply, scd2_current
from tidewell.plans.gold import country_day_stats_of
from tidewell.session import scratch_path
from tidewell.sources import shapes
from tidewell.streaming.cdc import DELETED, apply_changes_batch, live_rows
from tidewell.streaming.joins import fresh_static_join, newest_version_join
from tidewell.streaming.runner import land_files, run_available_now
from tidewell.streaming.stateful import stream_dedup, tumbling_stats
from tidewell.streaming.store import EpochTable, VersionedTable

JSON_TS = {"timestampFormat": shapes.JSON_TS_FORMAT}
MONTH_BUCKET = "year(order_timestamp) * 12 + month(order_timestamp)"
RAW_ORDER_DDL = (f"order_id BIGINT, order_timestamp BIGINT, customer_id BIGINT, quantity BIGINT, total BIGINT, "
                 f"books ARRAY<{shapes.ITEM_DDL}>")


@dataclass
class Workspace:
    spark: SparkSession
    root: str

    @classmethod
    def new(cls, spark: SparkSession, name: str, root: str | None = None) -> "Workspace":
        return cls(spark, root or scratch_path(spark, f"pipeline-{name}"))

    def table(self, name: str, keys: list[str], ddl_or_schema, source: DataFrame, **kw) -> VersionedTable:
        """A keyed table, made empty on the first run; its buckets follow the size of ``source``."""
        empty = self.spark.createDataFrame([], ddl_or_schema)
        return VersionedTable(self.spark, self.path(name), keys, **kw).ensure(empty, input_bytes(source))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def stream(self, name: str, schema=None, **opts) -> DataFrame:
        schema = schema or self.spark.read.parquet(self.path(name)).schema
        r = self.spark.readStream.schema(schema)
        for k, v in opts.items():
            r = r.option(k, v)
        return r.parquet(self.path(name))

    def run(self, sdf: DataFrame, name: str, **kw) -> str:
        return run_available_now(sdf, name, path=self.path(name), checkpoint=self.checkpoint(name), **kw)


def raw_orders(spark: SparkSession, sf_dir: str, where: str | None = None) -> DataFrame:
    """Orders as the raw feed carries them: ``order_timestamp`` in unix seconds.  ``where``
    (over the order columns) chooses what a delivery holds."""
    o = shapes.book_orders(spark, sf_dir)
    return (o.filter(where) if where else o).withColumn("order_timestamp", F.unix_timestamp("order_timestamp"))


# The column names of silver and gold (f_name, l_name, books_counts, order_date, …) are fixed
# values: users of the reference select them by name.

def enriched_orders(orders: DataFrame, customers: DataFrame, how: str, *more) -> DataFrame:
    """Raw orders with their customer's name and a parsed time."""
    return orders.join(customers, "customer_id", how).select(
        "order_id", "quantity", "customer_id", json_path("profile", "first_name").alias("f_name"),
        json_path("profile", "last_name").alias("l_name"), unix_seconds_to_ts("order_timestamp").alias("order_timestamp"),
        "books", *more)


def daily_books(orders: DataFrame, *more: str) -> DataFrame:
    """Books per customer and day."""
    return (orders.groupBy("customer_id", "f_name", "l_name", day_bucket("order_timestamp").alias("order_date"), *more)
            .agg(F.sum("quantity").alias("books_counts")))


# ---------------------------------------------------------------- bookstore medallion (bronze/silver/gold)

def medallion_daily(spark: SparkSession, sf_dir: str, root: str | None = None, where: str | None = None) -> DataFrame:
    ws = Workspace.new(spark, "medallion", root)
    landing = land_files(raw_orders(spark, sf_dir, where), "json", "orders-raw", path=ws.path("landing"))
    customers = shapes.customer_profiles(spark, sf_dir)  # static lookup
    # bronze: raw rows + arrival time + source file
    bronze = (spark.readStream.schema(RAW_ORDER_DDL).json(landing)
              .withColumn("arrival_time", F.current_timestamp())
              .withColumn("source_file", F.col("_metadata.file_path")))
    ws.run(bronze, "orders_bronze")
    # silver: enrich with the customer's name, parse time, keep orders with books
    silver = enriched_orders(ws.stream("orders_bronze"), customers, "inner").filter(F.col("quantity") > 0)
    ws.run(silver, "orders_silver")
    # gold: books per customer and day, complete mode
    gold = daily_books(ws.stream("orders_silver"))
    table = EpochTable(spark, ws.path("daily_customer_books"))
    run_available_now(gold, "gold", output_mode="complete", foreach_batch=table.write,
                      checkpoint=ws.checkpoint("gold"))
    return table.read()


# ---------------------------------------------------------------- declarative country pipeline

def orders_cleaned(spark: SparkSession, sf_dir: str, ws: Workspace) -> DataFrame:
    landing = land_files(raw_orders(spark, sf_dir), "json", "orders-raw", path=ws.path("landing"))
    customers = shapes.customer_profiles(spark, sf_dir)
    raw = spark.readStream.schema(RAW_ORDER_DDL).json(landing)
    cleaned = Q.expect_drop(raw, {"valid_order_number": "order_id IS NOT NULL"})
    cleaned = enriched_orders(cleaned, customers, "left", json_path("profile", "address", "country").alias("country"))
    ws.run(cleaned, "orders_cleaned", partition_by=["country"])
    return spark.read.parquet(ws.path("orders_cleaned"))


def country_daily(spark: SparkSession, sf_dir: str, countries=("NATION_1", "NATION_6")) -> DataFrame:
    """Daily books of chosen countries, from their partitions of the cleaned orders in one scan."""
    ws = Workspace.new(spark, "country-daily")
    cleaned = orders_cleaned(spark, sf_dir, ws)
    return daily_books(cleaned.filter(F.col("country").isin(*countries)), "country")


# ---------------------------------------------------------------- CDC books pipeline

def books_silver(spark: SparkSession, sf_dir: str, ws: Workspace) -> DataFrame:
    """``APPLY CHANGES INTO books_silver KEYS (book_id) APPLY AS DELETE WHEN row_status = 'DELETE'
    SEQUENCE BY row_time COLUMNS * EXCEPT (row_status)`` as a stream into a tombstoned table."""
    landing = land_files(shapes.books_cdc(spark, sf_dir), "json", "books-cdc", path=ws.path("books_landing"), **JSON_TS)
    bronze = spark.readStream.schema(shapes.BOOK_CDC_DDL).options(**JSON_TS).json(landing)
    cols = ["book_id", "title", "author", "price", "row_time"]
    schema = shapes.books_cdc(spark, sf_dir).select(*cols).withColumn(DELETED, F.lit(False)).schema
    table = ws.table("books_silver", ["book_id"], schema, spark.read.schema(shapes.BOOK_CDC_DDL).json(landing))

    def upsert(batch, epoch):
        src = batch.select(*cols, (F.col("row_status") == "DELETE").alias(DELETED))
        table.commit(epoch + 1, src,
                     lambda cur, s: apply_changes_batch(cur, s, ["book_id"], "row_time", F.col(DELETED)),
                     commit_ts=F.lit(None).cast("timestamp"))

    run_available_now(bronze, "books_silver", foreach_batch=upsert, checkpoint=ws.checkpoint("books_silver"))
    return live_rows(table.read(), except_cols=["row_time"])


def author_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace.new(spark, "books-cdc")
    silver = books_silver(spark, sf_dir, ws)
    return silver.groupBy("author").agg(F.count(F.lit(1)).alias("books_count"))


def books_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace.new(spark, "books-sales")
    silver = books_silver(spark, sf_dir, ws)
    cleaned = orders_cleaned(spark, sf_dir, ws)
    items = cleaned.select("order_id", "customer_id", F.explode("books").alias("book"))
    return items.join(silver, F.col("book.book_id") == silver.book_id, "inner").select(
        "order_id", "customer_id", silver.book_id, "title", "author", "price",
        F.col("book.quantity").alias("quantity"))


# ---------------------------------------------------------------- lab pipeline

def country_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace.new(spark, "country-sales")
    landing = land_files(raw_orders(spark, sf_dir).drop("books"), "json", "orders-raw",
                         path=ws.path("landing"))
    raw = spark.readStream.schema(RAW_ORDER_DDL).json(landing)
    cust = shapes.customers(spark, sf_dir).select("customer_id", "email", "country_code")
    lk = shapes.country_lookup(spark, sf_dir)
    cleaned = Q.expect_drop(raw.join(cust, "customer_id", "left"), {"valid_email": "email IS NOT NULL"})
    ws.run(cleaned.select("order_id", "customer_id", "email", "country_code", "total"), "cleaned")
    c = broadcast_lookup(spark.read.parquet(ws.path("cleaned")), lk, F.col("country_code") == F.col("code"))
    return c.groupBy("country").agg(F.count("order_id").alias("orders_count"),
                                    F.sum("total").alias("total_amount"))


# ---------------------------------------------------------------- nine-task pipeline

def full_pipeline(spark: SparkSession, sf_dir: str, root: str | None = None,
                  where: str | None = None) -> dict[str, DataFrame]:
    """land → bronze → customers / orders / books silver → customers_orders, books_sales
    → countries_stats, authors_stats.

    ``where`` (over the envelope columns) chooses what this run lands; with the same ``root``
    the next run goes on from there."""
    from tidewell.plans.stream_queries import BRONZE, ORDER_VALUE_DDL, bronze_stream, demux, land_envelope
    ws = Workspace.new(spark, "full", root)
    lookup = shapes.country_lookup(spark, sf_dir)
    # task 1-2: land and ingest the multiplex feed into bronze, partitioned by topic and month
    landing = land_envelope(spark, sf_dir, ws.path("landing"), where)
    ws.run(bronze_stream(spark, landing), "bronze", **BRONZE)
    bronze = lambda: ws.stream("bronze")
    landed = spark.read.parquet(ws.path("bronze"))

    # task 3: customers silver, newest wins, with change rows
    cust_cols = ["customer_id", "email", "first_name", "city", "country", "balance", "row_time"]
    customers = ws.table("customers_silver", ["customer_id"], "customer_id bigint, email string, first_name string, "
                         "city string, country string, balance double, row_time timestamp", landed)
    cust_src = (broadcast_lookup(demux(bronze(), "customers", shapes.CUSTOMER_DDL), lookup,
                                 F.col("country_code") == F.col("code"), "inner")
                .select(*cust_cols, "row_status"))

    def upsert_customers(batch, epoch):
        ts = batch.agg(F.max("row_time")).first()[0]
        customers.commit(epoch + 1, batch,
                         lambda cur, src: scd1_upsert(cur, src, ["customer_id"], "row_time", method="rank"),
                         commit_ts=F.lit(ts).cast("timestamp"))

    run_available_now(cust_src, "customers_silver", foreach_batch=upsert_customers,
                      checkpoint=ws.checkpoint("customers_silver"))

    # task 4: orders silver, deduplicated within the watermark, insert-only
    order_cols = ["order_id", "order_timestamp", "customer_id", "quantity", "total", "books"]
    # buckets are months of the order time, part of the merge key: a batch rewrites its own months only
    orders = ws.table("orders_silver", ["order_id", "order_timestamp"], ", ".join(
        ["order_id bigint", "order_timestamp timestamp", "customer_id bigint", "quantity bigint", "total bigint",
         f"books array<{shapes.ITEM_DDL}>"]), landed, bucket_by=MONTH_BUCKET)
    ord_src = stream_dedup(demux(bronze(), "orders", ORDER_VALUE_DDL).select(*order_cols),
                           ["order_id", "order_timestamp"], "order_timestamp", "30 seconds")

    def upsert_orders(batch, epoch):
        orders.commit(epoch + 1, batch,
                      lambda cur, src: merge_insert_only(cur, src, ["order_id", "order_timestamp"]),
                      commit_ts=F.lit(None).cast("timestamp"))

    run_available_now(ord_src, "orders_silver", output_mode="update", foreach_batch=upsert_orders,
                      checkpoint=ws.checkpoint("orders_silver"))

    # task 5: books silver, type 2 on price
    books = ws.table("books_silver", ["book_id"], "book_id bigint, title string, author string, price double, "
                     "current boolean, effective_date timestamp, end_date timestamp", landed)
    book_src = demux(bronze(), "books", shapes.BOOK_DDL)

    def upsert_books(batch, epoch):
        books.commit(epoch + 1, batch, lambda cur, src: MergeResult(
            scd2_apply(cur, src, "book_id", "price", "updated", ["title", "author"]), _no_changes(cur)),
            commit_ts=F.lit(None).cast("timestamp"))

    run_available_now(book_src, "books_silver", foreach_batch=upsert_books, checkpoint=ws.checkpoint("books_silver"))
    current_books = lambda: scd2_current(books.read(), "book_id", "price", ["title", "author"])

    # task 6: customers_orders = each order with its customer's newest version from the
    # customer change feed (insert / update_postimage rows), newest-wins per (order, customer).
    # A stream-stream join of orders with every change row of their customer would pair each
    # order with all versions of its customer (quadratic for a busy customer) before the upsert
    # keeps one.  Instead one stream carries both feeds, and per micro-batch
    #   new orders ⋈ the newest version of each customer so far, and
    #   the newest version of each customer changed in the batch ⋈ that customer's orders;
    # each order meets at most one customer row per side.
    cf_schema = spark.read.parquet(customers.path + "/changes").schema
    versions = lambda df: (df.filter(F.col("_change_type").isin("insert", "update_postimage"))
                           .drop("_change_type", "_commit_version")
                           .withColumnRenamed("_commit_timestamp", "processed_timestamp"))
    cust_changes = versions(spark.readStream.schema(cf_schema).parquet(customers.path + "/changes"))
    order_cols5 = ["order_id", "order_timestamp", "customer_id", "quantity", "total"]
    o_schema = spark.read.parquet(orders.path + "/changes").schema
    order_changes = (spark.readStream.schema(o_schema).parquet(orders.path + "/changes")
                     .filter(F.col("_change_type") == "insert").select(*order_cols5))
    cust_cols = cust_changes.columns
    both = (order_changes.withColumn("_side", F.lit("order"))
            .unionByName(cust_changes.withColumn("_side", F.lit("customer")), allowMissingColumns=True))
    co_cols = ["order_id", "order_timestamp", "customer_id", "quantity", "total", "email", "first_name",
               "city", "country", "balance", "row_time", "processed_timestamp"]
    co = ws.table("customers_orders", ["order_id", "customer_id"], both.select(*co_cols).schema, landed)

    def upsert_co(batch, epoch):
        src = newest_version_join(
            batch.filter(F.col("_side") == "order").select(*order_cols5),
            batch.filter(F.col("_side") == "customer").select(*cust_cols),
            versions(customers.changes()),  # committed customer versions, re-read per batch
            orders.read().select(*order_cols5), "customer_id", "row_time").select(*co_cols)
        co.commit(epoch + 1, src, lambda cur, s: scd1_upsert(
            cur, s, ["order_id", "customer_id"], "row_time", status_col=None),
            commit_ts=F.lit(None).cast("timestamp"))

    run_available_now(both, "customers_orders", foreach_batch=upsert_co,
                      checkpoint=ws.checkpoint("customers_orders"))

    # task 7: books_sales = order items ⋈ current books; every micro-batch reads the current books anew
    items = (spark.readStream.schema(o_schema).parquet(orders.path + "/changes")
             .filter(F.col("_change_type") == "insert")
             .select("order_id", "order_timestamp", "customer_id", F.explode("books").alias("book")))
    sale = "order_id bigint, order_timestamp timestamp, customer_id bigint, book_id bigint, title string, " \
           "author string, price double, quantity bigint"

    def write_sales(joined, epoch):
        # one folder an epoch: a replayed micro-batch overwrites its own rows
        (joined.select("order_id", "order_timestamp", "customer_id", "book_id", "title", "author", "price",
                       F.col("book.quantity").alias("quantity"))
         .write.mode("overwrite").parquet(f"{ws.path('books_sales')}/epoch={epoch}"))

    run_available_now(items.withColumn("book_id", F.col("book.book_id")), "books_sales",
                      foreach_batch=fresh_static_join(current_books, "book_id", "inner", write_sales),
                      checkpoint=ws.checkpoint("books_sales"))

    # tasks 8-9: gold
    countries_stats = country_day_stats_of(co.read())
    authors = tumbling_stats(ws.stream("books_sales", sale), "order_timestamp", ["author"], "order_id", "quantity",
                             watermark="10 minutes")
    ws.run(authors, "authors_stats")
    return {"countries_stats": countries_stats,
            "authors_stats": spark.read.parquet(ws.path("authors_stats")),
            "customers_orders": co.read(), "current_books": current_books()}


def _no_changes(cur: DataFrame) -> DataFrame:
    return cur.limit(0).withColumn("_change_type", F.lit(None).cast("string"))
