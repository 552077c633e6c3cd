"""Table writes and layout operations, each read back after the write."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidewell.functions.scalar import year_month
from tidewell.operators import layout as L
from tidewell.operators import tables as W
from tidewell.plans.registry import query
from tidewell.session import scratch_path
from tidewell.sources import shapes
from tidewell.sources.tables import read_table


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@query("ctas", """
SELECT o_custkey AS customer_id, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent
FROM orders GROUP BY o_custkey
""")
def q_ctas(spark, d):
    o = read_table(spark, d, "orders")
    q = o.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    return W.ctas(q, _name("customer_spend"))


@query("replace_table", """
SELECT p_partkey AS book_id, p_name AS title, p_retailprice AS price FROM part
""")
def q_replace_table(spark, d):
    name = _name("books")
    W.ctas(read_table(spark, d, "nation"), name)  # first version, another schema
    return W.replace_table(shapes.books(spark, d).select("book_id", "title", "price"), name)


@query("overwrite_rows", """
SELECT p_partkey AS book_id, p_name AS title, p_retailprice * 1.1 AS price FROM part
""")
def q_overwrite_rows(spark, d):
    name = _name("books")
    b = shapes.books(spark, d).select("book_id", "title", "price")
    W.ctas(b, name)
    # new rows computed from the table itself: staged, then written over it
    staged = W.stage(spark.table(name).withColumn("price", F.col("price") * 1.1), name)
    return W.overwrite_rows(staged, name)


@query("append_rows", "SELECT * FROM nation UNION ALL SELECT * FROM nation")
def q_append_rows(spark, d):
    name = _name("nations")
    n = read_table(spark, d, "nation")
    W.ctas(n, name)
    return W.append_rows(n, name)


BOOKS_SQL = ("SELECT p_partkey AS book_id, p_name AS title, p_brand AS author, p_type AS category, "
             "p_retailprice AS price FROM part")


@query("sink_csv", BOOKS_SQL)
def q_sink_csv(spark, d):
    from tidewell.plans.batch_queries import BOOK_CSV_DDL
    from tidewell.sources.files import scan_csv
    path = scratch_path(spark, "books-csv")
    b = shapes.books(spark, d)
    p = read_table(spark, d, "part").select(F.col("p_partkey").alias("book_id"), "p_size")
    first = b.join(p.filter("p_size <= 25"), "book_id", "left_semi")
    later = b.join(p.filter("p_size > 25"), "book_id", "left_semi")
    W.sink_csv(first, path)
    W.sink_csv(later, path)  # new files appended next to the old ones
    return scan_csv(spark, path, BOOK_CSV_DDL)


@query("append_evolving", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total,
       CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_orderpriority END AS priority
FROM orders
""")
def q_append_evolving(spark, d):
    o = read_table(spark, d, "orders")
    path = scratch_path(spark, "orders-evolving")
    old = o.filter("o_orderdate < TIMESTAMP '1999-01-01'").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total"))
    new = o.filter("o_orderdate >= TIMESTAMP '1999-01-01'").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total"), F.col("o_orderpriority").alias("priority"))
    W.append_evolving(old, path)
    W.append_evolving(new, path)
    return W.read_evolving(spark, path)


@query("layout_rewrite", "SELECT * FROM lineitem")
def q_layout_rewrite(spark, d):
    li = read_table(spark, d, "lineitem")
    path = scratch_path(spark, "lineitem-clustered")
    L.layout_rewrite(li, path, ["l_partkey", "l_suppkey"])
    return spark.read.parquet(path)


@query("layout_rewrite_one", "SELECT * FROM lineitem WHERE l_orderkey BETWEEN 1000 AND 2000")
def q_layout_rewrite_one(spark, d):
    li = read_table(spark, d, "lineitem")
    path = scratch_path(spark, "lineitem-sorted")
    L.layout_rewrite(li, path, ["l_orderkey"])
    # reads after the rewrite skip row groups by their min/max statistics
    return spark.read.parquet(path).filter("l_orderkey BETWEEN 1000 AND 2000")


@query("pack_small_files", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, 0 AS went_again, 0 AS came_again FROM orders
""")
def q_pack_small_files(spark, d):
    """Orders by status in many small files, packed; packing again finds nothing to do."""
    path = scratch_path(spark, "orders-small")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    o.repartition(24).write.partitionBy("o_orderstatus").parquet(path)
    L.pack_small_files(spark, path)
    went, came = L.pack_small_files(spark, path)
    return spark.read.parquet(path).withColumns({"went_again": F.lit(went), "came_again": F.lit(came)})


@query("expire_partitions", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders
WHERE strftime(o_orderdate, '%Y-%m') >= '1998-01'
""")
def q_expire_partitions(spark, d):
    name = _name("orders_by_month")
    o = read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", year_month(F.col("o_orderdate").cast("timestamp")).alias("year_month"))
    W.ctas(o, name, partition_by=["year_month"])
    L.expire_partitions(spark, name, "year_month", "1998-01", scratch_path(spark, "archive-orders"))
    return spark.table(name)


@query("expire_partitions_archive", """
SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders
WHERE strftime(o_orderdate, '%Y-%m') < '1998-01'
""")
def q_expire_partitions_archive(spark, d):
    name = _name("orders_by_month")
    o = read_table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", year_month(F.col("o_orderdate").cast("timestamp")).alias("year_month"))
    W.ctas(o, name, partition_by=["year_month"])
    archive = scratch_path(spark, "archive-orders")
    L.expire_partitions(spark, name, "year_month", "1998-01", archive)
    return spark.read.parquet(archive).select("o_orderkey", "o_custkey", "year_month")


INLINE_VALUES = [(100001, "Customer#100001", 3, 12.5), (100002, "Customer#100002", 7, -4.0),
                 (100003, "Customer#100003", 24, 0.0)]


@query("inline_rows", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer UNION ALL "
       + "SELECT * FROM (VALUES " + ", ".join(f"({k}, '{n}', {c}, {b})" for k, n, c, b in INLINE_VALUES)
       + ") v(c_custkey, c_name, c_nationkey, c_acctbal)")
def q_inline_rows(spark, d):
    """``INSERT INTO t VALUES (…), (…)`` into a table created from ``customer``."""
    name = _name("customers_t")
    W.ctas(read_table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal"), name)
    values = ", ".join(f"({k}, '{n}', {c}, {b})" for k, n, c, b in INLINE_VALUES)
    spark.sql(f"INSERT INTO {name} VALUES {values}")
    return spark.table(name)


@query("expire_bronze_months", """
SELECT 'orders' AS topic, strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m') AS year_month, o_orderkey AS "offset"
FROM orders WHERE strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m') >= '1998-01'
UNION ALL
SELECT t.topic, strftime(CAST(ts AS TIMESTAMP), '%Y-%m'), epoch_us(CAST(ts AS TIMESTAMP))
FROM events, (VALUES ('customers'), ('books')) t(topic)
""")
def q_expire_bronze_months(spark, d):
    """Months expire on a table partitioned by topic and month; the archive run twice holds them once."""
    name, archive = _name("bronze"), scratch_path(spark, "archive-bronze")
    bronze = shapes.bronze_envelope(spark, d).select(
        "offset", "topic", year_month(F.timestamp_millis("timestamp")).alias("year_month"))
    W.ctas(bronze, name, partition_by=["topic", "year_month"])
    L.expire_partitions(spark, name, "year_month", "1998-01", archive)
    L.expire_partitions(spark, name, "year_month", "1998-01", archive)
    return spark.table(name).select("topic", "year_month", "offset")


@query("stored_view", """
SELECT n_name AS country, count(*) AS customers, round(avg(c_acctbal), 2) AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 GROUP BY n_name
""")
def q_stored_view(spark, d):
    """``CREATE VIEW`` over stored tables: the view is kept in the catalog and computed when read."""
    customers, nations, view = _name("customers"), _name("nations"), _name("country_view")
    W.ctas(read_table(spark, d, "customer"), customers)
    W.ctas(read_table(spark, d, "nation"), nations)
    return W.create_view(spark, view, f"""
        SELECT n_name AS country, count(*) AS customers, round(avg(c_acctbal), 2) AS balance
        FROM {customers} JOIN {nations} ON c_nationkey = n_nationkey WHERE c_acctbal > 0 GROUP BY n_name""")


@query("check_rejects_write", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000")
def q_check_rejects_write(spark, d):
    """A write that breaks a CHECK rule fails as a whole: the table still holds the first, valid write."""
    from pyspark.errors import PySparkException
    from tidewell.operators.quality import check_constraint
    path, rules = scratch_path(spark, "checked-orders"), {"price": "o_totalprice > 1000"}
    o = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    check_constraint(o.filter("o_totalprice > 1000"), rules).write.parquet(path)
    try:
        check_constraint(o.withColumn("o_totalprice", -F.col("o_totalprice")), rules).write.mode("append").parquet(path)
    except PySparkException:
        return spark.read.parquet(path)
    raise AssertionError("a write with violating rows was accepted")


@query("layout_rewrite_ranks", "SELECT * FROM events WHERE value <= 2 AND event_type = 'purchase'")
def q_layout_rewrite_ranks(spark, d):
    """Clustered by quantile ranks: most values are small and few are large, and types are strings."""
    e = read_table(spark, d, "events")
    path = scratch_path(spark, "events-clustered")
    L.layout_rewrite(e, path, ["value", "event_type"], by="rank")
    return spark.read.parquet(path).filter("value <= 2 AND event_type = 'purchase'")
