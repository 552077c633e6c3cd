"""Gold aggregates over the customers–orders relation (the flagship query)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.scalar import day_bucket
from tidewell.operators.joins import broadcast_lookup
from tidewell.plans.registry import query
from tidewell.sources import shapes
from tidewell.sources.tables import read_table


def customer_countries(spark: SparkSession, sf_dir: str, country: str | None = None) -> DataFrame:
    """``customer_id, email, name, country``; the nation lookup is broadcast
    only after its row count is checked (``broadcast_lookup``)."""
    cust = shapes.customers(spark, sf_dir).select("customer_id", "email", "name", "country_code")
    lookup = shapes.country_lookup(spark, sf_dir)
    if country is not None:
        lookup = lookup.filter(F.col("country") == country)
    return (broadcast_lookup(cust, lookup, F.col("country_code") == F.col("code"), "inner")
            .drop("code", "country_code"))


def customers_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders enriched with their customer and country (inner joins, as the silver table)."""
    orders = shapes.book_orders(spark, sf_dir)
    return orders.join(customer_countries(spark, sf_dir), "customer_id", "inner")


def country_day_stats_for(spark: SparkSession, sf_dir: str, country: str) -> DataFrame:
    """The view filtered to one country, planned join-first: the country filter
    cuts customers, then orders, then their line items (a runtime filter on the
    line-item scan for shuffle joins) before anything is aggregated."""
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_timestamp"))
    oc = orders.join(customer_countries(spark, sf_dir, country).select("customer_id", "country"), "customer_id")
    lines = read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_quantity").cast("bigint").alias("q"))
    per_order = (oc.join(lines, "order_id", "left")
                 .groupBy("country", day_bucket("order_timestamp").alias("order_date"), "order_id")
                 .agg(F.sum("q").alias("quantity")))
    return (per_order.groupBy("country", "order_date")
            .agg(F.count("order_id").alias("orders_count"), F.sum("quantity").alias("books_count")))


def materialize_customers_orders(spark: SparkSession, sf_dir: str) -> str:
    """Write the silver ``customers_orders`` table, partitioned by country (the
    view's filter column), under the checkpoint root; return its path.

    The ``rebalance`` hint shuffles rows by country, so each write task covers
    few country directories, and adaptive execution splits a country that holds
    a large share of all rows into advisory-size partitions (and merges small
    ones) instead of writing it from one task.
    """
    from tidewell.session import scratch_path
    path = scratch_path(spark, "customers_orders")
    (customers_orders(spark, sf_dir).drop("books").hint("rebalance", "country")
     .write.partitionBy("country").parquet(path))
    return path


def countries_stats_vw(spark: SparkSession, path: str, country: str | None = None) -> DataFrame:
    """``SELECT * FROM countries_stats_vw [WHERE country = …]`` over the silver table;
    the country filter prunes partitions."""
    co = spark.read.parquet(path)
    if country is not None:
        co = co.filter(F.col("country") == country)
    return country_day_stats_of(co)


def country_day_stats_of(customers_orders_df: DataFrame) -> DataFrame:
    """``countries_stats_vw``: orders and books per country and day."""
    return (customers_orders_df
            .groupBy("country", day_bucket("order_timestamp").alias("order_date"))
            .agg(F.count("order_id").alias("orders_count"),
                 F.sum("quantity").alias("books_count")))


COUNTRY_DAY_SQL = """
WITH items AS (
  SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY l_orderkey)
SELECT n_name AS country, date_trunc('day', o_orderdate) AS order_date,
       count(o_orderkey) AS orders_count, CAST(sum(q) AS BIGINT) AS books_count
FROM orders
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN items ON l_orderkey = o_orderkey
{where}
GROUP BY n_name, date_trunc('day', o_orderdate)
"""


@query("country_day_stats", COUNTRY_DAY_SQL.format(where=""))
def q_country_day_stats(spark, d):
    return country_day_stats_of(customers_orders(spark, d))


# the reference times ``SELECT * FROM countries_stats_vw WHERE country = …`` on one country
BENCH_COUNTRY = "NATION_6"


@query("country_day_stats_one",
       COUNTRY_DAY_SQL.format(where=f"WHERE n_name = '{BENCH_COUNTRY}'"))
def q_country_day_stats_one(spark, d):
    return country_day_stats_for(spark, d, BENCH_COUNTRY)


@query("countries_stats_vw",
       COUNTRY_DAY_SQL.format(where=f"WHERE n_name = '{BENCH_COUNTRY}'"))
def q_countries_stats_vw(spark, d):
    """The reference's timed shape: the view over the materialised silver table."""
    return countries_stats_vw(spark, materialize_customers_orders(spark, d), BENCH_COUNTRY)
