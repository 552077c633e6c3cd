"""Helpers shared by the registered queries: landing derived files, oracle CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewell.session import scratch_path


def land(df: DataFrame, fmt: str, name: str, files: int | None = None, **options) -> str:
    """Write ``df`` under the checkpoint root in ``fmt``; return the folder.

    Each call uses a fresh folder, so re-running a query never appends twice.
    """
    path = scratch_path(df.sparkSession, name)
    out = df.repartition(files) if files else df
    w = out.write.mode("overwrite").format(fmt)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return path


def r2(col: str) -> str:
    return f"round({col}, 2)"


# ---- oracle SQL fragments (DuckDB) over the driver tables ------------------------------

BOOK_ORDERS_CTE = """
bo AS (
  SELECT o_orderkey AS order_id, CAST(o_orderdate AS TIMESTAMP) AS order_timestamp,
         o_custkey AS customer_id, li.quantity, li.total, li.books
  FROM orders LEFT JOIN (
    SELECT l_orderkey,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
           CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS total,
           list({'book_id': l_partkey, 'quantity': CAST(l_quantity AS BIGINT),
                 'subtotal': CAST(floor(l_extendedprice) AS BIGINT)}
                ORDER BY l_partkey, CAST(l_quantity AS BIGINT), floor(l_extendedprice)) AS books
    FROM lineitem GROUP BY l_orderkey) li ON li.l_orderkey = o_orderkey)
"""

CUSTOMERS_CTE = """
cu AS (
  SELECT c_custkey AS customer_id,
         CASE WHEN c_acctbal >= 0 THEN 'c' || CAST(c_custkey AS VARCHAR) || '@' || lower(c_mktsegment)
              || '.' || (['com', 'org', 'edu', 'net', 'io'])[(c_nationkey % 5) + 1] END AS email,
         c_name AS name, c_nationkey AS country_code, c_mktsegment AS segment, c_acctbal AS balance
  FROM customer)
"""

CUSTOMER_FEED_CTE = """
cf AS (
  SELECT user_id AS customer_id,
         'u' || CAST(user_id AS VARCHAR) || '@' || event_type || '.com' AS email,
         'First' || CAST(user_id AS VARCHAR) AS first_name,
         'City' || json_extract_string(props, '$.k') AS city,
         CAST(user_id % 25 AS INTEGER) AS country_code,
         value AS balance,
         CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS row_status,
         CAST(ts AS TIMESTAMP) AS row_time, event_id
  FROM events)
"""

PRICE_FEED_CTE = """
pf AS (
  SELECT user_id AS book_id, 'Book ' || CAST(user_id AS VARCHAR) AS title,
         'Author ' || CAST(user_id % 10 AS VARCHAR) AS author, value AS price,
         CAST(ts AS TIMESTAMP) AS updated
  FROM events)
"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
