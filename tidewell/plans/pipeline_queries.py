"""Pipelines B2–B6 as registered queries (each returns its gold table)."""

from __future__ import annotations

from tidewell.plans import pipelines as P
from tidewell.plans.registry import query

ITEMS = """items AS (SELECT l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q,
                   CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS t FROM lineitem GROUP BY 1)"""


@query("medallion_daily", f"""
WITH {ITEMS}
SELECT o_custkey AS customer_id, c_name AS f_name, c_mktsegment AS l_name,
       date_trunc('day', CAST(o_orderdate AS TIMESTAMP)) AS order_date, CAST(sum(q) AS BIGINT) AS books_counts
FROM orders JOIN customer ON o_custkey = c_custkey JOIN items ON l_orderkey = o_orderkey
WHERE q > 0 GROUP BY 1, 2, 3, 4
""")
def q_medallion_daily(spark, d):
    return P.medallion_daily(spark, d)


@query("country_daily", f"""
WITH {ITEMS}
SELECT o_custkey AS customer_id, c_name AS f_name, c_mktsegment AS l_name,
       date_trunc('day', CAST(o_orderdate AS TIMESTAMP)) AS order_date, CAST(sum(q) AS BIGINT) AS books_counts,
       n_name AS country
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN items ON l_orderkey = o_orderkey
WHERE n_name IN ('NATION_1', 'NATION_6') GROUP BY 1, 2, 3, 4, 6
""")
def q_country_daily(spark, d):
    return P.country_daily(spark, d)


LIVE_BOOKS = """live AS (SELECT user_id AS book_id, 'Book ' || CAST(user_id AS VARCHAR) AS title,
       'Author ' || CAST(user_id % 10 AS VARCHAR) AS author, value AS price FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) x
  WHERE rn = 1 AND event_type <> 'error')"""


@query("author_counts", f"WITH {LIVE_BOOKS} SELECT author, count(*) AS books_count FROM live GROUP BY author")
def q_author_counts(spark, d):
    return P.author_counts(spark, d)


@query("books_sales", f"""
WITH {LIVE_BOOKS}
SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS book_id, title, author, price,
       CAST(l_quantity AS BIGINT) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN live ON l_partkey = live.book_id
""")
def q_books_sales(spark, d):
    return P.books_sales(spark, d)


@query("country_sales", f"""
WITH {ITEMS}
SELECT n_name AS country, count(o_orderkey) AS orders_count, CAST(sum(t) AS BIGINT) AS total_amount
FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal >= 0
JOIN nation ON c_nationkey = n_nationkey LEFT JOIN items ON l_orderkey = o_orderkey
GROUP BY n_name
""")
def q_country_sales(spark, d):
    return P.country_sales(spark, d)


@query("full_pipeline", f"""
WITH {ITEMS}, cust AS (SELECT DISTINCT user_id FROM events WHERE event_type <> 'error')
SELECT n_name AS country, date_trunc('day', CAST(o_orderdate AS TIMESTAMP)) AS order_date,
       count(o_orderkey) AS orders_count, CAST(sum(q) AS BIGINT) AS books_count
FROM orders JOIN cust ON o_custkey = user_id JOIN nation ON n_nationkey = user_id % 25
LEFT JOIN items ON l_orderkey = o_orderkey
GROUP BY 1, 2
""")
def q_full_pipeline(spark, d):
    return P.full_pipeline(spark, d)["countries_stats"]


@query("authors_stats", """
WITH books AS (SELECT DISTINCT user_id FROM events),
s AS (SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS ts, 'Author ' || CAST(l_partkey % 10 AS VARCHAR) AS author,
             CAST(l_quantity AS BIGINT) AS quantity
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_partkey IN (SELECT user_id FROM books))
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end,
       author, count(o_orderkey) AS orders_count, round(avg(quantity), 4) AS avg_value
FROM s GROUP BY 1, 2, 3
HAVING time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM s) - INTERVAL 10 MINUTE
""")
def q_authors_stats(spark, d):
    return P.full_pipeline(spark, d)["authors_stats"]
