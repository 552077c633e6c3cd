"""Batch operators: scans, projections, predicates, JSON, arrays, UDFs, time,
aggregation, joins, windows, sort/limit and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import scalar as X
from tidewell.operators import aggregate as G
from tidewell.operators import joins as J
from tidewell.operators import setops as U
from tidewell.operators.window import latest_per_key
from tidewell.plans.common import (BOOK_ORDERS_CTE, CUSTOMER_FEED_CTE, CUSTOMERS_CTE, land,
                                   with_ctes)
from tidewell.plans.registry import query
from tidewell.session import scratch_path
from tidewell.sources import files as S
from tidewell.sources import shapes
from tidewell.sources.tables import read_table

BOOK_CSV_DDL = "book_id BIGINT, title STRING, author STRING, category STRING, price DOUBLE"

# ---------------------------------------------------------------------------- sources


@query("scan_parquet", "SELECT * FROM orders")
def q_scan_parquet(spark, d):
    return S.scan_parquet(spark, f"{d}/orders.parquet")


CUSTOMER_JSON_SQL = ("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, "
                     "c_mktsegment FROM customer")


@query("scan_json", CUSTOMER_JSON_SQL)
def q_scan_json(spark, d):
    path = land(read_table(spark, d, "customer"), "json", "customers-json")
    return S.scan_json(spark, path).select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                           "c_mktsegment")


@query("scan_json_glob", CUSTOMER_JSON_SQL)
def q_scan_json_glob(spark, d):
    path = land(read_table(spark, d, "customer"), "json", "customers-json")
    return S.scan_json(spark, f"{path}/part-*.json").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("scan_with_provenance",
       "SELECT c_custkey, c_name, true AS from_json_file FROM customer")
def q_scan_with_provenance(spark, d):
    path = land(read_table(spark, d, "customer"), "json", "customers-json")
    df = S.with_provenance(S.scan_json(spark, path))
    return df.select("c_custkey", "c_name", F.col("source_file").endswith(".json").alias("from_json_file"))


@query("scan_text", "SELECT c_custkey AS customer_id, c_name AS name FROM customer")
def q_scan_text(spark, d):
    path = land(read_table(spark, d, "customer"), "json", "customers-json")
    lines = S.scan_text(spark, path)
    return lines.select(X.json_path("value", "c_custkey").cast("bigint").alias("customer_id"),
                        X.json_path("value", "c_name").alias("name"))


@query("scan_binary", "SELECT count(*) AS total_lines FROM customer")
def q_scan_binary(spark, d):
    path = land(read_table(spark, d, "customer"), "json", "customers-json")
    b = S.scan_binary(spark, path, glob="*.json")
    # each file's bytes → lines; counted per file on the executors, summed after
    per_file = b.select(F.size(F.filter(F.split(F.col("content").cast("string"), "\n"),
                                        lambda x: F.length(x) > 0)).alias("n"))
    return per_file.agg(F.sum("n").alias("total_lines"))


BOOKS_SQL = ("SELECT p_partkey AS book_id, p_name AS title, p_brand AS author, p_type AS category, "
             "p_retailprice AS price FROM part")


CSV_HEADER = "book_id;title;author;category;price"


def _books_csv(spark, d) -> str:
    """Two CSV exports (header, ';') into one folder, like successive file drops."""
    from tidewell.operators.tables import sink_csv
    path = scratch_path(spark, "books-csv")
    b = shapes.books(spark, d)
    sizes = read_table(spark, d, "part").select(F.col("p_partkey").alias("book_id"), "p_size")
    sink_csv(b.join(sizes.filter("p_size <= 25"), "book_id", "left_semi"), path)
    sink_csv(b.join(sizes.filter("p_size > 25"), "book_id", "left_semi"), path)
    return path


@query("scan_csv", BOOKS_SQL)
def q_scan_csv(spark, d):
    return S.scan_csv(spark, _books_csv(spark, d), BOOK_CSV_DDL, sep=";", header=True)


@query("scan_csv_raw", """
SELECT concat_ws(';', CAST(p_partkey AS VARCHAR), p_name, p_brand, p_type, CAST(p_retailprice AS VARCHAR)) AS _c0
FROM part
""")
def q_scan_csv_raw(spark, d):
    # default options: one unparsed ``_c0`` string per line, and every file's header
    # line read as data (one per file, so it is dropped here to keep the result exact)
    raw = S.scan_csv_raw(spark, _books_csv(spark, d)).select("_c0")
    return raw.filter(F.col("_c0") != CSV_HEADER)


@query("scan_table", "SELECT * FROM nation")
def q_scan_table(spark, d):
    name = "nation_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    read_table(spark, d, "nation").write.option("path", scratch_path(spark, "tables")).saveAsTable(name)
    return spark.read.table(name)


# ---------------------------------------------------------------------------- projection


@query("project", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice * 2 AS double_price,
       o_totalprice / 4 AS quarter_price, o_totalprice + 1 AS price_plus_one, 'orders' AS source
FROM orders
""")
def q_project(spark, d):
    o = read_table(spark, d, "orders")
    return (o.withColumnRenamed("o_orderkey", "order_id")
            .withColumn("double_price", F.col("o_totalprice") * 2)
            .withColumn("quarter_price", F.col("o_totalprice") / 4)
            .select("order_id", F.col("o_custkey").alias("customer_id"), "double_price",
                    "quarter_price", (F.col("o_totalprice") + 1).alias("price_plus_one"),
                    F.lit("orders").alias("source")))


@query("filter_predicates", with_ctes(CUSTOMERS_CTE) + """
SELECT customer_id, email, balance FROM cu
WHERE email IS NOT NULL AND balance >= 100 AND balance < 9000 AND country_code IN (1, 2, 3, 5, 8)
  AND segment <> 'BUILDING' AND (country_code = 1 OR balance > 500) AND customer_id > 3
""")
def q_filter_predicates(spark, d):
    c = shapes.customers(spark, d)
    return (c.filter(F.col("email").isNotNull() & (F.col("balance") >= 100) & (F.col("balance") < 9000)
                     & F.col("country_code").isin(1, 2, 3, 5, 8) & (F.col("segment") != "BUILDING")
                     & ((F.col("country_code") == 1) | (F.col("balance") > 500)) & (F.col("customer_id") > 3))
            .select("customer_id", "email", "balance"))


@query("filter_like", with_ctes(CUSTOMERS_CTE) + """
SELECT customer_id, email FROM cu WHERE email LIKE '%.edu' OR email LIKE 'c1%'
""")
def q_filter_like(spark, d):
    c = shapes.customers(spark, d)
    return c.filter(F.col("email").like("%.edu") | F.col("email").like("c1%")).select("customer_id", "email")


@query("case_when", with_ctes(CUSTOMERS_CTE) + """
SELECT customer_id,
       CASE WHEN balance < 0 THEN 'negative' WHEN balance < 1000 THEN 'low'
            WHEN balance < 5000 THEN 'mid' ELSE 'high' END AS band
FROM cu
""")
def q_case_when(spark, d):
    b = F.col("balance")
    band = (F.when(b < 0, "negative").when(b < 1000, "low").when(b < 5000, "mid").otherwise("high"))
    return shapes.customers(spark, d).select("customer_id", band.alias("band"))


@query("casts", """
SELECT o_orderkey AS order_id, CAST(o_orderkey AS VARCHAR) AS order_key_str,
       CAST(trunc(o_totalprice) AS INTEGER) AS price_int, CAST(o_orderdate AS DATE) AS order_day,
       CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS order_ts,
       CAST(trunc(CAST(o_orderkey AS DECIMAL(18, 0)) * 0.8) AS INTEGER) AS discounted_key
FROM orders
""")
def q_casts(spark, d):
    o = read_table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderkey").cast("string").alias("order_key_str"),
        F.col("o_totalprice").cast("int").alias("price_int"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        F.col("o_orderdate").cast("string").cast("timestamp").alias("order_ts"),
        F.expr("CAST(o_orderkey * 0.8 AS INT)").alias("discounted_key"))


# ---------------------------------------------------------------------------- JSON


PROFILE_SQL = """
SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
       'city ' || CAST(c_nationkey AS VARCHAR) AS city, n_name AS country
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
"""


@query("json_path", PROFILE_SQL)
def q_json_path(spark, d):
    p = shapes.customer_profiles(spark, d)
    return p.select("customer_id",
                    X.json_path("profile", "first_name").alias("first_name"),
                    X.json_path("profile", "last_name").alias("last_name"),
                    X.json_path("profile", "address", "city").alias("city"),
                    X.json_path("profile", "address", "country").alias("country"))


PROFILE_DDL = ("first_name STRING, last_name STRING, "
               "address STRUCT<street: STRING, city: STRING, country: STRING>")


@query("from_json_typed", PROFILE_SQL)
def q_from_json_typed(spark, d):
    p = shapes.customer_profiles(spark, d)
    parsed = p.select("customer_id", X.from_json_typed("profile", PROFILE_DDL).alias("v"))
    return parsed.select("customer_id", "v.*").select(
        "customer_id", "first_name", "last_name", F.col("address.city").alias("city"),
        F.col("address.country").alias("country"))


@query("from_json_sampled", PROFILE_SQL)
def q_from_json_sampled(spark, d):
    p = shapes.customer_profiles(spark, d)
    sample = p.select("profile").first()[0]  # one row: the sample literal
    ddl = X.schema_from_sample(spark, sample)
    parsed = p.select("customer_id", F.from_json("profile", ddl).alias("v"))
    return parsed.select("customer_id", F.col("v.first_name").alias("first_name"),
                         F.col("v.last_name").alias("last_name"),
                         F.col("v.address.city").alias("city"),
                         F.col("v.address.country").alias("country"))


@query("struct_access", with_ctes(BOOK_ORDERS_CTE) + """
SELECT order_id, array_to_string(list_transform(books, lambda b: CAST(b.book_id AS VARCHAR)), ',') AS book_ids,
       books[1].book_id AS first_book
FROM bo
""")
def q_struct_access(spark, d):
    o = shapes.book_orders(spark, d)
    return o.select("order_id",
                    F.array_join(F.col("books.book_id").cast("array<string>"), ",").alias("book_ids"),
                    F.element_at("books", 1)["book_id"].alias("first_book"))


# ---------------------------------------------------------------------------- arrays


@query("explode_items", """
SELECT l_orderkey AS order_id, l_partkey AS book_id, CAST(l_quantity AS BIGINT) AS quantity,
       CAST(floor(l_extendedprice) AS BIGINT) AS subtotal
FROM lineitem
""")
def q_explode_items(spark, d):
    o = shapes.book_orders(spark, d)
    return o.select("order_id", F.explode("books").alias("b")).select(
        "order_id", "b.book_id", "b.quantity", "b.subtotal")


MULTI_SQL = with_ctes(BOOK_ORDERS_CTE) + """
SELECT order_id, array_to_string(list_transform(list_filter(books, lambda i: i.quantity >= 2),
                                               lambda i: CAST(i.book_id AS VARCHAR)), ',') AS multiple_copies,
       len(list_filter(books, lambda i: i.quantity >= 2)) AS n_multiple
FROM bo __WHERE__
"""


def _multiple(spark, d):
    o = shapes.book_orders(spark, d)
    m = X.array_filter("books", lambda i: i["quantity"] >= 2)
    return o.select("order_id", m.alias("m"))


@query("array_filter", MULTI_SQL.replace("__WHERE__", ""))
def q_array_filter(spark, d):
    return _multiple(spark, d).select(
        "order_id", F.array_join(F.col("m.book_id").cast("array<string>"), ",").alias("multiple_copies"),
        F.size("m").alias("n_multiple"))


@query("array_size_filter", MULTI_SQL.replace("__WHERE__", "WHERE len(list_filter(books, lambda i: i.quantity >= 2)) > 0"))
def q_array_size_filter(spark, d):
    return (_multiple(spark, d).filter(F.size("m") > 0).select(
        "order_id", F.array_join(F.col("m.book_id").cast("array<string>"), ",").alias("multiple_copies"),
        F.size("m").alias("n_multiple")))


@query("array_transform", with_ctes(BOOK_ORDERS_CTE) + """
SELECT order_id, array_to_string(list_transform(books,
         lambda b: CAST(CAST(trunc(b.subtotal * 0.8) AS INTEGER) AS VARCHAR)), ',') AS subtotal_after_discount
FROM bo
""")
def q_array_transform(spark, d):
    o = shapes.book_orders(spark, d)
    return o.select("order_id", F.array_join(X.discounted("books").cast("array<string>"), ",")
                    .alias("subtotal_after_discount"))


@query("collect_sets", with_ctes(BOOK_ORDERS_CTE) + """
SELECT customer_id, array_to_string(list_sort(list(DISTINCT order_id)), ',') AS orders_set,
       CAST(count(DISTINCT list_transform(books, lambda b: b.book_id)) AS INTEGER) AS n_book_lists
FROM bo GROUP BY customer_id
""")
def q_collect_sets(spark, d):
    o = shapes.book_orders(spark, d)
    return o.groupBy("customer_id").agg(
        F.array_join(G.collect_sorted_set("order_id").cast("array<string>"), ",").alias("orders_set"),
        # distinct arrays counted by a distributed distinct aggregate, not gathered in a set
        F.count_distinct(F.col("books.book_id")).cast("int").alias("n_book_lists"))


@query("flatten_sets", """
SELECT o_custkey AS customer_id,
       coalesce(string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)), '') AS books_set
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey
""")
def q_flatten_sets(spark, d):
    o = shapes.book_orders(spark, d)
    s = G.distinct_elements(o, ["customer_id"], F.col("books.book_id").cast("array<string>"), "books")
    return s.select("customer_id", F.array_join("books", ",").alias("books_set"))


# ---------------------------------------------------------------------------- SQL UDFs


@query("url_from_email", with_ctes(CUSTOMERS_CTE) + """
SELECT customer_id, email, 'https://www.' || nullif(split_part(email, '@', 2), '') AS domain FROM cu
""")
def q_url_from_email(spark, d):
    X.register_sql_functions(spark)
    shapes.customers(spark, d).createOrReplaceTempView("customers_v")
    return spark.sql("SELECT customer_id, email, get_url(email) AS domain FROM customers_v")


SITE_SQL = with_ctes(CUSTOMERS_CTE) + """
SELECT customer_id, CASE WHEN email IS NULL THEN NULL
    WHEN email LIKE '%.com' THEN 'Commercial business'
    WHEN email LIKE '%.org' THEN 'Non-profits organization'
    WHEN email LIKE '%.edu' THEN 'Educational institution'
    ELSE 'Unknow extenstion for domain: ' || split_part(email, '@', 2) END AS domain_category
FROM cu
"""


@query("site_type", SITE_SQL)
def q_site_type(spark, d):
    X.register_sql_functions(spark)
    shapes.customers(spark, d).createOrReplaceTempView("customers_v")
    return spark.sql("SELECT customer_id, site_type(email) AS domain_category FROM customers_v")


@query("site_type_column", SITE_SQL)
def q_site_type_column(spark, d):
    return shapes.customers(spark, d).select("customer_id", X.site_type("email").alias("domain_category"))


@query("letter_grade", """
SELECT c_custkey AS student_id, (c_acctbal + 1000) / 2750 AS gpa,
       CASE WHEN (c_acctbal + 1000) / 2750 >= 3.5 THEN 'A' WHEN (c_acctbal + 1000) / 2750 >= 2.75 THEN 'B'
            WHEN (c_acctbal + 1000) / 2750 >= 2 THEN 'C' ELSE 'F' END AS letter_grade
FROM customer
""")
def q_letter_grade(spark, d):
    X.register_sql_functions(spark)
    read_table(spark, d, "customer").createOrReplaceTempView("students_v")
    return spark.sql("SELECT c_custkey AS student_id, (c_acctbal + 1000) / 2750 AS gpa, "
                     "get_letter_grade((c_acctbal + 1000) / 2750) AS letter_grade FROM students_v")


# ---------------------------------------------------------------------------- time


@query("unix_time", """
SELECT event_id, epoch(date_trunc('second', ts))::BIGINT AS ts_sec,
       date_trunc('second', CAST(ts AS TIMESTAMP)) AS ts_from_unix,
       CAST(ts AS DATE) AS day
FROM events
""")
def q_unix_time(spark, d):
    e = read_table(spark, d, "events").select("event_id", F.unix_timestamp(F.col("ts").cast("timestamp"))
                                              .alias("ts_sec"))
    return e.select("event_id", "ts_sec", X.unix_seconds_to_ts("ts_sec").alias("ts_from_unix"),
                    X.unix_seconds_to_ts("ts_sec").cast("date").alias("day"))


@query("day_bucket", """
SELECT date_trunc('day', CAST(ts AS TIMESTAMP)) AS day, count(*) AS n FROM events GROUP BY 1
""")
def q_day_bucket(spark, d):
    e = read_table(spark, d, "events")
    return e.groupBy(X.day_bucket(F.col("ts").cast("timestamp")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("year_month", """
SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS n FROM orders GROUP BY 1
""")
def q_year_month(spark, d):
    o = read_table(spark, d, "orders")
    return o.groupBy(X.year_month(F.col("o_orderdate").cast("timestamp")).alias("year_month")).agg(
        F.count(F.lit(1)).alias("n"))


@query("epoch_ms", """
SELECT event_id, epoch_us(CAST(ts AS TIMESTAMP)) // 1000 AS ts_ms,
       date_trunc('millisecond', CAST(ts AS TIMESTAMP)) AS event_time FROM events
""")
def q_epoch_ms(spark, d):
    e = read_table(spark, d, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp"))
                                              .alias("ts_ms"))
    return e.select("event_id", "ts_ms", X.epoch_ms_to_ts("ts_ms").alias("event_time"))


@query("deadline_add", """
SELECT event_id, CAST(ts AS DATE) + 30 AS deadline FROM events
""")
def q_deadline_add(spark, d):
    e = read_table(spark, d, "events")
    return e.select("event_id", X.deadline(F.col("ts").cast("timestamp"), 30).alias("deadline"))


# ---------------------------------------------------------------------------- aggregation


@query("count_rows", "SELECT count(*) AS n FROM lineitem")
def q_count_rows(spark, d):
    return G.count_rows(read_table(spark, d, "lineitem"))


@query("group_count", """
SELECT event_type, count(user_id) AS n_users FROM events GROUP BY event_type
""")
def q_group_count(spark, d):
    return G.group_count(read_table(spark, d, "events"), ["event_type"], "user_id", "n_users")


@query("daily_group_sum", """
SELECT date_trunc('day', CAST(ts AS TIMESTAMP)) AS day, event_type, round(sum(value), 2) AS total_value
FROM events GROUP BY 1, 2
""")
def q_daily_group_sum(spark, d):
    e = read_table(spark, d, "events")
    return (e.groupBy(X.day_bucket(F.col("ts").cast("timestamp")).alias("day"), "event_type")
            .agg(F.round(F.sum("value"), 2).alias("total_value")))


@query("group_by_json_field", """
SELECT json_extract_string(props, '$.k') AS k, count(*) AS n, round(sum(value), 2) AS total_value
FROM events GROUP BY 1
""")
def q_group_by_json_field(spark, d):
    e = read_table(spark, d, "events")
    return e.groupBy(X.json_path("props", "k").alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total_value"))


@query("distinct_values", "SELECT DISTINCT event_type FROM events")
def q_distinct_values(spark, d):
    return G.distinct_values(read_table(spark, d, "events"), ["event_type"])


EVENT_TYPES = ["signup", "error", "click", "view", "purchase"]


@query("pivot_sum", "SELECT user_id, " + ", ".join(
    f"round(sum(value) FILTER (WHERE event_type = '{t}'), 2) AS {t}" for t in EVENT_TYPES)
    + " FROM events GROUP BY user_id")
def q_pivot_sum(spark, d):
    e = read_table(spark, d, "events").select("user_id", "event_type", "value")
    p = G.pivot_sum(e, ["user_id"], "event_type", EVENT_TYPES, "value")
    return p.select("user_id", *[F.round(t, 2).alias(t) for t in EVENT_TYPES])


@query("dedup_batch", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_dedup_batch(spark, d):
    li = read_table(spark, d, "lineitem")
    return G.dedup_batch(li, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


# ---------------------------------------------------------------------------- windows


@query("latest_per_key", with_ctes(CUSTOMER_FEED_CTE) + """
SELECT customer_id, email, first_name, city, country_code, balance, row_status, row_time FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) AS rn FROM cf)
WHERE rn = 1
""")
def q_latest_per_key(spark, d):
    return latest_per_key(shapes.customer_feed(spark, d), ["customer_id"], "row_time")


@query("latest_per_key_rank", with_ctes(CUSTOMER_FEED_CTE) + """
SELECT customer_id, email, first_name, city, country_code, balance, row_status, row_time FROM (
  SELECT *, rank() OVER (PARTITION BY customer_id ORDER BY row_time DESC) AS rk FROM cf)
WHERE rk = 1
""")
def q_latest_per_key_rank(spark, d):
    return latest_per_key(shapes.customer_feed(spark, d), ["customer_id"], "row_time", method="rank")


@query("latest_per_composite_key", """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, rank() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS rk FROM events)
WHERE rk = 1
""")
def q_latest_per_composite_key(spark, d):
    e = read_table(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return latest_per_key(e, ["user_id", "event_type"], "ts", method="rank")


# ---------------------------------------------------------------------------- sort / limit


@query("ordered_history", "SELECT o_custkey, o_orderdate, o_orderkey FROM orders")
def q_ordered_history(spark, d):
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return o.orderBy("o_custkey", "o_orderdate", "o_orderkey")


@query("top_k", """
SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id
ORDER BY n_events DESC, user_id LIMIT 10
""")
def q_top_k(spark, d):
    # the limit is the feature: a top-10 report; TakeOrderedAndProject keeps 10 rows per task
    read_table(spark, d, "events").createOrReplaceTempView("events_v")
    spark.sql("CREATE OR REPLACE TEMP VIEW top_users AS SELECT user_id, count(*) AS n_events "
              "FROM events_v GROUP BY user_id ORDER BY n_events DESC, user_id LIMIT 10")
    # the session view published as a global temp view and read from another session
    spark.table("top_users").createOrReplaceGlobalTempView("top_users")
    return spark.newSession().table("global_temp.top_users")


# ---------------------------------------------------------------------------- set operations

SLICE_A = "o_orderdate < TIMESTAMP '1998-01-01'"
SLICE_B = "o_orderdate >= TIMESTAMP '1997-01-01'"


def _slices(spark, d):
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderdate")
    a = o.filter(SLICE_A).select("o_custkey", "o_orderpriority")
    b = o.filter(SLICE_B).select("o_custkey", "o_orderpriority")
    return a, b


def _set_sql(op: str) -> str:
    return (f"SELECT o_custkey, o_orderpriority FROM orders WHERE {SLICE_A} {op} "
            f"SELECT o_custkey, o_orderpriority FROM orders WHERE {SLICE_B}")


@query("set_union", _set_sql("UNION"))
def q_set_union(spark, d):
    a, b = _slices(spark, d)
    return U.set_union(a, b)


@query("set_union_all", _set_sql("UNION ALL"))
def q_set_union_all(spark, d):
    a, b = _slices(spark, d)
    return U.set_union(a, b, distinct=False)


@query("set_intersect", _set_sql("INTERSECT"))
def q_set_intersect(spark, d):
    a, b = _slices(spark, d)
    return U.set_intersect(a, b)


@query("set_intersect_all", _set_sql("INTERSECT ALL"))
def q_set_intersect_all(spark, d):
    a, b = _slices(spark, d)
    return U.set_intersect(a, b, all=True)


@query("set_except", _set_sql("EXCEPT"))
def q_set_except(spark, d):
    a, b = _slices(spark, d)
    return U.set_except(a, b)


@query("set_except_all", _set_sql("EXCEPT ALL"))
def q_set_except_all(spark, d):
    a, b = _slices(spark, d)
    return U.set_except(a, b, all=True)


# ---------------------------------------------------------------------------- joins


@query("explode_join", """
SELECT l_orderkey AS order_id, l_partkey AS book_id, p_name AS title, p_brand AS author,
       CAST(l_quantity AS BIGINT) AS quantity
FROM lineitem JOIN part ON l_partkey = p_partkey
""")
def q_explode_join(spark, d):
    o = shapes.book_orders(spark, d)
    items = o.select("order_id", F.explode("books").alias("book"))  # subquery in FROM
    b = shapes.books(spark, d)
    return items.join(b, F.col("book.book_id") == b.book_id, "inner").select(
        "order_id", b.book_id, "title", "author", F.col("book.quantity").alias("quantity"))


@query("join_daily_amount", """
SELECT CAST(o_orderdate AS DATE) AS order_day, count(*) AS n_orders, round(sum(o_totalprice), 2) AS amount,
       count(DISTINCT c_nationkey) AS n_countries
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def q_join_daily_amount(spark, d):
    o = read_table(spark, d, "orders")
    c = read_table(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return (j.groupBy(F.col("o_orderdate").cast("date").alias("order_day"))
            .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("amount"),
                 F.countDistinct("c_nationkey").alias("n_countries")))


@query("left_enrich", with_ctes(CUSTOMERS_CTE) + """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, cu.email, cu.segment
FROM orders LEFT JOIN (SELECT * FROM cu WHERE email IS NOT NULL) cu ON o_custkey = cu.customer_id
""")
def q_left_enrich(spark, d):
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"),
                                              F.col("o_custkey").alias("customer_id"))
    c = shapes.customers(spark, d).filter(F.col("email").isNotNull()).select("customer_id", "email", "segment")
    return o.join(c, "customer_id", "left").select("order_id", "customer_id", "email", "segment")


@query("broadcast_lookup", with_ctes(CUSTOMERS_CTE) + """
SELECT customer_id, email, n_name AS country FROM cu JOIN nation ON country_code = n_nationkey
""")
def q_broadcast_lookup(spark, d):
    c = shapes.customers(spark, d)
    lk = shapes.country_lookup(spark, d)
    return J.broadcast_lookup(c, lk, F.col("country_code") == F.col("code")).select(
        "customer_id", "email", F.col("country").alias("country"))


URGENT = "o_orderpriority = '1-URGENT'"


@query("semi_join", f"""
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE {URGENT})
""")
def q_semi_join(spark, d):
    c = read_table(spark, d, "customer").select("c_custkey", "c_name")
    urgent = read_table(spark, d, "orders").filter(URGENT).select(F.col("o_custkey").alias("c_custkey"))
    return J.semi_join(c, urgent, "c_custkey")


@query("anti_join", f"""
SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE {URGENT} AND o_custkey = c_custkey)
""")
def q_anti_join(spark, d):
    c = read_table(spark, d, "customer").select("c_custkey", "c_name")
    urgent = read_table(spark, d, "orders").filter(URGENT).select(F.col("o_custkey").alias("c_custkey"))
    return J.anti_join(c, urgent, "c_custkey")


# ---------------------------------------------------------------------------- windows in time


TUMBLING_SQL = """
SELECT time_bucket(INTERVAL 5 MINUTE, CAST(ts AS TIMESTAMP)) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, CAST(ts AS TIMESTAMP)) + INTERVAL 5 MINUTE AS window_end,
       event_type, count(event_id) AS orders_count, round(avg(value), 4) AS avg_value
FROM events GROUP BY 1, 2, 3 {having}
"""


@query("tumbling_stats", TUMBLING_SQL.format(having=""))
def q_tumbling_stats(spark, d):
    from tidewell.streaming.stateful import tumbling_stats
    e = read_table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return tumbling_stats(e, "ts", ["event_type"], "event_id", "value")


@query("collect_set_lists", with_ctes(BOOK_ORDERS_CTE) + """
, lists AS (SELECT DISTINCT customer_id, array_to_string(list_transform(books, lambda b: b.book_id), ',') AS list FROM bo WHERE books IS NOT NULL)
SELECT customer_id, CAST(count(*) AS INTEGER) AS n_lists, string_agg(list, ';' ORDER BY list) AS book_lists FROM lists GROUP BY customer_id
""")
def q_collect_set_lists(spark, d):
    """The set of each customer's book lists themselves: distinct lists first, then one row each is gathered."""
    lists = shapes.book_orders(spark, d).filter("books IS NOT NULL").select("customer_id", F.col("books.book_id").alias("ids")).distinct()
    sets = lists.groupBy("customer_id").agg(F.collect_list("ids").alias("sets"))
    texts = F.array_sort(F.transform("sets", lambda ids: F.array_join(ids.cast("array<string>"), ",")))
    return sets.select("customer_id", F.size("sets").alias("n_lists"), F.array_join(texts, ";").alias("book_lists"))
