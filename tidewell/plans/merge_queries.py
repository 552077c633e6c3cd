"""Row-change operators: MERGE forms, type-1 upserts, CDC, UPDATE/DELETE, change rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import cdc
from tidewell.operators.changes import snapshot_diff
from tidewell.operators.joins import broadcast_lookup
from tidewell.operators.merge import (Delete, Insert, Update, delete_in, delete_where, merge_insert_only,
                                      merge_into, update_where)
from tidewell.plans.common import CUSTOMER_FEED_CTE, CUSTOMERS_CTE, with_ctes
from tidewell.plans.registry import query
from tidewell.session import scratch_path
from tidewell.sources import shapes
from tidewell.sources.tables import read_table

URGENT = "o_orderpriority = '1-URGENT'"
# the customer feed is applied as two commits: everything before SPLIT, then the rest
SPLIT = "TIMESTAMP '2024-01-16 00:00:00'"
FEED_COLS = "customer_id, email, first_name, city, country_code, balance, row_status, row_time"


def _feed_halves(spark, d):
    f = shapes.customer_feed(spark, d)
    return f.filter(f"row_time < {SPLIT}"), f.filter(f"row_time >= {SPLIT}")


def _urgent_customers(spark, d):
    """Customers known to the urgent-order desk (target of the general MERGE)."""
    c = shapes.customers(spark, d)
    urgent = read_table(spark, d, "orders").filter(URGENT).select(F.col("o_custkey").alias("customer_id"))
    return c.join(urgent, "customer_id", "left_semi")


def _event_summary(spark, d):
    e = read_table(spark, d, "events")
    return e.groupBy(F.col("user_id").alias("customer_id")).agg(
        F.round(F.sum("value"), 2).alias("total"), F.count(F.lit(1)).alias("n"),
        F.max_by("event_type", "ts").alias("last_type"))


@query("merge_into", with_ctes(CUSTOMERS_CTE) + f"""
, tgt AS (SELECT * FROM cu WHERE customer_id IN (SELECT o_custkey FROM orders WHERE {URGENT}))
, src AS (SELECT user_id AS customer_id, round(sum(value), 2) AS total, count(*) AS n,
                 arg_max(event_type, ts) AS last_type FROM events GROUP BY user_id)
SELECT customer_id, email, name, country_code, segment, round(balance, 2) AS balance FROM (
  SELECT t.* FROM tgt t WHERE customer_id NOT IN (SELECT customer_id FROM src)
  UNION ALL
  SELECT t.customer_id, t.email, t.name, t.country_code,
         CASE WHEN s.total > 2000 THEN 'VIP' ELSE t.segment END, t.balance + s.total
  FROM tgt t JOIN src s USING (customer_id) WHERE s.last_type <> 'error'
  UNION ALL
  SELECT s.customer_id, NULL, 'new', 0, 'NEW', s.total FROM src s
  WHERE s.customer_id NOT IN (SELECT customer_id FROM tgt) AND s.n > 50)
""")
def q_merge_into(spark, d):
    r = merge_into(
        _urgent_customers(spark, d), _event_summary(spark, d), ["customer_id"],
        matched=[Delete("s.last_type = 'error'"),
                 Update("s.total > 2000", {"balance": "t.balance + s.total", "segment": "'VIP'"}),
                 Update(None, {"balance": "t.balance + s.total"})],
        not_matched=[Insert("s.n > 50", {"customer_id": "s.customer_id", "email": "NULL", "name": "'new'",
                                          "country_code": "0", "segment": "'NEW'", "balance": "s.total"})])
    return r.state.withColumn("balance", F.round("balance", 2))


def _backfill_inputs(spark, d):
    o = read_table(spark, d, "orders")
    span = o.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.min("o_orderdate").cast("timestamp").alias("first_order"),
        F.max("o_orderdate").cast("timestamp").alias("last_order"))
    tgt = (_urgent_customers(spark, d).join(span, "customer_id")
           .select("customer_id", "email", "name", F.col("first_order").alias("updated")))
    src = (read_table(spark, d, "customer").join(span, F.col("c_custkey") == F.col("customer_id"))
           .select("customer_id",
                   F.concat(F.lit("c"), F.col("customer_id").cast("string"), F.lit("@"),
                            F.lower("c_mktsegment"), F.lit(".com")).alias("email"),
                   F.col("c_name").alias("name"), F.col("last_order").alias("updated")))
    return tgt, src


@query("merge_backfill", with_ctes(CUSTOMERS_CTE) + f"""
, span AS (SELECT o_custkey AS customer_id, CAST(min(o_orderdate) AS TIMESTAMP) AS first_order,
                  CAST(max(o_orderdate) AS TIMESTAMP) AS last_order FROM orders GROUP BY 1)
, tgt AS (SELECT cu.customer_id, email, name, first_order AS updated FROM cu JOIN span USING (customer_id)
          WHERE cu.customer_id IN (SELECT o_custkey FROM orders WHERE {URGENT}))
, src AS (SELECT customer_id, 'c' || CAST(customer_id AS VARCHAR) || '@' || lower(c_mktsegment) || '.com' AS email,
                 c_name AS name, last_order AS updated FROM customer JOIN span ON c_custkey = customer_id)
SELECT t.customer_id, CASE WHEN t.email IS NULL AND s.email IS NOT NULL THEN s.email ELSE t.email END AS email,
       t.name, CASE WHEN t.email IS NULL AND s.email IS NOT NULL THEN s.updated ELSE t.updated END AS updated
FROM tgt t LEFT JOIN src s USING (customer_id)
UNION ALL
SELECT * FROM src WHERE customer_id NOT IN (SELECT customer_id FROM tgt)
""")
def q_merge_backfill(spark, d):
    tgt, src = _backfill_inputs(spark, d)
    r = merge_into(tgt, src, ["customer_id"],
                   matched=[Update("t.email IS NULL AND s.email IS NOT NULL",
                                   {"email": "s.email", "updated": "s.updated"})],
                   not_matched=[Insert()])
    return r.state


BOOK_COLS = "p_partkey AS book_id, p_name AS title, p_brand AS author, p_type AS category, p_retailprice AS price"


@query("merge_insert_only", f"""
SELECT {BOOK_COLS} FROM part WHERE p_size <= 25
UNION ALL
SELECT {BOOK_COLS} FROM part s WHERE p_type = 'ECONOMY'
  AND NOT EXISTS (SELECT 1 FROM part t WHERE t.p_size <= 25 AND t.p_partkey = s.p_partkey AND t.p_name = s.p_name)
""")
def q_merge_insert_only(spark, d):
    b = shapes.books(spark, d)
    # the catalogue as first loaded: the smaller-size books
    catalog = read_table(spark, d, "part").filter("p_size <= 25").select(
        F.col("p_partkey").alias("book_id"), F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"))
    once = merge_insert_only(catalog, b, ["book_id", "title"], "category = 'ECONOMY'").state
    # re-running the same merge inserts nothing more
    return merge_insert_only(once, b, ["book_id", "title"], "category = 'ECONOMY'").state


ORDER_SUM_SQL = """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS TIMESTAMP) AS order_timestamp, o_custkey AS customer_id,
       CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
       CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS total
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate, o_custkey
"""


@query("dedup_upsert", ORDER_SUM_SQL)
def q_dedup_upsert(spark, d):
    from tidewell.operators.aggregate import dedup_batch
    o = shapes.book_orders(spark, d).drop("books")
    loaded = o.filter("order_timestamp < TIMESTAMP '1998-01-01'")
    late = o.filter("order_timestamp >= TIMESTAMP '1997-01-01'")
    delivered = late.unionByName(late)  # the same files delivered twice
    batch = dedup_batch(delivered, ["order_id", "order_timestamp"])
    return merge_insert_only(loaded, batch, ["order_id", "order_timestamp"]).state


def commit(df):
    """The state a first commit leaves behind, written and read again as a table would be.  (A state
    handed on by ``checkpoint`` would carry the optimizer's size estimate of its plan along, and
    every join of a state with itself multiplies that.)"""
    path = scratch_path(df.sparkSession, "committed")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _empty_like(spark, df):
    return spark.createDataFrame([], df.schema)


def _customers_silver_src(spark, d, f):
    lk = shapes.country_lookup(spark, d)
    return (broadcast_lookup(f, lk, F.col("country_code") == F.col("code"), "inner")
            .select("customer_id", "email", "first_name", "city", "country", "balance", "row_status",
                    "row_time"))


SCD1_SQL = with_ctes(CUSTOMER_FEED_CTE) + """
SELECT customer_id, email, first_name, city, n_name AS country, balance, row_time FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) AS rn
  FROM cf WHERE row_status IN ('insert', 'update')) x
JOIN nation ON country_code = n_nationkey WHERE rn = 1
"""


@query("scd1_upsert", SCD1_SQL)
def q_scd1_upsert(spark, d):
    first, second = _feed_halves(spark, d)
    src1, src2 = _customers_silver_src(spark, d, first), _customers_silver_src(spark, d, second)
    cols = ["customer_id", "email", "first_name", "city", "country", "balance", "row_time"]
    target = _empty_like(spark, src1.select(*cols))
    s1 = commit(cdc.scd1_upsert(target, src1, ["customer_id"], "row_time").state)
    return cdc.scd1_upsert(s1, src2, ["customer_id"], "row_time").state


APPLY_SQL = with_ctes(CUSTOMER_FEED_CTE) + f"""
SELECT {FEED_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) AS rn FROM cf) x
WHERE rn = 1 AND row_status <> 'delete'
"""


@query("cdc_apply", APPLY_SQL)
def q_cdc_apply(spark, d):
    first, second = _feed_halves(spark, d)
    state = commit(cdc.apply_changes(first, ["customer_id"], "row_time", "row_status = 'delete'"))
    return cdc.cdc_apply(state, second, ["customer_id"], "row_time").state


@query("cdc_apply_late", with_ctes(CUSTOMER_FEED_CTE) + f"""
, now AS (SELECT {FEED_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) AS rn FROM cf) x
  WHERE rn = 1 AND row_status <> 'delete')
, late AS (SELECT {FEED_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) AS rn
    FROM cf WHERE row_time < {SPLIT}) x WHERE rn = 1 AND row_status <> 'delete')
SELECT * FROM now UNION ALL SELECT * FROM late WHERE customer_id NOT IN (SELECT customer_id FROM now)
""")
def q_cdc_apply_late(spark, d):
    """The older half of the feed arrives after the whole: neither its updates nor its deletes touch newer
    rows; keys that are gone come back by their old insert (the tombstoned form avoids that)."""
    feed = shapes.customer_feed(spark, d)
    first, _ = _feed_halves(spark, d)
    state = commit(cdc.apply_changes(feed, ["customer_id"], "row_time", "row_status = 'delete'"))
    return cdc.cdc_apply(state, first, ["customer_id"], "row_time").state


@query("merge_duplicate_source", """
SELECT c_custkey AS k, c_acctbal AS v FROM customer
UNION ALL SELECT user_id - 20, value FROM events WHERE user_id - 20 NOT IN (SELECT c_custkey FROM customer)
""")
def q_merge_duplicate_source(spark, d):
    """Many source rows match each target row and none of them fires: every target row stays, once.
    Source keys are shifted, so that the lowest find no customer and are inserted."""
    t = read_table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("v"))
    s = read_table(spark, d, "events").select((F.col("user_id") - 20).alias("k"), F.col("value").alias("v"))
    return merge_into(t, s, ["k"], matched=[Update("s.v > 1e12"), Delete("s.v < -1e12")], not_matched=[Insert()]).state


@query("apply_changes", APPLY_SQL)
def q_apply_changes(spark, d):
    # arrival order is irrelevant: the later half is listed first
    first, second = _feed_halves(spark, d)
    return cdc.apply_changes(second.unionByName(first), ["customer_id"], "row_time",
                             "row_status = 'delete'")


@query("apply_changes_except", with_ctes(CUSTOMER_FEED_CTE) + """
SELECT customer_id, email, first_name, city, country_code, balance, row_time FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) AS rn FROM cf) x
WHERE rn = 1 AND row_status <> 'delete'
""")
def q_apply_changes_except(spark, d):
    return cdc.apply_changes(shapes.customer_feed(spark, d), ["customer_id"], "row_time",
                             F.col("row_status") == "delete", except_cols=["row_status"])


STATE_AT_SPLIT = f"""
st1 AS (SELECT {FEED_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) AS rn
  FROM cf WHERE row_time < {SPLIT}) x WHERE rn = 1 AND row_status <> 'delete'),
src2 AS (SELECT {FEED_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) AS rn
  FROM cf WHERE row_time >= {SPLIT}) x WHERE rn = 1)
"""

CHANGES_SQL = with_ctes(CUSTOMER_FEED_CTE, STATE_AT_SPLIT) + f"""
SELECT t.*, 'delete' AS _change_type FROM st1 t JOIN src2 s USING (customer_id) WHERE s.row_status = 'delete'
UNION ALL
SELECT t.*, 'update_preimage' FROM st1 t JOIN src2 s USING (customer_id) WHERE s.row_status <> 'delete'
UNION ALL
SELECT s.*, 'update_postimage' FROM st1 t JOIN src2 s USING (customer_id) WHERE s.row_status <> 'delete'
UNION ALL
SELECT s.*, 'insert' FROM src2 s WHERE s.row_status <> 'delete'
  AND s.customer_id NOT IN (SELECT customer_id FROM st1)
"""


@query("change_feed", CHANGES_SQL)
def q_change_feed(spark, d):
    first, second = _feed_halves(spark, d)
    state = cdc.apply_changes(first, ["customer_id"], "row_time", "row_status = 'delete'")
    return cdc.cdc_apply(state, second, ["customer_id"], "row_time").changes


@query("snapshot_diff", CHANGES_SQL)
def q_snapshot_diff(spark, d):
    first, _ = _feed_halves(spark, d)
    feed = shapes.customer_feed(spark, d)
    before = cdc.apply_changes(first, ["customer_id"], "row_time", "row_status = 'delete'")
    after = cdc.apply_changes(feed, ["customer_id"], "row_time", "row_status = 'delete'")
    return snapshot_diff(before, after, ["customer_id"])


@query("update_where", """
SELECT c_custkey, c_name, CASE WHEN c_name LIKE 'Customer#0000001%' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal
FROM customer
""")
def q_update_where(spark, d):
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return update_where(c, "c_name LIKE 'Customer#0000001%'", {"c_acctbal": "c_acctbal + 100"}).state


@query("update_where_changes", """
SELECT c_custkey, c_name, c_acctbal, 'update_preimage' AS _change_type FROM customer WHERE c_name LIKE 'Customer#0000001%'
UNION ALL
SELECT c_custkey, c_name, c_acctbal + 100, 'update_postimage' FROM customer WHERE c_name LIKE 'Customer#0000001%'
""")
def q_update_where_changes(spark, d):
    c = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return update_where(c, "c_name LIKE 'Customer#0000001%'", {"c_acctbal": "c_acctbal + 100"}).changes


@query("delete_where", "SELECT * FROM orders WHERE NOT (o_orderstatus = 'F')")
def q_delete_where(spark, d):
    return delete_where(read_table(spark, d, "orders"), "o_orderstatus = 'F'").state


@query("delete_in", """
SELECT * FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events WHERE event_type = 'error')
""")
def q_delete_in(spark, d):
    c = read_table(spark, d, "customer")
    errs = read_table(spark, d, "events").filter("event_type = 'error'").select(F.col("user_id").alias("c_custkey"))
    return delete_in(c, errs, ["c_custkey"]).state


REQUESTS_SQL = with_ctes(CUSTOMER_FEED_CTE) + """
, req AS (SELECT customer_id, row_time AS request_timestamp, CAST(row_time AS DATE) + 30 AS deadline,
                 'requested' AS status FROM cf WHERE row_status = 'delete')
, done AS (SELECT DISTINCT customer_id FROM cf WHERE row_status = 'delete' AND row_time < TIMESTAMP '2024-01-16 00:00:00')
"""


@query("merge_status", REQUESTS_SQL + """
SELECT customer_id, request_timestamp, deadline,
       CASE WHEN customer_id IN (SELECT customer_id FROM done) THEN 'deleted' ELSE status END AS status
FROM req
""")
def q_merge_status(spark, d):
    from tidewell.streaming.deletes import delete_requests
    feed = shapes.customer_feed(spark, d)
    req = delete_requests(feed)
    done = (feed.filter(f"row_status = 'delete' AND row_time < {SPLIT}").select("customer_id").distinct())
    return merge_into(req, done, ["customer_id"], matched=[Update(None, {"status": "'deleted'"})],
                      check_cardinality=False).state


@query("scd1_upsert_cdf", None)
def q_scd1_upsert_cdf(spark, d):
    """Newest-wins upsert fed by change-feed rows (insert / update_postimage), composite
    key, ``_commit_timestamp`` kept as ``processed_timestamp``; two commits."""
    from tidewell.plans.version_queries import V15, customer_change_feed
    feed = (customer_change_feed(spark, d)
            .withColumnRenamed("_commit_timestamp", "processed_timestamp"))
    keys = ["customer_id", "country_code"]
    cols = [c for c in feed.columns if c not in ("_change_type", "_commit_version")]
    target = _empty_like(spark, feed.select(*cols))

    def step(tgt, part):
        src = part.drop("_commit_version")
        r = cdc.scd1_upsert(tgt, src, keys, "processed_timestamp", status_col="_change_type",
                            statuses=("insert", "update_postimage"), method="rank")
        return r.state

    feed = commit(feed)
    s1 = commit(step(target, feed.filter(F.col("_commit_version") <= V15)))
    return step(s1, feed.filter(F.col("_commit_version") > V15))


def _register_cdf_oracle():
    from tidewell.plans.registry import ORACLES
    from tidewell.plans.version_queries import FC, FEED_SQL
    ORACLES["scd1_upsert_cdf"] = (FEED_SQL + f"""
SELECT {FC}, _commit_timestamp AS processed_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id, country_code ORDER BY _commit_timestamp DESC) AS rn
  FROM feed WHERE _change_type IN ('insert', 'update_postimage')) x WHERE rn = 1""").strip()


_register_cdf_oracle()
