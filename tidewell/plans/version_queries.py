"""Versioned reads over a change feed, and type-2 history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidewell.operators import changes as C
from tidewell.operators.scd2 import scd2_apply, scd2_current, scd2_history
from tidewell.plans.common import CUSTOMER_FEED_CTE, PRICE_FEED_CTE, with_ctes
from tidewell.plans.registry import query
from tidewell.session import scratch_path
from tidewell.sources import shapes
from tidewell.sources.tables import read_table

FEED_COLS = ["customer_id", "email", "first_name", "city", "country_code", "balance", "row_status", "row_time"]
FC = ", ".join(FEED_COLS)


def day_version(day: dt.date) -> int:
    """Commit version of a day: days since 1970-01-01 (one commit per day of feed)."""
    return (day - dt.date(1970, 1, 1)).days


V10, V12, V15, V20 = (day_version(dt.date(2024, 1, n)) for n in (10, 12, 15, 20))


def customer_change_feed(spark, d):
    """Change feed of the customers table kept by applying the feed one day per commit."""
    f = shapes.customer_feed(spark, d)
    return C.cdc_change_feed(f, ["customer_id"], "row_time", "row_status",
                             F.unix_date(F.to_date("row_time")))


def _pcols(prefix: str) -> str:
    return ", ".join(f"{prefix}.{c}" for c in FEED_COLS)


FEED_SQL_CTE = f"""
cfv AS (SELECT {FC}, CAST(date_diff('day', DATE '1970-01-01', CAST(row_time AS DATE)) AS INTEGER) AS _commit_version
        FROM cf),
cts AS (SELECT _commit_version, max(row_time) AS _commit_timestamp FROM cfv GROUP BY 1),
lastv AS (SELECT {FC}, _commit_version FROM (
   SELECT *, row_number() OVER (PARTITION BY customer_id, _commit_version ORDER BY row_time DESC) AS rn FROM cfv) x
   WHERE rn = 1),
seqd AS (SELECT *, lag(_commit_version) OVER (PARTITION BY customer_id ORDER BY _commit_version) AS prev_v FROM lastv),
pr AS (SELECT n.*, p.customer_id AS p_key, p.row_status AS p_status FROM seqd n
       LEFT JOIN lastv p ON p.customer_id = n.customer_id AND p._commit_version = n.prev_v),
ch AS (
  SELECT {_pcols('n')}, 'insert' AS _change_type, n._commit_version FROM pr n
   WHERE n.row_status <> 'delete' AND (n.p_key IS NULL OR n.p_status = 'delete')
  UNION ALL
  SELECT {_pcols('p')}, 'update_preimage', n._commit_version FROM pr n
   JOIN lastv p ON p.customer_id = n.customer_id AND p._commit_version = n.prev_v
   WHERE n.row_status <> 'delete' AND p.row_status <> 'delete'
  UNION ALL
  SELECT {_pcols('n')}, 'update_postimage', n._commit_version FROM pr n
   WHERE n.row_status <> 'delete' AND n.p_key IS NOT NULL AND n.p_status <> 'delete'
  UNION ALL
  SELECT {_pcols('p')}, 'delete', n._commit_version FROM pr n
   JOIN lastv p ON p.customer_id = n.customer_id AND p._commit_version = n.prev_v
   WHERE n.row_status = 'delete' AND p.row_status <> 'delete'),
feed AS (SELECT ch.*, cts._commit_timestamp FROM ch JOIN cts USING (_commit_version))
"""

FEED_SQL = with_ctes(CUSTOMER_FEED_CTE, FEED_SQL_CTE)


def state_sql(name: str, day_end: str) -> str:
    return f"""{name} AS (SELECT {FC} FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) AS rn
  FROM cf WHERE row_time < TIMESTAMP '{day_end}') x WHERE rn = 1 AND row_status <> 'delete')"""


@query("change_feed_history", FEED_SQL + "SELECT * FROM feed")
def q_change_feed_history(spark, d):
    return customer_change_feed(spark, d)


@query("changes_between", FEED_SQL + f"SELECT * FROM feed WHERE _commit_version BETWEEN {V10} AND {V12}")
def q_changes_between(spark, d):
    return C.changes_between(customer_change_feed(spark, d), V10, V12)


AS_OF_SQL = with_ctes(CUSTOMER_FEED_CTE, state_sql("st", "2024-01-16")) + "SELECT * FROM st"


@query("as_of_version", AS_OF_SQL)
def q_as_of_version(spark, d):
    return C.as_of_version(customer_change_feed(spark, d), ["customer_id"], V15)


@query("as_of_latest", with_ctes(CUSTOMER_FEED_CTE, state_sql("st", "2100-01-01")) + "SELECT * FROM st")
def q_as_of_latest(spark, d):
    """Replaying the whole feed gives the current state."""
    return C.as_of_version(customer_change_feed(spark, d), ["customer_id"])


@query("restore_version", AS_OF_SQL)
def q_restore_version(spark, d):
    state, _ = C.restore_version(customer_change_feed(spark, d), ["customer_id"], V15)
    return state


@query("restore_changes", with_ctes(CUSTOMER_FEED_CTE, state_sql("old", "2024-01-16"),
                                    state_sql("cur", "2100-01-01")) + f"""
SELECT {_pcols('o')}, 'insert' AS _change_type FROM old o WHERE customer_id NOT IN (SELECT customer_id FROM cur)
UNION ALL
SELECT {_pcols('c')}, 'delete' FROM cur c WHERE customer_id NOT IN (SELECT customer_id FROM old)
UNION ALL
SELECT {_pcols('c')}, 'update_preimage' FROM cur c JOIN old o USING (customer_id) WHERE c.row_time <> o.row_time
UNION ALL
SELECT {_pcols('o')}, 'update_postimage' FROM cur c JOIN old o USING (customer_id) WHERE c.row_time <> o.row_time
""")
def q_restore_changes(spark, d):
    _, changes = C.restore_version(customer_change_feed(spark, d), ["customer_id"], V15)
    return changes


@query("version_diff", with_ctes(CUSTOMER_FEED_CTE, state_sql("s20", "2024-01-21"), state_sql("s10", "2024-01-11"))
       + "SELECT * FROM s20 EXCEPT SELECT * FROM s10")
def q_version_diff(spark, d):
    return C.version_diff(customer_change_feed(spark, d), ["customer_id"], V20, V10)


@query("commit_summary", FEED_SQL + """
SELECT _commit_version, _commit_timestamp,
       count(*) FILTER (WHERE _change_type = 'insert') AS insert,
       count(*) FILTER (WHERE _change_type = 'update_preimage') AS update_preimage,
       count(*) FILTER (WHERE _change_type = 'update_postimage') AS update_postimage,
       count(*) FILTER (WHERE _change_type = 'delete') AS delete
FROM feed GROUP BY 1, 2
""")
def q_commit_summary(spark, d):
    return C.commit_summary(customer_change_feed(spark, d))


# ---------------------------------------------------------------------------- type 2

SCD2_SQL = with_ctes(PRICE_FEED_CTE) + """
, seq AS (SELECT *, lag(price) OVER (PARTITION BY book_id ORDER BY updated) AS prev_price FROM pf)
, starts AS (SELECT * FROM seq WHERE prev_price IS NULL OR price <> prev_price)
, hist AS (SELECT book_id, title, author, price, updated AS effective_date,
                  lead(updated) OVER (PARTITION BY book_id ORDER BY updated) AS end_date FROM starts)
"""
SCD2_COLS = "book_id, title, author, price, end_date IS NULL AS current, effective_date, end_date"
SPLIT = "TIMESTAMP '2024-01-16 00:00:00'"


@query("scd2_history", SCD2_SQL + f"SELECT {SCD2_COLS} FROM hist")
def q_scd2_history(spark, d):
    return scd2_history(shapes.price_feed(spark, d), "book_id", "price", "updated", ["title", "author"])


@query("scd2_upsert", SCD2_SQL + f"SELECT {SCD2_COLS} FROM hist")
def q_scd2_upsert(spark, d):
    f = shapes.price_feed(spark, d)
    from tidewell.plans.merge_queries import commit
    first = commit(scd2_history(f.filter(f"updated < {SPLIT}"), "book_id", "price", "updated",
                                ["title", "author"]))
    return scd2_apply(first, f.filter(f"updated >= {SPLIT}"), "book_id", "price", "updated",
                      ["title", "author"])


@query("scd2_current", SCD2_SQL + "SELECT book_id, title, author, price FROM hist WHERE end_date IS NULL")
def q_scd2_current(spark, d):
    h = scd2_history(shapes.price_feed(spark, d), "book_id", "price", "updated", ["title", "author"])
    return scd2_current(h, "book_id", "price", ["title", "author"])


@query("scd2_out_of_order", SCD2_SQL + f"SELECT {SCD2_COLS} FROM hist")
def q_scd2_out_of_order(spark, d):
    """The later half of the feed arrives first, the earlier half twice after it."""
    f = shapes.price_feed(spark, d)
    from tidewell.plans.merge_queries import commit
    first = commit(scd2_history(f.filter(f"updated >= {SPLIT}"), "book_id", "price", "updated", ["title", "author"]))
    late = f.filter(f"updated < {SPLIT}")
    return scd2_apply(first, late.unionByName(late), "book_id", "price", "updated", ["title", "author"])


@query("changes_between_stored", FEED_SQL + f"SELECT * FROM feed WHERE _commit_version BETWEEN {V10} AND {V20}")
def q_changes_between_stored(spark, d):
    """The same window of changes, read from a feed stored by version: only its partitions are scanned."""
    path = C.store_feed(customer_change_feed(spark, d), scratch_path(spark, "feed-by-version"))
    return C.changes_between(spark.read.parquet(path), V10, V20)


@query("snapshot_diff_digest", """
WITH b AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-01'),
a AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 < 10 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders)
SELECT a.*, 'insert' AS _change_type FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)
UNION ALL SELECT b.*, 'update_preimage' FROM b JOIN a USING (o_orderkey) WHERE a.o_totalprice <> b.o_totalprice
UNION ALL SELECT a.*, 'update_postimage' FROM b JOIN a USING (o_orderkey) WHERE a.o_totalprice <> b.o_totalprice
""")
def q_snapshot_diff_digest(spark, d):
    """Orders before and after a correction of some key ranges and new orders: only key ranges that differ are joined."""
    o = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    before = o.filter("o_orderdate < TIMESTAMP '1998-06-01'").drop("o_orderdate")
    after = o.drop("o_orderdate").withColumn("o_totalprice", F.when(F.expr("o_orderkey % 1000 < 10"), F.col("o_totalprice") + 1)
                                             .otherwise(F.col("o_totalprice")))
    return C.snapshot_diff_by_digest(before, after, ["o_orderkey"], bucket_by="o_orderkey DIV 10")
