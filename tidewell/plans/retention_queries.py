"""Tables that forget on purpose: tombstones that expire."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.plans.common import CUSTOMER_FEED_CTE, with_ctes
from tidewell.plans.registry import query
from tidewell.session import scratch_path
from tidewell.sources import shapes
from tidewell.streaming.runner import land_files, run_available_now
from tidewell.streaming.tombstones import ExpiringApply

COLS = "customer_id, email, first_name, city, country_code, balance, row_time"
D9, D11, D21 = (f"TIMESTAMP '2024-01-{d:02d} 00:00:00'" for d in (9, 11, 21))
LATE_DAYS = "TIMESTAMP '2024-01-06 00:00:00'"
# deliveries in order: the middle third, days 9 and 10 after it (inside the horizon), the rest, and last the first five
# days, which are behind the horizon by then
DELIVERIES = [f"row_time >= {D11} AND row_time < {D21}", f"row_time >= {D9} AND row_time < {D11}", f"row_time >= {D21}",
              f"row_time < {LATE_DAYS}"]
HORIZON = "14 days"


def _customers(spark, d) -> ExpiringApply:
    feed = shapes.customer_feed(spark, d)
    landing, ckpt = scratch_path(spark, "landing-expiring"), scratch_path(spark, "checkpoint-expiring")
    kept = ExpiringApply(spark, scratch_path(spark, "expiring"), feed.drop("row_status").schema, ["customer_id"], "row_time",
                         "row_status = 'delete'", HORIZON)
    for part in DELIVERIES:
        land_files(feed.filter(part), "parquet", "landing-expiring", path=landing)
        run_available_now(spark.readStream.schema(feed.schema).parquet(landing), "expiring", checkpoint=ckpt,
                          foreach_batch=lambda batch, epoch: kept.apply(batch, epoch + 1))
    return kept


IN_TIME = f"row_time >= {D9}"
LIVE_CTE = f"""
live AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) AS rn FROM cf WHERE {IN_TIME}) x
         WHERE rn = 1 AND row_status <> 'delete'),
early AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY row_time DESC) AS rn FROM cf
          WHERE row_time < {LATE_DAYS}) x WHERE rn = 1)
"""


@query("apply_changes_expiring", with_ctes(CUSTOMER_FEED_CTE, LIVE_CTE) + f"SELECT {COLS} FROM live")
def q_apply_changes_expiring(spark, d):
    """Rows that come late inside the horizon revive no deleted key, and rows behind it are not inserted."""
    return _customers(spark, d).read()


@query("apply_changes_late", with_ctes(CUSTOMER_FEED_CTE, LIVE_CTE) + f"""
SELECT {COLS} FROM early WHERE row_status <> 'delete' AND customer_id NOT IN (SELECT customer_id FROM live)
""")
def q_apply_changes_late(spark, d):
    """The newest row of every key of the first days that has no live row: set aside, not lost."""
    return _customers(spark, d).late().drop("_tw_version")


@query("tombstones_kept", with_ctes(CUSTOMER_FEED_CTE) + f"""
, parts AS (SELECT *, CASE WHEN row_time >= {D21} THEN 3 WHEN row_time >= {D11} THEN 1 ELSE 2 END AS part FROM cf WHERE {IN_TIME}),
newest AS (SELECT *, row_number() OVER (PARTITION BY part, customer_id ORDER BY row_time DESC) AS rn FROM parts)
SELECT customer_id, row_time AS deleted_at FROM newest WHERE rn = 1 AND row_status = 'delete'
  AND CAST(row_time AS DATE) >= CAST((SELECT max(row_time) FROM cf) - INTERVAL 14 DAY AS DATE)
""")
def q_tombstones_kept(spark, d):
    """What is remembered of deletes in the end: those of the last horizon, by whole days."""
    return _customers(spark, d).tombstones().withColumnRenamed("_tw_seq", "deleted_at")
